"""Session settings and shared storage locations.

Nothing here sets the master or any storage credential: the cluster owns those.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Dynamic partition overwrite makes a re-run of a
# day replace only that day; AQE re-plans joins on measured sizes (broadcast
# only when the materialised side is small), coalesces tiny shuffle partitions
# and splits skewed ones. Long listings go to tasks of many paths each; the default of
# up to 10,000 tasks costs more to schedule than to run.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the pipeline's session settings (idempotent)."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _jvm_context(spark: SparkSession):
    """The JVM SparkContext handle, or None (e.g. a Spark Connect session)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points at shared storage;
    a cluster session without it is an error, never a machine-local folder.
    Only a ``local`` master with the setting unset (local runs, tests) gets a
    fresh local folder, registered so that lineage cuts and scratch output
    still work.
    """
    sc = _jvm_context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        jdir = sc._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(
                "spark.checkpoint.dir is unset: a cluster job needs a shared folder for "
                "lineage cuts and scratch tables (set it to shared storage)")
        root = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


# Scratch folders handed out by this process, for ``clear_scratch``.
_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/marketlake-scratch/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has handed out; call it when no
    result that reads them is needed any more. Returns their number."""
    paths, _SCRATCH[:] = list(_SCRATCH), []
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as its object."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as file listings spell it: with its scheme, nothing escaped."""
    fs, hpath = file_system(spark, path)
    return fs.makeQualified(hpath).toString()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none if it does not exist)."""
    fs, hpath = file_system(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())


def any_path(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob pattern matches anything (metadata only)."""
    fs, hpath = file_system(spark, pattern)
    return bool(fs.globStatus(hpath))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = file_system(spark, path)
    fs.delete(hpath, True)


def note(spark: SparkSession, folder: str, name: str) -> None:
    """Leave an empty file ``name`` in ``folder`` in place of those that are there."""
    fs, hpath = file_system(spark, folder)
    _, mark = file_system(spark, f"{folder}/{name}")
    before = [s.getPath() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []
    fs.create(mark, True).close()
    for path in before:
        if path.getName() != name:
            fs.delete(path, False)


def notes(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files that ``note`` has left in ``folder``."""
    fs, hpath = file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not exist."""
    fs, src = file_system(spark, source)
    _, dst = file_system(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (metadata only); without
    a JVM handle, through a zero-row listing read."""
    sc = _jvm_context(spark)
    if sc is not None:
        jvm = sc._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
        return fs.exists(hpath)
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(path).select("path").limit(0).collect()
        return True
    except AnalysisException:
        return False
