"""Rewriting partition folders of a table without losing data.

New files are written to a work folder beside the table, their row counts are
compared with those of the old ones, and only then are folders swapped: the old
one moves aside, the new one takes its place. Until the last swap is done every
row exists in a folder that ``recover`` knows, so a driver that dies in between
loses nothing. One job at a time rewrites a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.session import child_folders, delete_path, move_folder, path_exists

WORK_SUFFIX = "__rewrite"


def _leaves(spark: SparkSession, base: str, depth: int, below: str = "") -> list[str]:
    """Partition folders ``depth`` levels below ``base``, as relative paths."""
    if depth == 0:
        return [below]
    here = f"{base}/{below}" if below else base
    return [leaf for name in child_folders(spark, here) if "=" in name
            for leaf in _leaves(spark, base, depth - 1, f"{below}/{name}" if below else name)]


def recover(spark: SparkSession, path: str, depth: int) -> int:
    """Finish or undo swaps that were interrupted; returns the folders moved back.

    A folder that was moved aside and has no successor in the table goes back to
    its place; everything else in the work folder is then superfluous."""
    work = f"{path.rstrip('/')}{WORK_SUFFIX}"
    back = 0
    for run in child_folders(spark, work):
        old = f"{work}/{run}/old"
        for leaf in _leaves(spark, old, depth):
            if not path_exists(spark, f"{path}/{leaf}"):
                move_folder(spark, f"{old}/{leaf}", f"{path}/{leaf}")
                back += 1
    if path_exists(spark, work):
        delete_path(spark, work)
    return back


def rewrite_folders(
    spark: SparkSession,
    path: str,
    folders: list[str],
    keys: list[str],
    read: Callable[[str, list[str]], DataFrame],
    write: Callable[[DataFrame, str], None],
) -> None:
    """Rewrite the partition ``folders`` (relative to ``path``).

    ``read(base, folders)`` reads folders of the table or of its copy,
    ``write(df, base)`` writes the copy. The rows of every combination of the
    partition columns ``keys`` are counted on both sides before the swap."""
    path = path.rstrip("/")
    work = f"{path}{WORK_SUFFIX}/{uuid.uuid4().hex}"
    old, new = f"{work}/old", f"{work}/new"
    rows = read(path, folders)
    write(rows, new)
    made = [f for f in folders if path_exists(spark, f"{new}/{f}")]
    if _counts(rows, keys) != (_counts(read(new, made), keys) if made else {}):
        delete_path(spark, work)
        raise RuntimeError(f"rewriting {path}: the copy does not hold the same rows; nothing was changed")
    for folder in folders:
        move_folder(spark, f"{path}/{folder}", f"{old}/{folder}")
        if folder in made:  # a folder whose files hold no rows has no copy
            move_folder(spark, f"{new}/{folder}", f"{path}/{folder}")
    delete_path(spark, f"{path}{WORK_SUFFIX}")


def _counts(df: DataFrame, keys: list[str]) -> dict:
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*keys).count().collect()}
