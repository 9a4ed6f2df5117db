"""Bronze inputs: landed API page bodies and the partitioned JSON layer.

The collector's pages (JSON arrays of up to 250 asset objects) land as text;
executors parse them with a fixed schema, so nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from marketlake.schema import BRONZE_SCHEMA, PAGE_SIZE, PAYLOAD_FIELDS, PAYLOAD_SCHEMA
from marketlake.session import child_folders, path_exists

PAGE_ARRAY = ArrayType(PAYLOAD_SCHEMA)


def explode_pages(
    pages: DataFrame,
    body_col: str = "body",
    keep: list[str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Parse page bodies and emit one row per asset object.

    Extra keys in an object are ignored, missing keys become null (schema-driven
    projection). A body that is not a JSON array (an error object, text, null) is
    a failed page and is skipped; null elements and objects without an ``id`` are
    dropped. ``observation`` counts ``pages``, ``malformed_pages`` and
    ``dropped_items`` in the same pass. ``keep`` names page-level columns (fetch
    time, page id) carried to each row.
    """
    keep = list(keep or [])
    body = F.col(body_col)
    items = F.when(body.rlike(r"^\s*\["), F.from_json(body, PAGE_ARRAY))
    parsed = pages.select(*keep, items.alias("_items"))
    usable = F.filter("_items", lambda x: x.isNotNull() & x["id"].isNotNull())
    if observation is not None:
        parsed = parsed.observe(
            observation,
            F.count(F.lit(1)).alias("pages"),
            F.count_if(F.col("_items").isNull()).alias("malformed_pages"),
            F.coalesce(F.sum(F.size("_items") - F.size(usable)), F.lit(0)).alias("dropped_items"),
        )
    return (
        parsed.filter(F.col("_items").isNotNull())
        .select(*keep, F.explode(usable).alias("_item"))
        .select(*keep, *[F.col("_item")[f].alias(f) for f in PAYLOAD_FIELDS])
    )


def pack_pages(
    records: DataFrame,
    page_key: F.Column,
    extra_fields: dict[str, F.Column] | None = None,
    carry: dict[str, F.Column] | None = None,
) -> DataFrame:
    """Group records into page bodies (JSON arrays), the shape the market API
    returns. ``page_key`` must bound the page size (at most ``PAGE_SIZE`` rows
    per key), so no page is an unbounded group. ``extra_fields`` adds keys the
    reader must ignore; ``carry`` adds page-level aggregates (e.g. fetch time)."""
    obj = F.struct(*[F.col(f) for f in PAYLOAD_FIELDS],
                   *[c.alias(k) for k, c in (extra_fields or {}).items()])
    aggs = [F.to_json(F.collect_list(obj)).alias("body"),
            F.count(F.lit(1)).alias("n_items")]
    aggs += [c.alias(k) for k, c in (carry or {}).items()]
    return records.groupBy(page_key.alias("page_id")).agg(*aggs)


def page_key_by_sequence(seq_col: str, page_size: int = PAGE_SIZE) -> F.Column:
    """Page number from a dense sequence column: ``seq div page_size``."""
    return F.floor(F.col(seq_col) / F.lit(page_size)).cast("long")


def read_bronze(
    spark: SparkSession,
    base: str,
    dates: str | list[str] | None = None,
) -> DataFrame:
    """Scan the Bronze JSON layer with its fixed schema.

    With ``dates`` only the folders of those days are listed and read, whatever
    else the layer holds. A missing layer or day gives an empty frame, not an
    error.
    """
    if not path_exists(spark, base):
        return spark.createDataFrame([], BRONZE_SCHEMA)
    reader = spark.read.schema(BRONZE_SCHEMA)
    if dates is None:
        return reader.json(base)
    base = base.rstrip("/")
    days = [f"{base}/dt={d}" for d in ([dates] if isinstance(dates, str) else dates)]
    days = [d for d in dict.fromkeys(days) if path_exists(spark, d)]
    if not days:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return reader.option("basePath", base).json(days)


#: Folder of the rows without a time: no day holds them.
UNTIMED = "dt=__HIVE_DEFAULT_PARTITION__"


def days_present(spark: SparkSession, base: str) -> list[str]:
    """The days that the Bronze layer holds, from its folders. Rows without a time
    belong to no day (see ``untimed_rows``)."""
    return [d[3:] for d in child_folders(spark, base) if d.startswith("dt=") and d != UNTIMED]


def untimed_rows(spark: SparkSession, base: str) -> DataFrame:
    """The Bronze rows whose time is missing or unreadable. They are written beside the
    days by the same append, so a replay replaces them too; no daily job reads them."""
    folder = f"{base.rstrip('/')}/{UNTIMED}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return spark.read.schema(BRONZE_SCHEMA).option("basePath", base).json(folder)


def filter_dates(df: DataFrame, dates: str | list[str] | None, col: str = "dt") -> DataFrame:
    if dates is None:
        return df
    if isinstance(dates, str):
        return df.filter(F.col(col) == F.to_date(F.lit(dates)))
    return df.filter(F.col(col).isin([F.to_date(F.lit(d)) for d in dates]))
