"""Property tests on generated snapshot sets."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from marketlake.functions.columns import ingestion_metadata
from marketlake.operators.gold import hourly_fact
from marketlake.operators.silver import silver_from_bronze
from marketlake.schema import PAYLOAD_SCHEMA

SCHEMA = StructType(PAYLOAD_SCHEMA.fields + [StructField("ingestion_ts", TimestampType())])
BASE = dt.datetime(2024, 1, 14)

row = st.tuples(
    st.sampled_from(["a", "b", "c"]),                         # id
    st.floats(-10, 1000, allow_nan=False, width=32),          # price
    st.integers(0, 3 * 24 * 60 - 1),                          # minute offset (3 days)
    st.one_of(st.none(), st.integers(1, 5)),                  # rank
)


def _df(spark, rows):
    data = [(i, i.upper(), f"Asset {i}", float(p), float(p) * 10, 1.0, 0.0, 0.0, r, float(p) + 1,
             float(p) - 1, BASE + dt.timedelta(minutes=m)) for i, p, m, r in rows]
    return ingestion_metadata(spark.createDataFrame(data, SCHEMA))


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_silver_keys_unique_and_idempotent(spark, rows):
    df = _df(spark, rows)
    silver = silver_from_bronze(df).drop("_processed_at")
    keys = silver.groupBy("id", "dt", "hour").count()
    assert keys.filter("count > 1").count() == 0
    assert silver.count() == df.select("id", "dt", "hour").distinct().count()
    again = silver_from_bronze(silver).drop("_processed_at")
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, silver.collect()))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_fact_counts_and_bounds(spark, rows):
    fact = hourly_fact(_df(spark, rows))
    agg = fact.agg(F.sum("total_registros").alias("n"),
                   F.count_if(~((F.col("preco_min") <= F.col("preco_medio") + 1e-9)
                                & (F.col("preco_medio") <= F.col("preco_max") + 1e-9))).alias("bad")).first()
    assert agg.n == len(rows)
    assert agg.bad == 0
