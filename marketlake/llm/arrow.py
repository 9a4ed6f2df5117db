"""Rows out of tasks, as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marketlake.llm.common import ship_by_value

ship_by_value(__name__)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def batched(rows: Iterator[dict], schema: pa.Schema, size: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Rows (dicts; absent columns are null) in batches of at most ``size``."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
