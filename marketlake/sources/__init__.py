"""Readers: Bronze scans, landed page bodies, layer tables, stream sources, and
the adapter that maps the shared test tables onto the snapshot record shape."""

from marketlake.sources.bronze import explode_pages, pack_pages, read_bronze
from marketlake.sources.tables import read_table
from marketlake.sources.ticks import ticks_from_events, read_ticks
from marketlake.sources.stream import landing_stream, page_stream, rate_trigger_stream, with_landing_time

__all__ = [
    "explode_pages",
    "pack_pages",
    "read_bronze",
    "read_table",
    "ticks_from_events",
    "read_ticks",
    "landing_stream",
    "page_stream",
    "rate_trigger_stream",
    "with_landing_time",
]
