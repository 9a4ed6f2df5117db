"""Writers: Bronze JSON append, layer publish (dynamic partition overwrite),
newline-JSON batch files, page bodies, compaction, folding of closed Bronze hours."""

from marketlake.sinks.writers import (
    append_bronze,
    compact,
    fold_bronze,
    land_pages,
    publish,
    write_ndjson,
)

__all__ = ["append_bronze", "compact", "fold_bronze", "land_pages", "publish", "write_ndjson"]
