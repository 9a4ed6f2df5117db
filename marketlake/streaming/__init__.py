"""Structured Streaming ingest into the Bronze layer."""

from marketlake.streaming.bronze_ingest import bronze_batch_writer, prepare_bronze, start_bronze_stream

__all__ = ["bronze_batch_writer", "prepare_bronze", "start_bronze_stream"]
