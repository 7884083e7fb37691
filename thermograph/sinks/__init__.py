"""Sinks: CSV/Parquet for batch results, per-epoch writers for streams."""

from thermograph.sinks.files import preview, write_csv, write_parquet
from thermograph.sinks.streams import epoch_parquet_writer

__all__ = ["epoch_parquet_writer", "preview", "write_csv", "write_parquet"]
