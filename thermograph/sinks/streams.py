"""Streaming sinks: idempotent per-epoch appends through ``foreachBatch``."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame


def epoch_parquet_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None
                         ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each micro-batch to
    ``<path>/epoch=<id>`` with overwrite, so a replayed epoch (after a
    failure) replaces its own output instead of duplicating it."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(os.path.join(path, f"epoch={epoch_id}"))
    return write
