"""Batch sinks: semicolon CSV directories and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from thermograph.session import delete_path


def write_csv(df: DataFrame, path: str, *, skip_empty: bool = True,
              mode: str = "overwrite", sep: str = ";", header: bool = True) -> bool:
    """Write ``df`` as a ``;``-separated CSV directory with a header.

    With ``skip_empty`` an empty result leaves no directory behind.  The
    result is computed once: it is written, then the written files are probed
    for a first row (a probe of ``df`` itself would run its whole plan a
    second time), and the directory is removed when there is none.  Returns
    whether the result was kept."""
    df.write.mode(mode).option("header", str(header).lower()).option("sep", sep).csv(path)
    if not skip_empty:
        return True
    spark = df.sparkSession
    back = spark.read.option("header", str(header).lower()).option("sep", sep).csv(path)
    if back.isEmpty():
        delete_path(spark, path)
        return False
    return True


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def preview(df: DataFrame, n: int = 20) -> None:
    """Console preview of the first rows (``show``)."""
    df.show(n, truncate=False)
