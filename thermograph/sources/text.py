"""Text sources: one record per file, or a table with a text column."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermograph.sources.readings import spread


def read_text_lines(spark: SparkSession, path: str, sep: str = "\n") -> DataFrame:
    """(doc STRING, text STRING): the pieces of each file, for files too large to be
    one row; a file is cut after each ``sep`` (newline or blank), whichever keeps
    pieces short, and its parts are read by as many tasks as it has splits.

    The pieces put together are the file: each ends with its separator, but for one at
    the end of a file that doesn't.  A separator at the end of a piece ends its last
    word and a separator inside one a word each, so that words, also the empty ones of
    runs of separators, are those of the whole file; an empty file is one empty piece.
    Which files end without a separator is known from their sizes, and their last
    piece by its place (one row per file)."""
    if sep not in (" ", "\n"):
        raise ValueError(f"no separator of words: {sep!r}")
    rows = spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("text"),
        F.col("_metadata.file_size").alias("_size"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("_place"))
    files = rows.groupBy("doc").agg(
        F.sum(F.octet_length("text") + 1).alias("_bytes"), F.max("_size").alias("_size"),
        F.max("_place").alias("_place"))
    # One byte more than the file has: its last piece has no separator.
    bare = files.where("_bytes > _size").select("doc", F.col("_place").alias("_last"))
    pieces = rows.join(bare, "doc", "left").select("doc", F.when(
        F.col("_last").eqNullSafe(F.col("_place")), F.col("text")
    ).otherwise(F.concat("text", F.lit(sep))).alias("text"))
    return pieces.unionByName(_empty_files(spark, path, files))


def _empty_files(spark: SparkSession, path: str, seen: DataFrame) -> DataFrame:
    """(doc, text): the files under ``path`` that are not in ``seen`` (doc): scans
    leave out empty ones, the list of files that the scan is planned from has them."""
    def plain(c):  # file:/x and file:///x
        return F.regexp_replace(c, "^([a-zA-Z][a-zA-Z0-9+.-]*):/+", "$1:/")

    names = [(f,) for f in spark.read.text(path).inputFiles()]
    listed = spark.createDataFrame(names, "doc string").select(plain(F.col("doc")).alias("doc"))
    seen = seen.select(plain(F.col("doc")).alias("doc"))
    return listed.join(seen, "doc", "left_anti").select("doc", F.lit("").alias("text"))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc STRING, text STRING): each file is one whole record, for files that
    fit one row; see ``read_text_lines`` for larger ones."""
    rows = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("text"))
    seen = rows.select("doc").distinct()
    return rows.unionByName(_empty_files(spark, path, seen))


def documents(spark: SparkSession, sf_dir: str, *, spread_rows: bool = True) -> DataFrame:
    """(doc_id, text) of the driver's ``documents`` table.

    Texts are CPU-heavy per row (tokenizing, letter counts), so when the
    table arrives in fewer splits than cores the rows are spread first."""
    df = (spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
          .select("doc_id", "text"))
    return spread(df) if spread_rows else df
