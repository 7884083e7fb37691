"""Spark helpers shared by the operators: written intermediate tables,
connected components, and grouped reading of sorted partitions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermograph.session import delete_path, scratch_path


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut
    and its parts survive a lost executor."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sorted_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each value of ``column`` as a table, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        values = batch.column(column).to_numpy(zero_copy_only=False)
        i = 0
        while i < len(values):
            # Sorted: the run of values[i] ends at the first larger one.
            j = i + int((values[i:] == values[i]).sum())
            if held and values[i] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = values[i]
            held.append(batch.slice(i, j - i))
            i = j
    if held:
        yield pa.Table.from_batches(held)


def components(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b: BIGINT); the label is the
    same within a component and is one of its nodes.

    Each round every node points to its smallest neighbour (if smaller),
    pointers are followed twice, and edges are drawn between what is pointed
    to; edges inside one label go.  Labels of all rounds are composed."""
    folder = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    parts = iter(range(1 << 30))

    def kept(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(parts)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    left = kept(edges.select("a", "b").where("a <> b").distinct())
    labels = None
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p"))
        hook = kept(hook.select(F.col("a").alias("node"), "p"))
        for _ in range(2):
            up = hook.select(F.col("node").alias("p"), F.col("p").alias("q"))
            hook = hook.join(up, "p", "left").select("node", F.coalesce("q", "p").alias("p"))
        hook = kept(hook)
        if labels is None:
            labels = hook.select("node", F.col("p").alias("label"))
        else:
            step = hook.select(F.col("node").alias("label"), F.col("p").alias("q"))
            labels = labels.join(step, "label", "left").select(
                "node", F.coalesce("q", "label").alias("label"))
        labels = kept(labels)
        a = hook.select(F.col("node").alias("a"), F.col("p").alias("la"))
        b = hook.select(F.col("node").alias("b"), F.col("p").alias("lb"))
        left = (left.join(a, "a").join(b, "b")
                .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
                .where("a <> b").distinct())
        left = kept(left)
        if left.isEmpty():
            break
    out = written(spark, labels, f"{name}-labels")
    delete_path(spark, folder)  # the rounds' tables; the result no longer needs them
    return out


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str, limit: int = 500_000) -> DataFrame:
    """``docs`` without the rows whose id is in ``ids`` (one column, a written
    table); it is broadcast if it has at most ``limit`` rows."""
    key = free_name(docs, "_out")
    ids = ids.toDF(key)
    side = F.broadcast(ids) if ids.count() <= limit else ids
    return docs.join(side, docs[id_col].eqNullSafe(F.col(key)), "left_anti")


def with_length(docs: DataFrame, text_col: str, length_col: str) -> DataFrame:
    """``docs`` with ``length_col``, if it has one, set to the length of the text."""
    if length_col not in docs.columns:
        return docs
    return docs.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
