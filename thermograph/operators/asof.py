"""As-of join: to each row what was last said about its key.

Rows of both sides are put into one order (key, time, side) and the last values are
carried forward.  A key may hold a large share of all rows, so for large inputs the
order is cut into blocks by row count (``operators.blocks``): a window by (block, key)
carries inside a block, and one row per (block, key) carries between blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermograph.operators.actuators import TARGET_ROWS, time_order
from thermograph.operators.blocks import BLOCK, row_blocks, target_rows
from thermograph.session import is_small, key_parts


def as_of_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str,
               right_time: str, values: list[str], *, tiebreak: str | None = None,
               block_rows: int | None = None) -> DataFrame:
    """Each row of ``left`` once, with the ``values`` of the last row of ``right`` that
    has its key and a time up to its own; null if there is none.

    Of several such rows at one time the one of the largest ``tiebreak`` counts, then
    the one of the largest values.  A missing time is before every other; a missing
    key has nothing.  ``block_rows``: rows of a block; by default one window partition
    per key for inputs that the optimizer estimates small, else
    ``spark.thermograph.bucketRows``."""
    if block_rows is None and not (is_small(left) and is_small(right)):
        block_rows = target_rows(left, TARGET_ROWS)
    taken = [c for c in values if c in left.columns]
    if taken:
        raise ValueError(f"both sides have {taken}")
    tie = F.struct(*([tiebreak] if tiebreak else []), *values)
    said = right.where(F.col(right_key).isNotNull()).select(
        F.col(right_key).alias("_key"), time_order(right_time).alias("_ord"), F.lit(0).alias("_side"),
        F.struct(*values).alias("_v"), tie.alias("_tie"))
    rows = left.select(F.col(left_key).alias("_key"), time_order(left_time).alias("_ord"),
                       F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"),
                       F.xxhash64(*left.columns).alias("_any"))
    both = said.unionByName(rows, allowMissingColumns=True).withColumns(key_parts("_key"))
    order = ["_ord", "_side", "_tie"]
    part = ["_kn", "_kv"]
    if block_rows is not None:
        # Rows of the left side have no order at one time: any even deal will do.
        both = row_blocks(both, [*part, *order, "_any"], block_rows, "as_of_blocks")
        part = [BLOCK, *part]
    now = Window.partitionBy(*part).orderBy(*order)
    now = now.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("_v", ignorenulls=True)
    out = both.withColumn("_now", last.over(now))
    if block_rows is not None:
        before = (Window.partitionBy("_kn", "_kv").orderBy(BLOCK)
                  .rowsBetween(Window.unboundedPreceding, -1))
        carry = both.where("_side = 0").groupBy(*part).agg(
            F.max_by("_v", F.struct("_ord", "_tie")).alias("_v"))
        # Blocks without anything said pass on what came in.
        carry = both.select(*part).distinct().join(carry, part, "left")
        carry = carry.select(*part, last.over(before).alias("_carry"))
        out = out.join(carry, part).withColumn("_now", F.coalesce("_now", "_carry"))
    out = out.where("_side = 1").withColumn("_now", F.when(~F.col("_kn"), F.col("_now")))
    return out.select("_l.*", *[F.col(f"_now.{c}").alias(c) for c in values])
