"""Monthly means of the day/night differences and the month with the largest
mean temperature difference.

The month pools the same calendar month of every year (1..12).  The result of
the aggregate has at most twelve rows, so the maximum is taken by a window over
those rows, never by a round trip through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermograph.functions.exact import mean_2dp, to_cents


def _monthly_sums(diff: DataFrame) -> DataFrame:
    return (diff.groupBy(F.month("day").alias("month"))
            .agg(F.sum(to_cents("temp_diff")).alias("_st"),
                 F.count("temp_diff").alias("_nt"),
                 F.sum(to_cents("hum_diff")).alias("_sh"),
                 F.count("hum_diff").alias("_nh"),
                 F.count(F.lit(1)).alias("n_days")))


def monthly_diff_means(diff: DataFrame) -> DataFrame:
    """month INT, temp, hum (half-even two-digit means), n_days."""
    return _monthly_sums(diff).select(
        "month", mean_2dp("_st", "_nt").alias("temp"),
        mean_2dp("_sh", "_nh").alias("hum"), "n_days")


def max_month(diff: DataFrame) -> DataFrame:
    """month INT, temp DOUBLE: the month(s) whose unrounded mean temperature
    difference is the largest (ties all kept), the mean then rounded
    half-even to two digits.  Empty when there is no non-null mean."""
    sums = _monthly_sums(diff).where(F.col("_nt") > 0)
    # At most 12 rows: means are compared exactly, as s1 * n2 against s2 * n1.
    rows = F.collect_list(F.struct("_st", "_nt")).over(Window.partitionBy(F.lit(0)))
    wide = "DECIMAL(19,0)"
    beaten = F.exists("_all", lambda o: o["_st"].cast(wide) * F.col("_nt").cast(wide)
                      > F.col("_st").cast(wide) * o["_nt"].cast(wide))
    return (sums.withColumn("_all", rows).where(~beaten)
            .select("month", mean_2dp("_st", "_nt").alias("temp")))
