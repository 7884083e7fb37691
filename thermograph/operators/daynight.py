"""Day-versus-night means and differences per level of the hierarchy.

The difference is computed in ONE shuffle: a single aggregate by
(level key, day) with conditional sums for the day and night rows, instead of
aggregating by (daily, day, key) and joining the day side to the night side.
Map-side partial aggregation bounds what a hot key sends through the shuffle
to one row per (key, day) per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.constants import LEVEL_KEY
from thermograph.functions.exact import Held, cents_to_double, held, to_cents

MEASURES = ("temperature", "humidity")


def _key(level: str) -> str:
    return LEVEL_KEY[level]


def daily_means(df: DataFrame, level: str = "room") -> DataFrame:
    """Mean temperature and humidity per (daily, day, level key).

    Output: daily, day, <key>, avg_temp, avg_hum (half-even, two digits),
    n_rows.  ``df`` must be enriched (location + calendar)."""
    key = _key(level)
    how = held(df, *MEASURES)
    values = {p: c for m in MEASURES for p, c in how[m].values().items()}
    agg = df.groupBy("daily", "day", key).agg(
        *[F.sum(c).alias(f"_s_{p}") for p, c in values.items()],
        *[F.count(values[m]).alias(f"_n_{m}") for m in MEASURES],
        F.count(F.lit(1)).alias("n_rows"))
    temp, hum = (cents_to_double(how[m].mean("_s_{}".format, f"_n_{m}")) for m in MEASURES)
    return agg.select("daily", "day", key, temp.alias("avg_temp"), hum.alias("avg_hum"), "n_rows")


def _conditional_sums(how: dict[str, Held]) -> list:
    """Rows, sums and counts of the day (``_d``) and of the night (``_n``)."""
    out = []
    for side, rows in (("d", F.col("daily")), ("n", ~F.col("daily"))):
        out.append(F.count(F.when(rows, 1)).alias(f"_{side}n"))
        for m in MEASURES:
            values = how[m].values()
            out += [F.sum(F.when(rows, c)).alias(f"_{side}s_{p}") for p, c in values.items()]
            out.append(F.count(F.when(rows, values[m])).alias(f"_{side}n_{m}"))
    return out


def _diff_from_sums(agg: DataFrame, key: str, how: dict[str, Held]) -> DataFrame:
    # A null key never pairs a day side with a night side (an equality
    # match), so it has no difference.
    agg = agg.where((F.col("_dn") > 0) & (F.col("_nn") > 0) & F.col(key).isNotNull())
    cents = agg.select("day", key, *[
        how[m].mean(f"_{side}s_{{}}".format, f"_{side}n_{m}").alias(f"_{side}{m[0]}")
        for side in "dn" for m in MEASURES])
    return cents.select(
        "day", key,
        cents_to_double("_dt").alias("day_temp"), cents_to_double("_dh").alias("day_hum"),
        cents_to_double("_nt").alias("night_temp"), cents_to_double("_nh").alias("night_hum"),
        cents_to_double(F.col("_dt") - F.col("_nt")).alias("temp_diff"),
        cents_to_double(F.col("_dh") - F.col("_nh")).alias("hum_diff"))


def day_night_diff(df: DataFrame, level: str = "room") -> DataFrame:
    """Day mean, night mean and their difference per (day, level key).

    A (key, day) appears only when it has at least one daytime row and one
    night row (rows are counted, not non-null values, so an all-null measure
    gives a null mean and a null difference).  Means are rounded half-even to
    two digits before the difference; the difference of two-digit values is
    exact.  Output: day, <key>, day_temp, day_hum, night_temp, night_hum,
    temp_diff, hum_diff (DOUBLE).
    """
    key = _key(level)
    how = held(df, *MEASURES)
    agg = (df.where(F.col("daily").isNotNull())
           .groupBy(key, "day")
           .agg(*_conditional_sums(how)))
    return _diff_from_sums(agg, key, how)


def room_day_partials(df: DataFrame, how: dict[str, Held] | None = None) -> DataFrame:
    """Conditional sums per (room, day), carrying every coarser level key, of
    the whole numbers that hold the measures (``how``: :func:`held`).

    This is the only aggregate that reads the readings when all four levels
    are wanted: the coarser levels add these partial sums up (sums and counts
    compose; means would not)."""
    keys = [LEVEL_KEY[lv] for lv in ("room", "floor", "building", "neighborhood")]
    return (df.where(F.col("daily").isNotNull())
            .groupBy(*keys, "day")
            .agg(*_conditional_sums(how or held(df, *MEASURES))))


def day_night_diff_from_partials(partials: DataFrame, level: str = "room",
                                 how: dict[str, Held] | None = None) -> DataFrame:
    """:func:`day_night_diff` for one level from :func:`room_day_partials`;
    ``how``: as the readings' measures are held (two-digit units by default)."""
    key = _key(level)
    how = how or {m: Held(m) for m in MEASURES}
    if level == "room":
        return _diff_from_sums(partials, key, how)
    sums = [c for c in partials.columns if c.startswith("_")]
    agg = partials.groupBy(key, "day").agg(*[F.sum(c).alias(c) for c in sums])
    return _diff_from_sums(agg, key, how)


def day_night_diff_join(df: DataFrame, level: str = "room") -> DataFrame:
    """The same result as :func:`day_night_diff`, written as the day side
    joined to the night side (two readers of one aggregate).  Kept to check
    the one-shuffle form against it."""
    key = _key(level)
    means = daily_means(df, level)
    day = means.where(F.col("daily")).select(
        "day", key, F.col("avg_temp").alias("day_temp"), F.col("avg_hum").alias("day_hum"))
    night = means.where(~F.col("daily")).select(
        "day", key, F.col("avg_temp").alias("night_temp"), F.col("avg_hum").alias("night_hum"))
    j = day.join(night, ["day", key], "inner")
    return j.select(
        "day", key, "day_temp", "day_hum", "night_temp", "night_hum",
        cents_to_double(to_cents("day_temp") - to_cents("night_temp")).alias("temp_diff"),
        cents_to_double(to_cents("day_hum") - to_cents("night_hum")).alias("hum_diff"))


def day_night_diff_float(df: DataFrame, level: str = "room") -> DataFrame:
    """Single-precision variant: FLOAT measures, DOUBLE means rounded with
    ``bround`` and differences of the rounded means rounded again."""
    key = _key(level)
    means = (df.where(F.col("daily").isNotNull())
             .groupBy("daily", "day", key)
             .agg(F.avg(F.col("temperature").cast("float")).alias("t"),
                  F.avg(F.col("humidity").cast("float")).alias("h")))
    day = means.where(F.col("daily")).select(
        "day", key, F.bround("t", 2).alias("day_temp"), F.bround("h", 2).alias("day_hum"))
    night = means.where(~F.col("daily")).select(
        "day", key, F.bround("t", 2).alias("night_temp"), F.bround("h", 2).alias("night_hum"))
    j = day.join(night, ["day", key], "inner")
    return j.select("day", key, "day_temp", "day_hum", "night_temp", "night_hum",
                    F.bround(F.col("day_temp") - F.col("night_temp"), 2).alias("temp_diff"),
                    F.bround(F.col("day_hum") - F.col("night_hum"), 2).alias("hum_diff"))
