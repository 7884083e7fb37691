"""Reading-level operators: merging duplicate readings, synthetic readings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermograph.constants import (GEN_END, GEN_FLOORS, GEN_HUMIDITY, GEN_LETTERS,
                                   GEN_START, GEN_TEMPERATURE)
from thermograph.functions.exact import Held, held


def dedupe_readings(df: DataFrame, location: str = "location",
                    ts: str = "dateTime") -> DataFrame:
    """One reading per (location, time): the mean of its duplicates.

    The mean is the nearest DOUBLE to the exact quotient of sum and count, so it is
    the same in every engine.  Output: location, dateTime, temperature, humidity,
    n_readings.  Ordering is left to the sink."""
    measures = ("temperature", "humidity")
    how = held(df, *measures)
    values = {p: c for m in measures for p, c in how[m].values().items()}
    agg = df.groupBy(location, ts).agg(
        *[F.sum(c).alias(f"_s_{p}") for p, c in values.items()],
        *[F.count(values[m]).alias(f"_n_{m}") for m in measures],
        F.count(F.lit(1)).alias("n_readings"))
    return agg.select(location, ts, *[_quotient(how[m]).alias(m) for m in measures], "n_readings")


def _quotient(how: Held) -> Column:
    """Sum by count as DOUBLE; digits are divided as whole numbers of any size, in
    batches, as no engine type holds them."""
    n = F.col(f"_n_{how.name}")
    if not how.base:
        one = F.lit(10 ** how.scale)
        return F.col(f"_s_{how.name}").cast("double") / (n * one).cast("double")

    @F.pandas_udf("double")
    def divide(*columns: pd.Series) -> pd.Series:
        out = []
        for *sums, count in zip(*columns, strict=True):
            total, one = how.exact([int(x) for x in sums]) if count else (0, 1)
            out.append(total / (one * int(count)) if count else None)
        return pd.Series(out, dtype="float64")

    zero = [F.coalesce(F.col(f"_s_{p}"), F.lit(0)) for p in how.parts]
    return F.when(n > 0, divide(*zero, n))


def generate_readings(spark: SparkSession, n: int, seed: int = 7,
                      num_partitions: int | None = None) -> DataFrame:
    """``n`` synthetic readings: random 5x5x5x5 location, random minute in the
    generation period, temperature and humidity uniform at two digits.

    Built on ``spark.range`` so the rows are generated by the executors."""
    base = spark.range(0, n, numPartitions=num_partitions) if num_partitions else spark.range(0, n)
    start = F.unix_seconds(F.to_timestamp(F.lit(GEN_START)))
    end = F.unix_seconds(F.to_timestamp(F.lit(GEN_END)))
    letters = F.array(*[F.lit(c) for c in GEN_LETTERS])
    floors = F.array(*[F.lit(c) for c in GEN_FLOORS])

    def pick(arr, s):
        return F.element_at(arr, (F.floor(F.rand(seed + s) * 5) + 1).cast("int"))

    minutes = F.floor(F.rand(seed + 10) * ((end - start) / 60 + 1)).cast("bigint")
    t_lo, t_hi = GEN_TEMPERATURE
    h_lo, h_hi = GEN_HUMIDITY
    return base.select(
        F.concat_ws(".", pick(letters, 1), pick(letters, 2), pick(floors, 3),
                    pick(letters, 4)).alias("location"),
        F.timestamp_seconds(start + minutes * 60).alias("dateTime"),
        F.round(F.lit(t_lo) + F.rand(seed + 20) * (t_hi - t_lo), 2)
        .cast("decimal(10,2)").alias("temperature"),
        F.round(F.lit(h_lo) + F.rand(seed + 30) * (h_hi - h_lo), 2)
        .cast("decimal(10,2)").alias("humidity"),
    )
