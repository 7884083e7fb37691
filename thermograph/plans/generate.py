"""Synthetic readings data set: generate, merge duplicates, write.

``n`` random readings are generated by the executors, readings of the same
(location, minute) are merged into their mean, and the result is written as a
``;`` CSV directory in time order with the header
``Location;Date Time;Temperature;Humidity``.

Usage::

    python -m thermograph.plans.generate --rows 100000 --out dataset/
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermograph.operators.readings import dedupe_readings, generate_readings
from thermograph.session import apply_job_conf
from thermograph.sinks.files import write_csv


def dataset(spark: SparkSession, n: int, seed: int = 7) -> DataFrame:
    merged = dedupe_readings(generate_readings(spark, n, seed))
    return merged.select(
        F.col("location").alias("Location"),
        F.date_format("dateTime", "yyyy-MM-dd HH:mm:ss").alias("Date Time"),
        F.col("temperature").alias("Temperature"),
        F.col("humidity").alias("Humidity"),
        F.col("dateTime").alias("_t"))


def write_dataset(spark: SparkSession, n: int, out: str, seed: int = 7) -> bool:
    """Write the data set ordered by time (a range-partitioned sort, so each
    output file holds one time range and the files are in order)."""
    df = dataset(spark, n, seed).orderBy("_t", "Location").drop("_t")
    return write_csv(df, out)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="generate a synthetic readings data set")
    ap.add_argument("--rows", type=int, default=100_000)
    ap.add_argument("--seed", type=int, default=7)
    ap.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    spark = (SparkSession.builder.appName("thermograph-generate")
             .config("spark.ui.enabled", "false").getOrCreate())
    apply_job_conf(spark)
    write_dataset(spark, args.rows, args.out, args.seed)


if __name__ == "__main__":
    main()
