"""Reading sources: the semicolon CSV of readings, and the sensor view over
the driver's ``events`` table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermograph.constants import SENSOR_ORG
from thermograph.session import is_small

SPREAD_BYTES = 256 * 1024 * 1024
SPREAD_PARTS = 16


def readings_schema(measure_type: T.DataType | None = None,
                    time_type: T.DataType | None = None) -> T.StructType:
    """location STRING, dateTime TIMESTAMP, temperature, humidity.

    ``measure_type`` defaults to DECIMAL(30,18): eighteen places are kept exactly.
    A narrower DECIMAL is cheaper to add up; ``DoubleType()`` and ``FloatType()``
    read the nearest binary value.
    """
    m = measure_type or T.DecimalType(30, 18)
    return T.StructType([
        T.StructField("location", T.StringType(), True),
        T.StructField("dateTime", time_type or T.TimestampType(), True),
        T.StructField("temperature", m, True),
        T.StructField("humidity", m, True),
    ])


def read_readings_csv(spark: SparkSession, path: str, *,
                      measure_type: T.DataType | None = None,
                      time_type: T.DataType | None = None,
                      timestamp_format: str | None = None) -> DataFrame:
    """``;``-separated readings with a header, bound to the schema by position
    (header names are ignored, so ``Date Time`` and ``dateTime`` both load).

    Times parse with Spark's default rules (``yyyy-MM-dd HH:mm`` and
    ``yyyy-MM-dd HH:mm:ss`` both work) unless ``timestamp_format`` is given."""
    r = (spark.read.schema(readings_schema(measure_type, time_type))
         .option("header", "true").option("sep", ";")
         .option("enforceSchema", "true"))
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    return r.csv(path)


def read_readings_checked(spark: SparkSession, path: str, *,
                          measure_type: T.DataType | None = None,
                          time_type: T.DataType | None = None,
                          timestamp_format: str | None = None) -> DataFrame:
    """All rows of ``path``, readable or not: the columns of
    :func:`read_readings_csv`, ``file``, ``raw`` (the row as text) and ``reason``.

    ``reason`` is null for a good row, else what is wrong first: ``columns`` (not
    four), ``location`` (missing), ``time``, ``temperature`` or ``humidity`` (not of the
    type, or of more digits than it holds).  An empty time or measure is missing, not
    wrong.  Good and bad rows together are the rows of the input."""
    schema = readings_schema(measure_type, time_type)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]
                         + [T.StructField("_corrupt", T.StringType())])
    rows = (spark.read.schema(texts).option("header", "true").option("sep", ";")
            .option("enforceSchema", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").csv(path)
            .select("*", F.col("_metadata.file_path").alias("file")))
    names = [f.name for f in schema]
    place, time, *measures = schema
    parsed = {}
    if timestamp_format:
        parsed[time.name] = F.try_to_timestamp(time.name, F.lit(timestamp_format)).cast(time.dataType)
    else:
        parsed[time.name] = F.col(time.name).try_cast(time.dataType)
    bad = [("columns", F.col("_corrupt").isNotNull()), ("location", F.col(place.name).isNull()),
           ("time", F.col(time.name).isNotNull() & parsed[time.name].isNull())]
    for m in measures:
        text = F.trim(F.col(m.name))
        parsed[m.name] = text.try_cast(m.dataType)
        wrong = parsed[m.name].isNull()
        if isinstance(m.dataType, T.DecimalType):
            # A cast would round what is behind the last place.
            wrong = wrong | (text.try_cast("decimal(38,30)") != parsed[m.name]) | (
                F.length(F.regexp_extract(text, r"\.(\d*?)0*\z", 1)) > m.dataType.scale)
        bad.append((m.name, F.col(m.name).isNotNull() & F.coalesce(wrong, F.lit(False))))
    reason = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in bad])
    raw = F.coalesce("_corrupt", F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in names]))
    out = rows.withColumns({"reason": reason, "raw": raw, **{f"_{c}": v for c, v in parsed.items()}})
    return out.select(place.name, *[F.col(f"_{c}").alias(c) for c in parsed], "file", "raw", "reason")


def accepted(checked: DataFrame) -> DataFrame:
    """The readings of :func:`read_readings_checked` that are good."""
    return checked.where("reason is null").drop("file", "raw", "reason")


def rejected(checked: DataFrame) -> DataFrame:
    """(file, raw, reason) of the rows that are not."""
    return checked.where("reason is not null").select("file", "raw", "reason")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows of an input of up to ``SPREAD_BYTES`` (the
    optimizer's estimate) over ``SPREAD_PARTS`` partitions: one row group of a
    small table is a single split.  A larger or unknown size is left as it is;
    the plan depends on no number of cores."""
    if is_small(df, SPREAD_BYTES):
        return df.repartition(SPREAD_PARTS)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def location_from_user(user_id: str = "user_id"):
    """Room of the sensor view: four binary location parts from user id bits."""
    u = F.col(user_id)

    def bit(div: int):
        return F.pmod(F.floor(u / div).cast("bigint"), F.lit(2)).cast("string")

    return F.concat(F.chr(F.lit(65) + F.pmod(u, F.lit(2))), F.lit("."), bit(2),
                    F.lit("."), bit(4), F.lit("."), bit(8))


def sensor_id_from_user(user_id: str = "user_id", org: str = SENSOR_ORG):
    """``<org>-abcd`` with digits a, b, c in 0..3 and a room digit d."""
    u = F.col(user_id)

    def digit(div: int, mod: int):
        return F.pmod(F.floor(u / div).cast("bigint"), F.lit(mod)).cast("string")

    return F.concat(F.lit(f"{org}-"), digit(1, 4), digit(4, 4), digit(16, 4), digit(1, 10))


def sensor_readings(spark: SparkSession, sf_dir: str, *,
                    with_sensor: bool = False, spread_rows: bool = False) -> DataFrame:
    """Readings derived from ``events`` (one reading per event).

    location from user-id bits (16 rooms), dateTime = ts + (event_id % 12) * 30
    days (all twelve months occur), temperature = 10 + value % 27.5 and
    humidity = (7 * value) % 100, both DECIMAL(10,2).
    """
    ev = table(spark, sf_dir, "events")
    if spread_rows:
        ev = spread(ev)
    cols = [
        F.col("event_id"),
        location_from_user().alias("location"),
        (F.col("ts") + F.make_dt_interval(
            days=(F.pmod(F.col("event_id"), F.lit(12)) * 30).cast("int"))).alias("dateTime"),
        (F.lit(10) + F.col("value") % 27.5).cast("decimal(10,2)").alias("temperature"),
        ((F.col("value") * 7) % 100).cast("decimal(10,2)").alias("humidity"),
    ]
    if with_sensor:
        cols.append(sensor_id_from_user().alias("sensor_id"))
    return ev.select(*cols)
