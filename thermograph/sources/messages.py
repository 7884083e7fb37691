"""Message sources.

Messages are rows ``(topic, payload, arrival)``; a broker client is not part
of this library.  In batch they are built from readings (the shape a sensor
publishes); as a stream they are read from files that a connector lands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermograph.constants import DATA_PREFIX
from thermograph.functions.topics import location_to_topic

MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("payload", T.StringType(), True),
    T.StructField("arrival", T.TimestampNTZType(), True),
])

# JSON body of a telemetry message; "Def Route" has a space in its name.
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("d", T.StructType([
        T.StructField("s_id", T.StringType(), True),
        T.StructField("seq", T.IntegerType(), True),
        # As sent: eighteen places, so that limits are compared before any rounding.
        T.StructField("temp_c", T.DecimalType(30, 18), True),
        T.StructField("hum", T.DecimalType(30, 18), True),
        T.StructField("Def Route", T.StringType(), True),
    ]), True),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("sensor_id", T.StringType(), True),
    T.StructField("arrival", T.TimestampNTZType(), True),
])


def telemetry_messages(readings: DataFrame, prefix: str = DATA_PREFIX,
                       route: str = "fe80::1") -> DataFrame:
    """What each sensor publishes for a reading: topic from its location and
    a JSON payload; ``readings`` needs event_id, location, dateTime,
    temperature, humidity and sensor_id."""
    body = F.struct(
        F.col("sensor_id").alias("s_id"),
        F.pmod(F.col("event_id"), F.lit(1 << 20)).cast("int").alias("seq"),
        F.col("temperature").alias("temp_c"),
        F.col("humidity").alias("hum"),
        F.lit(route).alias("Def Route"),
    )
    return readings.select(
        "event_id",
        location_to_topic("location", prefix).alias("topic"),
        F.to_json(F.struct(body.alias("d"))).alias("payload"),
        F.col("dateTime").alias("arrival"),
    )


def read_message_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(event_id, topic, payload, arrival)`` from landed files."""
    r = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_request_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Streaming configuration requests ``(sensor_id, arrival)``."""
    return spark.readStream.schema(REQUEST_SCHEMA).format(fmt).load(path)
