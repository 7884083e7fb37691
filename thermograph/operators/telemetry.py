"""Telemetry messages: parsing, topic/location mapping, location assignment,
subscription filters and bridge routing.  All stateless column expressions
except the assignment join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.constants import CONF_PREFIX, DATA_PREFIX, SENSOR_ORG
from thermograph.functions.location import valid_location
from thermograph.operators.asof import as_of_join
from thermograph.functions.topics import (config_reply_topic, route_direction,
                                          sensor_location, topic_matches,
                                          topic_to_location)
from thermograph.sources.messages import PAYLOAD_SCHEMA


def parse_telemetry(messages: DataFrame, prefix: str = DATA_PREFIX, *,
                    keep_malformed: bool = False) -> DataFrame:
    """(topic, payload, arrival[, event_id]) -> readings.

    Output: [event_id,] location, dateTime, temperature, humidity, s_id, seq.
    A payload that is not JSON, or has no ``d`` object, is dropped unless
    ``keep_malformed`` (then its measures are null).  A missing field gives
    null for that field only."""
    j = F.from_json(F.col("payload"), PAYLOAD_SCHEMA)
    # Parse once: a generator output is a barrier for filter push-down, so a
    # filter on the parsed struct (ours, or one inferred from a later join)
    # does not copy the parse into the scan-side filter as well.
    parsed = messages.select("*", F.explode(F.array(j)).alias("_j"))
    if not keep_malformed:
        parsed = parsed.where(F.col("_j.d").isNotNull())
    lead = ["event_id"] if "event_id" in messages.columns else []
    return parsed.select(
        *lead,
        topic_to_location("topic", prefix).alias("location"),
        F.col("arrival").alias("dateTime"),
        F.col("_j.d.temp_c").alias("temperature"),
        F.col("_j.d.hum").alias("humidity"),
        F.col("_j.d.s_id").alias("s_id"),
        F.col("_j.d.seq").alias("seq"),
    )


def malformed(messages: DataFrame, needs_time: bool = False) -> DataFrame:
    """The messages that :func:`parse_telemetry` leaves out: no JSON, or no
    ``d`` object; with ``needs_time`` also those without an arrival time.  All their
    columns are kept."""
    j = F.from_json(F.col("payload"), PAYLOAD_SCHEMA)
    bad = F.col("_j.d").isNull()
    if needs_time:
        bad = bad | F.col("arrival").isNull()
    return messages.select("*", F.explode(F.array(j)).alias("_j")).where(bad).drop("_j")


def config_replies(requests: DataFrame, sensor_id: str = "sensor_id", *,
                   org: str = SENSOR_ORG, conf_prefix: str = CONF_PREFIX) -> DataFrame:
    """Location assignment: each request (a sensor id) gets a reply on the
    sensor's own topic carrying ``N/B/F/R`` (null when the id is out of
    range).  Output: sensor_id, topic, location."""
    return requests.select(
        F.col(sensor_id).alias("sensor_id"),
        config_reply_topic(sensor_id, conf_prefix).alias("topic"),
        sensor_location(sensor_id, org).alias("location"))


def telemetry_with_location(readings: DataFrame, replies: DataFrame) -> DataFrame:
    """Attach each sensor's assigned location (``/`` form turned into dots)
    to its telemetry rows, joined on the sensor id.

    For replies without times: a sensor has one location (the smallest, if replies
    name several; see :func:`telemetry_located` for histories).  Messages of sensors
    without a location are left out.  The join is left to the optimizer, whose
    adaptive execution switches it to a broadcast only when the measured assignment
    side is small."""
    dotted = F.replace("location", F.lit("/"), F.lit("."))
    assign = (replies.where(F.col("location").isNotNull()).groupBy("sensor_id")
              .agg(F.min(dotted).alias("assigned_location")))
    return readings.join(assign, readings["s_id"] == assign["sensor_id"], "inner") \
        .drop("sensor_id")


def telemetry_located(readings: DataFrame, history: DataFrame, *, tiebreak: str | None = None,
                      block_rows: int | None = None) -> DataFrame:
    """Each telemetry row once, with the location its sensor had at that time
    (``assigned_location``, dotted; null before the first assignment) and since when
    (``assigned_at``).

    ``history``: sensor_id, location (``/`` or dotted), assigned_at.  A sensor keeps
    its last location until it is given another; replies without a location change
    nothing.  An assignment counts from its own time on; of several at one time the
    one of the largest ``tiebreak`` does."""
    said = history.where(F.col("location").isNotNull()).select(
        F.col("sensor_id").alias("_sensor"), F.col("assigned_at"),
        F.replace("location", F.lit("/"), F.lit(".")).alias("assigned_location"),
        *([tiebreak] if tiebreak else []))
    return as_of_join(readings, said, "s_id", "_sensor", "dateTime", "assigned_at",
                      ["assigned_location", "assigned_at"], tiebreak=tiebreak, block_rows=block_rows)


def filter_topics(messages: DataFrame, prefix: str = DATA_PREFIX,
                  location: str | None = None) -> DataFrame:
    """Messages of one location (exact topic) or of every location under
    ``prefix`` (wildcard subscription)."""
    return messages.where(topic_matches("topic", prefix, location))


def route_topics(messages: DataFrame, data_prefix: str = DATA_PREFIX,
                 conf_prefix: str = CONF_PREFIX) -> DataFrame:
    """Adds ``direction``: "out" for data topics, "both" for configuration
    topics, null for topics the bridge does not carry."""
    return messages.withColumn("direction", route_direction("topic", data_prefix, conf_prefix))


def check_locations(df: DataFrame, location: str = "location") -> DataFrame:
    """Adds ``valid``: whether the text is an acceptable N.B.F.R location."""
    return df.withColumn("valid", valid_location(location))
