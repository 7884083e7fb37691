"""Registry of named queries over the driver's tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.  The
matching DuckDB statement lives in :mod:`thermograph.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermograph.constants import LEVEL_KEY, LEVELS
from thermograph.operators.daynight import daily_means, day_night_diff
from thermograph.operators.enrich import enrich, enrich_calendar, enrich_location
from thermograph.operators.months import max_month, monthly_diff_means
from thermograph.operators.moving import moving_average
from thermograph.operators.readings import dedupe_readings
from thermograph.operators.subscriptions import match_messages
from thermograph.operators import actuators as act
from thermograph.operators import telemetry as tel
from thermograph.operators import words
from thermograph.constants import CONF_PREFIX, DATA_PREFIX
from thermograph.functions.topics import location_to_topic, sensor_location, topic_to_location
from thermograph.plans import oracle
from thermograph.sources.messages import telemetry_messages
from thermograph.sources.readings import location_from_user, sensor_readings
from thermograph.sources.text import documents

# Location used by the single-location subscription query.
EXACT_LOCATION = "B.1.0.1"

Query = Callable[[SparkSession, str], DataFrame]


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(sensor_readings(spark, sf_dir))


def _measures_as_double(df: DataFrame) -> DataFrame:
    """Registered results carry measures as DOUBLE (the nearest double of the
    two-digit value), a type every engine reports the same way."""
    return df.withColumns({m: F.col(m).cast("double") for m in ("temperature", "humidity")})


def q_scan_readings(spark, sf_dir):
    return _measures_as_double(sensor_readings(spark, sf_dir))


def q_enrich_location(spark, sf_dir):
    return enrich_location(sensor_readings(spark, sf_dir)).select(
        "event_id", "fullRoomLocation", "neighborhood", "building", "floor", "room",
        "fullFloorLocation", "fullBuildingLocation")


def q_enrich_calendar(spark, sf_dir):
    return enrich_calendar(sensor_readings(spark, sf_dir)).select(
        "event_id", "dateTime", "hour", "day", "week", "month", "year", "night", "daily")


def q_bround_measures(spark, sf_dir):
    r = sensor_readings(spark, sf_dir)
    return r.select("event_id",
                    F.bround("temperature", 1).cast("double").alias("temperature_1dp"),
                    F.bround("humidity", 1).cast("double").alias("humidity_1dp"))


def q_mean_daily(level, spark, sf_dir):
    return daily_means(_enriched(spark, sf_dir), level)


def q_diff(level, spark, sf_dir):
    return day_night_diff(_enriched(spark, sf_dir), level)


def q_monthly_diff(level, spark, sf_dir):
    return monthly_diff_means(day_night_diff(_enriched(spark, sf_dir), level))


def q_max_month(level, spark, sf_dir):
    return max_month(day_night_diff(_enriched(spark, sf_dir), level))


def q_moving(horizon, level, spark, sf_dir):
    return moving_average(_enriched(spark, sf_dir), level, horizon)


def q_dedupe_readings(spark, sf_dir):
    return dedupe_readings(sensor_readings(spark, sf_dir))


def _messages(spark, sf_dir):
    # JSON writing and parsing is CPU-heavy per row: spread a coarse scan.
    return telemetry_messages(sensor_readings(spark, sf_dir, with_sensor=True, spread_rows=True))


def _mixed(spark, sf_dir):
    """Data messages, configuration requests and replies in one stream."""
    r = sensor_readings(spark, sf_dir, with_sensor=True)
    data = r.select("event_id", F.lit("data").alias("kind"),
                    location_to_topic("location").alias("topic"))
    req = r.select("event_id", F.lit("request").alias("kind"), F.lit(CONF_PREFIX).alias("topic"))
    rep = r.select("event_id", F.lit("reply").alias("kind"),
                   F.concat(F.lit(CONF_PREFIX + "/"), F.col("sensor_id")).alias("topic"))
    return data.unionByName(req).unionByName(rep)


def q_word_count(spark, sf_dir):
    return words.word_count(documents(spark, sf_dir))


def q_word_count_per_doc(spark, sf_dir):
    return words.word_count_per_doc(documents(spark, sf_dir))


def q_distinct_words_per_doc(spark, sf_dir):
    return words.distinct_words_per_doc(documents(spark, sf_dir))


def q_corpus_sizes(spark, sf_dir):
    return words.corpus_sizes(documents(spark, sf_dir))


def q_letter_count(spark, sf_dir):
    return words.letter_count(documents(spark, sf_dir))


def q_parse_telemetry(spark, sf_dir):
    return _measures_as_double(tel.parse_telemetry(_messages(spark, sf_dir)))


def q_topic_to_location(spark, sf_dir):
    m = telemetry_messages(sensor_readings(spark, sf_dir, with_sensor=True))
    return m.select("event_id", "topic", topic_to_location("topic").alias("location"))


def q_location_to_topic(spark, sf_dir):
    r = sensor_readings(spark, sf_dir)
    return r.select("event_id", "location", location_to_topic("location").alias("topic"))


def q_sensor_location(spark, sf_dir):
    r = sensor_readings(spark, sf_dir, with_sensor=True)
    return r.select("event_id", "sensor_id", sensor_location("sensor_id").alias("location"))


def q_config_replies(spark, sf_dir):
    req = sensor_readings(spark, sf_dir, with_sensor=True).select("sensor_id").distinct()
    return tel.config_replies(req)


def q_topic_filter_exact(spark, sf_dir):
    return tel.filter_topics(_mixed(spark, sf_dir), DATA_PREFIX, EXACT_LOCATION)


def q_topic_filter_wildcard(spark, sf_dir):
    return tel.filter_topics(_mixed(spark, sf_dir), DATA_PREFIX)


def q_route_topics(spark, sf_dir):
    return tel.route_topics(_mixed(spark, sf_dir))


def q_valid_location(spark, sf_dir):
    r = sensor_readings(spark, sf_dir)
    cand = r.select("event_id", F.explode(F.array(
        F.struct(F.lit(0).alias("variant"), F.col("location").alias("candidate")),
        F.struct(F.lit(1).alias("variant"), F.lower("location").alias("candidate")),
        F.struct(F.lit(2).alias("variant"),
                 F.replace("location", F.lit("."), F.lit("/")).alias("candidate")))).alias("c"))
    return tel.check_locations(cand.select("event_id", "c.variant", "c.candidate"), "candidate")


def q_telemetry_with_location(spark, sf_dir):
    parsed = tel.parse_telemetry(_messages(spark, sf_dir))
    req = sensor_readings(spark, sf_dir, with_sensor=True).select("sensor_id")
    return _measures_as_double(tel.telemetry_with_location(parsed, tel.config_replies(req)))


def q_telemetry_located(spark, sf_dir, block_rows=None):
    """Signups assign a sensor the room that their number names."""
    parsed = tel.parse_telemetry(_messages(spark, sf_dir))
    kind = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'signup'").select("event_id")
    history = (sensor_readings(spark, sf_dir, with_sensor=True).join(kind, "event_id")
               .select("sensor_id", location_from_user("event_id").alias("location"),
                       F.col("dateTime").alias("assigned_at"), F.col("event_id").alias("reply_id")))
    out = tel.telemetry_located(parsed, history, tiebreak="reply_id", block_rows=block_rows)
    return _measures_as_double(out).select("event_id", "s_id", "dateTime", "temperature",
                                           "assigned_location", "assigned_at")


def q_match_subscriptions(spark, sf_dir):
    """All topics against patterns that the rooms' locations give: the room, a floor
    of any building, a room of any floor, a neighborhood, everything and others."""
    messages = _mixed(spark, sf_dir)
    rooms = sensor_readings(spark, sf_dir).select(F.split("location", r"\.").alias("p")).distinct()
    n, b, f, r = (F.get("p", F.lit(i)) for i in range(4))
    patterns = rooms.select(F.explode(F.array(
        F.concat(F.lit(DATA_PREFIX), F.array_join("p", "/")),
        F.concat(F.lit(DATA_PREFIX), n, F.lit("/+/"), f, F.lit("/#")),
        F.concat(F.lit(DATA_PREFIX), n, F.lit("/"), b, F.lit("/+/"), r),
        F.concat(F.lit(DATA_PREFIX), n, F.lit("/#")),
        F.concat(F.lit("+/+/"), n, F.lit("/#")), F.lit(CONF_PREFIX + "/#"), F.lit(CONF_PREFIX + "/+"),
        F.lit("#"), F.lit("+"), F.lit(CONF_PREFIX), F.lit("a#"), F.lit(""))).alias("pattern"))
    return match_messages(messages, patterns).select("event_id", "kind", "topic", "pattern")


def q_transitions(metric, spark, sf_dir):
    return act.actuator_transitions(sensor_readings(spark, sf_dir), metric)


def q_actuator_events(spark, sf_dir):
    return act.actuator_events(sensor_readings(spark, sf_dir))


def q_actuator_state(spark, sf_dir):
    return act.actuator_states(sensor_readings(spark, sf_dir))


def _four_digits(spark, sf_dir, with_sensor=False):
    """Readings whose measures have four digits (whole numbers of 0.0001, by a rule
    from ``events``)."""
    base = F.round(F.col("value") * 100).cast("bigint")
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", base.alias("_b"))
    units = {"temperature": (F.col("_b") * 37 + F.col("event_id")) % 400000,
             "humidity": (F.col("_b") * 53 + F.col("event_id")) % 1000000}
    rows = sensor_readings(spark, sf_dir, with_sensor=with_sensor).drop("temperature", "humidity")
    return rows.join(ev, "event_id").withColumns({
        m: (u.cast("decimal(12,0)") / 10000).cast("decimal(10,4)") for m, u in units.items()}).drop("_b")


def q_mean_daily_4dp(spark, sf_dir):
    return daily_means(enrich(_four_digits(spark, sf_dir)), "room")


def q_moving_4dp(spark, sf_dir):
    return moving_average(enrich(_four_digits(spark, sf_dir)), "room", "day", strategy="prefix")


def q_parse_telemetry_4dp(spark, sf_dir):
    messages = telemetry_messages(_four_digits(spark, sf_dir, with_sensor=True))
    return _measures_as_double(tel.parse_telemetry(messages))


def q_transitions_4dp(spark, sf_dir):
    """Limits are held against what was sent, with all its digits."""
    messages = telemetry_messages(_four_digits(spark, sf_dir, with_sensor=True))
    return act.actuator_transitions(tel.parse_telemetry(messages), "temperature")


def _unrounded(spark, sf_dir):
    """Enriched readings whose measures are the unrounded DOUBLE of ``events``."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.col("value").alias("temperature"), (F.col("value") / 7).alias("humidity"))
    rows = sensor_readings(spark, sf_dir).drop("temperature", "humidity")
    return enrich(rows.join(ev, "event_id"))


def q_mean_daily_double(spark, sf_dir):
    return daily_means(_unrounded(spark, sf_dir), "room")


def q_diff_double(spark, sf_dir):
    return day_night_diff(_unrounded(spark, sf_dir), "floor")


def q_moving_double(spark, sf_dir):
    return moving_average(_unrounded(spark, sf_dir), "room", "day", strategy="prefix")


def q_moving_by(strategy, horizon, spark, sf_dir):
    return moving_average(_enriched(spark, sf_dir), "neighborhood", horizon, strategy=strategy)


def q_actuator_state_bucketed(spark, sf_dir):
    return act.actuator_states(sensor_readings(spark, sf_dir), bucket_us=act.HOUR_US)


def q_actuator_state_blocks(spark, sf_dir):
    return act.actuator_states(sensor_readings(spark, sf_dir), block_rows=act.TARGET_ROWS)


def q_transitions_bucketed(spark, sf_dir):
    return act.actuator_transitions(sensor_readings(spark, sf_dir), "temperature",
                                    bucket_us=act.DAY_US)


def q_malformed_telemetry(spark, sf_dir):
    """Payloads cut short or without a body, by rule; the messages set aside."""
    n = F.col("event_id")
    broken = _messages(spark, sf_dir).withColumn("payload", F.when(
        n % 7 == 0, F.substring("payload", 1, 5)).when(n % 11 == 0, "{}").otherwise(F.col("payload")))
    return tel.malformed(broken).select("event_id", "topic")


def _register() -> tuple[dict[str, Query], dict[str, str]]:
    qs: dict[str, Query] = {}
    sql: dict[str, str] = {}

    def add(name: str, fn: Query, stmt: str | None) -> None:
        qs[name] = fn
        if stmt is not None:
            sql[name] = stmt

    add("scan_readings", q_scan_readings, oracle.scan_readings())
    add("enrich_location", q_enrich_location, oracle.enrich_location())
    add("enrich_calendar", q_enrich_calendar, oracle.enrich_calendar())
    add("bround_measures", q_bround_measures, oracle.bround_measures())
    for lv in LEVELS:
        add(f"mean_daily_{lv}", partial(q_mean_daily, lv), oracle.mean_daily(lv))
        add(f"diff_{lv}", partial(q_diff, lv), oracle.diff(lv))
        add(f"monthly_diff_{lv}", partial(q_monthly_diff, lv), oracle.monthly_diff(lv))
        add(f"max_month_{lv}", partial(q_max_month, lv), oracle.max_month(lv))
    for hz in ("hour", "day", "week"):
        for lv in LEVELS:
            add(f"moving_avg_{hz}_{lv}", partial(q_moving, hz, lv), oracle.moving_avg(hz, lv))
    add("dedupe_readings", q_dedupe_readings, oracle.dedupe_readings())
    add("word_count_per_doc", q_word_count_per_doc, oracle.word_count_per_doc())
    add("word_count", q_word_count, oracle.word_count())
    add("distinct_words_per_doc", q_distinct_words_per_doc, oracle.distinct_words_per_doc())
    add("corpus_sizes", q_corpus_sizes, oracle.corpus_sizes())
    add("letter_count", q_letter_count, oracle.letter_count())
    add("parse_telemetry", q_parse_telemetry, oracle.parse_telemetry())
    add("topic_to_location", q_topic_to_location, oracle.topic_to_location())
    add("location_to_topic", q_location_to_topic, oracle.location_to_topic())
    add("sensor_location", q_sensor_location, oracle.sensor_location())
    add("config_replies", q_config_replies, oracle.config_replies())
    add("topic_filter_exact", q_topic_filter_exact, oracle.topic_filter_exact(EXACT_LOCATION))
    add("topic_filter_wildcard", q_topic_filter_wildcard, oracle.topic_filter_wildcard())
    add("route_topics", q_route_topics, oracle.route_topics())
    add("valid_location", q_valid_location, oracle.valid_location())
    add("telemetry_with_location", q_telemetry_with_location, oracle.telemetry_with_location())
    add("telemetry_located", q_telemetry_located, oracle.telemetry_located())
    add("telemetry_located_blocks", partial(q_telemetry_located, block_rows=act.TARGET_ROWS),
        oracle.telemetry_located())
    add("match_subscriptions", q_match_subscriptions, oracle.match_subscriptions())
    add("temperature_transitions", partial(q_transitions, "temperature"), oracle.transitions("temperature"))
    add("humidity_transitions", partial(q_transitions, "humidity"), oracle.transitions("humidity"))
    add("actuator_events", q_actuator_events, oracle.actuator_events())
    add("actuator_state", q_actuator_state, oracle.actuator_state())
    # The plans that large inputs take, whatever the size of this one.
    for hz in ("hour", "day", "week"):
        for strategy in ("prefix", "halo", "blocks"):
            add(f"moving_avg_{hz}_neighborhood_{strategy}", partial(q_moving_by, strategy, hz),
                oracle.moving_avg(hz, "neighborhood"))
    add("actuator_state_bucketed", q_actuator_state_bucketed, oracle.actuator_state())
    add("actuator_state_blocks", q_actuator_state_blocks, oracle.actuator_state())
    add("temperature_transitions_bucketed", q_transitions_bucketed, oracle.transitions("temperature"))
    add("malformed_telemetry", q_malformed_telemetry, oracle.malformed_telemetry())
    # Measures with more than two digits.
    add("mean_daily_room_4dp", q_mean_daily_4dp, oracle.four_digit(oracle.mean_daily("room")))
    add("moving_avg_day_room_4dp", q_moving_4dp, oracle.four_digit(oracle.moving_avg("day", "room")))
    add("parse_telemetry_4dp", q_parse_telemetry_4dp, oracle.four_digit_values(oracle.parse_telemetry()))
    add("temperature_transitions_4dp", q_transitions_4dp,
        oracle.four_digit_values(oracle.transitions("temperature")))
    # Measures as unrounded DOUBLE.
    add("mean_daily_room_double", q_mean_daily_double, oracle.unrounded(oracle.mean_daily("room")))
    add("diff_floor_double", q_diff_double, oracle.unrounded(oracle.diff("floor")))
    add("moving_avg_day_room_double", q_moving_double, oracle.unrounded(oracle.moving_avg("day", "room")))
    return qs, sql


QUERIES, ORACLE_SQL = _register()
assert set(ORACLE_SQL) <= set(QUERIES)
assert all(LEVEL_KEY[lv] for lv in LEVELS)
