"""Missing times, measures of more digits, event rows, malformed messages."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from thermograph.operators.actuators import actuator_states, final_states
from thermograph.operators.daynight import daily_means
from thermograph.operators.enrich import enrich
from thermograph.operators.words import word_count_per_doc
from thermograph.streaming.actuators import _epochs, bucketed_actuator_writer, event_rows

HOUR = 3600 * 10**6
SCHEMA = "location string, dateTime timestamp, temperature double, humidity double, event_id bigint"


def _rows(spark, rows):
    return spark.createDataFrame(
        [("A.0.S.1", dt.datetime(2022, 1, d) if d else None, t, None, i)
         for i, (d, t) in enumerate(rows)], SCHEMA)


def _states(df):
    return {r.event_id: r.temperature_state for r in df.collect()}


@pytest.mark.parametrize("bucket", [None, 60 * 10**6, HOUR, 7 * 24 * HOUR])
def test_missing_time_is_first_in_every_plan(spark, bucket):
    df = _rows(spark, [(None, 35.0), (1, 30.0), (2, 30.0)])
    assert _states(actuator_states(df, bucket_us=bucket)) == {0: "on", 1: "on", 2: "on"}


def test_missing_tiebreak_and_time_in_final_state(spark):
    df = _rows(spark, [(None, 35.0)])
    states = actuator_states(df, bucket_us=HOUR).withColumn("event_id", F.lit(None).cast("bigint"))
    assert final_states(states, ["temperature"]).collect()[0].temperature == 1


def test_state_survives_a_batch_without_times(spark, tmp_path):
    out, state = str(tmp_path / "o"), str(tmp_path / "s")
    write = bucketed_actuator_writer(out, state, {"temperature": 30.0})
    for epoch, row in enumerate([(1, 35.0), (None, 30.0), (2, 30.0)]):
        write(_rows(spark, [row]), epoch)
    got = spark.read.parquet(out).orderBy("epoch").collect()
    assert [r.temperature_state for r in got] == ["on", "on", "on"]


def test_old_state_epochs_go(spark, tmp_path):
    out, state = str(tmp_path / "o"), str(tmp_path / "s")
    write = bucketed_actuator_writer(out, state, {"temperature": 30.0}, as_events=True)
    for epoch in range(6):
        write(_rows(spark, [(1, 35.0 if epoch % 2 == 0 else 20.0)]), epoch)
    assert len(_epochs(spark, state)[1]) <= 2
    assert len(_epochs(spark, state + "/_states")[1]) <= 1
    got = spark.read.parquet(out).orderBy("epoch").collect()
    assert [r.action for r in got] == ["on", "off", "on", "off", "on", "off"]
    write(_rows(spark, [(1, 20.0)]), 5)  # a replay gives the same
    assert spark.read.parquet(out).count() == 6


def test_event_rows_equal_batch(spark):
    from thermograph.operators.actuators import actuator_events
    from thermograph.sources.readings import sensor_readings
    r = sensor_readings(spark, "/root/testdata/sf0.001")
    states = actuator_states(r, keep=["temperature", "humidity"])
    got = event_rows(states, ["temperature", "humidity"], ["location"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, actuator_events(r).collect()))


def test_three_digits_are_not_cut(spark):
    rows = [("A.0.S.1", dt.datetime(2022, 1, 1, 12), Decimal(t), Decimal(0)) for t in
            ("20.006", "20.006", "20.001")]
    df = spark.createDataFrame(rows, "location string, dateTime timestamp, "
                                     "temperature decimal(10,3), humidity decimal(10,3)")
    assert daily_means(enrich(df)).collect()[0].avg_temp == 20.0
    as_float = df.withColumn("temperature", F.col("temperature").cast("double"))
    assert daily_means(enrich(as_float)).collect()[0].avg_temp == 20.0


def test_month_tie_is_exact(spark):
    from thermograph.operators.months import max_month
    rows = [(dt.date(2022, 1, d), 1.0, 0.0) for d in (1, 2, 3)] + [
        (dt.date(2022, 2, 1), 1.0, 0.0), (dt.date(2022, 3, 1), 0.99, 0.0)]
    df = spark.createDataFrame(rows, "day date, temp_diff double, hum_diff double")
    assert sorted(r.month for r in max_month(df).collect()) == [1, 2]


def test_rows_of_one_text_are_one_text(spark):
    """A11 and A13-A15 agree on what a repeated id means."""
    from thermograph.operators.words import corpus_sizes, distinct_words_per_doc
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, "a  a"), (3, "a b"), (4, None)],
                               "doc_id int, text string")
    per = sorted(map(tuple, word_count_per_doc(df).collect()))
    assert per == [(1, "a", 1), (1, "b", 2), (2, "", 1), (3, "", 1), (3, "a", 3), (3, "b", 1)]
    distinct = {r.doc_id: r.n_words for r in distinct_words_per_doc(df).collect()}
    assert distinct == {1: 2, 2: 1, 3: 3, 4: 0}
    assert tuple(corpus_sizes(df).first()) == (4, 3, 6)


@pytest.mark.parametrize("mode", ["buckets", "keyed"])
def test_one_location_and_bad_messages(spark, tmp_path, mode):
    from thermograph.constants import DATA_PREFIX
    from thermograph.sources.messages import MESSAGE_SCHEMA
    from thermograph.streaming.telemetry import actuators, telemetry_ingest
    land = str(tmp_path / "in")
    at = dt.datetime(2022, 1, 1)
    rows = [(1, DATA_PREFIX + "A/0/S/1", '{"d":{"temp_c":35,"hum":70}}', at),
            (2, DATA_PREFIX + "B/0/S/1", '{"d":{"temp_c":35,"hum":70}}', at),
            (3, DATA_PREFIX + "A/0/S/1", "{broken", at)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.parquet(land)
    with pytest.raises(ValueError):
        actuators(spark, land, str(tmp_path / "x"), location="a.0.S.1")
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    q = actuators(spark, land, out, mode=mode, location="A.0.S.1", as_events=True,
                  malformed_path=bad, checkpoint=str(tmp_path / "c"), available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(out).collect()
    assert [(r.event_id, r.metric, r.action) for r in got] == [
        (1, "temperature", "on"), (1, "humidity", "on")]
    if mode == "buckets":
        assert [r.event_id for r in spark.read.parquet(bad).collect()] == [3]
    q = telemetry_ingest(spark, land, str(tmp_path / "i"), checkpoint=str(tmp_path / "ci"),
                         available_now=True)
    q.awaitTermination()
    good = spark.read.parquet(str(tmp_path / "i")).count()
    assert (good, spark.read.parquet(str(tmp_path / "i_malformed")).count()) == (2, 1)


def test_stream_joined_to_the_assignments(spark, tmp_path):
    """Telemetry of a stream gets its sensor's location from a static table."""
    from thermograph.operators.telemetry import (config_replies, parse_telemetry,
                                                 telemetry_with_location)
    from thermograph.sinks.streams import epoch_parquet_writer
    from thermograph.sources.messages import read_message_stream, telemetry_messages
    from thermograph.sources.readings import sensor_readings
    r = sensor_readings(spark, "/root/testdata/sf0.001", with_sensor=True)
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    telemetry_messages(r).repartition(3).write.parquet(land)
    replies = config_replies(r.select("sensor_id").distinct())
    stream = telemetry_with_location(
        parse_telemetry(read_message_stream(spark, land, max_files_per_trigger=1)), replies)
    q = (stream.writeStream.foreachBatch(epoch_parquet_writer(out))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    batch = telemetry_with_location(parse_telemetry(spark.read.parquet(land)), replies)
    cols = ["event_id", "location", "s_id", "assigned_location"]
    got = spark.read.parquet(out).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch.select(*cols).collect()))
