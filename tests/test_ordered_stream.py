"""Messages that arrive out of order, and bad messages beside keyed state."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from thermograph.constants import DATA_PREFIX
from thermograph.operators.actuators import actuator_states
from thermograph.operators.telemetry import parse_telemetry
from thermograph.sources.messages import MESSAGE_SCHEMA
from thermograph.streaming.telemetry import actuators

START = dt.datetime(2022, 5, 1, 9)


def land(spark, tmp_path, files: list[list[tuple]]) -> str:
    path = str(tmp_path / "in")
    for rows in files:
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def message(i: int, minute: int | None, room: int, temp: float) -> tuple:
    at = None if minute is None else START + dt.timedelta(minutes=minute)
    return (i, f"{DATA_PREFIX}A/0/S/{room}", f'{{"d":{{"temp_c":{temp},"hum":{100 - temp}}}}}', at)


def test_a_shuffled_stream_is_the_batch(spark, tmp_path):
    rng = random.Random(7)
    rows = [message(i, i // 2, rng.randrange(3), rng.choice([29, 30, 30.004, 31, 71])) for i in range(160)]
    # Each message is up to 20 minutes out of order.
    rows.sort(key=lambda r: (r[3] - START).seconds / 60 + rng.uniform(-10, 10))
    files = [rows[i:i + 20] for i in range(0, len(rows), 20)]
    files.append([message(1000, 300, 9, 20), (1001, f"{DATA_PREFIX}A/0/S/1", "{", START),
                  message(1002, None, 1, 99)])
    path = land(spark, tmp_path, files)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for _ in range(2):  # the watermark moves between micro-batches; the second run ends it
        q = actuators(spark, path, out, mode="ordered", delay="30 minutes", malformed_path=bad,
                      checkpoint=str(tmp_path / "c"), available_now=True, max_files_per_trigger=1)
        q.awaitTermination()
        land(spark, tmp_path, [[message(1003, 301, 8, 20)]])
    got = spark.read.parquet(out)
    batch = actuator_states(parse_telemetry(spark.createDataFrame(rows, MESSAGE_SCHEMA)), bucket_us=None)
    columns = ["event_id", "location", "temperature_state", "temperature_event", "humidity_state",
               "humidity_event"]
    want = batch.select(*columns).collect()
    assert sorted(map(tuple, got.where("event_id < 1000").select(*columns).collect())) == sorted(map(tuple, want))
    assert sorted(r.event_id for r in spark.read.parquet(bad).collect()) == [1001, 1002]
    assert got.schema["dateTime"].dataType == batch.schema["dateTime"].dataType


@pytest.mark.parametrize("as_events", [True, False])
def test_keyed_state_sets_bad_messages_aside(spark, tmp_path, as_events):
    path = land(spark, tmp_path, [[message(1, 0, 1, 35), (2, f"{DATA_PREFIX}A/0/S/1", "{}", START)],
                                  [message(3, 5, 1, 20)]])
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    q = actuators(spark, path, out, mode="keyed", malformed_path=bad, as_events=as_events,
                  checkpoint=str(tmp_path / "c"), available_now=True)
    q.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(bad).select("event_id", "payload").collect()] == [(2, "{}")]
    assert {r.event_id for r in spark.read.parquet(out).collect()} == {1, 3}
    with pytest.raises(Exception, match="no readable payload"):
        actuators(spark, path, str(tmp_path / "o2"), mode="keyed", checkpoint=str(tmp_path / "c2"),
                  available_now=True).awaitTermination()


def test_no_digit_of_a_message_is_cut(spark):
    rows = [message(1, 0, 1, 30.004), message(2, 1, 1, 30), message(3, 2, 1, 29.9999999)]
    got = actuator_states(parse_telemetry(spark.createDataFrame(rows, MESSAGE_SCHEMA)), {"temperature": 30.0})
    assert [r.temperature_event for r in got.orderBy("event_id").collect()] == ["on", "no change", "off"]
    assert parse_telemetry(spark.createDataFrame(rows, MESSAGE_SCHEMA)).where(
        F.col("temperature") == F.lit("30.004").cast("decimal(30,18)")).count() == 1
