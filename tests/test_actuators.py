"""Actuators: batch state machine edges, bucketing, and the streaming form."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, readings_df
from thermograph.operators.actuators import actuator_events, actuator_states, actuator_transitions
from thermograph.sources.messages import telemetry_messages
from thermograph.sources.readings import sensor_readings
from thermograph.streaming.telemetry import actuators as actuator_job
from thermograph.streaming.telemetry import location_assignment, telemetry_ingest


def _seq(spark, values, loc="A.0.S.1", start=dt.datetime(2022, 1, 1)):
    rows = [(loc, start + dt.timedelta(minutes=i), t, h) for i, (t, h) in enumerate(values)]
    df = readings_df(spark, rows)
    return df.withColumn("event_id", F.monotonically_increasing_id())


def test_state_machine(spark):
    # temperature: 29 (off) 31 (on) 30 (=limit, no change) 31 (still on) 29.99 (off) 30 (no change)
    vals = [("29", "61"), ("31", "61"), ("30", "60"), ("31", "59"), ("29.99", None), ("30", "60.01")]
    st = actuator_states(_seq(spark, vals)).orderBy("dateTime").collect()
    assert [r.temperature_event for r in st] == ["no change", "on", "no change", "no change", "off", "no change"]
    assert [r.temperature_state for r in st] == ["off", "on", "on", "on", "off", "off"]
    assert [r.humidity_event for r in st] == ["on", "no change", "no change", "off", "no change", "on"]


def test_across_buckets_and_global_scope(spark):
    base = dt.datetime(2022, 1, 1)
    rows = [("A.0.S.1", base, "31", "50"), ("B.0.S.1", base + dt.timedelta(days=3), "20", "50"),
            ("A.0.S.1", base + dt.timedelta(days=5), "31", "50"), ("A.0.S.1", base + dt.timedelta(days=9), "29", "50")]
    df = readings_df(spark, rows).withColumn("event_id", F.monotonically_increasing_id())
    t = actuator_transitions(df, "temperature").orderBy("dateTime").collect()
    assert [(r.location, r.action) for r in t] == [("A.0.S.1", "on"), ("A.0.S.1", "off")]
    g = actuator_transitions(df, "temperature", scope="global").orderBy("dateTime").collect()
    assert [r.action for r in g] == ["on", "off", "on", "off"]
    nb = actuator_transitions(df, "temperature", bucket_us=86400 * 10**6).orderBy("dateTime").collect()
    assert [(r.location, r.action) for r in nb] == [("A.0.S.1", "on"), ("A.0.S.1", "off")]


def test_events_order_and_columns(spark):
    ev = actuator_events(_seq(spark, [("31", "61")])).collect()
    assert [(r.metric, r.action, r.value) for r in ev] == [("temperature", "on", 31.0), ("humidity", "on", 61.0)]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bucketing_does_not_change_states(spark):
    r = sensor_readings(spark, SF001)
    plain = _rows(actuator_states(r, bucket_us=None))
    assert _rows(actuator_states(r)) == plain
    assert _rows(actuator_states(r, bucket_us=3600 * 10**6)) == plain
    assert _rows(actuator_states(r, bucket_us=86400 * 10**6)) == plain
    assert _rows(actuator_states(r, scope="global", bucket_us=None)) == \
        _rows(actuator_states(r, scope="global", bucket_us=3600 * 10**6))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Messages of sf0.001 landed as 5 files in time order."""
    d = tmp_path_factory.mktemp("landed")
    msgs = telemetry_messages(sensor_readings(spark, SF001, with_sensor=True)).toPandas()
    msgs = msgs.sort_values(["arrival", "event_id"]).reset_index(drop=True)
    n = len(msgs)
    for i in range(5):
        part = msgs.iloc[i * n // 5:(i + 1) * n // 5]
        spark.createDataFrame(part, "event_id long, topic string, payload string, arrival timestamp_ntz") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(d, f"batch={i}"))
    return str(d)


def test_stream_equals_batch(spark, landed, tmp_path):
    import glob
    files = sorted(glob.glob(os.path.join(landed, "batch=*", "*.parquet")))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, f in enumerate(files):
        os.link(f, flat / f"part-{i:03d}.parquet")
    batch = actuator_states(sensor_readings(spark, SF001))
    cols = ["location", "event_id", "temperature_state", "temperature_event", "humidity_state", "humidity_event"]
    for mode in ("keyed", "buckets"):
        out = tmp_path / f"out_{mode}"
        q = actuator_job(spark, str(flat), str(out), checkpoint=str(tmp_path / f"ck_{mode}"),
                         available_now=True, max_files_per_trigger=1, mode=mode)
        q.awaitTermination(300)
        got = spark.read.parquet(str(out))
        assert got.select("epoch").distinct().count() == 5, mode
        assert _rows(got.select(*cols)) == _rows(batch.select(*cols)), mode
    # one actuator shared by every location, through the bucketed writer;
    # events_only keeps just the messages that switch something
    gbatch = actuator_states(sensor_readings(spark, SF001), scope="global", bucket_us=3600 * 10**6)
    gcols = ["event_id", "temperature_state", "temperature_event", "humidity_state", "humidity_event"]
    q = actuator_job(spark, str(flat), str(tmp_path / "out_global"), checkpoint=str(tmp_path / "ck_global"),
                     available_now=True, max_files_per_trigger=1, scope="global")
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out_global"))
    assert _rows(got.select(*gcols)) == _rows(gbatch.select(*gcols))
    q = actuator_job(spark, str(flat), str(tmp_path / "out_events"), checkpoint=str(tmp_path / "ck_events"),
                     available_now=True, max_files_per_trigger=2, events_only=True)
    q.awaitTermination(300)
    ev = spark.read.parquet(str(tmp_path / "out_events"))
    changed = batch.where("temperature_event != 'no change' OR humidity_event != 'no change'")
    assert _rows(ev.select(*cols)) == _rows(changed.select(*cols))


def test_initial_state(spark):
    vals = [("29", "59"), ("31", "59")]
    df = _seq(spark, vals)
    init = spark.createDataFrame([("A.0.S.1", 1, 0)], "location string, temperature int, humidity int")
    st = actuator_states(df, initial=init).orderBy("dateTime").collect()
    assert [r.temperature_event for r in st] == ["off", "on"]


def test_ingest_and_assignment_streams(spark, landed, tmp_path):
    import glob
    files = sorted(glob.glob(os.path.join(landed, "batch=*", "*.parquet")))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, f in enumerate(files):
        os.link(f, flat / f"part-{i:03d}.parquet")
    q = telemetry_ingest(spark, str(flat), str(tmp_path / "rows"), checkpoint=str(tmp_path / "ck1"),
                         available_now=True)
    q.awaitTermination(300)
    rows = spark.read.parquet(str(tmp_path / "rows"))
    src = sensor_readings(spark, SF001)
    assert rows.count() == src.count()
    assert _rows(rows.select("event_id", "location", "temperature", "humidity")) == \
        _rows(src.select("event_id", "location", "temperature", "humidity"))
    req_dir = tmp_path / "req"
    sensor_readings(spark, SF001, with_sensor=True).select(
        "sensor_id", F.col("dateTime").alias("arrival")).write.parquet(str(req_dir))
    q2 = location_assignment(spark, str(req_dir), str(tmp_path / "replies"),
                             checkpoint=str(tmp_path / "ck2"), available_now=True)
    q2.awaitTermination(300)
    rep = spark.read.parquet(str(tmp_path / "replies"))
    assert rep.where("location IS NULL").count() == 0
    assert rep.count() == src.count()


def test_bucketed_writer_replay_is_idempotent(spark, tmp_path):
    """A replayed micro-batch (after a failure) rewrites the same output and
    state: epoch e always reads the newest state older than e."""
    from thermograph.streaming.actuators import bucketed_actuator_writer
    r = sensor_readings(spark, SF001).orderBy("dateTime", "event_id").cache()
    n = r.count()
    first = r.limit(n // 2)
    second = r.exceptAll(first)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = bucketed_actuator_writer(out, state)
    write(first, 0)
    write(second, 1)
    snap = _rows(spark.read.parquet(out))
    write(second, 1)  # replay of the last epoch
    assert _rows(spark.read.parquet(out)) == snap
    write(first, 0)   # replay of an earlier epoch leaves the later output alone
    write(second, 1)
    assert _rows(spark.read.parquet(out)) == snap
    cols = ["location", "event_id", "temperature_state", "temperature_event"]
    assert _rows(spark.read.parquet(out).select(*cols)) == _rows(actuator_states(r).select(*cols))
    r.unpersist()


def test_checkpoint_dir_required_on_clusters():
    from types import SimpleNamespace

    from thermograph.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                           sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(fake)


def test_transitions_stream(spark, landed, tmp_path):
    import glob

    from thermograph.operators.telemetry import parse_telemetry
    from thermograph.sources.messages import read_message_stream
    from thermograph.streaming.actuators import transitions_stream
    files = sorted(glob.glob(os.path.join(landed, "batch=*", "*.parquet")))
    flat = tmp_path / "flat"
    flat.mkdir()
    for i, f in enumerate(files):
        os.link(f, flat / f"part-{i:03d}.parquet")
    rows = parse_telemetry(read_message_stream(spark, str(flat), max_files_per_trigger=1))
    q = (transitions_stream(rows, "temperature").writeStream.format("memory")
         .queryName("temp_transitions").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT location, event_id, temperature_event FROM temp_transitions")
    want = actuator_transitions(sensor_readings(spark, SF001), "temperature") \
        .select("location", "event_id", F.col("action").alias("temperature_event"))
    assert _rows(got) == _rows(want)
