"""Row-bounded blocks: whatever the times are, no task windows more than the target."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import readings_df
from thermograph.operators import blocks
from thermograph.operators.actuators import actuator_states
from thermograph.operators.enrich import enrich, enrich_location
from thermograph.operators.moving import moving_average, moving_averages

START = dt.datetime(2022, 5, 1, 9)
N = 3000


def times(kind: str) -> list:
    rng = random.Random(kind)
    at = {"instant": lambda: START, "null": lambda: None,
          "minute": lambda: START + dt.timedelta(seconds=rng.randint(0, 59)),
          "mixed": lambda: rng.choice([None, START, START + dt.timedelta(minutes=rng.randint(0, 3000))])}
    return [at[kind]() for _ in range(N)]


def readings(spark, kind: str, rooms: int = 1):
    rng = random.Random(kind)
    rows = [(f"A.0.S.{rng.randrange(rooms)}", t, rng.choice([None, 29, 30, 31]), rng.choice([59, 60, 61]))
            for t in times(kind)]
    rows = [(*r, i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "location string, dateTime timestamp, temperature int, "
                                     "humidity int, event_id long")
    return df.withColumns({m: F.col(m).cast("decimal(10,2)") for m in ("temperature", "humidity")})


@pytest.fixture
def written(monkeypatch):
    """Largest (block, key) of each table of blocks that is written."""
    found, write = [], blocks.row_blocks

    def spy(df, order, target, name):
        out = write(df, order, target, name)
        found.append(out.groupBy(blocks.BLOCK).count().agg(F.max("count")).first()[0] or 0)
        return out
    monkeypatch.setattr("thermograph.operators.actuators.row_blocks", spy)
    monkeypatch.setattr("thermograph.operators.moving.row_blocks", spy)
    return found


def same(a, b) -> None:
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("kind", ["instant", "null", "minute", "mixed"])
def test_actuators(spark, written, kind):
    df = readings(spark, kind)
    for scope in ("location", "global"):
        same(actuator_states(df, scope=scope, block_rows=300),
             actuator_states(df, scope=scope, bucket_us=None))
    assert len(written) == 2 and max(written) <= 300


def test_actuators_continue_from_a_state(spark):
    df = readings(spark, "mixed", rooms=3)
    first = spark.createDataFrame([("A.0.S.0", 1, 1), ("A.0.S.2", 0, 1)],
                                  "location string, temperature int, humidity int")
    same(actuator_states(df, block_rows=300, initial=first),
         actuator_states(df, bucket_us=None, initial=first))


def test_large_inputs_take_blocks(spark, written):
    df = readings(spark, "minute")
    spark.conf.set("spark.thermograph.smallInputBytes", "0")
    spark.conf.set("spark.thermograph.bucketRows", "400")
    try:
        got = actuator_states(df)
        week = moving_average(enrich(df), "neighborhood", "week")
    finally:
        spark.conf.unset("spark.thermograph.smallInputBytes")
        spark.conf.unset("spark.thermograph.bucketRows")
    # One table for the states; one for each key of the averages (instants are few).
    assert len(written) == 3 and max(written) <= 400
    same(got, actuator_states(df, bucket_us=None))
    same(week, moving_average(enrich(df), "neighborhood", "week", strategy="plain"))


@pytest.mark.parametrize("kind", ["instant", "null", "minute", "mixed"])
@pytest.mark.parametrize("strategy", ["blocks", "prefix", "halo"])
def test_moving_averages(spark, written, kind, strategy):
    df = enrich_location(readings(spark, kind, rooms=3))
    spark.conf.set("spark.thermograph.bucketRows", "300")
    try:
        got = moving_averages(df, "floor", {"h": "1 hour", "d": "1 day"}, strategy=strategy)
        same(got, moving_averages(df, "floor", {"h": "1 hour", "d": "1 day"}, strategy="plain"))
    finally:
        spark.conf.unset("spark.thermograph.bucketRows")
    assert not written or max(written) <= 300


def test_null_keys_and_empty_input(spark):
    rows = [(None, START, "20.01", "1.00"), (None, None, "21.01", None), ("A.0.S.1", None, "5.00", "2.00"),
            ("A.0.S.1", START, None, "3.00"), (None, START + dt.timedelta(minutes=5), "22.02", "9.99")]
    df = enrich_location(readings_df(spark, rows))
    for frame in (df, df.limit(0)):
        for strategy in ("blocks", "prefix", "halo"):
            same(moving_average(frame, "room", "1 hour", strategy=strategy),
                 moving_average(frame, "room", "1 hour", strategy="plain"))
    empty = readings(spark, "null").limit(0)
    assert actuator_states(empty, block_rows=10).count() == 0


@pytest.mark.parametrize("strategy", ["blocks", "prefix", "plain"])
def test_float_form_is_the_sliding_frame(spark, strategy):
    from pyspark.sql import Window
    rng = random.Random(6)
    rows = [("A.0.S.1", START + dt.timedelta(minutes=i), f"{rng.uniform(-9, 40):.2f}", f"{10.0 ** (i % 7):.2f}")
            for i in range(400)]
    df = enrich_location(readings_df(spark, rows))
    got = {r.dateTime: (r.avg_temp, r.avg_hum)
           for r in moving_average(df, "room", "1 hour", exact=False, strategy=strategy).collect()}
    w = Window.partitionBy("location").orderBy(F.unix_seconds("dateTime")).rangeBetween(-3600, 0)
    want = readings_df(spark, rows).select("dateTime", *[
        F.bround(F.avg(F.col(m).cast("float")).over(w), 2).alias(m) for m in ("temperature", "humidity")])
    assert got == {r.dateTime: (r.temperature, r.humidity) for r in want.collect()}


def test_tables_of_a_run_are_removed(spark):
    import glob

    from thermograph.session import clear_scratch, scratch_root, scratch_run
    df = readings(spark, "mixed")
    root = scratch_root(spark).removeprefix("file:")
    with scratch_run(spark):
        states = actuator_states(df, block_rows=300)
        assert states.count() == N and glob.glob(f"{root}/run-*/actuator_blocks-*")
    assert not glob.glob(f"{root}/run-*")
    assert actuator_states(df, block_rows=300).count() == N and glob.glob(f"{root}/actuator_blocks-*")
    clear_scratch(spark)
    assert not glob.glob(f"{root}/*")
