"""Moving averages: frame edges and equivalence of the plans."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001, SF01, readings_df
from thermograph.constants import LEVELS
from thermograph.functions.calendar import epoch_micros
from thermograph.operators.enrich import enrich
from thermograph.operators.moving import horizon_micros, moving_average, moving_averages
from thermograph.sources.readings import sensor_readings

SCHEMA = "location string, dateTime timestamp, temperature decimal(10,2), humidity decimal(10,2)"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_horizons():
    assert horizon_micros("1 hour") == 3600 * 10**6
    assert horizon_micros("week") == 7 * 86400 * 10**6
    assert horizon_micros("7 days") == 7 * 86400 * 10**6


def test_frame_edges(spark):
    d = dt.datetime
    rows = [("A.0.S.1", d(2022, 1, 1, 10, 0), "10.00", "1.00"),
            ("A.0.S.1", d(2022, 1, 1, 11, 0), "20.00", "2.00"),   # exactly 1 h later: includes 10:00
            ("A.0.S.1", d(2022, 1, 1, 11, 0), "30.00", "3.00"),   # peer of the previous row
            ("A.0.S.1", d(2022, 1, 1, 12, 0, 1), "40.00", None),  # 1 h 0 m 1 s after 11:00
            ("A.0.S.2", d(2022, 1, 1, 10, 30), "50.00", "5.00")]
    df = enrich(readings_df(spark, rows))
    for strategy, bucket in (("prefix", "auto"), ("prefix", "30 minutes"), ("halo", "auto"),
                             ("halo", "1 hour"), ("plain", None)):
        got = _rows(moving_average(df, "room", "1 hour", strategy=strategy, bucket=bucket))
        assert got == _rows(spark.createDataFrame([
            ("A.0.S.1", d(2022, 1, 1, 10, 0), 10.0, 1.0),
            ("A.0.S.1", d(2022, 1, 1, 11, 0), 20.0, 2.0),
            ("A.0.S.1", d(2022, 1, 1, 11, 0), 20.0, 2.0),
            ("A.0.S.1", d(2022, 1, 1, 12, 0, 1), 40.0, None),
            ("A.0.S.2", d(2022, 1, 1, 10, 30), 50.0, 5.0)],
            "k string, t timestamp, a double, b double")), (strategy, bucket)
    # building level: temperature pooled over both rooms, humidity per room
    got = {(r.dateTime, r.avg_temp, r.avg_hum) for r in moving_average(df, "building", "1 hour").collect()}
    assert (d(2022, 1, 1, 11, 0), 27.5, 2.0) in got  # (10+20+30+50)/4, (1+2+3)/3


@pytest.fixture(scope="module")
def enriched(spark):
    return enrich(sensor_readings(spark, SF01)).cache()


@pytest.mark.parametrize("level", LEVELS)
def test_strategies_agree(enriched, level):
    for hz in ("hour", "week"):
        a = _rows(moving_average(enriched, level, hz))
        b = _rows(moving_average(enriched, level, hz, bucket=None))
        c = _rows(moving_average(enriched, level, hz, strategy="halo", bucket="1 day"))
        d = _rows(moving_average(enriched, level, hz, strategy="prefix", bucket="20 minute"))
        e = _rows(moving_average(enriched, level, hz, strategy="prefix"))
        assert a == b == c == d == e


def test_growing_frames_equal_sliding_decimal_frame(spark, enriched):
    """The cumulative-difference frame sum equals Spark's own sliding RANGE
    average on DECIMAL input, rounded half-even."""
    h = horizon_micros("day")
    w = Window.partitionBy("fullRoomLocation").orderBy("_o").rangeBetween(-h, 0)
    ref = (enriched.withColumn("_o", epoch_micros("dateTime"))
           .select("fullRoomLocation", "dateTime",
                   F.bround(F.avg("temperature").over(w), 2).cast("double").alias("avg_temp"),
                   F.bround(F.avg("humidity").over(w), 2).cast("double").alias("avg_hum")))
    assert _rows(moving_average(enriched, "room", "day")) == _rows(ref)


def test_all_horizons_in_one_pass(enriched):
    for strategy in ("prefix", "halo", "plain"):
        allh = moving_averages(enriched, "floor", strategy=strategy)
        for hz in ("hour", "day", "week"):
            one = moving_average(enriched, "floor", hz, strategy="plain")
            a = _rows(allh.select("fullFloorLocation", "dateTime", f"avg_temp_{hz}", f"avg_hum_{hz}"))
            assert a == _rows(one), strategy


def test_null_time_rows(spark):
    rows = [("A.0.S.1", None, "10.00", "1.00"), ("A.0.S.1", None, "20.00", "3.00"),
            ("A.0.S.1", dt.datetime(2022, 1, 1), "30.00", "5.00")]
    df = enrich(readings_df(spark, rows))
    got = _rows(moving_average(df, "room", "1 hour"))
    plain = _rows(moving_average(df, "room", "1 hour", bucket=None))
    halo = _rows(moving_average(df, "room", "1 hour", strategy="halo"))
    prefix = _rows(moving_average(df, "room", "1 hour", strategy="prefix"))
    assert got == plain == halo == prefix
    nulls = [r for r in got if r[1] is None]
    assert [r[2] for r in nulls] == [15.0, 15.0]


def test_float_mode_runs(spark):
    rows = [("A.0.S.1", dt.datetime(2022, 1, 1, 10), "10.01", "1.00"),
            ("A.0.S.1", dt.datetime(2022, 1, 1, 10, 30), "10.02", "2.00")]
    df = enrich(readings_df(spark, rows))
    got = sorted(r.avg_temp for r in moving_average(df, "room", "1 hour", exact=False).collect())
    assert got == [10.01, 10.02]


def test_all_levels_in_one_pass(enriched):
    from thermograph.operators.moving import level_view, moving_averages_all_levels
    for strategy in ("plain", "prefix"):
        allv = moving_averages_all_levels(enriched, strategy=strategy).cache()
        for lv in LEVELS:
            assert _rows(level_view(allv, lv)) == _rows(moving_averages(enriched, lv, strategy="plain")), (strategy, lv)
        allv.unpersist()


def test_humidity_scope_level(enriched):
    for strategy in ("plain", "prefix", "halo"):
        got = _rows(moving_average(enriched, "building", "day", humidity_scope="level", strategy=strategy))
        # with humidity windowed by the level, both measures share one key
        h = horizon_micros("day")
        w = Window.partitionBy("fullBuildingLocation").orderBy("_o").rangeBetween(-h, 0)
        ref = (enriched.withColumn("_o", epoch_micros("dateTime"))
               .select("fullBuildingLocation", "dateTime",
                       F.bround(F.avg("temperature").over(w), 2).cast("double").alias("avg_temp"),
                       F.bround(F.avg("humidity").over(w), 2).cast("double").alias("avg_hum")))
        assert got == _rows(ref), strategy


def test_adaptive_widths(spark, enriched):
    from thermograph.operators.moving import candidate_widths
    hour = 3600 * 10**6
    assert candidate_widths([7 * 24 * hour])[:3] == [168 * hour, 84 * hour, 56 * hour]
    assert candidate_widths([hour, 24 * hour, 168 * hour]) == [hour]
    assert candidate_widths([30 * 60 * 10**6]) == [30 * 60 * 10**6]
    plain = _rows(moving_average(enriched, "neighborhood", "week", strategy="plain"))
    for target in ("1", "50", "100000000"):  # narrowest, middle, widest buckets
        spark.conf.set("spark.thermograph.bucketRows", target)
        try:
            assert _rows(moving_average(enriched, "neighborhood", "week", strategy="prefix")) == plain, target
        finally:
            spark.conf.unset("spark.thermograph.bucketRows")


def test_adaptive_plan_choice(spark, enriched):
    from thermograph.operators.moving import _plan_stages, busiest_hours
    from thermograph.functions.calendar import epoch_micros as em
    base = enriched.withColumn("_ord", em("dateTime"))
    b = busiest_hours(base, ["neighborhood", "fullRoomLocation"])
    assert b["neighborhood"] >= b["fullRoomLocation"] >= 1
    week = 7 * 86400 * 10**6
    assert _plan_stages(base, ["neighborhood"], [week], True, 10**9)["neighborhood"][0] == "halo"
    # more rows in the busiest hour than the target: blocks of rows, or buckets
    # narrower than an hour where prefix is asked for
    assert _plan_stages(base, ["neighborhood"], [week], True, 1)["neighborhood"] == ("blocks", 1)
    how, width = _plan_stages(base, ["neighborhood"], [week], False, 1)["neighborhood"]
    assert how == "prefix" and width < 3600 * 10**6 and week % width == 0
    spark.conf.set("spark.thermograph.smallInputBytes", "0")
    try:
        plain = _rows(moving_average(enriched, "floor", "day", strategy="plain"))
        assert _rows(moving_average(enriched, "floor", "day")) == plain
    finally:
        spark.conf.unset("spark.thermograph.smallInputBytes")


def test_all_levels_adaptive(spark, enriched):
    from thermograph.operators.moving import level_view, moving_averages_all_levels
    plain = moving_averages_all_levels(enriched, strategy="plain")
    for target in (None, "1"):
        spark.conf.set("spark.thermograph.smallInputBytes", "0")
        if target:
            spark.conf.set("spark.thermograph.bucketRows", target)
        try:
            got = moving_averages_all_levels(enriched)
            for lv in ("room", "neighborhood"):
                assert _rows(level_view(got, lv)) == _rows(level_view(plain, lv)), (target, lv)
        finally:
            spark.conf.unset("spark.thermograph.smallInputBytes")
            spark.conf.unset("spark.thermograph.bucketRows")


def test_busiest_hours_grouping_sets(enriched):
    from thermograph.operators.moving import busiest_hours
    base = enriched.withColumn("_ord", epoch_micros("dateTime"))
    keys = ["fullRoomLocation", "fullFloorLocation", "fullBuildingLocation", "neighborhood"]
    got = busiest_hours(base, keys)
    for k in keys:
        direct = (base.groupBy(k, F.floor(F.col("_ord") / 3600000000)).count()
                  .agg(F.max("count")).first()[0])
        assert got[k] == direct, k


def _input_scans(df) -> int:
    """Parquet scans of the events table in the executed plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan parquet" in line and "events.parquet" in line
               for line in plan.splitlines())


def test_one_pre_aggregate_for_all_stages(spark):
    """The rows are the only scan of the input that the large plans keep: all
    totals, and the statistic, come from one written table."""
    from thermograph.operators.enrich import enrich_location
    from thermograph.operators.moving import level_view, moving_averages_all_levels
    rows = enrich_location(sensor_readings(spark, SF001))
    plain = moving_averages_all_levels(rows, strategy="plain")
    for target in ("1000000", "40", "1"):
        spark.conf.set("spark.thermograph.bucketRows", target)
        try:
            got = moving_averages_all_levels(rows, strategy="prefix")
        finally:
            spark.conf.unset("spark.thermograph.bucketRows")
        assert _input_scans(got) == _input_scans(plain), target
        assert _rows(level_view(got, "neighborhood")) == _rows(level_view(plain, "neighborhood"))
    both = moving_averages_all_levels(rows, strategy="prefix", bucket="15 minutes")
    assert _input_scans(both) == _input_scans(plain)
    assert _rows(level_view(both, "floor")) == _rows(level_view(plain, "floor"))


def test_busiest_hours_from_totals(enriched):
    from thermograph.functions.exact import to_units
    from thermograph.operators.moving import _bucket_totals, busiest_hours
    keys = ["fullRoomLocation", "neighborhood"]
    base = (enriched.withColumn("_ord", epoch_micros("dateTime"))
            .withColumn("_c_temperature", to_units("temperature", 2)))
    for fine in (3600 * 10**6, 5 * 60 * 10**6):
        totals = _bucket_totals(base, keys, ["temperature"], fine)
        assert busiest_hours(base, keys, totals, fine) == busiest_hours(base, keys), fine
        assert busiest_hours(base, keys[:1], totals, fine) == busiest_hours(base, keys[:1]), fine
