"""Day/night differences and month winners: edges and equivalent plans."""

import datetime as dt

import pytest

from conftest import SF01, readings_df
from thermograph.constants import LEVELS
from thermograph.operators.daynight import (day_night_diff, day_night_diff_from_partials,
                                            day_night_diff_join, room_day_partials)
from thermograph.operators.enrich import enrich
from thermograph.operators.months import max_month, monthly_diff_means
from thermograph.sources.readings import sensor_readings

SCHEMA = "location string, dateTime timestamp, temperature decimal(10,2), humidity decimal(10,2)"


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_difference_edges(spark):
    d = dt.datetime
    rows = [
        # day with day and night rows; half-even tie on the day side (10.005 -> 10.00)
        ("A.0.S.1", d(2022, 3, 1, 9), "10.00", "50.00"),
        ("A.0.S.1", d(2022, 3, 1, 10), "10.01", "50.01"),
        ("A.0.S.1", d(2022, 3, 1, 21), "8.00", "40.00"),
        # day without night: absent
        ("A.0.S.1", d(2022, 3, 2, 9), "10.00", "50.00"),
        # night measure all null: present, null mean and null difference
        ("A.0.S.1", d(2022, 3, 3, 9), "10.00", "50.00"),
        ("A.0.S.1", d(2022, 3, 3, 3), None, "40.00"),
        # null time: in neither side
        ("A.0.S.1", None, "99.00", "99.00"),
    ]
    df = readings_df(spark, rows)
    got = {r.day: r for r in day_night_diff(enrich(df), "room").collect()}
    assert set(got) == {dt.date(2022, 3, 1), dt.date(2022, 3, 3)}
    a = got[dt.date(2022, 3, 1)]
    assert (a.day_temp, a.night_temp, a.temp_diff) == (10.0, 8.0, 2.0)
    assert (a.day_hum, a.night_hum, a.hum_diff) == (50.0, 40.0, 10.0)
    b = got[dt.date(2022, 3, 3)]
    assert b.night_temp is None and b.temp_diff is None and b.hum_diff == 10.0


@pytest.fixture(scope="module")
def enriched(spark):
    return enrich(sensor_readings(spark, SF01))


@pytest.mark.parametrize("level", LEVELS)
def test_one_shuffle_equals_join(enriched, level):
    assert _sorted(day_night_diff(enriched, level)) == _sorted(day_night_diff_join(enriched, level))


@pytest.mark.parametrize("level", LEVELS)
def test_rollup_equals_direct(enriched, level):
    partials = room_day_partials(enriched)
    assert _sorted(day_night_diff_from_partials(partials, level)) == _sorted(day_night_diff(enriched, level))


def test_room_winner_sf001(enriched):
    assert [tuple(r) for r in max_month(day_night_diff(enriched, "room")).collect()] == [(7, 0.64)]


def _diff_table(spark, rows):
    return spark.createDataFrame(rows, "day date, temp_diff double, hum_diff double")


def test_month_ties_kept(spark):
    rows = [(dt.date(2021, 1, 5), 1.0, 0.0), (dt.date(2022, 1, 7), 2.0, 0.0),
            (dt.date(2021, 2, 5), 1.5, 0.0), (dt.date(2021, 3, 5), -4.0, 0.0)]
    got = sorted(tuple(r) for r in max_month(_diff_table(spark, rows)).collect())
    assert got == [(1, 1.5), (2, 1.5)]
    m = {r.month: r for r in monthly_diff_means(_diff_table(spark, rows)).collect()}
    assert m[1].n_days == 2 and m[1].temp == 1.5


def test_month_all_null_is_empty(spark):
    rows = [(dt.date(2021, 1, 5), None, 1.0)]
    assert max_month(_diff_table(spark, rows)).collect() == []


def test_winner_on_unrounded_mean(spark):
    # month 1 mean 1.004999.. (rounds to 1.00), month 2 mean 1.0049 -> month 1 wins.
    rows = [(dt.date(2021, 1, d), v, 0.0) for d, v in [(1, 1.01), (2, 1.0), (3, 1.0), (4, 1.01)]]
    rows += [(dt.date(2021, 2, 1), 1.0, 0.0)]
    got = [tuple(r) for r in max_month(_diff_table(spark, rows)).collect()]
    assert got == [(1, 1.0)]


GOLDEN_SAMPLE = [
    # committed difference rows (day; key; day_temp; day_hum; night_temp; night_hum; temp_diff; hum_diff)
    ("2020-08-04", "C.B.S.D", 27.86, 37.08, 31.69, 40.84, -3.83, -3.76),
]


def test_difference_invariant_on_sample(spark):
    df = spark.createDataFrame(GOLDEN_SAMPLE, "day string, k string, dt double, dh double, nt double, nh double, td double, hd double")
    for r in df.selectExpr("bround(dt - nt, 2) = td AS a", "bround(dh - nh, 2) = hd AS b").collect():
        assert r.a and r.b


def test_float_variant_agrees_without_ties(spark):
    from thermograph.operators.daynight import day_night_diff_float
    d = dt.datetime
    rows = [("A.0.S.1", d(2022, 3, 1, 9), "10.10", "50.20"), ("A.0.S.1", d(2022, 3, 1, 10), "10.30", "50.40"),
            ("A.0.S.1", d(2022, 3, 1, 22), "8.00", "40.00")]
    df = enrich(readings_df(spark, rows))
    a = day_night_diff_float(df, "room").first()
    b = day_night_diff(df, "room").first()
    assert (a.day_temp, a.night_temp, a.temp_diff, a.hum_diff) == (b.day_temp, b.night_temp, b.temp_diff, b.hum_diff)


def test_null_location_has_no_difference(spark):
    d = dt.datetime
    rows = [(None, d(2022, 3, 1, 9), "10.00", "50.00"), (None, d(2022, 3, 1, 22), "8.00", "40.00"),
            ("A.0.S.1", d(2022, 3, 1, 9), "10.00", "50.00"), ("A.0.S.1", d(2022, 3, 1, 22), "8.00", "40.00")]
    df = enrich(readings_df(spark, rows))
    for lv in LEVELS:
        a = _sorted(day_night_diff(df, lv))
        assert a == _sorted(day_night_diff_join(df, lv)) == _sorted(
            day_night_diff_from_partials(room_day_partials(df), lv)), lv
    assert len(_sorted(day_night_diff(df, "room"))) == 1
