"""Sums of DOUBLE, FLOAT and wide DECIMAL measures keep every digit."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from thermograph.functions.exact import binary_places, held
from thermograph.operators.daynight import daily_means, day_night_diff, day_night_diff_from_partials
from thermograph.operators.daynight import room_day_partials
from thermograph.operators.enrich import enrich
from thermograph.operators.moving import moving_average
from thermograph.operators.readings import dedupe_readings

START = dt.datetime(2022, 5, 1, 9)


def half_even(x: Fraction) -> float:
    return float(round(x * 100)) / 100  # round() of a Fraction goes to the even number


def values(kind: str, n: int) -> list:
    rng = random.Random(kind)
    if kind == "decimal(30,18)":
        return [Decimal(rng.randint(-10**20, 10**20)).scaleb(-18) for _ in range(n)]
    if kind == "float":
        import numpy as np
        return [float(np.float32(rng.uniform(-40, 60))) for _ in range(n)]
    out = [rng.choice([rng.uniform(-50, 50), rng.uniform(0, 1) * 2.0 ** rng.randint(-80, 40), 0.0,
                       -0.0, 0.125, 20.0149996, 1e-300, -3.5, 2.0**50 + 0.25, 5e-324])
           for _ in range(n)]
    return out + [None, math.nan, math.inf]


def frame(spark, kind, vs, key=lambda i: i % 3):
    rows = [(f"A.0.S.{key(i)}", START + dt.timedelta(minutes=11 * (i % 200)), v, v) for i, v in enumerate(vs)]
    return spark.createDataFrame(
        rows, f"location string, dateTime timestamp, temperature {kind}, humidity {kind}")


def finite(v) -> bool:
    return v is not None and not (isinstance(v, float) and not math.isfinite(v))


@pytest.mark.parametrize("kind", ["double", "float", "decimal(30,18)"])
def test_daily_means(spark, kind):
    vs = values(kind, 120)
    df = enrich(frame(spark, kind, vs))
    got = {(r.fullRoomLocation, r.day, r.daily): r.avg_temp for r in daily_means(df).collect()}
    want = {}
    for i, v in enumerate(vs):
        at = START + dt.timedelta(minutes=11 * (i % 200))
        want.setdefault((f"A.0.S.{i % 3}", at.date(), 8 <= at.hour < 20), []).append(v)
    for k, vs in want.items():
        vs = [Fraction(v) for v in vs if finite(v)]
        assert got[k] == (half_even(sum(vs) / len(vs)) if vs else None), k
    assert got.keys() == want.keys()


@pytest.mark.parametrize("kind", ["double", "decimal(30,18)"])
def test_frames_and_partials(spark, kind):
    # Fewer digits here: each one is a column of every frame.
    vs = [v for v in values(kind, 90) if not finite(v) or v == 0 or abs(v) > 1e-6]
    df = enrich(frame(spark, kind, vs))
    plain = moving_average(df, "room", "1 hour").collect()
    prefix = moving_average(df, "room", "1 hour", strategy="prefix").collect()
    assert sorted(map(str, plain)) == sorted(map(str, prefix))
    at = [START + dt.timedelta(minutes=11 * (i % 200)) for i in range(len(vs))]
    want = []
    for i in range(len(vs)):
        inside = [Fraction(vs[j]) for j in range(len(vs)) if j % 3 == i % 3 and finite(vs[j])
                  and at[i] - dt.timedelta(hours=1) <= at[j] <= at[i]]
        want.append((f"A.0.S.{i % 3}", at[i], half_even(sum(inside) / len(inside)) if inside else None))
    assert sorted((r.fullRoomLocation, r.dateTime, str(r.avg_temp)) for r in plain) == sorted(
        (a, b, str(c)) for a, b, c in want)
    one = day_night_diff(df, "floor").collect()
    how = held(df, "temperature", "humidity")
    two = day_night_diff_from_partials(room_day_partials(df, how), "floor", how).collect()
    assert one and sorted(map(str, one)) == sorted(map(str, two))


@pytest.mark.parametrize("kind", ["double", "decimal(30,18)"])
def test_merged_duplicates(spark, kind):
    vs = values(kind, 60)
    df = frame(spark, kind, vs, key=lambda i: i % 7).withColumn("dateTime", F.lit(START))
    got = {r.location: (r.temperature, r.n_readings) for r in dedupe_readings(df).collect()}
    for k in range(7):
        mine = vs[k::7]
        exact = [Fraction(v) for v in mine if finite(v)]
        assert got[f"A.0.S.{k}"] == (float(sum(exact) / len(exact)), len(mine))


def test_a_value_below_the_tie_rounds_down(spark, tmp_path):
    from thermograph.sources.readings import read_readings_csv
    (tmp_path / "r.csv").write_text(
        "location;dateTime;temperature;humidity\nA.0.S.1;2022-05-01 09:00;20.0149996;20.015\n")
    rows = read_readings_csv(spark, str(tmp_path / "r.csv"))
    for df in (rows, rows.withColumn("temperature", F.col("temperature").cast("double"))):
        r = daily_means(enrich(df)).first()
        assert (r.avg_temp, r.avg_hum) == (20.01, 20.02)


def test_digits_hold_the_last_bit():
    for least, bits in ((1.0, 53), (5e-324, 53), (0.1, 24), (1e300, 53), (2.0**-20, 53)):
        last = Fraction(least) * Fraction(1, 2**(bits - 1))
        digits = Fraction(1, 2**(24 * binary_places(least, bits)))
        assert digits <= last or Fraction(least) % digits == 0


def test_types_that_cannot_be_held_raise(spark):
    df = spark.createDataFrame([(Decimal("1"),)], "temperature decimal(38,20)")
    with pytest.raises(ValueError):
        held(df, "temperature")
