"""Exact two-digit arithmetic: half-even rounding by integer steps."""

from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from thermograph.functions.exact import half_even_div, mean_2dp, to_cents


def _py(s, n):
    return int((Decimal(s) / Decimal(n)).quantize(Decimal(1), rounding=ROUND_HALF_EVEN))


def test_ties_and_signs(spark):
    cases = [(5, 2), (15, 2), (-5, 2), (-15, 2), (7, 3), (-7, 3), (0, 5), (1, 0), (10, 4), (-10, 4)]
    df = spark.createDataFrame(cases, "s bigint, n bigint")
    got = {(r.s, r.n): r.q for r in df.select("s", "n", half_even_div("s", "n").alias("q")).collect()}
    for s, n in cases:
        assert got[(s, n)] == (None if n == 0 else _py(s, n)), (s, n)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "s bigint, n bigint")
    got = [r.q for r in df.select(half_even_div("s", "n").alias("q")).collect()]
    assert got == [_py(s, n) for s, n in pairs]


def test_cents_and_mean(spark):
    df = spark.createDataFrame([("12.35",), ("-0.05",), (None,)], "x string") \
        .select(F.col("x").cast("decimal(10,2)").alias("x"))
    assert [r.c for r in df.select(to_cents("x").alias("c")).collect()] == [1235, -5, None]
    m = spark.createDataFrame([(1235 + 1236, 2)], "s bigint, n bigint") \
        .select(mean_2dp("s", "n").alias("m")).first().m
    assert m == 12.36  # 12.355 -> 12.36 (6 is even)
