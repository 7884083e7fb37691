"""Property tests: every plan against a brute-force computation in Python."""

import datetime as dt
from decimal import ROUND_HALF_EVEN, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import readings_df
from thermograph.operators.actuators import actuator_states
from thermograph.operators.enrich import enrich
from thermograph.operators.moving import moving_average

T0 = dt.datetime(2022, 3, 1)
ROOMS = ["A.0.S.1", "A.0.S.2", "B.1.0.1"]

row = st.tuples(
    st.sampled_from(ROOMS),
    st.one_of(st.none(), st.integers(0, 48 * 6).map(lambda k: T0 + dt.timedelta(minutes=10 * k))),
    st.one_of(st.none(), st.integers(-500, 4000).map(lambda c: Decimal(c) / 100)),
    st.one_of(st.none(), st.integers(0, 10000).map(lambda c: Decimal(c) / 100)),
)


def _he(total: Decimal, n: int):
    if n == 0:
        return None
    return float((total / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_EVEN))


def _brute(rows, level_of, h):
    out = []
    for loc, t, temp, hum in rows:
        k = level_of(loc)

        def frame(key_of, idx):
            vals = []
            for loc2, t2, *ms in rows:
                if key_of(loc2) != key_of(loc):
                    continue
                if t is None:
                    ok = t2 is None
                else:
                    ok = t2 is not None and t - h <= t2 <= t
                if ok and ms[idx] is not None:
                    vals.append(ms[idx])
            return _he(sum(vals, Decimal(0)), len(vals))

        out.append((k, t, frame(level_of, 0), frame(lambda x: x, 1)))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_moving_average_plans_equal_brute_force(spark, rows):
    df = enrich(readings_df(spark, rows)).cache()
    h = dt.timedelta(hours=1)
    want = _brute(rows, lambda loc: loc.split(".")[0], h)
    for strategy, bucket in (("plain", None), ("prefix", "10 minute"), ("prefix", "1 hour"),
                             ("halo", "1 hour"), ("halo", "auto")):
        got = moving_average(df, "neighborhood", "1 hour", strategy=strategy, bucket=bucket).collect()
        assert sorted((tuple(r) for r in got), key=repr) == want, (strategy, bucket)
    df.unpersist()


def _brute_states(rows, limit):
    state = {}
    out = {}
    for loc, t, v, eid in sorted(rows, key=lambda r: (r[1], r[3])):
        was = state.get(loc, 0)
        now = was
        if v is not None and v > limit:
            now = 1
        elif v is not None and v < limit:
            now = 0
        state[loc] = now
        out[eid] = ("on" if now else "off", ("on" if now else "off") if now != was else "no change")
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(ROOMS[:2]),
                          st.integers(0, 72).map(lambda k: T0 + dt.timedelta(minutes=20 * k)),
                          st.one_of(st.none(), st.sampled_from([Decimal("29.99"), Decimal("30"), Decimal("30.01"), Decimal("45")]))),
                min_size=1, max_size=40))
def test_actuator_plans_equal_brute_force(spark, rows):
    rows = [(loc, t, v, i) for i, (loc, t, v) in enumerate(rows)]
    df = readings_df(spark, [(loc, t, v, "50") for loc, t, v, _ in rows]) \
        .withColumn("event_id", F.monotonically_increasing_id())
    ids = {r.event_id: i for i, r in enumerate(df.select("event_id").collect())}
    want = _brute_states(rows, 30)
    for bucket in (None, 3600 * 10**6, 86400 * 10**6):
        got = actuator_states(df, {"temperature": 30}, bucket_us=bucket).collect()
        assert {ids[r.event_id]: (r.temperature_state, r.temperature_event) for r in got} == want, bucket


def test_null_locations_all_plans(spark):
    d = dt.datetime
    rows = [(None, d(2022, 3, 1, 0, 0), "10.00", "1.00"), (None, d(2022, 3, 1, 2, 0), "20.00", "2.00"),
            (None, d(2022, 3, 1, 4, 30), "31.00", "3.00"), ("A.0.S.1", d(2022, 3, 1, 1), "40.00", "4.00"),
            (None, d(2022, 3, 1, 5, 0), "29.00", None)]
    df = enrich(readings_df(spark, rows)).cache()
    want = sorted((tuple(r) for r in moving_average(df, "room", "1 day", strategy="plain").collect()), key=repr)
    for strategy, bucket in (("prefix", "1 hour"), ("halo", "1 day"), ("prefix", "auto")):
        got = moving_average(df, "room", "1 day", strategy=strategy, bucket=bucket).collect()
        assert sorted((tuple(r) for r in got), key=repr) == want, (strategy, bucket)
    raw = readings_df(spark, rows).withColumn("event_id", F.monotonically_increasing_id())
    plain = sorted((tuple(r) for r in actuator_states(raw, bucket_us=None).collect()), key=repr)
    hourly = sorted((tuple(r) for r in actuator_states(raw, bucket_us=3600 * 10**6).collect()), key=repr)
    assert plain == hourly
