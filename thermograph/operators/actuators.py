"""Threshold actuators as a batch computation.

An actuator starts off; a value above the limit switches it on, a value below
the limit switches it off, a value equal to the limit (or missing) changes
nothing.  So the state after a message is the last "signal" (1 above, 0 below)
seen so far, or off when there is none, and a message is a transition when its
signal differs from the state before it.

Plan: the order (scope key, time, tiebreak) is cut into blocks of rows, by row
count (``operators.blocks``), so that a key with a large share of the messages, one
instant, a missing time or a single actuator for all messages is spread over many
tasks.  On the states {off, on} a block is a function: constant (the last signal in
it) or the identity (no signal), so blocks compose by "the last one that is not the
identity", an associative scan over a small table with one row per (key, block).
The state entering a block is joined back on (key, block), which is also the
partitioning of the window inside blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermograph.constants import HUMIDITY_LIMIT, TEMPERATURE_LIMIT
from thermograph.functions.calendar import epoch_micros, floor_div
from thermograph.operators.blocks import BLOCK, row_blocks, target_rows
from thermograph.session import is_small, join_null_safe, key_parts

DAY_US = 86400 * 10**6
HOUR_US = 3600 * 10**6
# Rows of a block that is windowed in one task.
TARGET_ROWS = 1_000_000
# Time order of a missing time: before every real one (year 1 is -6.2e16), and
# small enough that the packed order fits DECIMAL(38,0).
NO_TIME = -10**17
DEFAULT_LIMITS = {"temperature": TEMPERATURE_LIMIT, "humidity": HUMIDITY_LIMIT}


def time_order(ts: str) -> Column:
    """Microseconds since the epoch; missing times come first, as nulls do."""
    return F.coalesce(epoch_micros(ts), F.lit(NO_TIME))


def signal(value: Column | str, limit: float) -> Column:
    """1 above the limit, 0 below it, null at the limit or for a null value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v > F.lit(limit), F.lit(1)).when(v < F.lit(limit), F.lit(0))


def _packed_order(ord_col: str, tiebreak: str, tiebreak_type: str) -> Column:
    """(time, tiebreak) as one orderable number: time * 10^20 + (tiebreak +
    2^63 + 1, 0 if missing) for an integral tiebreak (fits DECIMAL(38,0) for any BIGINT time in
    microseconds); a struct for any other tiebreak type."""
    if tiebreak_type in ("bigint", "int", "smallint", "tinyint"):
        return F.expr(f"CAST({ord_col} AS DECIMAL(38,0)) * CAST(1e20 AS DECIMAL(38,0)) "
                      f"+ coalesce(CAST({tiebreak} AS DECIMAL(38,0)) "
                      f"+ CAST(9223372036854775809 AS DECIMAL(38,0)), CAST(0 AS DECIMAL(38,0)))")
    return F.struct(F.col(ord_col), F.col(tiebreak))


def _state_word(c: Column) -> Column:
    return F.when(c == 1, F.lit("on")).otherwise(F.lit("off"))


def actuator_states(readings: DataFrame, limits: dict[str, float] | None = None, *,
                    scope: str = "location", location: str = "location",
                    ts: str = "dateTime", tiebreak: str = "event_id",
                    bucket_us: int | str | None = "auto", block_rows: int | None = None,
                    keep: list[str] | tuple = (),
                    initial: DataFrame | None = None) -> DataFrame:
    """One row per message with the state of every actuator after it.

    Output: <key>, event_id, dateTime, and per metric ``<m>`` (a measure
    column): ``<m>_state`` ("on"/"off") and ``<m>_event`` ("on", "off" or
    "no change"), plus the ``keep`` columns passed through.
    ``scope="location"`` keeps one actuator per location;
    ``scope="global"`` shares one actuator among all messages (one key, still
    split into blocks).  ``initial`` (one row per key: the key column and
    ``<m>`` as 0/1) gives the states before the first message, e.g. the state
    left by earlier micro-batches; missing keys start off.

    ``bucket_us="auto"``: one window partition per key for an input that the
    optimizer estimates small, else blocks of up to ``spark.thermograph.bucketRows``
    rows.  ``block_rows`` asks for blocks of so many rows, whatever the size;
    ``bucket_us`` in microseconds for clock buckets of that width, None for one
    partition per key.  Messages that are equal in key, time and tiebreak have no
    order among each other."""
    limits = limits or DEFAULT_LIMITS
    key = location if scope == "location" else "_scope"
    df = readings
    if scope != "location":
        df = df.withColumn("_scope", F.lit("all"))
    df = df.withColumn("_ord", time_order(ts))
    if bucket_us == "auto" and block_rows is None:
        block_rows = None if is_small(readings) else target_rows(readings, TARGET_ROWS)
        bucket_us = None
    df = df.withColumns({**{f"_sig_{m}": signal(m, lim) for m, lim in limits.items()},
                         **key_parts(key)})
    if block_rows is not None:
        # Rows without a tiebreak at one instant are dealt by what they say.
        df = df.withColumn("_tie", F.xxhash64(*limits))
        df = row_blocks(df, ["_kn", "_kv", "_ord", tiebreak, "_tie"], block_rows, "actuator_blocks")
        df = df.withColumnRenamed(BLOCK, "_bucket")
    else:
        df = df.withColumn("_bucket", floor_div("_ord", bucket_us) if bucket_us
                           else F.lit(0).cast("bigint"))
    w = Window.partitionBy("_kn", "_kv", "_bucket").orderBy("_ord", tiebreak)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({
        **{f"_now_{m}": F.last(f"_sig_{m}", ignorenulls=True).over(upto) for m in limits},
        **{f"_was_{m}": F.last(f"_sig_{m}", ignorenulls=True).over(prior) for m in limits},
    })
    if bucket_us or block_rows is not None or initial is not None:
        j = _with_carry(df, local, key, limits, tiebreak, location, scope, initial)
    else:
        # one partition per key and nothing before it: no state to carry in
        j = local.withColumns({f"_carry_{m}": F.lit(None).cast("int") for m in limits})
    out = [key, tiebreak, ts, *keep]
    cols = {}
    for m in limits:
        now = F.coalesce(F.col(f"_now_{m}"), F.col(f"_carry_{m}"), F.lit(0))
        was = F.coalesce(F.col(f"_was_{m}"), F.col(f"_carry_{m}"), F.lit(0))
        cols[f"{m}_state"] = _state_word(now)
        cols[f"{m}_event"] = F.when(now != was, _state_word(now)).otherwise(F.lit("no change"))
        out += [f"{m}_state", f"{m}_event"]
    res = j.withColumns(cols).select(*out)
    if scope != "location":
        res = res.drop("_scope")
    return res


def _with_carry(df: DataFrame, local: DataFrame, key: str, limits: dict[str, float],
                tiebreak: str, location: str, scope: str, initial: DataFrame | None) -> DataFrame:
    """Joins to every row the state entering its (key, bucket)."""
    # Last signal of each (key, bucket), ordered by (time, tiebreak).  The
    # order is packed into one DECIMAL(38,0) so the aggregate stays a hash
    # aggregate (a struct ordering would force a sort of every input row).
    order_key = _packed_order("_ord", tiebreak, dict(df.dtypes)[tiebreak])
    lasts = df.groupBy(key, "_bucket").agg(*[
        F.max_by(F.col(f"_sig_{m}"), F.when(F.col(f"_sig_{m}").isNotNull(), order_key))
        .alias(f"_last_{m}") for m in limits])
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select(key, "_bucket", *[
        F.last(f"_last_{m}", ignorenulls=True).over(before).alias(f"_carry_{m}") for m in limits])
    if initial is not None:
        init = initial.select(F.col(location).alias(key) if scope == "location" else F.lit("all").alias(key),
                              *[F.col(m).cast("int").alias(f"_init_{m}") for m in limits])
        carry = join_null_safe(carry, init, [key]).select(
            key, "_bucket", *[F.coalesce(f"_carry_{m}", f"_init_{m}").alias(f"_carry_{m}") for m in limits])
    # keyed like the window, so the join reuses its partitioning
    return local.join(carry.withColumns(key_parts(key)).drop(key), ["_kn", "_kv", "_bucket"], "left")


def actuator_transitions(readings: DataFrame, metric: str = "temperature",
                         limit: float | None = None, **kw) -> DataFrame:
    """Messages that switch one actuator: <key>, event_id, dateTime, value,
    action ("on"/"off")."""
    lim = DEFAULT_LIMITS[metric] if limit is None else limit
    states = actuator_states(readings, {metric: lim}, keep=[metric], **kw)
    key = [kw.get("location", "location")] if kw.get("scope", "location") == "location" else []
    return (states.where(F.col(f"{metric}_event") != "no change")
            .select(*key, kw.get("tiebreak", "event_id"), kw.get("ts", "dateTime"),
                    F.col(metric).cast("double").alias("value"),
                    F.col(f"{metric}_event").alias("action")))


def actuator_events(readings: DataFrame, limits: dict[str, float] | None = None,
                    **kw) -> DataFrame:
    """All switching events of both actuators: <key>, event_id, dateTime,
    metric, value, action.  Within one message temperature comes first."""
    limits = limits or DEFAULT_LIMITS
    key = [kw.get("location", "location")] if kw.get("scope", "location") == "location" else []
    tiebreak = kw.get("tiebreak", "event_id")
    ts = kw.get("ts", "dateTime")
    st = actuator_states(readings, limits, keep=list(limits), **kw)
    stacked = st.select(
        *key, tiebreak, ts,
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                     F.col(f"{m}_event").alias("action"))
            for m in limits])).alias("_e"))
    return (stacked.where(F.col("_e.action") != "no change")
            .select(*key, tiebreak, ts, "_e.metric", "_e.value", "_e.action"))


def final_states(states: DataFrame, metrics: list[str], *, key: str = "location",
                 ts: str = "dateTime", tiebreak: str = "event_id") -> DataFrame:
    """State of every actuator after the last message of each key (0/1), from
    the output of :func:`actuator_states`: one row per key, a hash aggregate."""
    df = states.withColumn("_ord", time_order(ts))
    order_key = _packed_order("_ord", tiebreak, dict(df.dtypes)[tiebreak])
    return df.groupBy(key).agg(*[
        F.max_by(F.when(F.col(f"{m}_state") == "on", 1).otherwise(0), order_key).alias(m)
        for m in metrics])
