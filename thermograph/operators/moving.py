"""Time-range moving averages.

For every reading: the mean of the readings of the same key whose time lies
in ``[t - horizon, t]`` (all rows with an equal time are peers, the lower bound
is inclusive), rounded half-even to two digits.  Temperature is windowed by the
level key; humidity by the room key (``humidity_scope="room"``, as the batch
job does) or by the level key (``"level"``).

Frame sums are exact BIGINT sums (``functions.exact``), always written as differences
of *growing* frames (``UNBOUNDED PRECEDING .. x``), which Spark evaluates
incrementally: the cost per row does not depend on how many rows a frame holds
(a sliding RANGE frame re-aggregates its buffer whenever its lower edge moves).

Strategies (a key may hold a large share of all rows -- there are only a
handful of neighborhoods -- so the default never windows a whole key in one
task):

``"prefix"``
    Time is cut into buckets of width ``g`` dividing every horizon
    (``h = m * g``).  For a row at ``t`` in bucket ``b``::

        sum[t-h, t] = own(b, <= t) + total(b-m .. b-1) - own(b-m, < t-h)

    The first term is a growing frame over bucket ``b``.  The last term is a
    growing frame over a *ghost* copy of bucket ``b-m`` shifted forward by
    ``h`` into bucket ``b`` (each row is copied exactly once per horizon).
    The middle term comes from a small table of bucket totals per (key,
    bucket), joined on (key, bucket).  Work per task is bounded by one
    bucket of one key, whatever the horizon.  With ``bucket="auto"`` the
    width is chosen per key from the data, as below.
``"halo"``
    Buckets of width ``B`` (default 4 horizons, at least a day); each row also
    goes as a halo copy to the later buckets whose frames reach back to it
    (about ``h / B`` extra rows).  Cheaper (no totals table), but a bucket of
    a hot key holds ``B`` worth of its rows.
``"blocks"``
    For keys with so many rows in an hour that no clock bucket bounds a task.  Rows
    are added up per (key, instant); each instant asks for the sum of all up to it
    and, per horizon, of all before ``t - h``.  Instants and questions are sorted
    together, by key and time, and cut into blocks by row count
    (``operators.blocks``); growing sums inside a block, and one row per (key, block)
    for what comes before it, answer them.  The answers are joined to the rows.
``"plain"``
    One window partition per key (the textbook form).

Rows without a time are peers of each other only: but for ``plain``, they get their
key's sums from an aggregate joined to them, not from a window.

``strategy="auto"`` (the default) takes ``plain`` when the optimizer's size
estimate of the input is small (``spark.thermograph.smallInputBytes``,
64 MiB): one task per key is cheap there and buckets would only add stages.
Otherwise the input is aggregated once, to sums and counts per (all keys,
hour), and that table is written to the shared folder.  A grouping-sets sum over
it (one number per window key to the driver) finds the busiest (key, hour), and
each window key gets ``halo`` if a halo bucket of its busiest stretch stays under
``spark.thermograph.bucketRows`` (1,000,000) rows, else ``prefix`` with the
widest whole-hour bucket that does, else ``blocks``: sparse keys take the cheap
plan, a hot key the bounded one.  The bucket totals of every window key are rolled
up from the same table, so the input is read twice (once for the table, once for
the rows), whatever the number of keys; once more for each key that takes
``blocks``.
"""

from __future__ import annotations

import uuid
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermograph.constants import HORIZONS, LEVEL_KEY
from thermograph.functions.calendar import epoch_micros, floor_div
from thermograph.functions.exact import Held, cents_to_double, held
from thermograph.operators.blocks import BLOCK, row_blocks, target_rows
from thermograph.session import is_small, join_null_safe, key_parts, scratch_path

_US = {"us": 1, "microsecond": 1, "ms": 1000, "millisecond": 1000,
       "s": 10**6, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
       "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}

_ORD = "_ord"
# Adaptive prefix buckets aim at most this many rows per (key, bucket)
# (``spark.thermograph.bucketRows``).
TARGET_BUCKET_ROWS = 1_000_000
_SHORT = {"temperature": "temp", "humidity": "hum"}
HOUR_US = _US["hour"]


def horizon_micros(horizon: str | int) -> int:
    """``"7 days"`` / ``"1 hour"`` / ``"week"`` / microseconds -> microseconds."""
    if isinstance(horizon, int):
        return horizon
    h = HORIZONS.get(horizon, horizon).strip().lower()
    num, _, unit = h.partition(" ")
    if not unit:
        num, unit = "1", num
    unit = unit.rstrip("s") if unit not in ("s", "us", "ms") else unit
    return int(float(num) * _US[unit])


def auto_bucket_micros(h_us: int) -> int:
    """Default halo bucket width: four horizons, at least one day."""
    return max(4 * h_us, _US["day"])


def _unit_cols(how: dict[str, Held]) -> dict[str, Column]:
    """The whole numbers that hold the measures, ``_c_<part>``."""
    return {f"_c_{p}": c for h in how.values() for p, c in h.values().items()}


def _parts(how: dict[str, Held], measures: list[str]) -> list[str]:
    return [p for m in measures for p in how[m].parts]


def _out_name(measure: str, name: str, tag: str | None) -> str:
    return f"avg_{_SHORT[measure]}_{name}" if tag is None else f"avg_{_SHORT[measure]}_{tag}_{name}"


def _mean_cols(how: dict[str, Held], measures: list[str], names: list[str],
               tag: str | None = None) -> dict[str, Column]:
    return {_out_name(m, nm, tag): cents_to_double(
                how[m].mean(f"_s_{{}}_{nm}".format, f"_n_{m}_{nm}"))
            for nm in names for m in measures}


def _drop_sums(df: DataFrame, measures: list[str], names: list[str]) -> DataFrame:
    return df.drop(*[f"_{p}_{m}_{nm}" for nm in names for m in measures for p in ("s", "n")])


# --- plain and halo ---------------------------------------------------------

def _with_halo(df: DataFrame, h_us: int, width: int) -> DataFrame:
    """Adds ``_bucket`` and ``_halo``: the row in its own bucket, plus a halo
    copy in every later bucket whose frames reach back to it."""
    own = floor_div(_ORD, width)
    last = floor_div(f"{_ORD} + {int(h_us)}", width)
    buckets = F.when(F.col(_ORD).isNull(), F.array(F.lit(None).cast("bigint"))) \
        .otherwise(F.sequence(own, last))
    return (df.withColumn("_own", own)
            .withColumn("_bucket", F.explode(buckets))
            .withColumn("_halo", F.coalesce(F.col("_bucket") != F.col("_own"), F.lit(False)))
            .drop("_own"))


def _growing_stage(df: DataFrame, key: str, measures: list[str], hs: dict[str, int],
                   width: int | None) -> DataFrame:
    spec = [key]
    if width:
        df = _with_halo(df, max(hs.values()), width)
        spec = [key, "_bucket"]
    w = Window.partitionBy(*spec).orderBy(_ORD)
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    has_t = F.col(_ORD).isNotNull()  # a null time is a peer of null times only
    cols: dict[str, Column] = {}
    for nm, h in hs.items():
        before = w.rangeBetween(Window.unboundedPreceding, -(h + 1))
        for m in measures:
            c = F.col(f"_c_{m}")
            cols[f"_s_{m}_{nm}"] = F.sum(c).over(upto) - F.coalesce(
                F.when(has_t, F.sum(c).over(before)), F.lit(0))
            cols[f"_n_{m}_{nm}"] = F.count(c).over(upto) - F.coalesce(
                F.when(has_t, F.count(c).over(before)), F.lit(0))
    df = df.withColumns(cols)
    if width:
        df = df.where(~F.col("_halo")).drop("_bucket", "_halo")
    return df


# --- prefix -------------------------------------------------------------------

def _bucket_totals(base: DataFrame, keys: list[str], measures: list[str], g: int) -> DataFrame:
    """Sums, counts and rows per (keys, fine bucket); rows without a time have a
    null bucket."""
    return (base.groupBy(*keys, floor_div(_ORD, g).alias("_b"))
            .agg(F.count(F.lit(1)).alias("_rows"),
                 *[e for m in measures for e in (
                     F.sum(f"_c_{m}").alias(f"_ts_{m}"), F.count(f"_c_{m}").alias(f"_tn_{m}"))]))


def _written_totals(base: DataFrame, keys: list[str], measures: list[str], g: int) -> DataFrame:
    """``_bucket_totals`` over all ``keys``, written to the shared folder: what
    every window key rolls its own totals up from."""
    spark = base.sparkSession
    totals = _bucket_totals(base, keys, measures, g)
    path = scratch_path(spark, f"moving_totals-{uuid.uuid4().hex}")
    totals.write.parquet(path)
    return spark.read.schema(totals.schema).parquet(path)


# Widths below an hour, for keys with more rows in an hour than one task takes.
SUB_HOUR_US = [m * 60 * 10**6 for m in (30, 15, 5, 1)]


def candidate_widths(hs: list[int]) -> list[int]:
    """Bucket widths for the prefix strategy, widest first: whole hours
    dividing every horizon (or the common divisor itself below an hour)."""
    g = 0
    for h in hs:
        g = gcd(g, h)
    if g % HOUR_US:
        return [g]
    units = g // HOUR_US
    return [d * HOUR_US for d in range(units, 0, -1) if units % d == 0]


def busiest_hours(base: DataFrame, keys: list[str], totals: DataFrame | None = None,
                  fine: int = HOUR_US) -> dict[str, int]:
    """Most rows any single (key, hour) holds, for every key column: one
    scan with grouping sets and partial aggregation; one number per key
    reaches the driver.  With ``totals`` (per bucket of ``fine``, a part of an
    hour) the scan is of that table, not of ``base``."""
    keys = list(dict.fromkeys(keys))
    if totals is None:
        x = base.where(F.col(_ORD).isNotNull()).select(
            *keys, floor_div(_ORD, HOUR_US).alias("_h"), F.lit(1).cast("bigint").alias("_rows"))
    else:
        x = totals.where("_b is not null").select(
            *keys, floor_div(f"_b * {fine}", HOUR_US).alias("_h"), "_rows")
    rows = F.sum("_rows").alias("_r")
    if len(keys) == 1:
        r = x.groupBy(keys[0], "_h").agg(rows).agg(F.max("_r")).first()[0]
        return {keys[0]: r or 0}
    n = len(keys)
    # grouping_id: a set bit for every column left out of the set, first column highest
    gid = {sum(1 << (n - j) for j in range(n) if j != i): keys[i] for i in range(n)}
    per = (x.groupingSets([[k, "_h"] for k in keys], *keys, "_h")
           .agg(rows, F.grouping_id().alias("_gid"))
           .groupBy("_gid").agg(F.max("_r").alias("r")))
    out = {k: 0 for k in keys}
    for row in per.collect():
        out[gid[row["_gid"]]] = row["r"] or 0
    return out


def _plan_stages(base: DataFrame, stage_keys: list[str], hs: list[int], adaptive_halo: bool,
                 target_rows: int, totals: DataFrame | None = None,
                 fine: int = HOUR_US) -> dict[str, tuple[str, int]]:
    """Per window key: ``("halo", B)`` when a halo bucket of the busiest key
    stays under the row target, else ``("prefix", g)`` with the widest whole-hour
    bucket that does, else ``("blocks", target)``.  Without ``adaptive_halo``: always
    ``prefix``, below an hour as if an hour's rows were spread evenly."""
    busiest = busiest_hours(base, stage_keys, totals, fine)
    halo_b = auto_bucket_micros(max(hs))
    widths = candidate_widths(hs)
    widths += [w for w in SUB_HOUR_US if w < widths[-1] and all(h % w == 0 for h in hs)]
    plan = {}
    for k in dict.fromkeys(stage_keys):
        r = busiest.get(k, 0)
        if adaptive_halo and r * -(-halo_b // HOUR_US) <= target_rows:
            plan[k] = ("halo", halo_b)
            continue
        if adaptive_halo:
            fit = [w for w in widths if r * max(1, w / HOUR_US) <= target_rows]
            plan[k] = ("prefix", fit[0]) if fit else ("blocks", target_rows)
            continue
        fit = [w for w in widths if r * w / HOUR_US <= target_rows]
        plan[k] = ("prefix", fit[0] if fit else widths[-1])
    return plan


def _span_totals(totals: DataFrame, key: str, measures: list[str], ms: dict[str, int],
                 fine: int | None = None, g: int | None = None) -> DataFrame:
    """total(b-m .. b-1) per (key, b) for every horizon, as growing-frame
    differences over the small totals table (one row per key and bucket).
    ``fine``: the totals are of more keys and of buckets of ``fine``, a part
    of ``g``, and are rolled up first."""
    totals = totals.where("_b is not null")
    t = totals if fine is None else totals.groupBy(
        key, floor_div(f"_b * {fine}", g).alias("_b")).agg(
        *[F.sum(f"_{p}_{m}").alias(f"_{p}_{m}") for m in measures for p in ("ts", "tn")])
    w = Window.partitionBy(key).orderBy("_b")
    upto = w.rangeBetween(Window.unboundedPreceding, -1)
    cols = []
    for nm, m_ in ms.items():
        before = w.rangeBetween(Window.unboundedPreceding, -(m_ + 1))
        for m in measures:
            for p, out in (("ts", "s"), ("tn", "n")):
                c = F.col(f"_{p}_{m}")
                cols.append((F.coalesce(F.sum(c).over(upto), F.lit(0))
                             - F.coalesce(F.sum(c).over(before), F.lit(0))).alias(f"_d{out}_{m}_{nm}"))
    return t.select(key, "_b", *cols)


def _prefix_stage(rows: DataFrame, key: str, measures: list[str], hs: dict[str, int],
                  g: int, spans: DataFrame, payload: list[str]) -> DataFrame:
    names = list(hs)
    ms = {nm: h // g for nm, h in hs.items()}
    # copy 0 is the row itself; copy i is its ghost for horizon i (shifted by h_i)
    copies = F.when(F.col(_ORD).isNull(), F.array(F.lit(0))) \
        .otherwise(F.array(*[F.lit(i) for i in range(len(names) + 1)]))
    x = rows.withColumn("_b0", floor_div(_ORD, g)).withColumn("_k", F.explode(copies))
    shift = F.lit(0).cast("bigint")
    bshift = F.lit(0).cast("bigint")
    for i, nm in enumerate(names, start=1):
        shift = F.when(F.col("_k") == i, F.lit(hs[nm])).otherwise(shift)
        bshift = F.when(F.col("_k") == i, F.lit(ms[nm])).otherwise(bshift)
    own = F.col("_k") == 0
    x = x.withColumns({
        "_t": F.col(_ORD) + shift,
        "_b": F.col("_b0") + bshift,
        # ghosts carry only what the frame sums need
        **{p: F.when(own, F.col(p)) for p in payload},
    }).drop("_b0")
    x = x.withColumns(key_parts(key))
    w = Window.partitionBy("_kn", "_kv", "_b").orderBy("_t")
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    strictly_before = w.rangeBetween(Window.unboundedPreceding, -1)
    cols: dict[str, Column] = {}
    for m in measures:
        c = F.col(f"_c_{m}")
        cols[f"_os_{m}"] = F.sum(F.when(own, c)).over(upto)
        cols[f"_on_{m}"] = F.count(F.when(own, c)).over(upto)
        for i, nm in enumerate(names, start=1):
            gi = F.col("_k") == i
            cols[f"_gs_{m}_{nm}"] = F.sum(F.when(gi, c)).over(strictly_before)
            cols[f"_gn_{m}_{nm}"] = F.count(F.when(gi, c)).over(strictly_before)
    x = x.withColumns(cols).where(own)
    # spans are keyed the same way: the join reuses the window's partitioning
    x = x.join(spans.withColumns(key_parts(key)).drop(key), ["_kn", "_kv", "_b"], "left")
    timed = F.col(_ORD).isNotNull()
    out: dict[str, Column] = {}
    for m in measures:
        for nm in names:
            for p in ("s", "n"):
                out[f"_{p}_{m}_{nm}"] = (F.coalesce(F.col(f"_o{p}_{m}"), F.lit(0))
                                         + F.when(timed, F.coalesce(F.col(f"_d{p}_{m}_{nm}"), F.lit(0))
                                                  - F.coalesce(F.col(f"_g{p}_{m}_{nm}"), F.lit(0)))
                                         .otherwise(F.lit(0)))
    x = x.withColumns(out)
    drop = ["_k", "_t", "_b", "_kn", "_kv"] + [f"_o{p}_{m}" for m in measures for p in ("s", "n")]
    drop += [f"_{a}{p}_{m}_{nm}" for a in ("g", "d") for p in ("s", "n") for m in measures for nm in names]
    return x.drop(*drop)


# --- blocks, and rows without a time ------------------------------------------

def _key_sums(rows: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(*[e for m in measures for e in (
        F.sum(f"_c_{m}").alias(f"_ts_{m}"), F.count(f"_c_{m}").alias(f"_tn_{m}"))])


def _block_stage(rows: DataFrame, base: DataFrame, key: str, measures: list[str],
                 hs: dict[str, int], target: int) -> DataFrame:
    """Frame sums of the timed ``rows`` from blocks of the instants of ``base``."""
    names, sums = list(hs), [f"_t{p}_{m}" for m in measures for p in ("s", "n")]
    timed = base.where(F.col(_ORD).isNotNull()).withColumns(key_parts(key))
    instants = _key_sums(timed, ["_kn", "_kv", _ORD], measures)
    # Of an instant's rows the last one adds its sums; those before it ask for the
    # sum of what is earlier than t - h, so they come before an instant at t - h.
    own = len(names)
    asks = [F.struct((F.col(_ORD) - h).alias("_at"), F.lit(i).alias("_k"))
            for i, h in enumerate(hs.values())]
    asks.append(F.struct(F.col(_ORD).alias("_at"), F.lit(own).alias("_k")))
    x = instants.withColumn("_a", F.explode(F.array(*asks))).select(
        "_kn", "_kv", _ORD, "_a._at", "_a._k",
        *[F.when(F.col("_a._k") == own, F.col(c)).alias(c) for c in sums])
    x = row_blocks(x, ["_kn", "_kv", "_at", "_k"], target, "moving_blocks")
    inside = (Window.partitionBy(BLOCK, "_kn", "_kv").orderBy("_at", "_k")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = (Window.partitionBy("_kn", "_kv").orderBy(BLOCK)
               .rowsBetween(Window.unboundedPreceding, -1))
    before = x.groupBy(BLOCK, "_kn", "_kv").agg(*[F.sum(c).alias(c) for c in sums]).select(
        BLOCK, "_kn", "_kv", *[F.sum(c).over(earlier).alias(f"_e{c}") for c in sums])
    x = x.withColumns({c: F.sum(c).over(inside) for c in sums}).join(before, [BLOCK, "_kn", "_kv"])
    total = {c: F.coalesce(c, F.lit(0)) + F.coalesce(f"_e{c}", F.lit(0)) for c in sums}
    found = x.groupBy("_kn", "_kv", _ORD).agg(*[
        (F.max(F.when(F.col("_k") == own, total[f"_t{p}_{m}"]))
         - F.max(F.when(F.col("_k") == i, total[f"_t{p}_{m}"]))).alias(f"_{p}_{m}_{nm}")
        for i, nm in enumerate(names) for m in measures for p in ("s", "n")])
    return rows.withColumns(key_parts(key)).join(found, ["_kn", "_kv", _ORD], "left").drop("_kn", "_kv")


def _untimed_stage(rows: DataFrame, untimed: DataFrame, key: str, measures: list[str],
                   names: list[str]) -> DataFrame:
    """Frame sums of rows without a time: all such rows of the key.

    ``untimed``: (keys, ``_ts_`` / ``_tn_`` sums), any number of rows per key."""
    sums = [f"_t{p}_{m}" for m in measures for p in ("s", "n")]
    per = untimed.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums])
    per = per.select(key, *[F.col(f"_t{p}_{m}").alias(f"_{p}_{m}_{nm}")
                            for nm in names for m in measures for p in ("s", "n")])
    return join_null_safe(rows, per, [key])


# --- public -------------------------------------------------------------------

def _resolve(strategy: str, bucket, hs: list[int], df: DataFrame) -> tuple[str, int | None]:
    if bucket is False or bucket is None or strategy == "plain":
        return "plain", None
    if strategy == "auto":
        # small inputs: one window partition per key; else chosen per key
        # from the data (halo or prefix buckets)
        return ("plain", None) if is_small(df) else ("adaptive", None)
    if strategy == "blocks":
        return "blocks", None
    if strategy == "halo":
        width = auto_bucket_micros(max(hs)) if bucket in ("auto", True) else horizon_micros(bucket)
        return "halo", width
    if strategy == "prefix":
        if bucket in ("auto", True):
            return "prefix", None  # chosen per window key from the data
        g = horizon_micros(bucket)
        if any(h % g for h in hs):
            raise ValueError(f"fine bucket {g}us must divide every horizon {hs}")
        return "prefix", g
    raise ValueError(f"unknown strategy {strategy!r}")


def _run_stages(df: DataFrame, keys: list[str], stages: list[tuple[str, list[str], str | None]],
                hs: dict[str, int], strategy: str, width: int | None) -> DataFrame:
    """Chains one window stage per (key, measures, output tag) over the rows
    of ``df``; the rows keep every earlier stage's outputs."""
    names = list(hs)
    how_held = held(df, "temperature", "humidity")
    base = (df.select(*keys, "dateTime", "temperature", "humidity")
            .withColumn(_ORD, epoch_micros("dateTime"))
            .withColumns(_unit_cols(how_held)))
    rows = base
    stage_keys = [k for k, _, _ in stages]
    used = _parts(how_held, list(dict.fromkeys(m for _, ms, _ in stages for m in ms)))
    target = target_rows(df, TARGET_BUCKET_ROWS)
    totals, fine = None, width
    if strategy in ("adaptive", "prefix") and width is None:
        fine = gcd(HOUR_US, *hs.values())
        totals = _written_totals(base, list(dict.fromkeys(stage_keys)), used, fine)
        plan = _plan_stages(base, stage_keys, list(hs.values()), strategy == "adaptive", target,
                            totals, fine)
    else:
        plan = {k: (strategy, target if strategy == "blocks" else width) for k in stage_keys}
    narrow = [w for how, w in plan.values() if how == "prefix" and (totals is None or w % fine)]
    if len(narrow) > 1:  # several keys: one read for all of them
        fine = min(narrow)
        totals = _written_totals(base, list(dict.fromkeys(stage_keys)), used, fine)
    untimed = untimed_rows = None
    if strategy != "plain":
        if totals is not None:
            untimed = totals.where("_b is null")
            untimed = None if untimed.isEmpty() else untimed
        else:
            untimed = _key_sums(base.where(F.col(_ORD).isNull()), list(dict.fromkeys(stage_keys)), used)
        if untimed is not None:
            untimed_rows = rows.where(F.col(_ORD).isNull())
            rows = rows.where(F.col(_ORD).isNotNull())
    for k, of, tag in stages:
        how, w = plan[k]
        measures = _parts(how_held, of)
        if how == "prefix":
            ms = {nm: h // w for nm, h in hs.items()}
            if totals is not None and w % fine == 0:
                spans = _span_totals(totals, k, measures, ms, fine, w)
            else:  # of this key alone: a partial aggregate, one row per (key, bucket)
                spans = _span_totals(_bucket_totals(base, [k], measures, w), k, measures, ms)
            payload = [c for c in rows.columns
                       if c not in (k, _ORD) and not c.startswith("_c_")]
            rows = _prefix_stage(rows, k, measures, hs, w, spans, payload)
        elif how == "blocks":
            rows = _block_stage(rows, base, k, measures, hs, w)
        else:
            rows = _growing_stage(rows, k, measures, hs, w if how == "halo" else None)
        means = _mean_cols(how_held, of, names, tag)
        rows = _drop_sums(rows.withColumns(means), measures, names)
        if untimed is not None:
            untimed_rows = _drop_sums(_untimed_stage(untimed_rows, untimed, k, measures, names)
                                      .withColumns(means), measures, names)
    if untimed is not None:
        rows = rows.unionByName(untimed_rows)
    return rows.drop(_ORD, *_unit_cols(how_held))


def moving_averages(df: DataFrame, level: str = "room",
                    horizons: dict[str, str | int] | None = None, *,
                    humidity_scope: str = "room", strategy: str = "auto",
                    bucket: str | int | None | bool = "auto") -> DataFrame:
    """Moving averages of one level for several horizons in one pass.

    Output: <key>, dateTime, avg_temp_<name>, avg_hum_<name> for every horizon
    name (default ``hour``, ``day``, ``week``).  ``strategy="auto"`` takes
    ``plain`` for an input the optimizer estimates as small
    (:func:`thermograph.session.is_small`) and ``prefix`` otherwise.
    ``df`` needs dateTime, temperature, humidity and the location columns of
    :func:`thermograph.operators.enrich.enrich_location`.  ``bucket`` is the
    bucket width of the strategy (``"auto"``, ``"1 hour"``, microseconds);
    ``bucket=None``/``False`` selects the plain strategy."""
    horizons = horizons or dict(HORIZONS)
    hs = {nm: horizon_micros(h) for nm, h in horizons.items()}
    strategy, width = _resolve(strategy, bucket, list(hs.values()), df)
    key = LEVEL_KEY[level]
    room = LEVEL_KEY["room"]
    hum_key = room if humidity_scope == "room" else key
    stages = ([(key, ["temperature", "humidity"], None)] if hum_key == key
              else [(key, ["temperature"], None), (hum_key, ["humidity"], None)])
    rows = _run_stages(df, list(dict.fromkeys([key, room])), stages, hs, strategy, width)
    outs = [_out_name(m, nm, None) for nm in hs for m in ("temperature", "humidity")]
    return rows.select(key, "dateTime", *outs)


def moving_averages_all_levels(df: DataFrame, horizons: dict[str, str | int] | None = None, *,
                               strategy: str = "auto",
                               bucket: str | int | None | bool = "auto") -> DataFrame:
    """Every level's moving averages in one pass, one row per reading.

    Humidity is windowed by room for every level, so it is computed once
    (``avg_hum_<h>``); temperature once per level (``avg_temp_<level>_<h>``).
    Four window stages in all instead of seven, and one read of the input.
    Output: the four level keys, dateTime and those columns."""
    horizons = horizons or dict(HORIZONS)
    hs = {nm: horizon_micros(h) for nm, h in horizons.items()}
    strategy, width = _resolve(strategy, bucket, list(hs.values()), df)
    room = LEVEL_KEY["room"]
    keys = [LEVEL_KEY[lv] for lv in ("room", "floor", "building", "neighborhood")]
    stages = [(room, ["humidity"], None)] + [(LEVEL_KEY[lv], ["temperature"], lv)
                                             for lv in ("room", "floor", "building", "neighborhood")]
    rows = _run_stages(df, keys, stages, hs, strategy, width)
    outs = [_out_name("humidity", nm, None) for nm in hs]
    outs += [_out_name("temperature", nm, lv) for lv in ("room", "floor", "building", "neighborhood")
             for nm in hs]
    return rows.select(*keys, "dateTime", *outs)


def level_view(all_levels: DataFrame, level: str,
               horizons: dict[str, str | int] | None = None) -> DataFrame:
    """One level's result (<key>, dateTime, avg_temp_<h>, avg_hum_<h>) from
    :func:`moving_averages_all_levels`."""
    names = list(horizons or HORIZONS)
    cols = []
    for nm in names:
        cols += [F.col(_out_name("temperature", nm, level)).alias(_out_name("temperature", nm, None)),
                 F.col(_out_name("humidity", nm, None))]
    return all_levels.select(LEVEL_KEY[level], "dateTime", *cols)


def moving_average(df: DataFrame, level: str = "room", horizon: str | int = "1 hour", *,
                   humidity_scope: str = "room", exact: bool = True,
                   strategy: str = "auto",
                   bucket: str | int | None | bool = "auto") -> DataFrame:
    """One row per reading: <level key>, dateTime, avg_temp, avg_hum.

    ``exact=False`` averages the measures as FLOAT.  Their sums are exact as well
    (``functions.exact``), so that growing sums can be subtracted and every strategy
    gives what a sliding frame does."""
    key = LEVEL_KEY[level]
    if not exact:
        df = df.withColumns({m: F.col(m).cast("float") for m in ("temperature", "humidity")})
    res = moving_averages(df, level, {"h": horizon}, humidity_scope=humidity_scope,
                          strategy=strategy, bucket=bucket)
    return res.select(key, "dateTime", F.col("avg_temp_h").alias("avg_temp"),
                      F.col("avg_hum_h").alias("avg_hum"))
