"""Threshold actuators on a stream.

Two forms: keyed state with ``applyInPandasWithState`` (one pandas group per
key and micro-batch), and :func:`bucketed_actuator_writer`, which runs every
micro-batch through the bucketed batch operator seeded with a per-key state
table (a hot key is split by time inside the micro-batch).

The state of a key is two small integers (the last signal of each actuator),
so it does not grow with the stream.  Inside a micro-batch the rows of a key
are applied in (time, tiebreak) order; rows arriving in a later micro-batch are
applied after those of earlier ones, as a message consumer would.  When
micro-batches arrive in time order the output equals
:func:`thermograph.operators.actuators.actuator_states` on the whole input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from thermograph.operators.actuators import DEFAULT_LIMITS
from thermograph.session import delete_path, scratch_run


def _output_schema(key: str, tiebreak: str, ts_type: str, metrics: list[str]) -> str:
    cols = [f"{key} string", f"{tiebreak} bigint", f"dateTime {ts_type}"]
    for m in metrics:
        cols += [f"{m}_state string", f"{m}_event string"]
    return ", ".join(cols)


def _state_schema(metrics: list[str]) -> str:
    return ", ".join(f"{m} int" for m in metrics)


def _make_step(key: str, tiebreak: str, limits: dict[str, float], values: bool = False):
    metrics = list(limits)

    def step(group_key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # The rows of one key in one micro-batch (bounded by the trigger size).
        pdf = pd.concat(list(pdfs), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values(["dateTime", tiebreak], kind="stable",
                              na_position="first").reset_index(drop=True)
        prev = state.get if state.exists else tuple(0 for _ in metrics)
        out = pd.DataFrame({key: pdf[key].astype(object), tiebreak: pdf[tiebreak],
                            "dateTime": pdf["dateTime"]})
        last = []
        for i, m in enumerate(metrics):
            v = pd.to_numeric(pdf[m], errors="coerce").astype("float64")
            sig = pd.Series(np.where(v > limits[m], 1.0, np.where(v < limits[m], 0.0, np.nan)))
            sig[v.isna()] = np.nan
            now = sig.ffill().fillna(prev[i]).astype("int64")
            was = now.shift(1).fillna(prev[i]).astype("int64")
            word = np.where(now == 1, "on", "off")
            out[f"{m}_state"] = word
            out[f"{m}_event"] = np.where(now != was, word, "no change")
            last.append(int(now.iloc[-1]))
        if values:
            for m in metrics:
                out[m] = pd.to_numeric(pdf[m], errors="coerce").astype("float64")
        state.update(tuple(last))
        yield out

    return step


def actuator_state_stream(readings: DataFrame, limits: dict[str, float] | None = None, *,
                          scope: str = "location", location: str = "location",
                          tiebreak: str = "event_id", values: bool = False) -> DataFrame:
    """Streaming readings (for a batch, use ``actuator_states``) -> one row per message with the state of
    each actuator after it and what changed (same columns as the batch form;
    with ``values`` also the measures).

    ``scope="global"`` keeps one actuator for all locations (a single key)."""
    limits = limits or DEFAULT_LIMITS
    metrics = list(limits)
    key = location if scope == "location" else "_scope"
    df = readings if scope == "location" else readings.withColumn("_scope", F.lit("all"))
    ts_type = dict(df.dtypes)["dateTime"]
    ts_type = "timestamp_ntz" if ts_type == "timestamp_ntz" else "timestamp"
    df = df.select(key, tiebreak, "dateTime",
                   *[F.col(m).cast("double").alias(m) for m in metrics])
    out = df.groupBy(key).applyInPandasWithState(
        _make_step(key, tiebreak, limits, values),
        outputStructType=_output_schema(key, tiebreak, ts_type, metrics)
        + "".join(f", {m} double" for m in metrics if values),
        stateStructType=_state_schema(metrics),
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )
    return out.drop("_scope") if scope != "location" else out


def transitions_stream(readings: DataFrame, metric: str = "temperature", **kw) -> DataFrame:
    """Only the messages that switch the ``metric`` actuator."""
    lim = {metric: DEFAULT_LIMITS[metric]} if "limits" not in kw else kw.pop("limits")
    st = actuator_state_stream(readings, lim, **kw)
    return st.where(F.col(f"{metric}_event") != "no change")


# --- messages out of order --------------------------------------------------------

def _ordered_step(key: str, tiebreak: str, limits: dict[str, float]):
    metrics = list(limits)
    apply = _make_step(key, tiebreak, limits, values=True)

    class Carried:
        """The last signals, in the form that the unordered step reads and leaves."""
        exists = True

        def __init__(self, last: tuple):
            self.get = last

        def update(self, last: tuple) -> None:
            self.get = last

    def step(group_key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else None
        last = tuple(kept[:len(metrics)]) if kept else tuple(0 for _ in metrics)
        frames = [] if state.hasTimedOut else list(pdfs)
        if kept and len(kept[len(metrics)]):
            at, ids, *values = kept[len(metrics):]
            held = pd.DataFrame({"dateTime": pd.to_datetime(np.asarray(at, "int64"), unit="us"),
                                 tiebreak: pd.array(ids, "Int64")})
            for m, v in zip(metrics, values, strict=True):
                held[m] = np.asarray(v, "float64")
            held[key] = group_key[0]
            frames.append(held)
        rows = pd.concat([f[[key, tiebreak, "dateTime", *metrics]] for f in frames], ignore_index=True)
        micros = rows["dateTime"].astype("datetime64[us]").astype("int64")
        passed = state.getCurrentWatermarkMs()
        # Rows up to the watermark are complete: later ones of such times are late.
        ready = micros <= passed * 1000
        carried = Carried(last)
        if ready.any():
            yield from apply(group_key, iter([rows[ready]]), carried)
        rest, micros = rows[~ready], micros[~ready]
        state.update((*carried.get, micros.tolist(), [None if pd.isna(x) else int(x) for x in rest[tiebreak]],
                      *[pd.to_numeric(rest[m]).astype("float64").tolist() for m in metrics]))
        if len(rest):
            state.setTimeoutTimestamp(int(-(-int(micros.min()) // 1000)))

    return step


def ordered_state_stream(readings: DataFrame, delay: str, limits: dict[str, float] | None = None, *,
                         scope: str = "location", location: str = "location",
                         tiebreak: str = "event_id") -> DataFrame:
    """As :func:`actuator_state_stream` with ``values``, for messages that arrive up to
    ``delay`` out of order: the output is the batch result on all messages that are not
    late, whatever order they come in.

    A message waits in its key's state until the watermark (the latest time seen, less
    ``delay``) has passed it; then those that wait are applied in (time, tiebreak)
    order, by a timer where no new message of the key comes.  The state of a key is what
    it receives in ``delay``.  Later messages are dropped by the watermark, and so are
    those without a time: set them aside before."""
    limits = limits or DEFAULT_LIMITS
    metrics = list(limits)
    key = location if scope == "location" else "_scope"
    df = readings if scope == "location" else readings.withColumn("_scope", F.lit("all"))
    ts_type = dict(df.dtypes)["dateTime"]
    df = df.select(F.coalesce(F.col(key), F.lit("")).alias(key), tiebreak,
                   F.col("dateTime").cast("timestamp").alias("dateTime"),
                   *[F.col(m).cast("double").alias(m) for m in metrics])
    out = df.withWatermark("dateTime", delay).groupBy(key).applyInPandasWithState(
        _ordered_step(key, tiebreak, limits),
        outputStructType=_output_schema(key, tiebreak, "timestamp", metrics)
        + "".join(f", {m} double" for m in metrics),
        stateStructType=_state_schema(metrics) + ", at array<bigint>, ids array<bigint>"
        + "".join(f", values_{m} array<double>" for m in metrics),
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    ).withColumn("dateTime", F.col("dateTime").cast(ts_type))
    return out.drop("_scope") if scope != "location" else out


# --- micro-batches through the bucketed batch operator -------------------------

def _epochs(spark, root: str) -> tuple[list[int], list[int]]:
    """Numbers of the complete ``<root>/epoch=<n>`` and of all of them (any
    file system Spark can reach)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return [], []
    done, found = [], []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.startswith("epoch="):
            found.append(int(name.split("=", 1)[1]))
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                done.append(found[-1])
    return sorted(done), sorted(found)


def switched(states: DataFrame, metrics: list[str]) -> DataFrame:
    """The messages that switch any actuator."""
    changed = F.lit(False)
    for m in metrics:
        changed = changed | (F.col(f"{m}_event") != "no change")
    return states.where(changed)


def event_rows(states: DataFrame, metrics: list[str], key: list[str]) -> DataFrame:
    """One row per switch: key, event_id, dateTime, metric, value, action;
    within a message the metrics keep their order (temperature first)."""
    each = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                 F.col(f"{m}_event").alias("action")) for m in metrics]))
    rows = states.select(*key, "event_id", "dateTime", each.alias("_e"))
    return rows.where(F.col("_e.action") != "no change").select(
        *key, "event_id", "dateTime", "_e.metric", "_e.value", "_e.action")


def bucketed_actuator_writer(out_path: str, state_path: str,
                             limits: dict[str, float] | None = None, *,
                             scope: str = "location", events_only: bool = False,
                             as_events: bool = False):
    """A ``foreachBatch`` function running the actuators per micro-batch with
    the bucketed batch operator, so a hot key is split by time within the
    batch instead of landing in one group.

    The state between micro-batches is a table with one row per key written
    to ``<state_path>/epoch=<id>``; epoch ``e`` reads the newest state older
    than ``e``, and the two newest before it are kept, all older ones deleted.
    ``events_only`` writes only the messages that switch an actuator,
    ``as_events`` one row per switch (:func:`event_rows`).  Outputs and state are written with overwrite per epoch, so a
    replayed epoch recomputes the same result."""
    from thermograph.operators.actuators import actuator_states, final_states

    limits = limits or DEFAULT_LIMITS
    metrics = list(limits)
    key = "location" if scope == "location" else "_scope"

    def write(batch: DataFrame, epoch_id: int) -> None:
        # Blocks of a large micro-batch are removed when its output is written.
        with scratch_run(batch.sparkSession):
            apply(batch, epoch_id)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        root = state_path.rstrip("/")
        older = [n for n in _epochs(spark, root)[0] if n < epoch_id]
        prev_path = f"{root}/epoch={older[-1]}" if older else None
        prev = spark.read.parquet(prev_path) if prev_path else None
        init = prev.withColumnRenamed(key, "location") if (prev is not None and scope != "location") else prev
        states = actuator_states(batch, limits, scope=scope, initial=init, keep=metrics)
        out = f"{out_path.rstrip('/')}/epoch={epoch_id}"
        # Each message is written once: the output itself, or, where that has
        # events only, the states it is made of; the new state is read from it.
        states_path = f"{root}/_states/epoch={epoch_id}" if events_only or as_events else out
        states.write.mode("overwrite").parquet(states_path)
        written = spark.read.schema(states.schema).parquet(states_path)
        if events_only and not as_events:
            switched(written, metrics).write.mode("overwrite").parquet(out)
        if as_events:
            own = [key] if scope == "location" else []
            event_rows(written, metrics, own).write.mode("overwrite").parquet(out)
        k = "location" if scope == "location" else "_scope"
        src = written if scope == "location" else written.withColumn("_scope", F.lit("all"))
        last = final_states(src, metrics, key=k).withColumn("_p", F.lit(1))
        if prev is not None:
            merged = prev.select(k, *metrics).withColumn("_p", F.lit(0)).unionByName(last)
            last = merged.groupBy(k).agg(*[F.max_by(m, F.when(F.col(m).isNotNull(), F.col("_p")))
                                           .alias(m) for m in metrics])
        else:
            last = last.drop("_p")
        last.write.mode("overwrite").parquet(f"{root}/epoch={epoch_id}")
        for n in _epochs(spark, root)[1]:
            if n < epoch_id and n not in older[-1:]:
                delete_path(spark, f"{root}/epoch={n}")
        for n in _epochs(spark, f"{root}/_states")[1]:
            if n < epoch_id:
                delete_path(spark, f"{root}/_states/epoch={n}")

    return write
