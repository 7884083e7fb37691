"""Streaming jobs: telemetry ingest, location assignment, actuators.

Each job is ``readStream`` -> DataFrame operators -> ``writeStream`` with a
checkpoint under the shared folder named by ``spark.checkpoint.dir``, so a
restarted job resumes where it stopped and a replayed micro-batch overwrites
its own output.
"""

from __future__ import annotations

import argparse
import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from thermograph.constants import DATA_PREFIX, LOCATION_PATTERN
from thermograph.operators.actuators import DEFAULT_LIMITS
from thermograph.operators.telemetry import (config_replies, filter_topics, malformed,
                                             parse_telemetry)
from thermograph.session import apply_job_conf, checkpoint_dir
from thermograph.sinks.streams import epoch_parquet_writer
from thermograph.sources.messages import read_message_stream, read_request_stream
from thermograph.streaming.actuators import (actuator_state_stream, bucketed_actuator_writer,
                                             event_rows, ordered_state_stream, switched)


def _start(df: DataFrame, name: str, out_path: str, spark: SparkSession,
           checkpoint: str | None, available_now: bool,
           trigger_seconds: int | None,
           write: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)
    w = df.writeStream.queryName(name).option("checkpointLocation", ckpt) \
        .foreachBatch(write or epoch_parquet_writer(out_path))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def split_malformed(write: Callable[[DataFrame, int], None], prefix: str,
                    malformed_path: str | None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over messages: readings go to ``write``,
    messages without a readable payload to ``<malformed_path>/epoch=<id>``
    (good + bad = input).  Without a path, a bad message is an error."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        bad = malformed(batch)
        if malformed_path:
            bad.write.mode("overwrite").parquet(os.path.join(malformed_path, f"epoch={epoch_id}"))
        elif not bad.isEmpty():
            raise ValueError("a message has no readable payload (no malformed_path is set)")
        write(parse_telemetry(batch, prefix), epoch_id)
    return run


_ASIDE = "_malformed"


def _beside(rows: DataFrame, bad: DataFrame) -> DataFrame:
    """One stream of ``rows`` and, in the column ``_malformed``, bad messages: the
    state of a stream is kept by its plan, so that they leave it together."""
    aside = bad.select(F.struct(*bad.columns).alias(_ASIDE))
    return rows.unionByName(aside, allowMissingColumns=True)


def _split_beside(out_path: str, malformed_path: str | None) -> Callable[[DataFrame, int], None]:
    """Writes the two parts of :func:`_beside` per micro-batch, computed once."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            bad = batch.where(F.col(_ASIDE).isNotNull()).select(f"{_ASIDE}.*")
            if malformed_path:
                bad.write.mode("overwrite").parquet(os.path.join(malformed_path, f"epoch={epoch_id}"))
            elif not bad.isEmpty():
                raise ValueError("a message has no readable payload (no malformed_path is set)")
            epoch_parquet_writer(out_path)(batch.where(F.col(_ASIDE).isNull()).drop(_ASIDE), epoch_id)
        finally:
            batch.unpersist()
    return run


def telemetry_ingest(spark: SparkSession, messages_path: str, out_path: str, *,
                     malformed_path: str | None = None,
                     prefix: str = DATA_PREFIX, checkpoint: str | None = None,
                     available_now: bool = False, trigger_seconds: int | None = None,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Messages landed as files -> reading rows (location, dateTime,
    temperature, humidity, sensor id) appended per micro-batch; only topics
    under ``prefix`` are read.  Messages without a readable payload go to
    ``malformed_path`` (default ``<out_path>_malformed``)."""
    msgs = read_message_stream(spark, messages_path, max_files_per_trigger=max_files_per_trigger)
    write = split_malformed(epoch_parquet_writer(out_path), prefix,
                            malformed_path or out_path.rstrip("/") + "_malformed")
    return _start(filter_topics(msgs, prefix), "telemetry_ingest", out_path, spark, checkpoint,
                  available_now, trigger_seconds, write)


def location_assignment(spark: SparkSession, requests_path: str, out_path: str, *,
                        checkpoint: str | None = None, available_now: bool = False,
                        trigger_seconds: int | None = None) -> StreamingQuery:
    """Configuration requests -> replies ``(sensor_id, topic, location)``."""
    req = read_request_stream(spark, requests_path)
    return _start(config_replies(req), "location_assignment", out_path, spark, checkpoint,
                  available_now, trigger_seconds)


def actuators(spark: SparkSession, messages_path: str, out_path: str, *,
              scope: str = "location", mode: str = "buckets", checkpoint: str | None = None,
              available_now: bool = False, trigger_seconds: int | None = None,
              max_files_per_trigger: int | None = None, events_only: bool = False,
              as_events: bool = False, location: str | None = None, prefix: str = DATA_PREFIX,
              limits: dict[str, float] | None = None,
              malformed_path: str | None = None, delay: str = "10 minutes") -> StreamingQuery:
    """Messages -> actuator state after every message (both actuators).

    ``location``: subscribe to this one location only (it must have the N.B.F.R
    form); otherwise to everything below ``prefix``.  ``events_only`` writes
    only the messages that switch an actuator; ``as_events`` a row per switch:
    key, event_id, dateTime, metric, value, action.
    ``malformed_path``: where messages without a readable payload are written,
    per micro-batch; without it a micro-batch that has any fails.

    ``mode="buckets"`` (default) runs each micro-batch through the bucketed
    batch operator with a per-key state table (a hot key is split by time);
    ``mode="keyed"`` uses ``applyInPandasWithState`` (one group per key and
    micro-batch); ``mode="ordered"`` also holds messages back for ``delay``, so that
    they are applied in time order however they arrive (messages without a time are
    set aside with the bad ones)."""
    if location is not None and not re.fullmatch(LOCATION_PATTERN, location):
        raise ValueError(f"not a location: {location!r}")
    limits = limits or DEFAULT_LIMITS
    msgs = read_message_stream(spark, messages_path, max_files_per_trigger=max_files_per_trigger)
    msgs = filter_topics(msgs, prefix, location)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams", "actuators")
    if mode in ("keyed", "ordered"):
        good = parse_telemetry(msgs, prefix)
        bad = malformed(msgs)
        if mode == "ordered":
            bad = malformed(msgs, needs_time=True)
            states = ordered_state_stream(good.where("dateTime is not null"), delay, limits, scope=scope)
            if not as_events:
                states = states.drop(*limits)
        else:
            states = actuator_state_stream(good, limits, scope=scope, values=as_events)
        if as_events:
            states = event_rows(states, list(limits), ["location"] if scope == "location" else [])
        elif events_only:
            states = switched(states, list(limits))
        return _start(_beside(states, bad), "actuators", out_path, spark, ckpt, available_now,
                      trigger_seconds, _split_beside(out_path, malformed_path))
    writer = split_malformed(
        bucketed_actuator_writer(out_path, os.path.join(ckpt, "state"), limits, scope=scope,
                                 events_only=events_only, as_events=as_events), prefix, malformed_path)
    w = msgs.writeStream.queryName("actuators").option("checkpointLocation", ckpt) \
        .foreachBatch(writer)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def main(argv: list[str] | None = None) -> None:
    """``python -m thermograph.streaming.telemetry {ingest,assign,actuators} ...``"""
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("job", choices=["ingest", "assign", "actuators"])
    ap.add_argument("--input", required=True, help="folder where messages land")
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--malformed", help="folder for messages without a readable payload")
    ap.add_argument("--prefix", default=DATA_PREFIX)
    ap.add_argument("--location", help="actuators: subscribe to one location only")
    ap.add_argument("--scope", choices=["location", "global"], default="location")
    ap.add_argument("--mode", choices=["buckets", "keyed", "ordered"], default="buckets")
    ap.add_argument("--delay", default="10 minutes", help="how late messages may come (ordered)")
    ap.add_argument("--events-only", action="store_true", help="messages that switch an actuator")
    ap.add_argument("--events", action="store_true", help="one row per switch")
    ap.add_argument("--once", action="store_true", help="stop when all that has landed is done")
    args = ap.parse_args(argv)
    spark = (SparkSession.builder.appName(f"thermograph-{args.job}")
             .config("spark.ui.enabled", "false").getOrCreate())
    apply_job_conf(spark)
    common = {"checkpoint": args.checkpoint, "available_now": args.once}
    if args.job == "ingest":
        query = telemetry_ingest(spark, args.input, args.out, prefix=args.prefix,
                                 malformed_path=args.malformed, **common)
    elif args.job == "assign":
        query = location_assignment(spark, args.input, args.out, **common)
    else:
        query = actuators(spark, args.input, args.out, prefix=args.prefix, scope=args.scope,
                          mode=args.mode, delay=args.delay, location=args.location, events_only=args.events_only, as_events=args.events,
                          malformed_path=args.malformed or args.out.rstrip("/") + "_malformed",
                          **common)
    query.awaitTermination()


if __name__ == "__main__":
    main()
