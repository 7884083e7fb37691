"""The batch statistics job: every moving average, day/night difference and
month winner of a readings table, written as ``;`` CSV directories.

Result names: ``movingAverage_<level>`` (1 hour, 1 day and 7 days side by
side, or one directory per horizon with ``split_horizons``),
``diff<Level>`` and ``maxMonth<Level>``.

Plan: the readings are aggregated ONCE into conditional sums per (room, day);
that table (rooms x days rows, far smaller than the readings) is written to the
shared checkpoint folder, which cuts the lineage and lets the four levels and
their month winners re-read it instead of the readings.  The moving averages of
all levels and horizons are computed in one pass of four window stages
(humidity is windowed by room at every level, so once), written once to the
shared folder and projected per result.

Usage::

    python -m thermograph.plans.stats --input readings.csv --out results/
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from thermograph.constants import LEVELS
from thermograph.functions.exact import held
from thermograph.operators.daynight import day_night_diff_from_partials, room_day_partials
from thermograph.operators.enrich import enrich
from thermograph.operators.months import max_month
from thermograph.operators.moving import level_view, moving_averages_all_levels
from thermograph.session import apply_job_conf, scratch_path, scratch_run
from thermograph.sinks.files import write_csv
from thermograph.sources.readings import accepted, read_readings_checked, rejected

_TITLE = {"room": "Room", "floor": "Floor", "building": "Building", "neighborhood": "Neighborhood"}
_HZ = {"hour": "Hour", "day": "Daily", "week": "Weekly"}


def run(spark: SparkSession, readings: DataFrame, out_dir: str, *,
        levels: tuple[str, ...] = LEVELS, split_horizons: bool = False,
        moving: bool = True, differences: bool = True) -> dict[str, bool]:
    """Compute and write all results; returns name -> written (False when the
    result was empty and skipped)."""
    apply_job_conf(spark)
    with scratch_run(spark):
        return _run(spark, enrich(readings), out_dir, levels, split_horizons, moving, differences)


def _run(spark: SparkSession, enriched: DataFrame, out_dir: str, levels: tuple[str, ...],
         split_horizons: bool, moving: bool, differences: bool) -> dict[str, bool]:
    written: dict[str, bool] = {}
    if differences:
        part_path = scratch_path(spark, f"room_day_partials-{uuid.uuid4().hex}")
        how = held(enriched, "temperature", "humidity")
        room_day_partials(enriched, how).write.mode("overwrite").parquet(part_path)
        partials = spark.read.parquet(part_path)
        for lv in levels:
            diff = day_night_diff_from_partials(partials, lv, how)
            name = f"diff{_TITLE[lv]}"
            written[name] = write_csv(diff, os.path.join(out_dir, name))
            if written[name]:
                mname = f"maxMonth{_TITLE[lv]}"
                # at most 12 rows, written in month order
                written[mname] = write_csv(max_month(diff).orderBy("month"),
                                           os.path.join(out_dir, mname))
    if moving:
        # All levels in one pass (humidity is windowed by room for every
        # level, so it is computed once), written once to the shared folder
        # and projected per level and horizon.
        all_path = scratch_path(spark, f"moving_all_levels-{uuid.uuid4().hex}")
        moving_averages_all_levels(enriched).write.mode("overwrite").parquet(all_path)
        all_levels = spark.read.parquet(all_path)
        for lv in levels:
            view = level_view(all_levels, lv)
            key = view.columns[0]
            # moving averages are written even when empty (one row per reading)
            if split_horizons:
                for hz, title in _HZ.items():
                    name = f"movingAverageTemperatureAndHumidity{title}{_TITLE[lv]}"
                    one = view.select(key, "dateTime", F.col(f"avg_temp_{hz}").alias("avg_temp"),
                                      F.col(f"avg_hum_{hz}").alias("avg_hum"))
                    written[name] = write_csv(one, os.path.join(out_dir, name), skip_empty=False)
            else:
                name = f"movingAverage{_TITLE[lv]}"
                written[name] = write_csv(view, os.path.join(out_dir, name), skip_empty=False)
    return written


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True, help="readings CSV file or directory")
    ap.add_argument("--out", required=True, help="output directory")
    ap.add_argument("--split-horizons", action="store_true")
    ap.add_argument("--measures", default="decimal(30,18)",
                    help="type of the measures in the input, e.g. double or decimal(10,2)")
    ap.add_argument("--rejects", help="folder for rows that can't be read (file, raw, reason); "
                    "without it such rows fail the job")
    args = ap.parse_args(argv)
    spark = (SparkSession.builder.appName("thermograph-stats")
             .config("spark.ui.enabled", "false").getOrCreate())
    apply_job_conf(spark)  # UTC before the CSV times are parsed
    checked = read_readings_checked(spark, args.input,
                                    measure_type=_parse_datatype_string(args.measures))
    if args.rejects:
        rejected(checked).write.mode("overwrite").parquet(args.rejects)
    else:
        bad = rejected(checked).first()
        if bad is not None:
            raise ValueError(f"a row can't be read ({bad.reason}): {bad.raw!r} of {bad.file}")
    res = run(spark, accepted(checked), args.out, split_horizons=args.split_horizons)
    for k, v in res.items():
        print(f"{k}: {'written' if v else 'empty, skipped'}")


if __name__ == "__main__":
    main()
