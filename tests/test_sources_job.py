"""CSV source bound by position, the generator, and the batch job."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermograph.operators.readings import dedupe_readings, generate_readings
from thermograph.plans.stats import run
from thermograph.sinks.files import write_csv
from thermograph.sources.readings import read_readings_csv

# A few rows in the layout of the live log: other header names, minute times.
LIVE_LOG = """Location;Date Time;Temperature;Humidity
A.0.S.1;2022-09-03 15:01;31.20;58.40
A.0.S.3;2022-09-03 15:01;16.16;74.85
A.0.S.1;2022-09-03 15:02;34.87;56.06
D.4.3.10;2022-09-03 15:02;20.00;60
A.0.S.1;2022-09-03 21:02;18.00;61.00
D.4.3.10;2022-09-03 22:00:30;19.00;62.50
"""


def _csv(tmp_path):
    p = tmp_path / "log.csv"
    p.write_text(LIVE_LOG)
    return str(p)


def test_csv_by_position(spark, tmp_path):
    df = read_readings_csv(spark, _csv(tmp_path))
    assert df.columns == ["location", "dateTime", "temperature", "humidity"]
    rows = df.collect()
    assert len(rows) == 6 and all(r.dateTime is not None for r in rows)
    assert rows[0].dateTime == dt.datetime(2022, 9, 3, 15, 1)
    assert float(rows[3].humidity) == 60.0
    f = read_readings_csv(spark, _csv(tmp_path), measure_type=T.FloatType())
    assert dict(f.dtypes)["temperature"] == "float"


def test_csv_round_trip_and_empty_skip(spark, tmp_path):
    df = read_readings_csv(spark, _csv(tmp_path))
    out = str(tmp_path / "out")
    assert write_csv(df, out)
    back = read_readings_csv(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert not write_csv(df.where("1 = 0"), str(tmp_path / "empty"))
    assert not os.path.exists(str(tmp_path / "empty"))


def test_generator_ranges(spark):
    g = generate_readings(spark, 5000, seed=3)
    s = g.agg(F.min("temperature").alias("tmin"), F.max("temperature").alias("tmax"),
              F.min("humidity").alias("hmin"), F.max("humidity").alias("hmax"),
              F.min("dateTime").alias("t0"), F.max("dateTime").alias("t1"),
              F.countDistinct("location").alias("nloc"), F.count("*").alias("n")).first()
    assert s.n == 5000
    assert 10.02 <= float(s.tmin) and float(s.tmax) <= 37.50
    assert 0 <= float(s.hmin) and float(s.hmax) <= 100
    assert s.t0 >= dt.datetime(2020, 4, 1) and s.t1 <= dt.datetime(2022, 8, 31, 23, 59)
    assert s.nloc > 500
    assert g.where(F.second("dateTime") != 0).count() == 0
    parts = g.select(F.split("location", "[.]").alias("p"))
    assert parts.where(~F.col("p")[2].isin("S", "0", "1", "2", "3")).count() == 0
    d = dedupe_readings(g)
    assert d.agg(F.sum("n_readings")).first()[0] == 5000


def test_stats_job(spark, tmp_path):
    df = read_readings_csv(spark, _csv(tmp_path))
    out = str(tmp_path / "stats")
    res = run(spark, df, out)
    assert res["diffRoom"] and res["maxMonthRoom"] and res["movingAverageNeighborhood"]
    diff = spark.read.option("header", True).option("sep", ";").csv(os.path.join(out, "diffRoom"))
    assert sorted(r.fullRoomLocation for r in diff.collect()) == ["A.0.S.1", "D.4.3.10"]
    r = diff.where("fullRoomLocation = 'A.0.S.1'").first()
    assert (float(r.day_temp), float(r.night_temp), float(r.temp_diff)) == (33.04, 18.0, 15.04)
    mv = spark.read.option("header", True).option("sep", ";").csv(os.path.join(out, "movingAverageRoom"))
    assert mv.count() == 6
    res2 = run(spark, df, str(tmp_path / "split"), levels=("room",), split_horizons=True, differences=False)
    assert len(res2) == 3


def test_generated_dataset_round_trip(spark, tmp_path):
    from thermograph.plans.generate import write_dataset
    out = str(tmp_path / "gen")
    assert write_dataset(spark, 2000, out, seed=11)
    back = read_readings_csv(spark, out)
    assert back.count() <= 2000 and back.where("dateTime IS NULL").count() == 0
    times = [r.dateTime for r in back.collect()]
    assert times == sorted(times)


def test_csv_timestamp_format(spark, tmp_path):
    p = tmp_path / "eu.csv"
    p.write_text("Location;Date Time;Temperature;Humidity\nA.0.S.1;03/09/2022 15:01;31.20;58.40\n")
    r = read_readings_csv(spark, str(p), timestamp_format="dd/MM/yyyy HH:mm").first()
    assert r.dateTime == dt.datetime(2022, 9, 3, 15, 1)
