"""As-of join, subscriptions, files over many tasks, rows that can't be read."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from thermograph.operators.asof import as_of_join
from thermograph.operators.subscriptions import match_messages, match_topics
from thermograph.operators.words import (corpus_sizes, distinct_words_per_doc, word_count,
                                         word_count_per_doc)
from thermograph.sources.readings import accepted, read_readings_checked, read_readings_csv, rejected
from thermograph.sources.text import read_text_files, read_text_lines

START = dt.datetime(2022, 5, 1, 9)


# --- as-of join

def as_of_rows(seed: int):
    rng = random.Random(seed)
    at = lambda: rng.choice([None, *[START + dt.timedelta(minutes=m) for m in range(0, 40, 5)]])
    left = [(i, rng.choice([None, "a", "a", "a", "b", "c"]), at()) for i in range(1200)]
    right = [(i, rng.choice([None, "a", "a", "b"]), at(), f"v{rng.randrange(99)}") for i in range(300)]
    return left, right


@pytest.mark.parametrize("block_rows", [None, 300])
def test_as_of_join(spark, block_rows):
    left, right = as_of_rows(1)
    got = as_of_join(spark.createDataFrame(left, "id int, k string, t timestamp"),
                     spark.createDataFrame(right, "n int, key string, at timestamp, v string"),
                     "k", "key", "t", "at", ["v", "at"], tiebreak="n", block_rows=block_rows)
    first = dt.datetime.min
    want = {}
    for i, k, t in left:
        known = [(a or first, n, v, a) for n, key, a, v in right
                 if key is not None and key == k and (a or first) <= (t or first)]
        want[i] = max(known, key=lambda x: x[:2])[2:] if known else (None, None)
    rows = got.collect()
    assert len(rows) == len(left) and {r.id: (r.v, r.at) for r in rows} == want


def test_as_of_of_nothing(spark):
    left, right = as_of_rows(2)
    a = spark.createDataFrame(left, "id int, k string, t timestamp")
    b = spark.createDataFrame(right, "n int, key string, at timestamp, v string")
    for rows in (None, 300):
        assert as_of_join(a.limit(0), b, "k", "key", "t", "at", ["v"], block_rows=rows).count() == 0
        none = as_of_join(a, b.limit(0), "k", "key", "t", "at", ["v"], block_rows=rows)
        assert none.where("v is null").count() == len(left)
    with pytest.raises(ValueError):
        as_of_join(a, b.withColumnRenamed("v", "id"), "k", "key", "t", "at", ["id"])


def test_a_sensor_that_moves(spark):
    """A message has the location that was in force at its time, and one row."""
    from thermograph.operators.telemetry import telemetry_located, telemetry_with_location
    minute = lambda m: START + dt.timedelta(minutes=m)
    msgs = spark.createDataFrame([(i, "x-0001", minute(m)) for i, m in enumerate((0, 5, 9, 10, 20))],
                                 "event_id long, s_id string, dateTime timestamp")
    said = spark.createDataFrame([("x-0001", "A/0/S/1", minute(5)), ("x-0001", None, minute(7)),
                                  ("x-0001", "B/1/0/2", minute(10))],
                                 "sensor_id string, location string, assigned_at timestamp")
    got = [r.assigned_location for r in telemetry_located(msgs, said).orderBy("event_id").collect()]
    assert got == [None, "A.0.S.1", "A.0.S.1", "B.1.0.2", "B.1.0.2"]
    assert telemetry_with_location(msgs, said).count() == 5


# --- subscriptions

def fits(topic: str, pattern: str) -> bool:
    """The broker's rule, level by level."""
    t, p = topic.split("/"), pattern.split("/")
    if topic.startswith("$") and p[0] in ("+", "#"):
        return False
    for i, level in enumerate(p):
        if level == "#":
            return len(t) >= i
        if i >= len(t) or level not in ("+", t[i]):
            return False
    return len(t) == len(p)


def test_topics_against_patterns(spark):
    rng = random.Random(3)
    names = ["a", "b", "", "c.d", "+", "#", "$s"]
    topics = sorted({"/".join(rng.choice(names) for _ in range(rng.randint(1, 4))) for _ in range(300)} - {""})
    patterns = {"/".join(rng.choice([*names[:4], "+", "+"]) for _ in range(rng.randint(1, 4)))
                + rng.choice(["", "", "/#"]) for _ in range(150)} | {"#", "+", "/", "/#", "+/#", "$s/#"}
    bad = ["a/#/b", "a#", "b+/c", "+a", "", "##"]
    df = match_topics(spark.createDataFrame([(t,) for t in [*topics, None, ""]], "topic string"),
                      spark.createDataFrame([(p,) for p in [*patterns, *bad, None]], "pattern string"))
    good = [p for p in patterns if p]
    assert sorted(map(tuple, df.collect())) == sorted((t, p) for t in topics for p in good if fits(t, p))


def test_messages_for_each_subscription(spark):
    msgs = spark.createDataFrame([(1, "a/b"), (2, "a/b"), (3, "c"), (4, None)], "id int, topic string")
    pats = spark.createDataFrame([("a/+",), ("#",), ("a/+",)], "pattern string")
    got = sorted((r.id, r.pattern) for r in match_messages(msgs, pats).collect())
    assert got == [(1, "#"), (1, "a/+"), (2, "#"), (2, "a/+"), (3, "#")]
    assert match_messages(msgs, pats.limit(0)).count() == 0
    assert match_messages(msgs.limit(0), pats).count() == 0


# --- one text over many tasks

TEXTS = ["", "\n", " ", "a", "a\n", "a ", "a \n", "a\n ", "a\n\n", "\n\n", "  ", " a", "a  b\n\nc ", "a b\nc d\n",
         "é ß\n中 文", "a\tb\r\nc\r", "x" * 5000 + " " + "y" * 5000 + "\n" + "a b " * 4000, " \n" * 3000]


@pytest.mark.parametrize("sep", ["\n", " "])
def test_pieces_of_files(spark, tmp_path, sep):
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("ab \n") for _ in range(rng.randint(1, 3000))) for _ in range(12)]
    for i, t in enumerate(texts):
        (tmp_path / f"f{i:02}").write_bytes(t.encode())
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "700")  # files of over 700 bytes are read by several tasks
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pieces = read_text_lines(spark, str(tmp_path), sep)
        assert spark.read.option("lineSep", sep).text(str(tmp_path)).rdd.getNumPartitions() > 40
        whole = read_text_files(spark, str(tmp_path))
        for count in (word_count_per_doc, distinct_words_per_doc, word_count, corpus_sizes):
            got, want = (sorted(map(tuple, count(df, "doc").collect())) for df in (pieces, whole))
            assert got == want, count
        size = pieces.groupBy("doc").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    finally:
        spark.conf.set(key, old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r.n for r in size) == sorted(len(t.encode()) for t in texts)
    n = {r.doc[-3:]: r.n for r in word_count_per_doc(read_text_lines(spark, str(tmp_path), sep), "doc")
         .groupBy("doc").agg(F.sum("n").alias("n")).collect()}
    assert all(n[f"f{i:02}"] == len(re.split("[ \n]", re.sub(r"[ \n]\Z", "", t))) for i, t in enumerate(texts))


def test_no_other_separator(spark, tmp_path):
    with pytest.raises(ValueError):
        read_text_lines(spark, str(tmp_path), ",")


# --- rows that can't be read

def test_rows_that_cannot_be_read(spark, tmp_path):
    rows = [("A.0.S.1;2022-05-01 09:00;20.5;60", None), ("A.0.S.1;2022-05-01 09:00:30;-1;1e1", None),
            ("A.0.S.1;;;", None), ("A.0.S.1;2022-05-01 09:00;20.5", "columns"),
            ("A.0.S.1;2022-05-01 09:00;20.5;60;7", "columns"), (";2022-05-01 09:00;20.5;60", "location"),
            ("A.0.S.1;yesterday;20.5;60", "time"), ("A.0.S.1;2022-13-01 09:00;x;60", "time"),
            ("A.0.S.1;2022-05-01 09:00;20,5;60", "temperature"), ("A.0.S.1;2022-05-01 09:00;2.5;-", "humidity"),
            ("A.0.S.1;2022-05-01 09:00;1.1234567890123456789;60", "temperature"),
            ("A.0.S.1;2022-05-01 09:00;1.12345678901234567800;60", None),
            ("A.0.S.1;2022-05-01 09:00;1;123456789012345678901", "humidity")]
    path = tmp_path / "in.csv"
    path.write_text("location;Date Time;t;h\n" + "".join(f"{r}\n" for r, _ in rows))
    checked = read_readings_checked(spark, str(path))
    assert {r.raw.rstrip(";"): r.reason for r in checked.collect()} == {r.rstrip(";"): x for r, x in rows}
    good, bad = accepted(checked), rejected(checked)
    assert good.count() + bad.count() == len(rows) and bad.columns == ["file", "raw", "reason"]
    assert good.schema == read_readings_csv(spark, str(path)).schema
    fine = tmp_path / "fine.csv"
    fine.write_text("location;dateTime;temperature;humidity\n" + "".join(
        f"{r}\n" for r, x in rows if x is None))
    same = read_readings_csv(spark, str(fine))
    assert sorted(map(str, good.collect())) == sorted(map(str, same.collect()))


def test_the_job_sets_bad_rows_aside(spark, tmp_path):
    from thermograph.plans import stats
    lines = ["location;dateTime;temperature;humidity"]
    lines += [f"A.0.S.1;2022-05-0{d} {h:02}:00;{20 + h}.5;50" for d in (1, 2) for h in (3, 10)]
    path = tmp_path / "in.csv"
    path.write_text("\n".join([*lines, "A.0.S.1;never;1;2"]) + "\n")
    with pytest.raises(ValueError, match="time"):
        stats.main(["--input", str(path), "--out", str(tmp_path / "x")])
    stats.main(["--input", str(path), "--out", str(tmp_path / "o"), "--rejects", str(tmp_path / "bad")])
    assert [r.reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["time"]
    assert spark.read.option("header", True).option("sep", ";").csv(str(tmp_path / "o" / "diffRoom")).count() == 2
