"""Message parsing, topics, location assignment and routing."""

import datetime as dt

import pytest

from thermograph.functions.location import valid_location
from thermograph.functions.topics import (location_to_topic, route_direction, sensor_location,
                                          topic_matches, topic_to_location)
from thermograph.operators.telemetry import (config_replies, parse_telemetry,
                                             telemetry_with_location)

P = "sensor/data/"


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "event_id long, topic string, payload string, arrival timestamp_ntz")


def test_parse(spark):
    t = dt.datetime(2022, 9, 3, 15, 1)
    rows = [
        (1, P + "A/0/S/3", '{"d":{"s_id":"sens-0013","seq":7,"temp_c":31.20,"hum":58.40,"Def Route":"fe80::201"}}', t),
        (2, P + "A/0/S/3", '{"d":{"s_id":"sens-0013","seq":8,"temp_c":30}}', t),
        (3, P + "A/0/S/3", "not json", t),
        (4, P + "B/1/2/3", '{"x":1}', t),
    ]
    got = {r.event_id: r for r in parse_telemetry(_msgs(spark, rows)).collect()}
    assert set(got) == {1, 2}
    a = got[1]
    assert (a.location, float(a.temperature), float(a.humidity), a.s_id, a.seq) == ("A.0.S.3", 31.2, 58.4, "sens-0013", 7)
    assert got[2].humidity is None and float(got[2].temperature) == 30.0
    kept = parse_telemetry(_msgs(spark, rows), keep_malformed=True).count()
    assert kept == 4


@pytest.mark.parametrize("sid,loc", [
    ("sens-0013", "A/0/0/3"), ("sens-3209", "D/2/S/9"), ("sens-0a13", None),
    ("sens-0413", None), ("sens-001", None), ("sens-1230x", "B/2/2/0"),
])
def test_sensor_location(spark, sid, loc):
    df = spark.createDataFrame([(sid,)], "sensor_id string")
    assert df.select(sensor_location("sensor_id").alias("l")).first().l == loc
    rep = config_replies(df).first()
    assert rep.topic == "sensor/conf/" + sid and rep.location == loc


def test_topics_and_patterns(spark):
    df = spark.createDataFrame([("A.0.S.3",), ("a.0.s.3",), ("A/0/S/3",), ("A.0.S",), ("A.0.S.3.4",)], "loc string")
    got = [r.v for r in df.select(valid_location("loc").alias("v")).collect()]
    assert got == [True, False, True, False, False]
    r = df.limit(1).select(location_to_topic("loc").alias("t")).first()
    assert r.t == P + "A/0/S/3"
    t = spark.createDataFrame([(P + "A/0/S/3",)], "topic string")
    assert t.select(topic_to_location("topic").alias("l")).first().l == "A.0.S.3"


def test_filters_and_routes(spark):
    topics = [P + "A/0/S/3", P + "B/0/S/3", "sensor/data", "sensor/conf", "sensor/conf/sens-0013", "other/x", "sensor/database"]
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    exact = [r.topic for r in df.where(topic_matches("topic", P, "A.0.S.3")).collect()]
    assert exact == [P + "A/0/S/3"]
    wild = [r.topic for r in df.where(topic_matches("topic", P)).collect()]
    assert wild == [P + "A/0/S/3", P + "B/0/S/3", "sensor/data"]
    routes = [r.d for r in df.select(route_direction("topic").alias("d")).collect()]
    assert routes == ["out", "out", "out", "both", "both", None, None]


def test_assignment_join(spark):
    t = dt.datetime(2022, 9, 3, 15, 1)
    rows = [(1, P + "A/0/0/3", '{"d":{"s_id":"sens-0013","temp_c":20,"hum":50}}', t),
            (2, P + "A/0/0/3", '{"d":{"s_id":"sens-9999","temp_c":20,"hum":50}}', t)]
    parsed = parse_telemetry(_msgs(spark, rows))
    req = spark.createDataFrame([("sens-0013",), ("sens-0013",), ("sens-9999",)], "sensor_id string")
    got = telemetry_with_location(parsed, config_replies(req)).collect()
    assert [(r.event_id, r.assigned_location) for r in got] == [(1, "A.0.0.3")]
