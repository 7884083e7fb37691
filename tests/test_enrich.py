"""Location and calendar enrichment edges."""

import datetime as dt

from conftest import readings_df
from thermograph.operators.enrich import enrich


def _rows(spark, data):
    df = readings_df(spark, data)
    return {r.fullRoomLocation: r for r in enrich(df).collect()}


def test_location_parts(spark):
    r = _rows(spark, [("A.0.S.3", dt.datetime(2022, 1, 3, 7, 59), 1, 1),
                      ("B.1", dt.datetime(2022, 1, 3, 8, 0), 1, 1),
                      ("C.2.1.4.9", dt.datetime(2022, 1, 3, 19, 59), 1, 1),
                      ("D", None, 1, 1)])
    a = r["A.0.S.3"]
    assert (a.neighborhood, a.building, a.floor, a.room) == ("A", "0", "S", "3")
    assert (a.fullFloorLocation, a.fullBuildingLocation) == ("A.0.S", "A.0")
    b = r["B.1"]
    assert (b.floor, b.room, b.fullFloorLocation, b.fullBuildingLocation) == (None, None, "B.1", "B.1")
    assert r["C.2.1.4.9"].room == "4"
    assert r["D"].fullBuildingLocation == "D"


def test_day_night_bounds(spark):
    r = _rows(spark, [("A.0.S.1", dt.datetime(2022, 1, 3, 7, 59), 1, 1),
                      ("A.0.S.2", dt.datetime(2022, 1, 3, 8, 0), 1, 1),
                      ("A.0.S.3", dt.datetime(2022, 1, 3, 19, 59), 1, 1),
                      ("A.0.S.4", dt.datetime(2022, 1, 3, 20, 0), 1, 1),
                      ("A.0.S.5", None, 1, 1)])
    assert (r["A.0.S.1"].daily, r["A.0.S.1"].night) == (False, True)
    assert (r["A.0.S.2"].daily, r["A.0.S.2"].night) == (True, False)
    assert (r["A.0.S.3"].daily, r["A.0.S.3"].night) == (True, False)
    assert (r["A.0.S.4"].daily, r["A.0.S.4"].night) == (False, True)
    assert r["A.0.S.5"].daily is None and r["A.0.S.5"].day is None
    a = r["A.0.S.2"]
    assert (a.hour, a.week, a.month, a.year, a.day) == (8, 1, 1, 2022, dt.date(2022, 1, 3))
