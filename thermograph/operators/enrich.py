"""Location and calendar columns added to readings (narrow projections)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermograph.constants import DAY_START_HOUR, NIGHT_START_HOUR
from thermograph.functions.calendar import is_daytime, is_night
from thermograph.functions.location import location_part, location_prefix


def enrich_location(df: DataFrame, location: str = "location") -> DataFrame:
    """Adds neighborhood, building, floor, room, fullFloorLocation,
    fullBuildingLocation and renames ``location`` to fullRoomLocation.

    Missing parts are null; prefixes skip null parts."""
    return (df
            .withColumns({
                "neighborhood": location_part(location, 0),
                "building": location_part(location, 1),
                "floor": location_part(location, 2),
                "room": location_part(location, 3),
            })
            .withColumns({
                "fullFloorLocation": location_prefix("neighborhood", "building", "floor"),
                "fullBuildingLocation": location_prefix("neighborhood", "building"),
            })
            .withColumnRenamed(location, "fullRoomLocation"))


def enrich_calendar(df: DataFrame, ts: str = "dateTime", *,
                    day_start: int = DAY_START_HOUR,
                    night_start: int = NIGHT_START_HOUR) -> DataFrame:
    """Adds hour, day (DATE), week (week of year), month, year, night, daily."""
    t = F.col(ts)
    return df.withColumns({
        "hour": F.hour(t),
        "day": F.to_date(t),
        "week": F.weekofyear(t),
        "month": F.month(t),
        "year": F.year(t),
        "night": is_night(t, day_start, night_start),
        "daily": is_daytime(t, day_start, night_start),
    })


def enrich(df: DataFrame, location: str = "location", ts: str = "dateTime") -> DataFrame:
    """Both enrichments; unused columns are pruned by the optimizer."""
    return enrich_calendar(enrich_location(df, location), ts)
