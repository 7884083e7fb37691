"""Message-topic expressions and the sensor-id -> location rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermograph.constants import (BUILDING_CODES, CONF_PREFIX, DATA_PREFIX,
                                   FLOOR_CODES, NEIGHBORHOOD_CODES, SENSOR_ORG)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def topic_to_location(topic: Column | str, prefix: str = DATA_PREFIX) -> Column:
    """``<prefix>A/0/S/3`` -> ``A.0.S.3`` (prefix removed, ``/`` -> ``.``)."""
    return F.replace(F.replace(_col(topic), F.lit(prefix), F.lit("")),
                     F.lit("/"), F.lit("."))


def location_to_topic(location: Column | str, prefix: str = DATA_PREFIX) -> Column:
    """``A.0.S.3`` -> ``<prefix>A/0/S/3``."""
    return F.concat(F.lit(prefix), F.replace(_col(location), F.lit("."), F.lit("/")))


def _code(digits: Column, pos: int, codes: list[str]) -> Column:
    idx = F.substring(digits, pos, 1).try_cast("int")
    return F.try_element_at(F.array(*[F.lit(c) for c in codes]), idx + 1)


def sensor_location(sensor_id: Column | str, org: str = SENSOR_ORG) -> Column:
    """``<org>-d0d1d2c3`` -> ``N/B/F/c3``; null when a digit is out of range.

    d0, d1, d2 index the neighborhood, building and floor codes; the fourth
    character is copied.  ``concat`` (not ``concat_ws``) keeps a missing part
    from silently shortening the location.
    """
    digits = F.replace(_col(sensor_id), F.lit(f"{org}-"), F.lit(""))
    room = F.when(F.length(digits) >= 4, F.substring(digits, 4, 1))
    return F.concat(_code(digits, 1, NEIGHBORHOOD_CODES), F.lit("/"),
                    _code(digits, 2, BUILDING_CODES), F.lit("/"),
                    _code(digits, 3, FLOOR_CODES), F.lit("/"), room)


def config_reply_topic(sensor_id: Column | str, conf_prefix: str = CONF_PREFIX) -> Column:
    """Reply topic of a configuration request: ``<conf_prefix>/<sensor_id>``."""
    return F.concat(F.lit(conf_prefix + "/"), _col(sensor_id))


def under(topic: Column | str, prefix: str) -> Column:
    """Multi-level wildcard ``<prefix>/#``: the prefix level itself or any
    topic below it."""
    t = _col(topic)
    base = prefix.rstrip("/")
    return (t == F.lit(base)) | t.startswith(base + "/")


def topic_matches(topic: Column | str, prefix: str = DATA_PREFIX,
                  location: str | None = None) -> Column:
    """Subscription filter: one exact location, or everything under prefix."""
    t = _col(topic)
    if location is None:
        return under(t, prefix)
    return t == F.lit(prefix.rstrip("/") + "/" + location.replace(".", "/"))


def route_direction(topic: Column | str, data_prefix: str = DATA_PREFIX,
                    conf_prefix: str = CONF_PREFIX) -> Column:
    """Bridge direction of a topic: data topics go out, conf topics both ways,
    anything else is not bridged (null)."""
    return (F.when(under(topic, data_prefix), F.lit("out"))
            .when(under(topic, conf_prefix), F.lit("both")))
