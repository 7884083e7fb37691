"""Location expressions: a location is ``neighborhood.building.floor.room``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from thermograph.constants import LOCATION_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def location_part(location: Column | str, index: int) -> Column:
    """Part ``index`` (0-based) of a dotted location; null when missing.

    ``get`` returns null past the end of the array (plain ``[i]`` raises under
    ANSI mode).
    """
    return F.get(F.split(_col(location), "[.]"), index)


def location_prefix(*parts: Column | str) -> Column:
    """Join parts with dots, skipping null parts."""
    return F.concat_ws(".", *[_col(p) for p in parts])


def valid_location(location: Column | str) -> Column:
    """True when the text has the N.B.F.R shape accepted for a subscription."""
    return _col(location).rlike(LOCATION_PATTERN)
