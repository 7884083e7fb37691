"""Fixed values and names shared by every operator.

Values under "fixed values" must stay equal to the behaviour being
reproduced; everything else is a default that callers may override.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# Daytime is hour in [DAY_START_HOUR, NIGHT_START_HOUR); the rest of the same
# calendar date is night.
DAY_START_HOUR = 8
NIGHT_START_HOUR = 20
# Actuator limits: switch on above the limit, off below it, no change at it.
TEMPERATURE_LIMIT = 30
HUMIDITY_LIMIT = 60
# Sensor id digits index these lists: neighborhood, building, floor.
NEIGHBORHOOD_CODES = ["A", "B", "C", "D"]
BUILDING_CODES = ["0", "1", "2", "3"]
FLOOR_CODES = ["S", "0", "1", "2"]
# Location format accepted for a single-location subscription (the dots are
# deliberately unescaped: any character may separate the parts).
LOCATION_PATTERN = "^([A-Z0-9]+.[A-Z0-9]+.[A-Z0-9]+.[A-Z0-9]+)$"
# Letters counted by the letter count.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Moving-average horizons.
HORIZONS = {"hour": "1 hour", "day": "1 day", "week": "7 days"}
# Generator ranges: temperature U(10.02, 37.50), humidity U(0, 100), minutes
# between these two instants, location parts from these lists.
GEN_TEMPERATURE = (10.02, 37.50)
GEN_HUMIDITY = (0.0, 100.0)
GEN_START = "2020-04-01 00:00:00"
GEN_END = "2022-08-31 23:59:00"
GEN_LETTERS = ["A", "B", "C", "D", "E"]
GEN_FLOORS = ["S", "0", "1", "2", "3"]
# --- end of fixed values ----------------------------------------------------

# Hierarchy levels, finest first, and the column holding each level's key.
LEVELS = ("room", "floor", "building", "neighborhood")
LEVEL_KEY = {
    "room": "fullRoomLocation",
    "floor": "fullFloorLocation",
    "building": "fullBuildingLocation",
    "neighborhood": "neighborhood",
}

# Topic layout (parameters; the defaults are neutral).
DATA_PREFIX = "sensor/data/"
CONF_PREFIX = "sensor/conf"
SENSOR_ORG = "sens"

