"""Reference SQL (DuckDB dialect) for every registered query.

Each statement recomputes the query from the raw tables with plain SQL so the
two engines share nothing but the input files.  Exact arithmetic mirrors
:mod:`thermograph.functions.exact`: measures as BIGINT hundredths, half-even
rounding by integer steps, DOUBLE only at the very end.
"""

from __future__ import annotations

from thermograph.constants import (BUILDING_CODES, CONF_PREFIX, DATA_PREFIX,
                                   DAY_START_HOUR, FLOOR_CODES, HUMIDITY_LIMIT,
                                   LETTERS, LOCATION_PATTERN, NEIGHBORHOOD_CODES,
                                   NIGHT_START_HOUR, SENSOR_ORG, TEMPERATURE_LIMIT)

LEVEL_SQL_KEY = {
    "room": "fullRoomLocation",
    "floor": "fullFloorLocation",
    "building": "fullBuildingLocation",
    "neighborhood": "neighborhood",
}
HORIZON_SQL = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY"}


def pmod(a: str, n: str) -> str:
    return f"(((({a}) % ({n})) + ({n})) % ({n}))"


def half_even(s: str, n: str) -> str:
    """round_half_even(s / n) for integer s, n (null unless n > 0)."""
    r = pmod(s, n)
    q = f"((({s}) - {r}) // ({n}))"
    return (f"(CASE WHEN ({n}) > 0 THEN {q} + CASE WHEN 2 * {r} > ({n}) THEN 1 "
            f"WHEN 2 * {r} = ({n}) AND {pmod(q, '2')} = 1 THEN 1 ELSE 0 END END)")


def cents_double(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 100.0)"


def mean2(s: str, n: str) -> str:
    return cents_double(half_even(s, n))


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


def _bit(div: int) -> str:
    return f"CAST(CAST(floor(user_id / {div}) AS BIGINT) % 2 AS VARCHAR)"


def _digit(div: int, mod: int) -> str:
    return f"CAST(CAST(floor(user_id / {div}) AS BIGINT) % {mod} AS VARCHAR)"


SENSORS_CTE = f"""sensors AS (
  SELECT event_id,
         chr(CAST(65 + user_id % 2 AS INTEGER)) || '.' || {_bit(2)} || '.' || {_bit(4)} || '.' || {_bit(8)} AS location,
         ts + to_days(CAST((event_id % 12) * 30 AS INTEGER)) AS dateTime,
         CAST(10 + value % 27.5 AS DECIMAL(10,2)) AS temperature,
         CAST((value * 7) % 100 AS DECIMAL(10,2)) AS humidity,
         '{SENSOR_ORG}-' || {_digit(1, 4)} || {_digit(4, 4)} || {_digit(16, 4)} || {_digit(1, 10)} AS sensor_id
  FROM events)"""

ENRICHED_CTE = f"""enriched AS (
  SELECT event_id, sensor_id,
         location AS fullRoomLocation,
         split_part(location, '.', 1) AS neighborhood,
         split_part(location, '.', 2) AS building,
         split_part(location, '.', 3) AS floor,
         split_part(location, '.', 4) AS room,
         split_part(location, '.', 1) || '.' || split_part(location, '.', 2) || '.' || split_part(location, '.', 3) AS fullFloorLocation,
         split_part(location, '.', 1) || '.' || split_part(location, '.', 2) AS fullBuildingLocation,
         dateTime, temperature, humidity,
         CAST(hour(dateTime) AS INTEGER) AS hour,
         CAST(dateTime AS DATE) AS day,
         CAST(weekofyear(dateTime) AS INTEGER) AS week,
         CAST(month(dateTime) AS INTEGER) AS month,
         CAST(year(dateTime) AS INTEGER) AS year,
         (hour(dateTime) < {DAY_START_HOUR} OR hour(dateTime) >= {NIGHT_START_HOUR}) AS night,
         (hour(dateTime) < {NIGHT_START_HOUR} AND hour(dateTime) >= {DAY_START_HOUR}) AS daily
  FROM sensors)"""


def with_enriched(body: str, *ctes: str) -> str:
    """``WITH sensors, enriched[, ctes...] body``."""
    return "WITH " + ",\n".join([SENSORS_CTE, ENRICHED_CTE, *ctes]) + "\n" + body


def scan_readings() -> str:
    return (f"WITH {SENSORS_CTE}\nSELECT event_id, location, dateTime, CAST(temperature AS DOUBLE) AS temperature, "
            "CAST(humidity AS DOUBLE) AS humidity FROM sensors")


def enrich_location() -> str:
    return with_enriched("""SELECT event_id, fullRoomLocation, neighborhood, building, floor, room,
       fullFloorLocation, fullBuildingLocation FROM enriched""")


def enrich_calendar() -> str:
    return with_enriched("SELECT event_id, dateTime, hour, day, week, month, year, night, daily FROM enriched")


def _diff_cte(level: str) -> str:
    k = LEVEL_SQL_KEY[level]
    return f"""means AS (
  SELECT daily, day, {k} AS k,
         sum({cents('temperature')}) AS st, count(temperature) AS nt,
         sum({cents('humidity')}) AS sh, count(humidity) AS nh
  FROM enriched WHERE daily IS NOT NULL GROUP BY daily, day, {k}),
rounded AS (
  SELECT daily, day, k, {half_even('st', 'nt')} AS t, {half_even('sh', 'nh')} AS h FROM means),
diff AS (
  SELECT d.day, d.k, d.t AS dt, d.h AS dh, n.t AS nt, n.h AS nh
  FROM rounded d JOIN rounded n ON d.k = n.k AND d.day = n.day
  WHERE d.daily AND NOT n.daily)"""


def mean_daily(level: str) -> str:
    k = LEVEL_SQL_KEY[level]
    return with_enriched(f"""SELECT daily, day, {k},
       {mean2(f"sum({cents('temperature')})", 'count(temperature)')} AS avg_temp,
       {mean2(f"sum({cents('humidity')})", 'count(humidity)')} AS avg_hum,
       count(*) AS n_rows
FROM enriched GROUP BY daily, day, {k}""")


def diff(level: str) -> str:
    k = LEVEL_SQL_KEY[level]
    return with_enriched(f"""SELECT day, k AS {k},
       {cents_double('dt')} AS day_temp, {cents_double('dh')} AS day_hum,
       {cents_double('nt')} AS night_temp, {cents_double('nh')} AS night_hum,
       {cents_double('dt - nt')} AS temp_diff, {cents_double('dh - nh')} AS hum_diff
FROM diff""", _diff_cte(level))


def monthly_diff(level: str) -> str:
    monthly = """monthly AS (
  SELECT CAST(month(day) AS INTEGER) AS month, sum(dt - nt) AS st, count(dt - nt) AS n_t,
         sum(dh - nh) AS sh, count(dh - nh) AS n_h, count(*) AS n_days
  FROM diff GROUP BY 1)"""
    return with_enriched(
        f"SELECT month, {mean2('st', 'n_t')} AS temp, {mean2('sh', 'n_h')} AS hum, n_days FROM monthly",
        _diff_cte(level), monthly)


def max_month(level: str) -> str:
    monthly = """monthly AS (
  SELECT CAST(month(day) AS INTEGER) AS month, sum(dt - nt) AS st, count(dt - nt) AS n_t
  FROM diff GROUP BY 1 HAVING count(dt - nt) > 0),
ranked AS (
  SELECT month, st, n_t, CAST(st AS DOUBLE) / CAST(n_t AS DOUBLE) AS m FROM monthly)"""
    return with_enriched(
        f"SELECT month, {mean2('st', 'n_t')} AS temp FROM ranked WHERE m = (SELECT max(m) FROM ranked)",
        _diff_cte(level), monthly)


def moving_avg(horizon: str, level: str, humidity_scope: str = "room") -> str:
    k = LEVEL_SQL_KEY[level]
    hk = "fullRoomLocation" if humidity_scope == "room" else k
    iv = HORIZON_SQL[horizon]

    def frame(part: str) -> str:
        return f"OVER (PARTITION BY {part} ORDER BY dateTime RANGE BETWEEN {iv} PRECEDING AND CURRENT ROW)"

    framed = f"""framed AS (
  SELECT {k}, dateTime,
         sum({cents('temperature')}) {frame(k)} AS st,
         count(temperature) {frame(k)} AS nt,
         sum({cents('humidity')}) {frame(hk)} AS sh,
         count(humidity) {frame(hk)} AS nh
  FROM enriched)"""
    return with_enriched(
        f"SELECT {k}, dateTime, {mean2('st', 'nt')} AS avg_temp, {mean2('sh', 'nh')} AS avg_hum FROM framed",
        framed)


_BASE = "CAST(round(value * 100) AS BIGINT)"
_FOUR_DIGITS = (
    ("temperature", "CAST(10 + value % 27.5 AS DECIMAL(10,2))", f"({_BASE} * 37 + event_id) % 400000"),
    ("humidity", "CAST((value * 7) % 100 AS DECIMAL(10,2))", f"({_BASE} * 53 + event_id) % 1000000"))


def four_digit(query: str) -> str:
    """``mean_daily`` or ``moving_avg`` SQL over four-digit measures: columns
    hold units of 0.0001, so counts are multiplied by 100 for a mean in
    hundredths."""
    for name, old, new in _FOUR_DIGITS:
        query = query.replace(f"{old} AS {name}", f"{new} AS {name}")
        query = query.replace(cents(name), name).replace(f"count({name})", f"100 * count({name})")
    return query


def four_digit_values(query: str) -> str:
    """SQL of single readings over the same measures, as DOUBLE."""
    for name, old, new in _FOUR_DIGITS:
        query = query.replace(f"{old} AS {name}", f"({new}) / 10000.0 AS {name}")
    return query


def unrounded(query: str) -> str:
    """``query`` (of the readings) over unrounded DOUBLE measures: columns hold whole
    numbers of 2**-64, which a DOUBLE of these sizes is, so a hundred times their sum
    over 2**64 times their count is a mean in hundredths."""
    one = str(2**64)
    for name, old, new in (("temperature", "CAST(10 + value % 27.5 AS DECIMAL(10,2))", "value"),
                           ("humidity", "CAST((value * 7) % 100 AS DECIMAL(10,2))", "value / 7")):
        query = query.replace(f"{old} AS {name}", f"CAST(({new}) * {one}.0 AS HUGEINT) AS {name}")
        query = query.replace(cents(name), f"100 * {name}::HUGEINT")
        query = query.replace(f"count({name})", f"{one}::HUGEINT * count({name})")
    return query


def malformed_telemetry() -> str:
    return f"""WITH {SENSORS_CTE}
SELECT event_id, {_topic('location')} AS topic FROM sensors
WHERE event_id % 7 = 0 OR event_id % 11 = 0"""


def dedupe_readings() -> str:
    return f"""WITH {SENSORS_CTE}
SELECT location, dateTime,
       CAST(sum({cents('temperature')}) AS DOUBLE) / CAST(count(temperature) * 100 AS DOUBLE) AS temperature,
       CAST(sum({cents('humidity')}) AS DOUBLE) / CAST(count(humidity) * 100 AS DOUBLE) AS humidity,
       count(*) AS n_readings
FROM sensors GROUP BY location, dateTime"""


def bround_measures() -> str:
    return f"""WITH {SENSORS_CTE}
SELECT event_id,
       CAST({half_even(cents('temperature'), '10')} AS DOUBLE) / 10.0 AS temperature_1dp,
       CAST({half_even(cents('humidity'), '10')} AS DOUBLE) / 10.0 AS humidity_1dp
FROM sensors"""


# --- words ------------------------------------------------------------------
SPLIT_SQL = r"string_split_regex(regexp_replace(text, '[ \n]\z', ''), '[ \n]')"
TOKENS_CTE = f"toks AS (SELECT doc_id, unnest({SPLIT_SQL}) AS word FROM documents)"


def word_count() -> str:
    return f"WITH {TOKENS_CTE}\nSELECT word, count(*) AS n FROM toks GROUP BY word"


def word_count_per_doc() -> str:
    return f"WITH {TOKENS_CTE}\nSELECT doc_id, word, count(*) AS n FROM toks GROUP BY doc_id, word"


def distinct_words_per_doc() -> str:
    return f"SELECT doc_id, CAST(len(list_distinct({SPLIT_SQL})) AS BIGINT) AS n_words FROM documents"


def corpus_sizes() -> str:
    return f"""WITH d AS ({distinct_words_per_doc()})
SELECT count(*) AS n_docs, max(n_words) AS max_distinct, CAST(sum(n_words) AS BIGINT) AS sum_distinct FROM d"""


def letter_count() -> str:
    sums = ",\n       ".join(
        f"CAST(coalesce(sum(length(text) - length(replace(text, '{c}', ''))), 0) AS BIGINT) AS {c}"
        for c in LETTERS)
    cols = ", ".join(LETTERS)
    return f"""WITH s AS (SELECT {sums} FROM documents)
SELECT letter, n FROM (UNPIVOT s ON {cols} INTO NAME letter VALUE n)"""


# --- messages -----------------------------------------------------------------
def _topic(loc: str) -> str:
    return f"'{DATA_PREFIX}' || replace({loc}, '.', '/')"


def _assigned(sensor_id: str) -> str:
    d = f"replace({sensor_id}, '{SENSOR_ORG}-', '')"

    def code(pos: int, codes: list[str]) -> str:
        lst = "[" + ", ".join(f"'{c}'" for c in codes) + "]"
        return f"{lst}[TRY_CAST(substr({d}, {pos}, 1) AS INTEGER) + 1]"

    return (f"({code(1, NEIGHBORHOOD_CODES)} || '/' || {code(2, BUILDING_CODES)} || '/' || "
            f"{code(3, FLOOR_CODES)} || '/' || CASE WHEN length({d}) >= 4 THEN substr({d}, 4, 1) END)")


def parse_telemetry() -> str:
    return f"""WITH {SENSORS_CTE}
SELECT event_id, location, dateTime, CAST(temperature AS DOUBLE) AS temperature,
       CAST(humidity AS DOUBLE) AS humidity, sensor_id AS s_id,
       CAST(event_id % 1048576 AS INTEGER) AS seq FROM sensors"""


def topic_to_location() -> str:
    return f"WITH {SENSORS_CTE}\nSELECT event_id, {_topic('location')} AS topic, location FROM sensors"


def location_to_topic() -> str:
    return f"WITH {SENSORS_CTE}\nSELECT event_id, location, {_topic('location')} AS topic FROM sensors"


def sensor_location() -> str:
    return f"WITH {SENSORS_CTE}\nSELECT event_id, sensor_id, {_assigned('sensor_id')} AS location FROM sensors"


def config_replies() -> str:
    return f"""WITH {SENSORS_CTE}
SELECT sensor_id, '{CONF_PREFIX}/' || sensor_id AS topic, {_assigned('sensor_id')} AS location
FROM (SELECT DISTINCT sensor_id FROM sensors)"""


MIXED_CTE = f"""mixed AS (
  SELECT event_id, 'data' AS kind, {_topic('location')} AS topic FROM sensors
  UNION ALL SELECT event_id, 'request', '{CONF_PREFIX}' FROM sensors
  UNION ALL SELECT event_id, 'reply', '{CONF_PREFIX}/' || sensor_id FROM sensors)"""


def _under(prefix: str) -> str:
    base = prefix.rstrip("/")
    return f"(topic = '{base}' OR starts_with(topic, '{base}/'))"


def topic_filter_exact(location: str) -> str:
    return f"""WITH {SENSORS_CTE}, {MIXED_CTE}
SELECT event_id, kind, topic FROM mixed WHERE topic = '{DATA_PREFIX.rstrip('/')}/{location.replace('.', '/')}'"""


def topic_filter_wildcard() -> str:
    return f"""WITH {SENSORS_CTE}, {MIXED_CTE}
SELECT event_id, kind, topic FROM mixed WHERE {_under(DATA_PREFIX)}"""


def route_topics() -> str:
    return f"""WITH {SENSORS_CTE}, {MIXED_CTE}
SELECT event_id, kind, topic,
       CASE WHEN {_under(DATA_PREFIX)} THEN 'out' WHEN {_under(CONF_PREFIX)} THEN 'both' END AS direction
FROM mixed"""


def valid_location() -> str:
    return f"""WITH {SENSORS_CTE},
cand AS (
  SELECT event_id, 0 AS variant, location AS candidate FROM sensors
  UNION ALL SELECT event_id, 1, lower(location) FROM sensors
  UNION ALL SELECT event_id, 2, replace(location, '.', '/') FROM sensors)
SELECT event_id, variant, candidate, regexp_full_match(candidate, '{LOCATION_PATTERN}') AS valid FROM cand"""


def telemetry_with_location() -> str:
    return f"""WITH {SENSORS_CTE}
SELECT event_id, location, dateTime, CAST(temperature AS DOUBLE) AS temperature,
       CAST(humidity AS DOUBLE) AS humidity, sensor_id AS s_id,
       CAST(event_id % 1048576 AS INTEGER) AS seq,
       replace({_assigned('sensor_id')}, '/', '.') AS assigned_location
FROM sensors WHERE {_assigned('sensor_id')} IS NOT NULL"""


def telemetry_located() -> str:
    bits = [f"CAST(CAST(floor(event_id / {d}) AS BIGINT) % 2 AS VARCHAR)" for d in (2, 4, 8)]
    room = "chr(CAST(65 + event_id % 2 AS INTEGER)) || '.' || " + " || '.' || ".join(bits)
    return f"""WITH {SENSORS_CTE},
hist AS (
  SELECT sensor_id, dateTime AS assigned_at, max_by({room}, event_id) AS assigned_location
  FROM sensors JOIN (SELECT event_id FROM events WHERE event_type = 'signup') USING (event_id)
  GROUP BY sensor_id, dateTime)
SELECT event_id, t.sensor_id AS s_id, dateTime, CAST(temperature AS DOUBLE) AS temperature,
       assigned_location, assigned_at
FROM sensors t ASOF LEFT JOIN hist h ON t.sensor_id = h.sensor_id AND t.dateTime >= h.assigned_at"""


def match_subscriptions() -> str:
    parts = "split_part(location, '.', 1) AS n, split_part(location, '.', 2) AS b, " \
            "split_part(location, '.', 3) AS f, split_part(location, '.', 4) AS r"
    return f"""WITH {SENSORS_CTE}, {MIXED_CTE},
rooms AS (SELECT DISTINCT location, {parts} FROM sensors),
given AS (SELECT DISTINCT unnest([{_topic('location')}, '{DATA_PREFIX}' || n || '/+/' || f || '/#',
    '{DATA_PREFIX}' || n || '/' || b || '/+/' || r, '{DATA_PREFIX}' || n || '/#', '+/+/' || n || '/#',
    '{CONF_PREFIX}/#', '{CONF_PREFIX}/+', '#', '+', '{CONF_PREFIX}']) AS pattern FROM rooms),
rule AS (SELECT pattern, CASE WHEN pattern = '#' THEN '.*' ELSE
    replace(replace(pattern, '+', '[^/]*'), '/#', '(/.*)?') END AS regex FROM given)
SELECT event_id, kind, topic, pattern FROM mixed JOIN rule ON regexp_full_match(topic, regex)"""


# --- actuators ----------------------------------------------------------------
_LIMITS = {"temperature": TEMPERATURE_LIMIT, "humidity": HUMIDITY_LIMIT}

STATES_CTE = f"""sig AS (
  SELECT location, event_id, dateTime, temperature, humidity,
         CASE WHEN temperature > {TEMPERATURE_LIMIT} THEN 1 WHEN temperature < {TEMPERATURE_LIMIT} THEN 0 END AS s_temperature,
         CASE WHEN humidity > {HUMIDITY_LIMIT} THEN 1 WHEN humidity < {HUMIDITY_LIMIT} THEN 0 END AS s_humidity
  FROM sensors),
st AS (
  SELECT *,
    coalesce(last_value(s_temperature IGNORE NULLS) OVER (PARTITION BY location ORDER BY dateTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS now_temperature,
    coalesce(last_value(s_temperature IGNORE NULLS) OVER (PARTITION BY location ORDER BY dateTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was_temperature,
    coalesce(last_value(s_humidity IGNORE NULLS) OVER (PARTITION BY location ORDER BY dateTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS now_humidity,
    coalesce(last_value(s_humidity IGNORE NULLS) OVER (PARTITION BY location ORDER BY dateTime, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was_humidity
  FROM sig)"""


def _word(x: str) -> str:
    return f"CASE WHEN {x} = 1 THEN 'on' ELSE 'off' END"


def _event(m: str) -> str:
    return f"CASE WHEN now_{m} <> was_{m} THEN {_word(f'now_{m}')} ELSE 'no change' END"


def transitions(metric: str) -> str:
    return f"""WITH {SENSORS_CTE}, {STATES_CTE}
SELECT location, event_id, dateTime, CAST({metric} AS DOUBLE) AS value, {_word(f'now_{metric}')} AS action
FROM st WHERE now_{metric} <> was_{metric}"""


def actuator_events() -> str:
    parts = "\nUNION ALL\n".join(
        f"SELECT location, event_id, dateTime, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, "
        f"{_word(f'now_{m}')} AS action FROM st WHERE now_{m} <> was_{m}" for m in _LIMITS)
    return f"WITH {SENSORS_CTE}, {STATES_CTE}\n{parts}"


def actuator_state() -> str:
    return f"""WITH {SENSORS_CTE}, {STATES_CTE}
SELECT location, event_id, dateTime,
       {_word('now_temperature')} AS temperature_state, {_event('temperature')} AS temperature_event,
       {_word('now_humidity')} AS humidity_state, {_event('humidity')} AS humidity_event
FROM st"""
