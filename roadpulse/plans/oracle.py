"""DuckDB SQL for the registered queries, written apart from the Spark side."""

from __future__ import annotations

_INCIDENTS = r"""
incidents AS (
  SELECT event_id,
         CAST(1 + event_id % 4 AS BIGINT) AS severity,
         CASE WHEN event_id % 97 <> 0 THEN CAST(33.9 AS DOUBLE)
           + CAST(user_id * 13 % 30 AS DOUBLE) / 100 + CAST(event_id % 7 AS DOUBLE) / 1000 END AS start_lat,
         CASE WHEN event_id % 89 <> 0 THEN CAST(-118.4 AS DOUBLE)
           + CAST(user_id * 29 % 40 AS DOUBLE) / 100 + CAST(event_id % 11 AS DOUBLE) / 1000 END AS start_lng,
         CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'bad-time'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS start_time,
         strftime(ts + to_microseconds(CAST(ROUND(value * 60000000) AS BIGINT)),
                  '%Y-%m-%d %H:%M:%S.%f') AS end_time,
         CASE WHEN event_id % 53 = 0 THEN NULL WHEN hour(ts) BETWEEN 6 AND 17 THEN 'Day'
              ELSE 'Night' END AS sunrise_sunset,
         CASE WHEN event_id % 59 = 0 THEN NULL WHEN hour(ts) BETWEEN 5 AND 18 THEN 'Day'
              ELSE 'Night' END AS astronomical_twilight,
         CASE WHEN event_id % 61 <> 0 THEN 'S' || CAST(user_id % 50 AS VARCHAR) END AS state,
         CASE event_id % 9
           WHEN 1 THEN 'I- ' || CAST(5 + user_id % 12 AS VARCHAR)
           WHEN 2 THEN 'I-' || CAST(5 + user_id % 12 AS VARCHAR) || ' N'
           WHEN 3 THEN 'us ' || CAST(101 + user_id % 5 AS VARCHAR)
           WHEN 4 THEN 'Hawaii 5 Hwy'
           WHEN 5 THEN 'Main St'
           WHEN 6 THEN 'MAIN ST'
           WHEN 7 THEN 'US - ' || CAST(101 + user_id % 5 AS VARCHAR)
           WHEN 8 THEN 'i ' || CAST(5 + user_id % 12 AS VARCHAR) END AS street,
         CASE WHEN event_id % 10 <> 0 THEN value / 100 END AS precipitation_in,
         CASE WHEN event_id % 13 <> 0 THEN 10 - value / 50 END AS visibility_mi,
         CASE WHEN event_id % 17 <> 0 THEN value / 10 END AS wind_speed_mph,
         CASE WHEN event_id % 19 <> 0
              THEN 40 + 15 * CAST(event_id % 4 AS DOUBLE) + value / 20 END AS temperature_f,
         CASE WHEN event_id % 23 <> 0 THEN CAST(20 + user_id % 80 AS DOUBLE) END AS humidity_pct
  FROM events)"""

_TIMES = """
timed AS (
  SELECT *, TRY_CAST(start_time AS TIMESTAMP) AS s_ts, TRY_CAST(end_time AS TIMESTAMP) AS e_ts
  FROM incidents),
spans AS (
  SELECT *, date_diff('second', date_trunc('second', s_ts), date_trunc('second', e_ts))
              / CAST(60 AS DOUBLE) AS minutes
  FROM timed)"""


def _distance(lat: str, lng: str, lat0: str, lng0: str) -> str:
    return (
        f"6371.0 * 2 * asin(sqrt(least(1.0, pow(sin((radians({lat0}) - radians({lat})) / 2), 2)"
        f" + cos(radians({lat})) * cos(radians({lat0}))"
        f" * pow(sin((radians({lng0}) - radians({lng})) / 2), 2))))"
    )


def _six(expression: str) -> str:
    """Rounded half up to six places, after taking float noise off at the tenth."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38, 10)), 6) AS DOUBLE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# --- radius -----------------------------------------------------------------

_HITS = f"""
hits AS (
  SELECT event_id, start_lat, start_lng, severity,
         {_distance("start_lat", "start_lng", "34.05", "-118.24")} AS km
  FROM incidents WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL)"""


def _radius_rows(km: str) -> str:
    return f"""{_with(_INCIDENTS, _HITS)}
SELECT event_id, start_lat, start_lng, severity, {_six("km")} AS distance_km FROM hits WHERE km <= {km}"""


# --- nearest without a radius, many centres ---------------------------------

_DEPOTS = """
depots AS (
  SELECT s_suppkey AS depot,
         CASE WHEN s_suppkey % 23 <> 0 THEN CAST(33.8 AS DOUBLE) + CAST(s_suppkey * 7 % 50 AS DOUBLE) / 100 END AS lat0,
         CAST(-118.5 AS DOUBLE) + CAST(s_suppkey * 11 % 60 AS DOUBLE) / 100 AS lng0
  FROM supplier)"""

_AROUND = f"""{_with(_INCIDENTS, _DEPOTS)},
pairs AS (
  SELECT depot, event_id, {_distance("start_lat", "start_lng", "lat0", "lng0")} AS km FROM depots, incidents
  WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL AND lat0 IS NOT NULL)"""

_PLACES = """
places(place, lat0, lng0) AS (
  VALUES ('near', 34.05::DOUBLE, -118.24::DOUBLE), ('far', 51.5, -0.13), ('pole', 90.0, 0.0), ('seam', -10.0, 180.0))"""

_NEAREST = f"""{_with(_INCIDENTS, _PLACES)},
ranked AS (
  SELECT place, event_id, {_distance("start_lat", "start_lng", "lat0", "lng0")} AS km FROM places, incidents
  WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY place ORDER BY round(km, 6), event_id) <= 10)
SELECT place, event_id, {_six("km")} AS distance_km FROM ranked"""


# --- hotspots ---------------------------------------------------------------


def _cells(where: str, measure: str = "") -> str:
    return f"""{_with(_INCIDENTS)}
SELECT ROUND(start_lat, 2) AS lat_cell, ROUND(start_lng, 2) AS lng_cell, COUNT(*) AS incidents{measure}
FROM incidents WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL AND {where} GROUP BY ALL"""


# Every centre against every point, with nothing to narrow the pairs.
_INFLUENCE = f"""{_with(_INCIDENTS)},
points AS (
  SELECT start_lat AS lat, start_lng AS lng, COUNT(*) AS n FROM incidents
  WHERE severity >= 3 AND start_lat IS NOT NULL AND start_lng IS NOT NULL GROUP BY ALL),
centres AS (SELECT DISTINCT ROUND(lat, 2) AS lat_cell, ROUND(lng, 2) AS lng_cell FROM points)
SELECT lat_cell, lng_cell, CAST(SUM(n) AS BIGINT) AS incidents
FROM centres, points WHERE {_distance("lat", "lng", "lat_cell", "lng_cell")} <= 2.0
GROUP BY ALL"""

_BY_COUNT = "ORDER BY incidents DESC, lat_cell, lng_cell LIMIT 5"

# --- routes -----------------------------------------------------------------


def _route(street: str, boundary: str = "") -> tuple[str, str]:
    named = f"regexp_extract(upper({street}), '{boundary}(I|US)(\\s*-\\s*|\\s+)\\d+')"
    letters = f"regexp_replace({named}, '[^A-Z]', '', 'g')"
    digits = f"regexp_replace({named}, '[^0-9]', '', 'g')"
    return f"CASE WHEN {named} <> '' THEN {letters} || '-' || {digits}", f"{named} <> ''"


def _routes(boundary: str = "") -> str:
    case, _ = _route("street", boundary)
    return f"""{_with(_INCIDENTS)}
SELECT DISTINCT street, {case} ELSE street END AS route FROM incidents WHERE street IS NOT NULL"""


def _ranking(highways_only: bool) -> str:
    case, found = _route("street")
    only = f"AND {found}" if highways_only else ""
    return f"""{_with(_INCIDENTS, _TIMES)}
SELECT {case} ELSE street END AS route, COUNT(severity) AS incidents, {_six("AVG(minutes)")} AS mean_clearance_min
FROM spans WHERE severity >= 3 AND street IS NOT NULL {only}
GROUP BY 1 ORDER BY incidents DESC, route LIMIT 10"""


# --- anomalous days ---------------------------------------------------------

_MEANS = "AVG(precipitation_in) AS mean_precipitation, AVG(visibility_mi) AS mean_visibility"
_PARSED = "CAST(TRY_CAST(start_time AS TIMESTAMP) AS DATE)"
_PREFIX = "substr(start_time, 1, 10)"


def _daily(day: str = _PARSED, means: str = _MEANS) -> str:
    return f"""
daily AS (
  SELECT state, {day} AS day, COUNT(start_time) AS day_incidents, {means}
  FROM incidents WHERE start_time IS NOT NULL AND state IS NOT NULL AND {day} IS NOT NULL
  GROUP BY ALL)"""


_ROUNDED_MEANS = f"{_six("mean_precipitation")} AS mean_precipitation, {_six("mean_visibility")} AS mean_visibility"
_WIND = ", AVG(wind_speed_mph) AS mean_wind_speed"
_ROUNDED_WIND = f", {_six("mean_wind_speed")} AS mean_wind_speed"

_HISTORY = """
history AS (
  SELECT state, AVG(day_incidents) AS hist_mean, stddev_samp(day_incidents) AS hist_std, COUNT(*) AS observed_days
  FROM daily GROUP BY state)"""


def _anomalies(daily: str, means: str = _ROUNDED_MEANS, tail: str = "") -> str:
    return f"""{_with(_INCIDENTS, daily, _HISTORY)}
SELECT state, day, day_incidents, {means}, {_six("hist_mean")} AS hist_mean, {_six("hist_std")} AS hist_std,
       {_six("hist_mean + 3 * hist_std")} AS threshold
FROM daily JOIN history USING (state) WHERE day_incidents > hist_mean + 3 * hist_std {tail}"""


_ORDER_SPIKES = f"""
WITH daily AS (
  SELECT n_name AS nation, CAST(o_orderdate AS DATE) AS day, COUNT(*) AS day_orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL),
history AS (
  SELECT nation, AVG(day_orders) AS hist_mean, stddev_samp(day_orders) AS hist_std FROM daily GROUP BY nation)
SELECT nation, day, day_orders, {_six("hist_mean")} AS hist_mean, {_six("hist_std")} AS hist_std,
       {_six("hist_mean + 3 * hist_std")} AS threshold
FROM daily JOIN history USING (nation) WHERE day_orders > hist_mean + 3 * hist_std"""

# --- clearance --------------------------------------------------------------


def _clearance(lights: str, unknown: str = "unknown") -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in lights.split(", "))
    return f"""{_with(_INCIDENTS, _TIMES)}
SELECT {lights},
       CASE WHEN s_ts IS NULL THEN '{unknown}' WHEN dayofweek(s_ts) IN (0, 6) THEN 'weekend'
            ELSE 'weekday' END AS day_type,
       {_six("AVG(minutes)")} AS mean_clearance_min, COUNT(*) AS incidents
FROM spans WHERE {present} GROUP BY ALL ORDER BY ALL"""


# --- ingest -----------------------------------------------------------------

_CLEAN = """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 109 <> 0 THEN value END AS value, props
FROM events WHERE event_id % 101 <> 0 AND event_id % 107 <> 0 AND event_id % 103 <> 0"""

_REJECTS = """
WITH parts AS (
  SELECT event_id, event_id || ',' || user_id || ',' || event_type AS head,
         CASE WHEN event_id % 103 = 0 THEN 'oops' WHEN event_id % 109 = 0 THEN 'N/A'
              ELSE CAST(value AS VARCHAR) END AS number,
         '"' || replace(props, '"', '""') || '"' AS quoted
  FROM events)
SELECT CASE WHEN event_id % 101 = 0 THEN head
            WHEN event_id % 107 = 0 THEN head || ',' || number || ',' || quoted || ',surplus'
            ELSE head || ',' || number || ',' || quoted END AS line,
       CASE WHEN event_id % 101 = 0 OR event_id % 107 = 0 THEN 'field_count'
            ELSE 'bad_value:value' END AS reject_reason
FROM parts WHERE event_id % 101 = 0 OR event_id % 107 = 0 OR event_id % 103 = 0"""

_RECORDS = f"SELECT * REPLACE (replace(props, ': ', ':' || chr(10)) AS props) FROM ({_CLEAN})"
_RECORD_REJECTS = f"SELECT * REPLACE (replace(line, ': ', ':' || chr(10)) AS line) FROM ({_REJECTS})"

_COLUMN_TYPES = (
    ("event_id", "bigint"), ("severity", "bigint"), ("start_lat", "double"), ("start_lng", "double"),
    ("start_time", "string"), ("end_time", "string"), ("sunrise_sunset", "string"),
    ("astronomical_twilight", "string"), ("state", "string"), ("street", "string"),
    ("precipitation_in", "double"), ("visibility_mi", "double"), ("wind_speed_mph", "double"),
    ("temperature_f", "double"), ("humidity_pct", "double"),
)

_PROFILE = f"{_with(_INCIDENTS)}\n" + "\nUNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS ordinal, '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null"
    " FROM incidents"
    for i, (c, t) in enumerate(_COLUMN_TYPES)
)

# --- severity model ---------------------------------------------------------

_FEATURES = """
features AS (
  SELECT event_id, severity, start_lat, start_lng, temperature_f, humidity_pct, visibility_mi,
         sunrise_sunset, state, severity - 1 AS label,
         CASE WHEN substr(md5(CAST(event_id AS VARCHAR)), 1, 4) < 'cccd' THEN 'train' ELSE 'test' END AS part
  FROM incidents
  WHERE severity IS NOT NULL AND start_lat IS NOT NULL AND start_lng IS NOT NULL
    AND temperature_f IS NOT NULL AND humidity_pct IS NOT NULL AND visibility_mi IS NOT NULL
    AND sunrise_sunset IS NOT NULL AND state IS NOT NULL)"""

_CONFUSION = """
confusion AS (
  SELECT label, CAST(CASE WHEN temperature_f < 60 THEN 0 WHEN temperature_f < 75 THEN 1
                          WHEN temperature_f < 90 THEN 2 ELSE 3 END AS BIGINT) AS prediction, COUNT(*) AS n
  FROM features GROUP BY ALL)"""

_METRICS = f"""{_with(_INCIDENTS, _FEATURES, _CONFUSION)},
supports AS (SELECT label AS cls, SUM(n) AS support, SUM(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
             FROM confusion GROUP BY label),
predicted AS (SELECT prediction AS cls, SUM(n) AS predicted FROM confusion GROUP BY prediction)
SELECT {_six("SUM(tp) / CAST(SUM(support) AS DOUBLE)")} AS accuracy,
       {_six("SUM(support * (CAST(2 AS DOUBLE) * tp / (support + COALESCE(predicted, 0)))) / SUM(support)")}
         AS weighted_f1
FROM supports LEFT JOIN predicted USING (cls)"""


def _category(column: str) -> str:
    return f"""
SELECT '{column}' AS feature, {column} AS category,
       row_number() OVER (ORDER BY COUNT(*) DESC, {column}) - 1 AS category_index
FROM features GROUP BY {column}"""


_INFERRED = """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 103 = 0 THEN 'oops'
         WHEN event_id % 109 <> 0 THEN CAST(value AS VARCHAR) END AS value, props
FROM events WHERE event_id % 101 <> 0 AND event_id % 107 <> 0"""

_KEYLESS = f"""{_with(_INCIDENTS, _FEATURES)},
parts AS (
  SELECT label, CASE WHEN event_id % 7 <> 0 AND part = 'train' THEN 'train' ELSE 'test' END AS part FROM features)
SELECT part, label, COUNT(*) AS n FROM parts GROUP BY ALL
UNION ALL SELECT part || ' rows', label, COUNT(*) FROM parts GROUP BY ALL"""


def _one_hot(column: str) -> str:
    return f"""
{column}_index AS (
  SELECT {column}, row_number() OVER (ORDER BY COUNT(*) DESC, {column}) - 1 AS {column}_at, COUNT(*) OVER () AS {column}_n
  FROM features GROUP BY {column})"""


def _hot(column: str) -> str:
    return f"list_transform(range({column}_n), lambda i: CASE WHEN i = {column}_at THEN '1.000000' ELSE '0.000000' END)"


_ASSEMBLED = f"""{_with(_INCIDENTS, _FEATURES, _one_hot("sunrise_sunset"), _one_hot("state"))}
SELECT event_id, label, array_to_string(list_concat(list_concat(
         list_transform([start_lat, start_lng, temperature_f, humidity_pct, visibility_mi], lambda x: printf('%.6f', {_six("x")})),
         {_hot("sunrise_sunset")}), {_hot("state")}), ' ') AS features
FROM features JOIN sunrise_sunset_index USING (sunrise_sunset) JOIN state_index USING (state)"""


def _curve_step(value: str, low: int, high: int) -> str:
    step = f"CAST(least(floor(({value} - {low}) / (CAST({high - low} AS DOUBLE) / {1 << 26})), {(1 << 26) - 1}) AS BIGINT)"
    return f"CASE WHEN {value} BETWEEN {low} AND {high} THEN {step} END"


# Bit by bit: bit i of the longitude's step goes to place 2 i, that of the latitude's to the place above.
_CURVE_KEYS = f"""{_with(_INCIDENTS)},
steps AS (
  SELECT event_id, {_curve_step("start_lng", -180, 180)} AS x, {_curve_step("start_lat", -90, 90)} AS y FROM incidents),
bits AS (
  SELECT event_id, CAST(sum((((x >> i) & 1) << (2 * i)) | (((y >> i) & 1) << (2 * i + 1))) AS BIGINT) AS curve_key
  FROM steps, range(26) r(i) GROUP BY event_id)
SELECT event_id, curve_key FROM bits"""

_REACH = "(degrees(5.0 / 6371.0) + 1e-9)"
_HALF = "(degrees(asin(sin(5.0 / 6371.0) / cos(radians(34.05)))) + 1e-9)"
_GROUPS_OPENED = f"""{_with(_INCIDENTS)},
inside AS (
  SELECT count(*) AS n FROM incidents
  WHERE start_lat BETWEEN 34.05 - {_REACH} AND 34.05 + {_REACH} AND start_lng BETWEEN -118.24 - {_HALF} AND -118.24 + {_HALF})
SELECT (SELECT count(*) FROM incidents) AS rows, n AS state_rows_in_box, n AS curve_rows_in_box,
       TRUE AS box_is_covered, TRUE AS half_or_fewer_opened FROM inside"""


_OPEN = f"""{_with(_INCIDENTS)},
timed AS (
  SELECT state, TRY_CAST(start_time AS TIMESTAMP) AS s, TRY_CAST(end_time AS TIMESTAMP) AS e FROM incidents),
usable AS (SELECT * FROM timed WHERE e >= s)"""

# By overlap of every incident with every hour; the most open by a running sum over every moment.
_OPEN_BY_HOUR = f"""{_OPEN},
hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(s)), date_trunc('hour', max(e)), INTERVAL 1 HOUR)) AS hour FROM usable),
moments AS (
  SELECT s AS m, 1 AS c FROM usable UNION ALL SELECT e, -1 FROM usable UNION ALL SELECT hour, 0 FROM hours),
running AS (SELECT m, sum(sum(c)) OVER (ORDER BY m) AS o FROM moments GROUP BY m),
most AS (SELECT date_trunc('hour', m) AS hour, max(o) AS most_open FROM running GROUP BY 1)
SELECT h.hour, CAST(count(*) FILTER (s >= h.hour AND s < h.hour + INTERVAL 1 HOUR) AS BIGINT) AS began,
       CAST(count(*) FILTER (s < h.hour AND e >= h.hour) AS BIGINT) AS open_before, CAST(any_value(most_open) AS BIGINT) AS most_open,
       {_six("coalesce(sum(greatest(0, date_diff('microsecond', greatest(s, h.hour), least(e, h.hour + INTERVAL 1 HOUR)))) FILTER (s IS NOT NULL), 0) / 60000000::DOUBLE")} AS open_minutes
FROM hours h JOIN most USING (hour) LEFT JOIN usable ON s < h.hour + INTERVAL 1 HOUR AND e >= h.hour
GROUP BY h.hour"""

_OPEN_BY_STATE = f"""{_OPEN},
moments AS (SELECT state, s AS moment, 1 AS c FROM usable UNION ALL SELECT state, e, -1 FROM usable)
SELECT state, moment, CAST(sum(sum(c)) OVER (PARTITION BY state ORDER BY moment) AS BIGINT) AS open
FROM moments GROUP BY state, moment"""


_SKETCHED = [c for c, _ in _COLUMN_TYPES if c != "state"]
_SKETCH_BOUNDS = f"{_with(_INCIDENTS)}\n" + "\nUNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS ordinal, '{c}' AS column_name, COUNT({c}) AS non_null, TRUE AS different_holds,"
    f" {'TRUE' if dict(_COLUMN_TYPES)[c] != 'string' else 'CAST(NULL AS BOOLEAN)'} AS quantiles_hold, TRUE AS frequent_holds FROM incidents"
    for i, c in enumerate(_SKETCHED)
)
_SKETCH_VALUES = f"{_with(_INCIDENTS)}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM incidents GROUP BY {c}"
    for c in ("severity", "sunrise_sunset", "street")
)


def oracle_sql() -> dict[str, str]:
    incidents = _with(_INCIDENTS)
    features = _with(_INCIDENTS, _FEATURES)
    located = "TRUE"
    severe = "severity >= 3"
    return {
        "ingest_typed": _CLEAN,
        "ingest_rejects": _REJECTS,
        "ingest_csv_files": _CLEAN,
        "ingest_records": _RECORDS,
        "ingest_record_rejects": _RECORD_REJECTS,
        "ingest_stream": _RECORDS,
        "ingest_stream_rejects": _RECORD_REJECTS,
        "ingest_inferred": _INFERRED,
        "convert_roundtrip": _CLEAN,
        "layout_order_check": f"{incidents}\nSELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS rows_out_of_order,"
        " CAST(0 AS BIGINT) AS files_overlapping, COUNT(*) FILTER (WHERE state IS NULL) AS null_first,"
        " TRUE AS several_files FROM incidents",
        "clustered_roundtrip": f"{incidents}\nSELECT * FROM incidents",
        "curve_roundtrip": f"{incidents}\nSELECT * FROM incidents",
        "curve_keys": _CURVE_KEYS,
        "curve_radius_search": _radius_rows("25.0"),
        "curve_groups_opened": _GROUPS_OPENED,
        "nearest_anywhere": _NEAREST,
        "incidents_around_depots": f"{_AROUND}\nSELECT depot, event_id, {_six("km")} AS distance_km FROM pairs WHERE km <= 2.0",
        "incident_counts_around_depots": f"{_AROUND}\nSELECT depot, COUNT(event_id) AS incidents"
        " FROM depots LEFT JOIN (SELECT * FROM pairs WHERE km <= 10.0) USING (depot) GROUP BY depot",
        "open_by_hour": _OPEN_BY_HOUR,
        "open_by_state": _OPEN_BY_STATE,
        "open_unusable": f"{_OPEN}\nSELECT (SELECT count(*) FROM timed) - (SELECT count(*) FROM usable) AS unusable",
        "sketch_profile_bounds": _SKETCH_BOUNDS,
        "sketch_profile_values": _SKETCH_VALUES,
        "layout_zone_totals": f"{incidents}\nSELECT COUNT(*) AS rows, "
        + ", ".join(
            f"{side}({key}) AS {side}_{key}"
            for key in ("state", "start_lat", "start_lng", "street")
            for side in ("min", "max")
        )
        + " FROM incidents",
        "sample_head": f"{incidents}\nSELECT event_id, severity, state, street, start_time, sunrise_sunset"
        " FROM incidents ORDER BY event_id LIMIT 5",
        "column_profile": _PROFILE,
        "radius_search": _radius_rows("25.0"),
        "radius_search_near": _radius_rows("5.0"),
        "radius_nearest10": _radius_rows("25.0") + "\nORDER BY distance_km, event_id LIMIT 10",
        "radius_count": f"{_with(_INCIDENTS, _HITS)}\nSELECT COUNT(*) AS incidents FROM hits WHERE km <= 25.0",
        "grid_cell_counts": _cells(severe),
        "grid_hotspots_top5": f"{_cells(severe)}\n{_BY_COUNT}",
        "hotspots_density": f"{_cells(located)}\n{_BY_COUNT}",
        "hotspots_weighted": _cells(located, ", CAST(SUM(severity) AS BIGINT) AS danger")
        + "\nORDER BY danger DESC, lat_cell, lng_cell LIMIT 5",
        "hotspots_one_state": f"{_cells(severe + " AND state = 'S7'")}\n{_BY_COUNT}",
        "hotspots_radius_cells": _INFLUENCE,
        "hotspots_radius": f"{_INFLUENCE}\n{_BY_COUNT}",
        "route_normalised": _routes(),
        "route_normalised_anchored": _routes("\\b"),
        "route_ranking_top10": _ranking(False),
        "highway_ranking_top10": _ranking(True),
        "daily_rollup": f"{_with(_INCIDENTS, _daily())}\nSELECT state, day, day_incidents, {_ROUNDED_MEANS} FROM daily",
        "daily_rollup_prefix": f"{_with(_INCIDENTS, _daily(_PREFIX))}\n"
        f"SELECT state, day, day_incidents, {_ROUNDED_MEANS} FROM daily",
        "entity_history_stats": f"{_with(_INCIDENTS, _daily(), _HISTORY)}\nSELECT state,"
        f" {_six("hist_mean")} AS hist_mean, {_six("hist_std")} AS hist_std, observed_days FROM history",
        "history_moments": f"{_with(_INCIDENTS, _daily(), _HISTORY)}\nSELECT state,"
        f" {_six("hist_mean")} AS hist_mean, {_six("hist_std")} AS hist_std, observed_days FROM history",
        "history_anomalies": _anomalies(_daily()),
        "sigma_anomalies": _anomalies(_daily()),
        "sigma_anomalies_join": _anomalies(_daily()),
        "sigma_anomalies_prefix": _anomalies(_daily(_PREFIX)),
        "sigma_anomalies_weather": _anomalies(_daily(means=_MEANS + _WIND), _ROUNDED_MEANS + _ROUNDED_WIND),
        "sigma_anomalies_top5": _anomalies(_daily(), tail="\nORDER BY day_incidents DESC, state, day LIMIT 5"),
        "sigma_anomalies_count": f"{_with(_INCIDENTS, _daily(), _HISTORY)}\nSELECT COUNT(*) AS anomalies"
        " FROM daily JOIN history USING (state) WHERE day_incidents > hist_mean + 3 * hist_std",
        "order_spike_days": _ORDER_SPIKES,
        "order_spike_top5": f"{_ORDER_SPIKES}\nORDER BY day_orders DESC, nation, day LIMIT 5",
        "daily_by_prefix_of_text": f"{incidents}\nSELECT {_PREFIX} AS day, COUNT(*) AS incidents FROM incidents"
        " WHERE start_time IS NOT NULL AND state IS NOT NULL GROUP BY 1",
        "clearance_by_light_daytype": _clearance("sunrise_sunset"),
        "clearance_unparsed_as_weekday": _clearance("sunrise_sunset", "weekday"),
        "clearance_by_twilight": _clearance("sunrise_sunset, astronomical_twilight"),
        "ml_feature_rows": f"{features}\nSELECT * EXCLUDE (part) FROM features",
        "ml_label_counts": f"{features}\nSELECT label, COUNT(*) AS n FROM features GROUP BY label",
        "ml_category_index": f"{features}{_category('sunrise_sunset')}\nUNION ALL {_category('state')}",
        "ml_split_counts": f"{features}\nSELECT part, label, COUNT(*) AS n FROM features GROUP BY ALL",
        "ml_split_counts_null_keys": _KEYLESS,
        "ml_assembled_rows": _ASSEMBLED,
        "ml_tree_checks": f"{features}\nSELECT COUNT(*) AS tested, COUNT(*) AS scored, TRUE AS once,"
        " TRUE AS known_classes, TRUE AS beats_guessing FROM features WHERE part = 'test'",
        "ml_test_rows": f"{features}\nSELECT event_id, severity, label FROM features WHERE part = 'test'",
        "ml_confusion": f"{_with(_INCIDENTS, _FEATURES, _CONFUSION)}\nSELECT * FROM confusion",
        "ml_metrics": _METRICS,
    }
