"""The registered queries stated again as plain SQL for an independent engine.

Segmentation is written as a row-by-row recursive walk and nearest-site search as brute force, so
neither repeats the reasoning of the Spark plans.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# ---- shared inputs ------------------------------------------------------------------------------

POS = """
raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS hex, CAST(floor(epoch(ts)) AS BIGINT) AS snapshot_time,
         CAST(user_id % 3 AS VARCHAR) AS hub, CAST(event_id % 2 AS VARCHAR) AS source,
         CASE WHEN event_id % 7 <> 0 THEN 'C' || (user_id % 20) END AS callsign,
         CASE WHEN event_id % 5 <> 0 THEN 'N' || user_id END AS registration,
         'T' || (user_id % 6) AS aircraft_type,
         30e0 + (event_id * 37 % 1000) / 50e0 AS latitude,
         -120e0 + (event_id * 91 % 2500) / 50e0 AS longitude,
         CASE WHEN event_type NOT IN ('signup', 'purchase') THEN CAST(floor(value * 60) AS INTEGER) END AS alt_baro,
         event_type IN ('signup', 'purchase') AS on_ground, value AS ground_speed,
         CAST(event_id * 13 % 400 AS DOUBLE) AS track,
         CASE WHEN event_id % 97 = 0 THEN 'emergency' END AS emergency
  FROM events),
pos AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY hex, snapshot_time ORDER BY event_id DESC) AS rn FROM raw)
  WHERE rn = 1)
"""

AIRPORTS = """
ap AS (
  SELECT 'S' || s_suppkey AS ident, 30e0 + (s_suppkey * 53 % 1000) / 50e0 AS latitude,
         -120e0 + (s_suppkey * 17 % 2500) / 50e0 AS longitude
  FROM supplier)
"""

WALK = """
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY hex ORDER BY snapshot_time) AS n,
         NOT on_ground AND coalesce(alt_baro, 0) > 0 AS air
  FROM pos),
walk AS (
  SELECT hex, n, snapshot_time, on_ground, CAST(0 AS BIGINT) AS seg, air AS armed FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.hex, o.n, o.snapshot_time, o.on_ground,
         w.seg + CASE WHEN o.snapshot_time - w.snapshot_time > 43200
                        OR (w.armed AND o.on_ground AND w.on_ground) THEN 1 ELSE 0 END,
         o.air OR (w.armed AND NOT (o.snapshot_time - w.snapshot_time > 43200
                        OR (w.armed AND o.on_ground AND w.on_ground)))
  FROM walk w JOIN ordered o ON o.hex = w.hex AND o.n = w.n + 1),
fixes AS (SELECT o.*, w.seg FROM ordered o JOIN walk w ON o.hex = w.hex AND o.n = w.n)
"""


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 3440.065 * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


LEGS = f"""
steps AS (
  SELECT *, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon
  FROM fixes WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  WINDOW w AS (PARTITION BY hex, seg ORDER BY n)),
flown AS (
  SELECT hex, seg, sum(CASE WHEN plat IS NULL THEN 0 ELSE {hav('plat', 'plon', 'latitude', 'longitude')} END) AS flown
  FROM steps GROUP BY hex, seg),
ends AS (
  SELECT hex, seg, min(snapshot_time) AS start_time, max(snapshot_time) AS end_time, count(*) AS fix_count,
         max(alt_baro) AS max_alt_ft, max(ground_speed) AS max_ground_speed_kt,
         min_by(on_ground, n) AS dep_observed, max_by(on_ground, n) AS arr_observed, bool_or(NOT on_ground) AS airborne,
         min_by(latitude, n) AS lat1, min_by(longitude, n) AS lon1,
         max_by(latitude, n) AS lat2, max_by(longitude, n) AS lon2,
         min_by(callsign, n) FILTER (WHERE callsign IS NOT NULL) AS callsign,
         min_by(registration, n) FILTER (WHERE registration IS NOT NULL) AS registration,
         min_by(aircraft_type, n) AS aircraft_type, min_by(hub, n) AS hub,
         min_by(emergency, n) FILTER (WHERE emergency IS NOT NULL) AS emergency
  FROM fixes GROUP BY hex, seg),
sized AS (
  SELECT e.*, f.flown, {hav('lat1', 'lon1', 'lat2', 'lon2')} AS direct, hex || '-' || start_time AS leg_id
  FROM ends e JOIN flown f USING (hex, seg)
  WHERE airborne AND end_time - start_time >= 3600),
dep AS (
  SELECT leg_id, ident FROM (
    SELECT s.leg_id, a.ident, row_number() OVER (PARTITION BY s.leg_id ORDER BY {hav('s.lat1', 's.lon1', 'a.latitude', 'a.longitude')}, a.ident) AS rn
    FROM sized s CROSS JOIN ap a
    WHERE s.dep_observed AND {hav('s.lat1', 's.lon1', 'a.latitude', 'a.longitude')} <= 100) WHERE rn = 1),
arr AS (
  SELECT leg_id, ident FROM (
    SELECT s.leg_id, a.ident, row_number() OVER (PARTITION BY s.leg_id ORDER BY {hav('s.lat2', 's.lon2', 'a.latitude', 'a.longitude')}, a.ident) AS rn
    FROM sized s CROSS JOIN ap a
    WHERE s.arr_observed AND {hav('s.lat2', 's.lon2', 'a.latitude', 'a.longitude')} <= 100) WHERE rn = 1),
legs AS (
  SELECT s.leg_id, hex, callsign, registration, aircraft_type, hub, start_time, end_time,
         end_time - start_time AS duration_s, d.ident AS dep_airport, r.ident AS arr_airport,
         dep_observed, arr_observed, dep_observed AND arr_observed AS complete, fix_count, max_alt_ft,
         max_ground_speed_kt, round(flown, 2) AS track_distance_nm, round(direct, 2) AS direct_distance_nm,
         CASE WHEN direct > 1 THEN round(flown / direct, 3) END AS track_efficiency, emergency
  FROM sized s LEFT JOIN dep d ON d.leg_id = s.leg_id LEFT JOIN arr r ON r.leg_id = s.leg_id)
"""

WITH_POS = f"WITH {POS}"
WITH_SEG = f"WITH RECURSIVE {POS}, {WALK}"
WITH_LEGS = f"WITH RECURSIVE {POS}, {WALK}, {AIRPORTS}, {LEGS}"

DIM = """
idf AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS hex, CAST(floor(epoch(ts)) AS BIGINT) AS t,
         'N' || user_id || CASE WHEN user_id % 3 = 0 AND ts >= TIMESTAMP '2024-01-16' THEN 'B' ELSE 'A' END AS registration,
         'T' || (user_id % 6) AS aircraft_type, ts < TIMESTAMP '2024-01-16' AS early
  FROM events),
regs AS (SELECT CAST(c_custkey AS VARCHAR) AS hex, c_mktsegment AS operator, CAST(c_nationkey AS VARCHAR) AS operator_icao FROM customer),
old_seen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hex ORDER BY t DESC, event_id) AS rn FROM idf WHERE early) WHERE rn = 1),
new_seen AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hex ORDER BY t DESC, event_id) AS rn FROM idf) WHERE rn = 1),
versions AS (
  -- unchanged, or unseen before the cut
  SELECT n.hex, n.registration, n.aircraft_type, coalesce(o.t, n.t) AS valid_from, CAST(NULL AS BIGINT) AS valid_to,
         true AS is_current, coalesce(o.t, n.t) AS first_seen, n.t AS last_seen
  FROM new_seen n LEFT JOIN old_seen o ON o.hex = n.hex
  WHERE o.hex IS NULL OR o.registration = n.registration
  UNION ALL
  SELECT o.hex, o.registration, o.aircraft_type, o.t, n.t, false, o.t, o.t
  FROM new_seen n JOIN old_seen o ON o.hex = n.hex WHERE o.registration <> n.registration
  UNION ALL
  SELECT n.hex, n.registration, n.aircraft_type, n.t, NULL, true, n.t, n.t
  FROM new_seen n JOIN old_seen o ON o.hex = n.hex WHERE o.registration <> n.registration),
dim AS (
  SELECT v.hex, v.registration, v.aircraft_type, r.operator, r.operator_icao, v.valid_from, v.valid_to, v.is_current,
         v.first_seen, v.last_seen
  FROM versions v LEFT JOIN regs r ON r.hex = v.hex)
"""

def ts(x: str) -> str:
    return f"(TIMESTAMP '1970-01-01' + to_seconds({x}))"


# ---- marts --------------------------------------------------------------------------------------

ORACLES["mart_traffic_density"] = f"""{WITH_POS}
SELECT hub, date_trunc('hour', {ts('snapshot_time')}) AS hour, count(DISTINCT hex) AS aircraft, count(*) AS fixes,
       count(DISTINCT hex) FILTER (WHERE on_ground) AS on_ground,
       round(avg(alt_baro) FILTER (WHERE NOT on_ground)) AS avg_alt_ft,
       round(avg(ground_speed) FILTER (WHERE NOT on_ground)) AS avg_gs_kt,
       count(DISTINCT aircraft_type) AS distinct_types, count(DISTINCT source) AS feeds_used
FROM pos GROUP BY 1, 2"""

ORACLES["mart_fleet_utilisation"] = f"""{WITH_LEGS}
SELECT registration, aircraft_type, CAST({ts('start_time')} AS DATE) AS day, count(*) AS legs,
       round(sum(duration_s) / 3600.0, 2) AS airborne_hours, round(sum(track_distance_nm)) AS distance_nm,
       count(*) FILTER (WHERE complete) AS complete_legs
FROM legs WHERE registration IS NOT NULL GROUP BY 1, 2, 3"""

ORACLES["mart_route_efficiency"] = f"""{WITH_LEGS}
SELECT aircraft_type, count(*) AS legs, round(avg(track_efficiency), 3) AS avg_track_ratio,
       round(max(track_efficiency), 3) AS worst_track_ratio, round(avg(track_distance_nm)) AS avg_flown_nm,
       round(avg(direct_distance_nm)) AS avg_direct_nm, round(avg(track_distance_nm - direct_distance_nm)) AS avg_excess_nm
FROM legs WHERE track_efficiency IS NOT NULL GROUP BY 1 HAVING count(*) >= 3"""

WX = """
wx AS (
  SELECT CAST(user_id % 20 AS VARCHAR) AS station, CAST(floor(epoch(ts)) AS BIGINT) AS obs_time,
         CASE event_type WHEN 'error' THEN 'LIFR' WHEN 'purchase' THEN 'IFR' WHEN 'click' THEN 'MVFR' ELSE 'VFR' END AS flight_category,
         value / 50e0 AS visibility_sm,
         CASE WHEN event_id % 4 <> 0 THEN CAST((event_id * 7 % 80) * 100 AS INTEGER) END AS ceiling_ft,
         CAST(event_id % 40 AS INTEGER) AS wind_speed_kt,
         CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 60 AS INTEGER) END AS wind_gust_kt,
         CAST(event_id % 160 - 95 AS DOUBLE) AS temp_c
  FROM events)
"""

ORACLES["mart_weather_risk"] = f"""WITH {WX}
SELECT station, date_trunc('hour', {ts('obs_time')}) AS hour, min(flight_category) AS flight_category,
       min(visibility_sm) AS min_visibility_sm, min(ceiling_ft) AS min_ceiling_ft, max(wind_speed_kt) AS max_wind_kt,
       max(coalesce(wind_gust_kt, 0)) AS max_gust_kt, bool_or(flight_category IN ('IFR', 'LIFR')) AS below_minima_risk
FROM wx GROUP BY 1, 2"""

ORACLES["mart_network_disruption"] = """
SELECT CAST(o_custkey % 25 AS VARCHAR) AS airport, o_orderpriority AS delay_type, o_orderstatus AS reason,
       count(*) AS observations, date_trunc('second', min(o_orderdate)) AS first_seen,
       date_trunc('second', max(o_orderdate)) AS last_seen,
       min(CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 60) || ' minutes' END) AS sample_avg_delay,
       min((o_orderkey % 90) || ' minutes') AS sample_max_delay
FROM orders GROUP BY 1, 2, 3"""

ORACLES["mart_safety_event"] = f"""{WITH_POS}
SELECT hex, min(callsign) AS callsign, min(registration) AS registration, min(aircraft_type) AS aircraft_type, emergency,
       min({ts('snapshot_time')}) AS first_seen, max({ts('snapshot_time')}) AS last_seen, count(*) AS fixes,
       CAST(round(max(alt_baro)) AS INTEGER) AS max_alt_ft
FROM pos WHERE emergency IS NOT NULL GROUP BY hex, emergency"""

ORACLES["mart_punctuality_proxy"] = f"""{WITH_LEGS},
baseline AS (
  SELECT callsign, median(duration_s) AS typical_s, count(*) AS samples FROM legs
  WHERE callsign IS NOT NULL AND complete GROUP BY 1 HAVING count(*) >= 3)
SELECT l.callsign, l.registration, CAST({ts('l.start_time')} AS DATE) AS day, l.duration_s, CAST(b.typical_s AS DOUBLE) AS typical_s,
       b.samples AS baseline_samples, round((l.duration_s - b.typical_s) / 60.0, 1) AS delta_minutes
FROM legs l JOIN baseline b USING (callsign) WHERE l.complete"""

LAUNCH = """
lw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS launch_id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS net, l_linestatus AS status,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS observed_at, 'Launch ' || l_orderkey AS name, 'P' || l_suppkey AS provider,
         'V' || l_linenumber AS vehicle, CAST(NULL AS VARCHAR) AS window_start, CAST(NULL AS VARCHAR) AS window_end,
         'Pad ' || (l_suppkey % 7) AS pad_name, 'Site ' || (l_suppkey % 5) AS pad_location,
         CAST(l_suppkey % 90 AS DOUBLE) AS pad_latitude, CAST(l_suppkey % 180 AS DOUBLE) AS pad_longitude,
         CAST(l_quantity AS INTEGER) AS probability, CASE WHEN l_partkey % 3 = 0 THEN 'winds' END AS weather_concerns,
         CASE WHEN l_partkey % 5 = 0 THEN 'hold' END AS hold_reason, l_linenumber, l_partkey
  FROM lineitem)
"""

ORACLES["mart_launch_conflict"] = f"""WITH {LAUNCH}
SELECT launch_id, name, provider, vehicle, status, net, window_start, window_end, pad_name, pad_location, pad_latitude,
       pad_longitude, probability, weather_concerns, hold_reason
FROM (SELECT *, row_number() OVER (PARTITION BY launch_id ORDER BY observed_at DESC, net DESC, l_linenumber DESC, l_partkey DESC,
             vehicle DESC, provider DESC, probability DESC, status DESC) AS rn FROM lw)
WHERE rn = 1"""

ORACLES["mart_launch_slips"] = f"""WITH {LAUNCH}
SELECT launch_id, min(name) AS name, min(provider) AS provider, count(DISTINCT net) AS distinct_nets, min(net) AS earliest_net,
       max(net) AS latest_net, date_diff('day', CAST(min(net) AS TIMESTAMP), CAST(max(net) AS TIMESTAMP)) AS slip_days,
       min(weather_concerns) AS weather_concerns
FROM lw WHERE net IS NOT NULL GROUP BY launch_id HAVING count(DISTINCT net) > 1"""

ORBIT = """
oe AS (
  SELECT CAST(l_partkey AS INTEGER) AS norad_cat_id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS epoch, 'OBJ ' || l_partkey AS object_name,
         (2000 + l_partkey % 25) || '-' || lpad(CAST(l_partkey % 100 AS VARCHAR), 3, '0') AS launch_designator,
         1 + l_quantity / 10 AS mean_motion, round(1440 / (1 + l_quantity / 10), 3) AS period_minutes,
         l_discount AS bstar, l_tax AS inclination
  FROM lineitem)
"""

ORACLES["mart_orbital_decay"] = f"""WITH {ORBIT}
SELECT norad_cat_id, min(object_name) AS object_name, min(launch_designator) AS launch_designator, count(*) AS epochs,
       min(epoch) AS first_epoch, max(epoch) AS last_epoch, round(min(period_minutes), 3) AS min_period_min,
       round(max(period_minutes), 3) AS max_period_min, round(max(mean_motion) - min(mean_motion), 6) AS mean_motion_delta,
       round(avg(bstar), 8) AS avg_bstar, round(avg(inclination), 2) AS inclination
FROM oe GROUP BY norad_cat_id"""

ORACLES["mart_fleet_identity"] = f"""WITH {DIM}
SELECT hex, registration, aircraft_type, operator_icao, operator, {ts('first_seen')} AS first_seen, {ts('last_seen')} AS last_seen
FROM dim WHERE is_current"""

ORACLES["mart_fuel_exposure"] = f"""{WITH_LEGS},
price AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS period, o_orderpriority AS series, round(avg(o_totalprice) / 100000, 4) AS price,
         '$/GAL' AS units FROM orders GROUP BY 1, 2),
newest AS (SELECT * FROM price ORDER BY period DESC, series LIMIT 1)
SELECT l.aircraft_type, count(*) AS legs, round(sum(track_distance_nm - direct_distance_nm)) AS excess_nm,
       any_value(p.price) AS fuel_price, any_value(p.units) AS price_units, any_value(p.period) AS price_date,
       round(sum(track_distance_nm - direct_distance_nm) * 3.5e0 * any_value(p.price), 2) AS est_excess_cost
FROM legs l CROSS JOIN newest p WHERE direct_distance_nm IS NOT NULL GROUP BY l.aircraft_type HAVING count(*) >= 3"""

NOTAM = """
nt AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS notam_id, CAST(o_custkey % 25 AS VARCHAR) AS location, CAST(o_custkey % 25 AS VARCHAR) AS icao_location,
         o_orderpriority AS classification, o_orderstatus AS type, strftime(o_orderdate, '%Y-%m-%d') AS effective_start,
         CASE WHEN o_orderkey % 10 <> 0 THEN strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') END AS effective_end
  FROM orders)
"""

ORACLES["mart_notam_impact"] = f"""WITH {NOTAM}
SELECT icao_location AS airport, classification, type, count(*) AS notams, min(effective_start) AS earliest_start,
       max(effective_end) AS latest_end FROM nt GROUP BY 1, 2, 3"""

ORACLES["carrier_fleet"] = f"""WITH {DIM}
SELECT operator_icao, min(operator) AS operator, count(*) AS fleet FROM dim
WHERE is_current AND operator_icao IS NOT NULL GROUP BY 1"""

# ---- derivations --------------------------------------------------------------------------------

ORACLES["segment_fixes"] = f"{WITH_SEG} SELECT hex, snapshot_time, seg FROM fixes"

ORACLES["track_distance"] = f"""{WITH_LEGS}
SELECT hex, seg, fix_count, round(flown, 2) AS track_distance_nm FROM ends JOIN flown USING (hex, seg)"""

ORACLES["haversine_nm"] = f"""{WITH_POS}
SELECT hex, snapshot_time, round({hav('latitude', 'longitude', '40.6392', '-73.7639')}, 3) AS distance_nm FROM pos"""

ORACLES["flight_legs"] = f"{WITH_LEGS} SELECT * FROM legs"

ORACLES["nearest_airport"] = f"""{WITH_POS}, {AIRPORTS},
near AS (
  SELECT p.hex, p.snapshot_time, a.ident, {hav('p.latitude', 'p.longitude', 'a.latitude', 'a.longitude')} AS d FROM pos p CROSS JOIN ap a)
SELECT hex, snapshot_time, ident, round(d, 3) AS distance_nm
FROM (SELECT *, row_number() OVER (PARTITION BY hex, snapshot_time ORDER BY d, ident) AS rn FROM near WHERE d <= 100)
WHERE rn = 1"""

ORACLES["aircraft_dimension"] = f"WITH {DIM} SELECT * FROM dim"

ORACLES["hub_coordinates"] = f"""WITH {AIRPORTS}
SELECT ident AS icao, latitude, longitude FROM ap WHERE ident IN (SELECT 'S' || (n_nationkey * 3) FROM nation)"""

# ---- relational operators -----------------------------------------------------------------------

ORACLES["dedupe_keep_last"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn
  FROM lineitem) WHERE rn = 1"""

ORACLES["union_by_name"] = """
SELECT event_id, CAST(user_id AS VARCHAR) AS hex, CASE WHEN event_id % 2 = 1 THEN event_type END AS squawk FROM events"""

# ---- parse jobs: the source rows, as the payloads were built from them ---------------------------

BASE = 1704067200


def nulls(*columns: str) -> str:
    """Columns a payload does not carry, as typed nulls."""
    kinds = {"s": "VARCHAR", "i": "INTEGER", "l": "BIGINT", "d": "DOUBLE", "b": "BOOLEAN"}
    return ", ".join(f"CAST(NULL AS {kinds[c.split(':')[1]]}) AS \"{c.split(':')[0]}\"" for c in columns)


ORACLES["parse_positions"] = f"""
SELECT 'a' || user_id AS hex, {BASE} + (event_id // 200) * 60 AS snapshot_time, 'H' || ((event_id // 200) % 3) AS hub, 'feed' AS source,
       CASE WHEN event_id % 7 <> 0 THEN 'C' || (user_id % 20) END AS callsign, 'N' || user_id AS registration, 'T' || (user_id % 6) AS aircraft_type,
       30e0 + (event_id * 37 % 1000) / 50e0 AS latitude, CAST(-120 + event_id % 50 AS DOUBLE) AS longitude,
       CASE WHEN event_type NOT IN ('signup', 'error') THEN CAST(floor(value * 60) AS INTEGER) END AS alt_baro, event_type = 'signup' AS on_ground,
       value AS ground_speed, CASE WHEN event_id % 97 = 0 THEN '7700' ELSE '1200' END AS squawk,
       CASE WHEN event_id % 97 = 0 THEN 'emergency' WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'minfuel' END AS emergency,
       CAST(event_id AS INTEGER) AS messages, event_id % 2 = 0 AS mlat,
       {nulls('category:s', 'alt_geom:i', 'track:d', 'baro_rate:i', 'geom_rate:i', 'nav_altitude_mcp:i', 'nav_qnh:d', 'distance_nm:d', 'bearing_deg:d', 'rssi:d', 'seen_pos:d')}
FROM events"""

ORACLES["parse_states"] = """
WITH s AS (SELECT *, event_id % 10 = 0 AS short FROM events)
SELECT CAST(event_id AS VARCHAR) AS icao24, CASE WHEN short THEN 'C' ELSE 'C' || user_id END AS callsign,
       CASE WHEN NOT short THEN 'XX' END AS origin_country, CASE WHEN NOT short THEN event_id END AS time_position,
       CASE WHEN NOT short THEN event_id + 1 END AS last_contact, CASE WHEN NOT short THEN value END AS longitude,
       CASE WHEN NOT short THEN value / 2 END AS latitude, CASE WHEN NOT short THEN CAST(user_id AS DOUBLE) END AS baro_altitude,
       CASE WHEN NOT short THEN event_type = 'signup' END AS on_ground, CASE WHEN NOT short THEN value END AS velocity,
       CAST(NULL AS DOUBLE) AS true_track, CASE WHEN NOT short THEN 1e0 END AS vertical_rate,
       CASE WHEN NOT short THEN CAST(user_id AS DOUBLE) END AS geo_altitude, CASE WHEN NOT short THEN '1200' END AS squawk,
       CASE WHEN NOT short THEN false END AS spi, CASE WHEN NOT short THEN CAST(0 AS INTEGER) END AS position_source,
       event_id // 200 AS snapshot_time, (event_id // 200) % 2 = 0 AS authenticated, CASE WHEN NOT short THEN CAST(3 AS INTEGER) END AS sensor_count
FROM s"""

CEIL = """CAST(least(CASE WHEN event_id % 4 <> 0 THEN event_id * 7 % 80 * 100 END, CASE WHEN event_id % 5 = 0 THEN 2500 END) AS INTEGER)"""
VISIB = "CASE event_id % 3 WHEN 0 THEN 10e0 WHEN 1 THEN value / 50 END"
WDIR = "CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 360 AS INTEGER) END"

ORACLES["parse_metar"] = f"""
SELECT 'K' || (user_id % 20) AS station, CAST(floor(epoch(ts)) AS BIGINT) AS obs_time, value AS latitude, CAST(user_id AS INTEGER) AS elevation_m,
       'VFR' AS flight_category, value / 10 AS temp_c, {WDIR} AS wind_dir_deg, CAST(event_id % 40 AS INTEGER) AS wind_speed_kt,
       {VISIB} AS visibility_sm, {CEIL} AS ceiling_ft, event_type AS raw,
       {nulls('report_time:s', 'name:s', 'longitude:d', 'dewpoint_c:d', 'wind_gust_kt:i', 'altimeter_hpa:d', 'sea_level_pressure:d')}
FROM events"""

ORACLES["parse_taf"] = f"""
SELECT 'K' || (user_id % 20) AS station, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS issue_time, event_id AS period_from,
       event_id + CASE WHEN k = 0 THEN 3600 ELSE 1800 END AS period_to, event_id AS valid_from, event_id + 86400 AS valid_to,
       CASE WHEN k = 1 THEN 'TEMPO' END AS change_indicator, CASE WHEN k = 1 THEN CAST(30 AS INTEGER) END AS probability,
       CASE WHEN k = 0 THEN {WDIR} END AS wind_dir_deg, CASE WHEN k = 0 THEN CAST(event_id % 40 AS INTEGER) END AS wind_speed_kt,
       CASE WHEN k = 0 THEN {VISIB} ELSE 3e0 END AS visibility_sm, CASE WHEN k = 0 THEN {CEIL} END AS ceiling_ft, event_type AS raw,
       {nulls('wind_gust_kt:i', 'wind_shear_hgt:i', 'vertical_vis_ft:i', 'weather:s')}
FROM events CROSS JOIN (VALUES (0), (1)) v(k)"""

HAZ = """h AS (
  SELECT *, ['TS', 'TURB', 'ICE', 'MTW', 'VA', 'XX'][o_custkey % 6 + 1] AS hazard,
         ['thunderstorm', 'turbulence', 'icing', 'mountain_wave', 'volcanic_ash', NULL][o_custkey % 6 + 1] AS hazard_name,
         o_custkey % 5 = 0 AS across, 10e0 + o_orderkey % 20 AS lat1, 12e0 + o_orderkey % 30 AS lat2 FROM orders)
"""

ORACLES["parse_sigmet"] = f"""WITH {HAZ}
SELECT 'F' || (o_custkey % 9) || '-' || CASE WHEN o_orderkey % 8 <> 0 THEN 'S' || o_orderkey ELSE 'None' END || '-'
         || CAST(floor(epoch(o_orderdate)) AS BIGINT) || '-' || hazard AS hazard_id,
       'SIGMET' AS kind, 'F' || (o_custkey % 9) AS fir_id, CASE WHEN o_orderkey % 8 <> 0 THEN 'S' || o_orderkey END AS series, hazard, hazard_name,
       CAST(CAST(floor(epoch(o_orderdate)) AS BIGINT) AS VARCHAR) AS valid_from, CAST(CAST(floor(epoch(o_orderdate)) AS BIGINT) + 14400 AS VARCHAR) AS valid_to,
       CAST(o_orderkey % 10 * 1000 AS VARCHAR) AS altitude_base_ft,
       CASE WHEN o_orderkey % 11 <> 0 THEN least(lat1, lat2) END AS min_lat, CASE WHEN o_orderkey % 11 <> 0 THEN greatest(lat1, lat2) END AS max_lat,
       CASE WHEN o_orderkey % 11 <> 0 THEN CASE WHEN across THEN 175e0 ELSE -100e0 END END AS min_lon,
       CASE WHEN o_orderkey % 11 <> 0 THEN CASE WHEN across THEN -176e0 ELSE -90e0 + o_custkey % 7 END END AS max_lon,
       o_orderkey % 11 <> 0 AND across AS crosses_antimeridian,
       {nulls('fir_name:s', 'icao_id:s', 'qualifier:s', 'altitude_top_ft:s', 'movement_dir:s', 'movement_speed_kt:s', 'change:s', 'raw:s')}
FROM h"""

ORACLES["parse_gairmet"] = f"""WITH {HAZ}
SELECT 'gairmet-SIERRA-' || strftime(o_orderdate, '%Y-%m-%d') || '-' || hazard || '-' || o_orderkey AS hazard_id, 'GAIRMET' AS kind, hazard, hazard_name,
       strftime(o_orderdate, '%Y-%m-%d') AS valid_from, o_orderpriority AS severity, least(lat1, lat2) AS min_lat, greatest(lat1, lat2) AS max_lat,
       CASE WHEN across THEN 175e0 ELSE -100e0 END AS min_lon, CASE WHEN across THEN -176e0 ELSE -90e0 + o_custkey % 7 END AS max_lon,
       across AS crosses_antimeridian, {nulls('valid_to:s', 'issue_time:s', 'altitude_base_ft:s', 'altitude_top_ft:s', 'frequency:s')}
FROM h"""

ORACLES["hazard_counts"] = f"WITH {HAZ} SELECT hazard_name, count(*) * 2 AS hazards FROM h GROUP BY hazard_name"

ORACLES["parse_disruption"] = f"""
WITH d AS (SELECT *, o_orderkey % 2 = 0 AS shut, o_orderkey % 4 = 1 AS inbound FROM orders)
SELECT 'K' || (o_custkey % 25) AS airport, 'Mixed ' || ((o_orderkey // 200) % 3) AS delay_type, {BASE} + (o_orderkey // 200) * 60 AS observed_at,
       CAST(o_orderkey AS VARCHAR) AS reason,
       CASE WHEN NOT shut AND inbound THEN (o_orderkey % 60) || ' minutes' END AS arrival_delay_min,
       CASE WHEN NOT shut AND inbound THEN '1 hour' END AS arrival_delay_max,
       CASE WHEN NOT shut AND NOT inbound THEN (o_orderkey % 60) || ' minutes' END AS departure_delay_min,
       CASE WHEN NOT shut AND NOT inbound THEN '1 hour' END AS departure_delay_max,
       CASE WHEN shut THEN strftime(o_orderdate, '%Y-%m-%d') END AS reopen_time,
       CASE WHEN shut THEN 'deep_a_b_c_d_e=0' || o_custkey || '; k=' || o_orderstatus || '; k1=x; q_007=v; start=0' || o_custkey ELSE 'arrival_departure_' || CASE WHEN inbound THEN 'arrival' ELSE 'departure' END
         || '_trend=' || o_orderstatus END AS extra,
       {nulls('avg_delay:s', 'max_delay:s', 'min_delay:s', 'end_time:s')}
FROM d"""

ORACLES["parse_launches"] = f"""
SELECT 'L' || o_orderkey AS launch_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS net,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Hold' ELSE 'Go for Launch' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'Hold' ELSE 'Go' END AS status_abbrev,
       o_orderpriority AS observed_at, CASE WHEN o_orderkey % 3 = 0 THEN 'M' END AS mission, CASE WHEN o_orderkey % 3 = 0 THEN 'Test' END AS mission_type,
       CASE WHEN o_orderkey % 3 = 0 THEN 'LEO' END AS orbit, CASE WHEN o_orderkey % 5 = 0 THEN 'R7' ELSE 'Falcon' END AS vehicle,
       CASE WHEN o_orderkey % 4 = 0 THEN 'A, ' || o_orderstatus END AS program, CAST(o_orderkey % 100 AS INTEGER) AS probability,
       'P' AS pad_name, CAST(o_custkey % 90 AS DOUBLE) AS pad_latitude, 'Cape' AS pad_location, o_orderkey % 2 = 1 AS webcast_live,
       {nulls('name:s', 'slug:s', 'provider:s', 'window_start:s', 'window_end:s', 'net_precision:s', 'weather_concerns:s', 'hold_reason:s', 'fail_reason:s', 'pad_longitude:d', 'country_code:s', 'pad_turnaround:s', 'orbital_attempt_count_year:i')}
FROM orders"""

ORACLES["parse_launch_updates"] = f"""
SELECT 'L' || o_orderkey || '-' || (o_orderkey * 2 + k) AS update_id, 'L' || o_orderkey AS launch_id, CASE WHEN k = 0 THEN o_orderstatus ELSE 'x' END AS comment,
       {nulls('created_on:s', 'info_url:s', 'created_by:s')}
FROM orders CROSS JOIN (VALUES (0), (1)) v(k)"""

ORACLES["parse_orbital"] = f"""
SELECT CAST(p_partkey AS INTEGER) AS norad_cat_id, '2026-07-29T00:00:00' AS epoch, p_name AS object_name,
       CASE WHEN p_partkey % 10 = 0 THEN 'UNKNOWN' ELSE (2000 + p_partkey % 25) || '-' || lpad(CAST(p_partkey % 100 AS VARCHAR), 3, '0') || 'BK' END AS object_id,
       CASE WHEN p_partkey % 10 <> 0 THEN (2000 + p_partkey % 25) || '-' || lpad(CAST(p_partkey % 100 AS VARCHAR), 3, '0') END AS launch_designator,
       CASE WHEN p_partkey % 10 <> 0 THEN CAST(2000 + p_partkey % 25 AS INTEGER) END AS launch_year,
       CASE WHEN p_partkey % 13 = 0 THEN 0e0 ELSE p_size / 4e0 END AS mean_motion, p_retailprice AS bstar,
       CASE WHEN p_partkey % 13 <> 0 THEN round(1440e0 / (p_size / 4e0), 3) END AS period_minutes, 'active' AS "group",
       {nulls('eccentricity:d', 'inclination:d', 'ra_of_asc_node:d', 'arg_of_pericenter:d', 'mean_anomaly:d', 'mean_motion_dot:d', 'rev_at_epoch:i')}
FROM part"""

ORACLES["parse_kp"] = """
SELECT CASE WHEN event_id % 50 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS observed_at,
       CASE WHEN event_id % 50 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS time_tag, CAST(event_id % 9 AS INTEGER) AS kp_index,
       CASE WHEN event_id % 20 <> 0 THEN event_id % 90 / 10e0 END AS estimated_kp, event_type AS kp_label,
       event_id % 20 <> 0 AND event_id % 90 >= 50 AS storm, 'noaa_swpc' AS source
FROM events"""

NOTAM_PARSED = f"""
SELECT CASE WHEN o_orderkey % 3 <> 0 THEN 'N' ELSE '#' END || o_orderkey AS notam_id, CASE WHEN o_orderkey % 6 <> 0 THEN '#' || o_orderkey END AS number,
       'L' || ((o_orderkey // 200) % 5) AS location,
       CASE WHEN o_custkey % 4 <> 0 THEN 'K' || (o_custkey % 25) ELSE 'L' || ((o_orderkey // 200) % 5) END AS icao_location, o_orderstatus AS type,
       o_orderpriority AS classification, strftime(o_orderdate, '%Y-%m-%d') AS effective_start,
       CASE WHEN o_orderkey % 2 = 0 THEN 'f' ELSE 's' END || o_orderkey AS formatted_text,
       {nulls('effective_end:s', 'issued:s', 'affected_fir:s', 'selection_code:s', 'minimum_fl:s', 'maximum_fl:s', 'text:s')}
FROM orders WHERE o_orderkey % 6 <> 0 OR o_orderkey % 3 <> 0"""
ORACLES["parse_notam"] = NOTAM_PARSED

ORACLES["parse_fuel"] = f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS period, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority WHEN o_orderkey % 5 <> 0 THEN 'NYH' ELSE 'EPJK' END AS series,
       'EPJK' AS product, CASE WHEN o_orderkey % 5 <> 0 THEN 'NYH' END AS area, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS price,
       '$/GAL' AS units, {nulls('product_name:s')}
FROM orders WHERE o_orderkey % 9 <> 0"""

ORACLES["parse_airports"] = f"""
SELECT 'S' || s_suppkey AS ident, CASE WHEN s_suppkey % 4 <> 0 THEN 'K' || s_suppkey END AS icao, s_name || ', "The" Field' AS name,
       ['large_airport', 'small_airport', 'heliport', 'medium_airport', 'closed'][s_suppkey % 5 + 1] AS kind, CAST(s_suppkey % 90 AS DOUBLE) AS latitude,
       CASE WHEN s_suppkey % 7 <> 0 THEN CAST(-(s_suppkey % 180) AS DOUBLE) END AS longitude,
       CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey AS INTEGER) END AS elevation_ft, 'NA' AS continent, CAST(s_nationkey AS VARCHAR) AS iso_country,
       s_name AS municipality, s_suppkey % 2 = 0 AS scheduled_service, {nulls('iata:s', 'iso_region:s')}
FROM supplier WHERE s_suppkey % 5 IN (0, 1, 3)"""

ORACLES["parse_runways"] = f"""
SELECT CAST(s_suppkey AS VARCHAR) AS runway_id, 'S' || (s_suppkey % 50) AS airport_ident, CAST(s_suppkey * 10 AS INTEGER) AS length_ft,
       CASE WHEN s_suppkey % 3 <> 0 THEN CAST(150 AS INTEGER) END AS width_ft, CASE WHEN s_suppkey % 4 <> 0 THEN 'ASP' END AS surface,
       s_suppkey % 2 = 1 AS lighted, false AS closed, '09' AS le_ident, CAST(s_suppkey % 90 AS DOUBLE) AS le_latitude,
       CAST(s_suppkey % 180 AS DOUBLE) AS le_longitude, 90.5e0 AS le_heading_deg, '27' AS he_ident,
       {nulls('he_latitude:d', 'he_longitude:d', 'he_heading_deg:d')}
FROM supplier"""

ORACLES["parse_registry"] = f"""
SELECT 'a' || c_custkey AS icao24, CASE WHEN c_custkey % 3 = 0 THEN 'N' || c_custkey END AS registration,
       CASE WHEN c_custkey % 3 = 1 THEN 'T' || (c_custkey % 6) END AS aircraft_type, 'Model "' || (c_custkey % 9) || '"' AS model,
       'O''Neil ' || (c_custkey % 4) AS manufacturer, CASE WHEN c_custkey % 6 = 2 THEN c_mktsegment END AS operator, CAST(c_nationkey AS VARCHAR) AS operator_icao,
       c_name AS owner, CAST(c_custkey AS VARCHAR) AS serial_number, {nulls('operator_iata:s', 'operator_callsign:s', 'country:s', 'category:s', 'built:s')}
FROM customer WHERE c_custkey % 50 <> 0 AND (c_custkey % 3 <> 2 OR c_custkey % 6 = 2)"""

ORACLES["ingest_airports"] = ORACLES["parse_airports"]
ORACLES["ingest_runways"] = ORACLES["parse_runways"]
ORACLES["replay_registry"] = ORACLES["parse_registry"]

ORACLES["normalisers"] = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 10e0 WHEN 1 THEN value WHEN 2 THEN 2.5e0 END AS visibility_sm,
       CASE WHEN event_id % 3 = 1 THEN CAST(event_id AS INTEGER) END AS wind_dir_deg,
       CAST((event_id % 720 - 360 + 180 + 720) % 360 - 180 AS DOUBLE) AS wrapped_lon,
       CASE WHEN event_id % 5 <> 0 THEN (1990 + event_id % 30) || '-' || lpad(CAST(event_id % 300 AS VARCHAR), 3, '0') END AS launch_designator,
       CASE WHEN event_id % 5 <> 0 THEN CAST(1990 + event_id % 30 AS INTEGER) END AS launch_year,
       round(1440e0 / nullif(value, 0), 3) AS period_minutes,
       CASE WHEN event_id % 6 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS update_epoch,
       CASE WHEN event_id % 6 <> 1 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS tag_epoch,
       CASE WHEN event_id % 2 = 0 THEN event_type END AS unquoted, event_type AS status, event_id % 90 >= 50 AS storm,
       CAST(floor(epoch(ts)) AS BIGINT) AS seconds
FROM events"""

# ---- storage ------------------------------------------------------------------------------------

ORACLES["bronze_roundtrip"] = NOTAM_PARSED

ORACLES["bronze_scan"] = f"""
WITH p AS (SELECT DISTINCT o_orderkey // 200 AS page FROM orders)
SELECT strftime({ts(f'{BASE} + page * 60')}, '%Y-%m-%d') AS dt, strftime({ts(f'{BASE} + page * 60')}, '%H') AS hh,
       CAST(sum(CASE WHEN page % 10 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS readable_pages,
       CAST(sum(CASE WHEN page % 10 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unreadable_pages, min({BASE}000 + page * 60000) AS first_captured_at
FROM p GROUP BY 1, 2"""

ORACLES["upsert_merge"] = f"""WITH {NOTAM}
SELECT notam_id, location, icao_location, classification, CASE WHEN classification = '1-URGENT' THEN 'R' ELSE type END AS type,
       effective_start, effective_end FROM nt"""

ORACLES["read_table"] = """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS period, o_orderpriority AS series, round(avg(o_totalprice) / 100000, 4) AS price
FROM orders GROUP BY ALL"""

ORACLES["replay_rebuild"] = f"SELECT notam_id, icao_location, type, formatted_text FROM ({NOTAM_PARSED})"
ORACLES["ingest_batch"] = ORACLES["replay_rebuild"]

ORACLES["load_ledger"] = """
SELECT CASE WHEN k = 1 THEN 'run-1' ELSE 'run-2' END AS run_id, 'notam' AS source, 'silver' AS layer, 'fct_notam' AS target, 'ok' AS status,
       count(DISTINCT o_orderkey // 200) AS pages,
       count(*) FILTER (WHERE o_orderkey % 6 <> 0) AS rows_read, count(*) FILTER (WHERE o_orderkey % 6 <> 0) AS rows_written
FROM orders CROSS JOIN (VALUES (1), (2)) v(k) GROUP BY k"""

ORACLES["lineage"] = f"""
SELECT 'page-' || lpad(CAST(page AS VARCHAR), 8, '0') AS page_id, strftime({ts(f'{BASE} + page * 60')}, 'dt=%Y-%m-%d/hh=%H') AS partition,
       count(*) AS row_count, 'fct_position' AS target
FROM (SELECT event_id // 200 AS page FROM events) GROUP BY page"""

ORACLES["table_stats"] = """
SELECT 'events' AS table_name, count(*) AS row_count, CAST(1 AS BIGINT) AS file_count FROM events
UNION ALL SELECT 'orders', count(*), 1 FROM orders UNION ALL SELECT 'lineitem', count(*), 1 FROM lineitem
UNION ALL SELECT 'customer', count(*), 1 FROM customer"""

ORACLES["publish_gold"] = f"""{WITH_LEGS}, {DIM}
SELECT 'fct_flight_leg' AS "table", hex, start_time AS since, registration FROM legs WHERE ascii(right(hex, 1)) % 2 = 0
UNION ALL SELECT 'dim_aircraft', hex, valid_from, registration FROM dim WHERE ascii(right(hex, 1)) % 2 = 0"""

ORACLES["merge_late_page"] = ORACLES["upsert_merge"]
ORACLES["replay_window"] = ORACLES["replay_rebuild"]
ORACLES["merge_blank_partition"] = """
SELECT CAST(o_orderkey AS INTEGER) AS norad_cat_id, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS epoch FROM orders"""

# ---- SQL surface --------------------------------------------------------------------------------

DENSITY = f"""
SELECT hub, date_trunc('hour', {ts('snapshot_time')}) AS hour, count(*) AS fixes, count(DISTINCT hex) AS aircraft,
       count(DISTINCT hex) FILTER (WHERE on_ground) AS on_ground FROM pos GROUP BY 1, 2"""

ORACLES["mart_refresh"] = f"""{WITH_POS}, {NOTAM}
SELECT (SELECT count(*) FROM ({DENSITY})) AS row_count, 'mart_traffic_density' AS mart, true AS created
UNION ALL SELECT (SELECT count(*) FROM (SELECT DISTINCT hex, emergency FROM pos WHERE emergency IS NOT NULL)), 'mart_safety_event', true
UNION ALL SELECT (SELECT count(*) FROM (SELECT DISTINCT icao_location, classification, type FROM nt)), 'mart_notam_impact', true
UNION ALL SELECT NULL, unnest(['mart_fleet_utilisation', 'mart_route_efficiency', 'mart_weather_risk', 'mart_network_disruption', 'mart_punctuality_proxy',
  'mart_launch_conflict', 'mart_launch_slips', 'mart_orbital_decay', 'mart_fleet_identity', 'mart_fuel_exposure']), false"""

ORACLES["adhoc_sql"] = f"""{WITH_POS}
SELECT hub, hour, fixes, aircraft FROM ({DENSITY}) WHERE on_ground > 0 ORDER BY fixes DESC, hub, hour LIMIT 25"""

# ---- data quality -------------------------------------------------------------------------------


def outcome(table: str, check: str, passed: str, observed: str, expected: str, severity: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", {passed} AS passed, {observed} AS observed, "
        f"'{expected}' AS expected, '{severity}' AS severity FROM {source}"
    )


def dq_null(table: str, c: str, limit: float, source: str, expr: str | None = None) -> str:
    e = expr or c
    n = f"count(*) FILTER (WHERE {e} IS NULL)"
    return outcome(
        table, f"not_null[{c}]", f"{n} / count(*) <= {limit}", f"printf('%.1f%% null (%d/%d)', {n} * 100e0 / count(*), {n}, count(*))",
        f"<={limit:.1%} null", "error", source,
    )


def dq_range(table: str, c: str, low: object, high: object, source: str) -> str:
    bad = f"({c} < {low} OR {c} > {high})"
    return outcome(
        table, f"in_range[{c}]", f"count(*) FILTER (WHERE {bad}) = 0",
        f"count(*) FILTER (WHERE {bad}) || ' out of range' || coalesce(' e.g. ' || min({c}) FILTER (WHERE {bad}), '')",
        f"{low}..{high}", "error", source,
    )


def dq_unique(table: str, keys: list[str], source: str) -> str:
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {source}))"
    label = "+".join(keys)
    return outcome(
        table, f"unique[{label}]", f"{distinct} = count(*)", f"(count(*) - {distinct}) || ' duplicates'", f"unique on {label}", "error", source
    )


def dq_rows(table: str, source: str) -> str:
    return outcome(table, "not_empty", "count(*) > 0", "count(*) || ' rows'", ">0 rows", "error", source)


FP = "fct_position"
ORACLES["dq_not_empty"] = f"{WITH_POS} " + dq_rows(FP, "raw")
ORACLES["dq_row_count"] = f"{WITH_POS} " + " UNION ALL ".join(
    outcome(FP, f"row_count_between_1_{n}", f"count(*) BETWEEN 1 AND {n}", "count(*) || ' rows'", f"1..{n} rows", "warn", "raw")
    for n in (5_000, 10**9)
)
ORACLES["dq_not_null"] = f"{WITH_POS} " + " UNION ALL ".join(
    [dq_null(FP, "hex", 0.0, "raw"), dq_null(FP, "callsign", 0.1, "raw"), dq_null(FP, "registration", 0.25, "raw"), dq_null(FP, "absent", 0.0, "raw", "NULL")]
)
ORACLES["dq_in_range"] = f"{WITH_POS} " + " UNION ALL ".join(
    [
        dq_range(FP, "ground_speed", 0, 100, "raw"),
        dq_range(FP, "longitude", -180, 180, "raw"),
        outcome(FP, "in_range[hex]", "true", "'0 out of range'", "0..1", "error", "(SELECT 1)"),
    ]
)
ORACLES["dq_unique"] = f"{WITH_POS} " + " UNION ALL ".join([dq_unique(FP, ["hex", "snapshot_time"], "raw"), dq_unique(FP, ["hex", "hub"], "raw")])
ORACLES["dq_fresh"] = f"{WITH_POS} " + " UNION ALL ".join(
    [
        *[
            outcome(FP, "fresh_within[snapshot_time]", f"2000000000 - max(snapshot_time) <= {age}", "(2000000000 - max(snapshot_time)) || 's old'", f"<={age}s old", "error", "raw")
            for age in (3600, 10**9)
        ],
        outcome(FP, "fresh_within[hex]", "false", "'no timestamps'", "<=3600s old", "error", "(SELECT 1)"),
    ]
)
ORACLES["dq_referential"] = f"""{WITH_POS},
missing AS (SELECT DISTINCT hex FROM pos WHERE hex NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0))
SELECT 'fct_position' AS "table", 'referential[hex]' AS "check", (SELECT count(*) FROM missing) = 0 AS passed,
       (SELECT count(*) FROM missing) || ' unknown' || CASE WHEN (SELECT count(*) FROM missing) > 0 THEN
         ' e.g. [''' || (SELECT string_agg(hex, ''', ''' ORDER BY hex) FROM (SELECT hex FROM missing ORDER BY hex LIMIT 3)) || ''']' ELSE '' END AS observed,
       'all present in reference' AS expected, 'warn' AS severity"""
ORACLES["dq_suite_position"] = f"{WITH_POS} " + " UNION ALL ".join(
    [
        dq_rows(FP, "pos"), dq_unique(FP, ["hex", "snapshot_time"], "pos"), dq_null(FP, "hex", 0.0, "pos"), dq_null(FP, "snapshot_time", 0.0, "pos"),
        dq_null(FP, "latitude", 0.02, "pos"), dq_range(FP, "latitude", -90, 90, "pos"), dq_range(FP, "longitude", -180, 180, "pos"),
        dq_range(FP, "alt_baro", -1500, 60000, "pos"), dq_range(FP, "ground_speed", 0, 1200, "pos"), dq_range(FP, "track", 0, 360, "pos"),
    ]
)
WO = "fct_weather_obs"
ORACLES["dq_blocking"] = f"WITH {WX} SELECT * FROM (" + " UNION ALL ".join(
    [
        dq_rows(WO, "wx"), dq_unique(WO, ["station", "obs_time"], "wx"), dq_null(WO, "station", 0.0, "wx"), dq_range(WO, "wind_speed_kt", 0, 250, "wx"),
        dq_range(WO, "visibility_sm", 0, 100, "wx"), dq_range(WO, "temp_c", -90, 60, "wx"),
    ]
) + ") WHERE NOT passed AND severity = 'error'"
ORACLES["dq_results"] = f"WITH {NOTAM} SELECT *, CAST({BASE} AS BIGINT) AS checked_at FROM (" + " UNION ALL ".join(
    [dq_unique("fct_notam", ["notam_id"], "nt"), dq_null("fct_notam", "notam_id", 0.0, "nt"), dq_null("fct_notam", "location", 0.0, "nt")]
) + ")"

# ---- intervals, boxes, rollup -------------------------------------------------------------------

ORACLES["hazard_exposure"] = f"""{WITH_POS},
hz AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS hazard_id, CAST(floor(epoch(o_orderdate)) AS BIGINT) % 2592000 + 1704067200 AS valid_from,
         CAST(floor(epoch(o_orderdate)) AS BIGINT) % 2592000 + 1704067200 + (o_orderkey % 4 + 1) * 3600 AS valid_to,
         30e0 + o_orderkey % 15 AS min_lat, 32e0 + o_orderkey % 15 + o_custkey % 5 AS max_lat, o_custkey % 5 = 0 AS across,
         CASE WHEN o_custkey % 5 = 0 THEN 170e0 ELSE -120e0 + o_orderkey % 45 END AS min_lon,
         CASE WHEN o_custkey % 5 = 0 THEN -110e0 ELSE -118e0 + o_orderkey % 45 + o_custkey % 5 END AS max_lon
  FROM orders)
SELECT hazard_id, hex, count(*) AS fixes, min(snapshot_time) AS first_inside, max(snapshot_time) AS last_inside
FROM pos JOIN hz ON snapshot_time BETWEEN valid_from AND valid_to AND latitude BETWEEN min_lat AND max_lat
  AND CASE WHEN across THEN longitude >= min_lon OR longitude <= max_lon ELSE longitude BETWEEN min_lon AND max_lon END
GROUP BY 1, 2"""

ORACLES["leg_identity_asof"] = f"""{WITH_LEGS}, {DIM}
SELECT l.leg_id, l.hex, l.start_time, d.registration AS identity_registration, d.aircraft_type AS identity_aircraft_type,
       d.operator_icao AS identity_operator_icao
FROM legs l LEFT JOIN dim d ON d.hex = l.hex AND d.valid_from <= l.start_time AND (d.valid_to IS NULL OR l.start_time < d.valid_to)"""

ORACLES["forecast_for_hour"] = """
WITH fall AS (
  SELECT event_id, CAST(user_id % 20 AS VARCHAR) AS station, strftime(ts - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') AS issue_time,
         CAST(floor(epoch(ts)) AS BIGINT) AS period_from, CAST(floor(epoch(ts)) AS BIGINT) + CASE WHEN event_id % 3 = 0 THEN 3600 ELSE 21600 END AS period_to,
         CASE WHEN event_id % 3 = 0 THEN 'TEMPO' || event_id END AS change_indicator, value / 50e0 AS visibility_sm,
         CAST(event_id * 7 % 80 * 100 AS INTEGER) AS ceiling_ft FROM events),
fc AS (SELECT * EXCLUDE (k, event_id) FROM (SELECT *, row_number() OVER (PARTITION BY station, issue_time, period_from, change_indicator ORDER BY event_id DESC) AS k FROM fall) WHERE k = 1),
want AS (SELECT DISTINCT CAST(user_id % 20 AS VARCHAR) AS station, CAST(floor(epoch(ts)) AS BIGINT) // 3600 * 3600 AS hour_start FROM events)
SELECT station, hour_start, issue_time, period_from, change_indicator, visibility_sm, ceiling_ft FROM (
  SELECT w.station, w.hour_start, f.* EXCLUDE (station, period_to),
         row_number() OVER (PARTITION BY w.station, w.hour_start ORDER BY issue_time DESC, period_from DESC, coalesce(change_indicator, '') DESC) AS rn
  FROM want w JOIN fc f ON f.station = w.station AND f.period_from <= w.hour_start AND w.hour_start < f.period_to)
WHERE rn = 1"""

ORACLES["objects_per_launch"] = f"""WITH {ORBIT}
SELECT launch_designator, count(DISTINCT norad_cat_id) AS objects, count(*) AS element_sets FROM oe GROUP BY 1"""

ORACLES["rollup_positions"] = f"""{WITH_POS}
SELECT hex, snapshot_time // 3600 * 3600 AS step_start, count(*) AS fixes, min(alt_baro) AS min_alt_baro, max(alt_baro) AS max_alt_baro,
       max(ground_speed) AS max_ground_speed, bool_or(on_ground) AS any_on_ground
FROM pos WHERE snapshot_time < 1707868800 - 30 * 86400 AND snapshot_time >= 1707868800 - 365 * 86400 GROUP BY 1, 2"""

# ---- streams ------------------------------------------------------------------------------------

ORACLES["stream_dedupe"] = f"{WITH_POS} SELECT hex, count(*) AS fixes FROM pos GROUP BY 1"

ORACLES["stream_upsert"] = """
SELECT period, series, price FROM (
  SELECT strftime(ts, '%Y-%m-%d') AS period, event_type AS series, value AS price,
         row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), event_type ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"""

ORACLES["stream_density"] = f"""{WITH_POS}
SELECT hub, snapshot_time // 3600 * 3600 AS hour_start, count(*) AS fixes, count(*) FILTER (WHERE on_ground) AS ground_fixes,
       max(alt_baro) AS max_alt_ft FROM raw GROUP BY 1, 2"""

ORACLES["stream_legs"] = ORACLES["flight_legs"]

ORACLES["stream_freshness"] = """
WITH f AS (SELECT event_type AS feed, max(CAST(floor(epoch(ts)) AS BIGINT)) AS newest FROM events GROUP BY 1),
     t AS (SELECT max(CAST(floor(epoch(ts)) AS BIGINT)) AS start FROM events),
     k AS (SELECT range AS batch_id FROM range(3))
SELECT batch_id, feed, start + 3600 * batch_id AS tick, newest, start + 3600 * batch_id - newest AS age_seconds,
       start + 3600 * batch_id - newest <= 5400 AS passed
FROM f, t, k"""
