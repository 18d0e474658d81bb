"""The driver's tables seen through aviation schemas.

Every adapter is a plain projection with integer arithmetic, so the checks can state the same
projection in another SQL engine and get bit-identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.normalise import rounded
from skyweave.operators.latest import keep_last

GAP_SECONDS = 43_200
MIN_LEG_SECONDS = 3_600
RADIUS_NM = 100.0


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_positions(events: DataFrame) -> DataFrame:
    """Fixes as they arrive: not yet unique, ``event_id`` is the arrival order."""
    ground = "event_type IN ('signup', 'purchase')"
    return events.selectExpr(
        "event_id",
        "CAST(user_id AS STRING) AS hex",
        "unix_timestamp(ts) AS snapshot_time",
        "CAST(user_id % 3 AS STRING) AS hub",
        "CAST(event_id % 2 AS STRING) AS source",
        "CASE WHEN event_id % 7 <> 0 THEN concat('C', user_id % 20) END AS callsign",
        "CASE WHEN event_id % 5 <> 0 THEN concat('N', user_id) END AS registration",
        "concat('T', user_id % 6) AS aircraft_type",
        "CAST(NULL AS STRING) AS category",
        "30e0 + (event_id * 37 % 1000) / 50e0 AS latitude",
        "-120e0 + (event_id * 91 % 2500) / 50e0 AS longitude",
        f"CASE WHEN NOT ({ground}) THEN CAST(floor(value * 60) AS INT) END AS alt_baro",
        f"{ground} AS on_ground",
        "value AS ground_speed",
        "CAST(event_id * 13 % 400 AS DOUBLE) AS track",
        "CASE WHEN event_id % 97 = 0 THEN '7700' ELSE '1200' END AS squawk",
        "CASE WHEN event_id % 97 = 0 THEN 'emergency' END AS emergency",
    )


def positions(events: DataFrame, *columns: str) -> DataFrame:
    """``fct_position``: the last arrival per ``(hex, snapshot_time)``, with its key and ``columns`` only if any are named."""
    raw = raw_positions(events)
    keys = ["hex", "snapshot_time"]
    return keep_last(raw.select("event_id", *keys, *columns) if columns else raw, keys, ["event_id"])


def airports(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "concat('S', s_suppkey) AS ident",
        "30e0 + (s_suppkey * 53 % 1000) / 50e0 AS latitude",
        "-120e0 + (s_suppkey * 17 % 2500) / 50e0 AS longitude",
    )


def registry(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "CAST(c_custkey AS STRING) AS icao24",
        "c_acctbal AS balance",
        "CAST(NULL AS STRING) AS registration",
        "CAST(NULL AS STRING) AS aircraft_type",
        "c_mktsegment AS operator",
        "CAST(c_nationkey AS STRING) AS operator_icao",
    )


def identity_fixes(events: DataFrame) -> DataFrame:
    """Fixes in which a third of the aircraft change registration in mid January 2024."""
    return events.selectExpr(
        "event_id",
        "CAST(user_id AS STRING) AS hex",
        "unix_timestamp(ts) AS snapshot_time",
        "concat('N', user_id, CASE WHEN user_id % 3 = 0 AND ts >= TIMESTAMP_NTZ'2024-01-16 00:00:00' "
        "THEN 'B' ELSE 'A' END) AS registration",
        "concat('T', user_id % 6) AS aircraft_type",
        "ts < TIMESTAMP_NTZ'2024-01-16 00:00:00' AS early",
    )


def weather_obs(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "CAST(user_id % 20 AS STRING) AS station",
        "unix_timestamp(ts) AS obs_time",
        "CASE event_type WHEN 'error' THEN 'LIFR' WHEN 'purchase' THEN 'IFR' WHEN 'click' THEN 'MVFR' "
        "ELSE 'VFR' END AS flight_category",
        "value / 50e0 AS visibility_sm",
        "CASE WHEN event_id % 4 <> 0 THEN CAST((event_id * 7 % 80) * 100 AS INT) END AS ceiling_ft",
        "CAST(event_id % 40 AS INT) AS wind_speed_kt",
        "CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 60 AS INT) END AS wind_gust_kt",
        "CAST(event_id % 160 - 95 AS DOUBLE) AS temp_c",
    )


def disruption(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_custkey % 25 AS STRING) AS airport",
        "o_orderpriority AS delay_type",
        "unix_timestamp(o_orderdate) AS observed_at",
        "o_orderstatus AS reason",
        "CASE WHEN o_orderkey % 4 <> 0 THEN concat(o_orderkey % 60, ' minutes') END AS avg_delay",
        "concat(o_orderkey % 90, ' minutes') AS max_delay",
    )


def notams(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS notam_id",
        "CAST(o_custkey % 25 AS STRING) AS location",
        "CAST(o_custkey % 25 AS STRING) AS icao_location",
        "o_orderpriority AS classification",
        "o_orderstatus AS type",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS effective_start",
        "CASE WHEN o_orderkey % 10 <> 0 THEN date_format(o_orderdate + INTERVAL 7 DAY, 'yyyy-MM-dd') END "
        "AS effective_end",
    )


def fuel_prices(orders: DataFrame) -> DataFrame:
    """One price per day and series; aggregated, so ``(period, series)`` is unique."""
    return orders.groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("period"), F.col("o_orderpriority").alias("series")
    ).agg(
        rounded(F.avg("o_totalprice") / 100000, 4).alias("price"),
        F.lit("$/GAL").alias("units"),
    )


def launch_windows(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "CAST(l_orderkey AS STRING) AS launch_id",
        "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS net",
        "l_linestatus AS status",
        "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS observed_at",
        "concat('Launch ', l_orderkey) AS name",
        "concat('P', l_suppkey) AS provider",
        "concat('V', l_linenumber) AS vehicle",
        "CAST(NULL AS STRING) AS window_start",
        "CAST(NULL AS STRING) AS window_end",
        "concat('Pad ', l_suppkey % 7) AS pad_name",
        "concat('Site ', l_suppkey % 5) AS pad_location",
        "CAST(l_suppkey % 90 AS DOUBLE) AS pad_latitude",
        "CAST(l_suppkey % 180 AS DOUBLE) AS pad_longitude",
        "CAST(l_quantity AS INT) AS probability",
        "CASE WHEN l_partkey % 3 = 0 THEN 'winds' END AS weather_concerns",
        "CASE WHEN l_partkey % 5 = 0 THEN 'hold' END AS hold_reason",
        "l_linenumber",
        "l_partkey",
    )


def orbital_elements(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "CAST(l_partkey AS INT) AS norad_cat_id",
        "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS epoch",
        "concat('OBJ ', l_partkey) AS object_name",
        "concat(2000 + l_partkey % 25, '-', lpad(CAST(l_partkey % 100 AS STRING), 3, '0')) AS launch_designator",
        "1 + l_quantity / 10 AS mean_motion",
        "round(1440 / (1 + l_quantity / 10) * 1000) / 1000 AS period_minutes",
        "l_discount AS bstar",
        "l_tax AS inclination",
    )


def hazards(orders: DataFrame) -> DataFrame:
    """Boxes of two to six degrees, valid for some hours; one in five crosses the antimeridian."""
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS hazard_id",
        "element_at(array('TS', 'TURB', 'ICE', 'MTW', 'VA'), CAST(o_custkey % 5 + 1 AS INT)) AS hazard",
        "unix_timestamp(o_orderdate) % 2592000 + 1704067200 AS valid_from",
        "unix_timestamp(o_orderdate) % 2592000 + 1704067200 + (o_orderkey % 4 + 1) * 3600 AS valid_to",
        "30e0 + (o_orderkey % 15) AS min_lat",
        "32e0 + (o_orderkey % 15) + (o_custkey % 5) AS max_lat",
        "CASE WHEN o_custkey % 5 = 0 THEN 170e0 ELSE -120e0 + (o_orderkey % 45) END AS min_lon",
        "CASE WHEN o_custkey % 5 = 0 THEN -110e0 ELSE -118e0 + (o_orderkey % 45) + (o_custkey % 5) END AS max_lon",
        "o_custkey % 5 = 0 AS crosses_antimeridian",
    )


def forecasts(events: DataFrame) -> DataFrame:
    """Six-hour forecasts with a shorter change period in every third; unique on the table's key."""
    rows = events.selectExpr(
        "event_id",
        "CAST(user_id % 20 AS STRING) AS station",
        "date_format(ts - INTERVAL 1 HOUR, \"yyyy-MM-dd'T'HH:mm:ss\") AS issue_time",
        "unix_timestamp(ts) AS period_from",
        "unix_timestamp(ts) + CASE WHEN event_id % 3 = 0 THEN 3600 ELSE 21600 END AS period_to",
        "CASE WHEN event_id % 3 = 0 THEN concat('TEMPO', event_id) END AS change_indicator",
        "value / 50e0 AS visibility_sm",
        "CAST(event_id * 7 % 80 * 100 AS INT) AS ceiling_ft",
    )
    keys = ["station", "issue_time", "period_from", "change_indicator"]
    return keep_last(rows, keys, ["event_id"], nullable_keys=["change_indicator"])
