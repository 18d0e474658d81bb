"""Payload pages built from the driver's tables, in the shapes the feeds have.

Rows are grouped into pages by ranges of a unique id, so a page holds at most ``PAGE`` items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE = 200
EPOCH_MS = 1_704_067_200_000


def _pages(df: DataFrame, id_column: str, item: str, envelope: str) -> DataFrame:
    """Pages of up to ``PAGE`` items; ``envelope`` is SQL over ``items`` and ``page``."""
    return (
        df.groupBy(F.expr(f"CAST({id_column} DIV {PAGE} AS BIGINT)").alias("page"))
        .agg(F.expr(f"collect_list({item})").alias("items"))
        .select(
            F.format_string("page-%08d", "page").alias("page_id"),
            (F.lit(EPOCH_MS) + F.col("page") * 60_000).alias("captured_at"),
            F.expr(f"to_json({envelope})").alias("payload"),
        )
    )


def surveillance(events: DataFrame) -> DataFrame:
    return _pages(
        events, "event_id",
        """named_struct(
          'hex', concat(' A', user_id, ' '), 'flight', CASE WHEN event_id % 7 <> 0 THEN concat('C', user_id % 20, '  ') ELSE '   ' END,
          'r', concat('N', user_id), 't', concat('T', user_id % 6),
          'alt_baro', CASE WHEN event_type = 'signup' THEN CAST('Ground' AS VARIANT) WHEN event_type = 'error' THEN CAST('1200' AS VARIANT)
                      ELSE CAST(CAST(floor(value * 60) AS INT) AS VARIANT) END,
          'lat', 30e0 + (event_id * 37 % 1000) / 50e0, 'lon', CAST(-120 + event_id % 50 AS STRING), 'gs', value,
          'squawk', CASE WHEN event_id % 97 = 0 THEN '7700' ELSE '1200' END,
          'emergency', CASE WHEN event_id % 3 = 0 THEN 'none' WHEN event_id % 31 = 0 THEN 'MinFuel' END,
          'messages', event_id + 0.75e0, 'mlat', CASE WHEN event_id % 2 = 0 THEN array('lat') ELSE array() END)""",
        f"named_struct('now', {EPOCH_MS} + page * 60000 + 999, '_feed', 'feed', '_hub', concat('H', page % 3), 'ac', items)",
    )


def states(events: DataFrame) -> DataFrame:
    return _pages(
        events, "event_id",
        """CASE WHEN event_id % 10 = 0 THEN array(CAST(CAST(event_id AS STRING) AS VARIANT), CAST(' C ' AS VARIANT)) ELSE
           array(CAST(CAST(event_id AS STRING) AS VARIANT), CAST(concat('C', user_id, ' ') AS VARIANT), CAST('XX' AS VARIANT),
           CAST(event_id AS VARIANT), CAST(event_id + 1 AS VARIANT), CAST(value AS VARIANT), CAST(value / 2 AS VARIANT), CAST(user_id AS VARIANT),
           CAST(event_type = 'signup' AS VARIANT), CAST(value AS VARIANT), CAST(NULL AS VARIANT), CAST(1 AS VARIANT),
           CAST(array(1, 2, 3) AS VARIANT), CAST(user_id AS VARIANT), CAST('1200' AS VARIANT), CAST(false AS VARIANT), CAST(0 AS VARIANT)) END""",
        "named_struct('time', page, '_authenticated', page % 2 = 0, 'states', items)",
    )


_CLOUDS = """array(named_struct('cover', 'FEW', 'base', 100), named_struct('cover', CASE WHEN event_id % 4 = 0 THEN 'SCT' ELSE 'BKN' END,
              'base', event_id * 7 % 80 * 100), named_struct('cover', CASE WHEN event_id % 5 = 0 THEN 'OVC' ELSE 'SCT' END, 'base', 2500))"""
_VISIB = """CASE WHEN event_id % 3 = 0 THEN CAST('10+' AS VARIANT) WHEN event_id % 3 = 1 THEN CAST(value / 50 AS VARIANT)
            ELSE CAST('' AS VARIANT) END"""
_WDIR = "CASE WHEN event_id % 6 = 0 THEN CAST('VRB' AS VARIANT) ELSE CAST(event_id % 360 AS VARIANT) END"


def metar(events: DataFrame) -> DataFrame:
    return _pages(
        events, "event_id",
        f"""named_struct('icaoId', concat('K', user_id % 20), 'obsTime', unix_timestamp(ts), 'lat', value, 'elev', user_id, 'fltCat', 'VFR',
            'temp', value / 10, 'wdir', {_WDIR}, 'wspd', event_id % 40, 'visib', {_VISIB}, 'clouds', {_CLOUDS}, 'rawOb', event_type)""",
        "named_struct('observations', items)",
    )


def taf(events: DataFrame) -> DataFrame:
    return _pages(
        events, "event_id",
        f"""named_struct('icaoId', concat('K', user_id % 20), 'issueTime', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'validTimeFrom', event_id,
            'validTimeTo', event_id + 86400, 'rawTAF', event_type, 'fcsts', array(
              named_struct('timeFrom', event_id, 'timeTo', event_id + 3600, 'wdir', {_WDIR}, 'wspd', event_id % 40, 'visib', {_VISIB},
                           'clouds', {_CLOUDS}, 'fcstChange', CAST(NULL AS STRING), 'probability', CAST(NULL AS INT)),
              named_struct('timeFrom', event_id, 'timeTo', event_id + 1800, 'wdir', CAST(NULL AS VARIANT), 'wspd', NULL,
                           'visib', CAST(3 AS VARIANT), 'clouds', array(), 'fcstChange', 'TEMPO', 'probability', 30)))""",
        "named_struct('forecasts', items)",
    )


_COORDS = """array(named_struct('lat', 10e0 + o_orderkey % 20, 'lon', CASE WHEN o_custkey % 5 = 0 THEN 175e0 ELSE -100e0 END),
             named_struct('lat', 12e0 + o_orderkey % 30, 'lon', CASE WHEN o_custkey % 5 = 0 THEN 184e0 ELSE -90e0 + o_custkey % 7 END))"""
_HAZARD = "element_at(array('TS', 'TURB', 'ICE', 'MTW', 'VA', 'XX'), CAST(o_custkey % 6 + 1 AS INT))"


def sigmet(orders: DataFrame) -> DataFrame:
    return _pages(
        orders, "o_orderkey",
        f"""named_struct('firId', concat('F', o_custkey % 9), 'seriesId', CASE WHEN o_orderkey % 8 <> 0 THEN concat('S', o_orderkey) END,
            'validTimeFrom', unix_timestamp(o_orderdate), 'validTimeTo', unix_timestamp(o_orderdate) + 14400, 'hazard', {_HAZARD},
            'base', o_orderkey % 10 * 1000, 'coords', CASE WHEN o_orderkey % 11 = 0 THEN array() ELSE {_COORDS} END)""",
        "named_struct('sigmets', items)",
    )


def gairmet(orders: DataFrame) -> DataFrame:
    return _pages(
        orders, "o_orderkey",
        f"""named_struct('productId', 'SIERRA', 'id', o_orderkey, 'hazard', {_HAZARD}, 'validTime', date_format(o_orderdate, 'yyyy-MM-dd'),
            'severity', o_orderpriority, 'coords', {_COORDS})""",
        "named_struct('gairmets', items)",
    )


def notam(orders: DataFrame) -> DataFrame:
    return _pages(
        orders, "o_orderkey",
        """named_struct('properties', named_struct('coreNOTAMData', named_struct(
             'notam', named_struct('id', CASE WHEN o_orderkey % 3 <> 0 THEN concat('N', o_orderkey) END,
               'number', CASE WHEN o_orderkey % 6 <> 0 THEN concat('#', o_orderkey) END,
               'icaoLocation', CASE WHEN o_custkey % 4 <> 0 THEN concat('K', o_custkey % 25) END, 'type', o_orderstatus,
               'classification', o_orderpriority, 'effectiveStart', date_format(o_orderdate, 'yyyy-MM-dd')),
             'notamTranslation', array(named_struct('simpleText', CAST(NULL AS STRING), 'formattedText', CAST(NULL AS STRING)),
               named_struct('simpleText', concat('s', o_orderkey), 'formattedText', CASE WHEN o_orderkey % 2 = 0 THEN concat('f', o_orderkey) END)))))""",
        "named_struct('_location', concat('L', page % 5), 'items', items)",
    )


def fuel(orders: DataFrame) -> DataFrame:
    return _pages(
        orders, "o_orderkey",
        """named_struct('period', CASE WHEN o_orderkey % 9 <> 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') END,
             'series', CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, 'duoarea', CASE WHEN o_orderkey % 5 <> 0 THEN 'NYH' END,
             'value', CASE WHEN o_orderkey % 4 = 0 THEN CAST('n/a' AS VARIANT) ELSE CAST(CAST(o_custkey AS STRING) AS VARIANT) END, 'units', '$/GAL')""",
        "named_struct('response', named_struct('data', items))",
    )


def launches(orders: DataFrame) -> DataFrame:
    return _pages(
        orders, "o_orderkey",
        """named_struct('id', concat('L', o_orderkey), 'net', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
             'status', CASE WHEN o_orderkey % 2 = 0 THEN CAST('Hold' AS VARIANT) ELSE parse_json('{"name":"Go for Launch","abbrev":"Go"}') END,
             'mission', CASE WHEN o_orderkey % 3 = 0 THEN parse_json('{"name":"M","type":"Test","orbit":{"name":"LEO"}}') END,
             'rocket', CASE WHEN o_orderkey % 5 = 0 THEN CAST('R7' AS VARIANT) ELSE parse_json('{"configuration":{"name":"Falcon"}}') END,
             'program', CASE WHEN o_orderkey % 4 = 0 THEN array(named_struct('name', 'A'), named_struct('name', o_orderstatus)) ELSE array() END,
             'holdreason', '', 'probability', CAST(o_orderkey % 100 AS INT), 'webcast_live', o_orderkey % 2 = 1, 'last_updated', o_orderpriority,
             'pad', named_struct('name', 'P', 'latitude', CAST(o_custkey % 90 AS STRING), 'location', named_struct('name', 'Cape')),
             'updates', array(named_struct('id', o_orderkey * 2, 'comment', o_orderstatus), named_struct('id', o_orderkey * 2 + 1, 'comment', 'x')))""",
        "named_struct('next', CAST(NULL AS STRING), 'results', items)",
    )


def orbital(part: DataFrame) -> DataFrame:
    return _pages(
        part, "p_partkey",
        """named_struct('NORAD_CAT_ID', p_partkey, 'EPOCH', '2026-07-29T00:00:00', 'OBJECT_NAME', p_name,
             'OBJECT_ID', CASE WHEN p_partkey % 10 = 0 THEN 'UNKNOWN' ELSE concat(2000 + p_partkey % 25, '-', lpad(CAST(p_partkey % 100 AS STRING), 3, '0'), 'BK') END,
             'MEAN_MOTION', CASE WHEN p_partkey % 13 = 0 THEN 0e0 ELSE p_size / 4e0 END, 'BSTAR', p_retailprice)""",
        "named_struct('_group', 'active', 'objects', items)",
    )


def kp(events: DataFrame) -> DataFrame:
    return _pages(
        events, "event_id",
        """named_struct('time_tag', CASE WHEN event_id % 50 = 0 THEN 'soon' ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") END,
             'kp_index', event_id % 9, 'estimated_kp', CASE WHEN event_id % 20 <> 0 THEN event_id % 90 / 10e0 END, 'kp', event_type)""",
        "named_struct('kp', items)",
    )


def disruption(orders: DataFrame) -> DataFrame:
    """XML with one block per page, seven levels deep: closures in one form, delays with a typed child in another."""
    return _pages(
        orders, "o_orderkey",
        """CASE WHEN o_orderkey % 2 = 0 THEN
             concat('<Airport><ARPT> k', o_custkey % 25, '</ARPT><Reason>', o_orderkey, '</Reason><Start>0', o_custkey, '</Start><Reopen>',
                    date_format(o_orderdate, 'yyyy-MM-dd'), '</Reopen><Deep><A><B><C><D><E>0', o_custkey, '</E></D></C></B></A></Deep>',
                    '<k1>x</k1><k>1</k><k>', o_orderstatus, '</k><Q no="007">v</Q></Airport>')
           ELSE concat('<Delay><ARPT>k', o_custkey % 25, '</ARPT><Reason>', o_orderkey, '</Reason><Arrival_Departure Type="',
                    CASE WHEN o_orderkey % 4 = 1 THEN 'Arrival' ELSE 'Departure' END, '"><Min>', o_orderkey % 60, ' minutes</Min><Max>1 hour</Max><Trend>',
                    o_orderstatus, '</Trend></Arrival_Departure></Delay>') END""",
        """named_struct('xml', concat('<AIRPORT_STATUS_INFORMATION><Update_Time>', date_format(timestamp_seconds(1704067200 + page * 60), 'EEE MMM d HH:mm:ss yyyy'),
             ' GMT</Update_Time><Delay_type><Name>Mixed ', page % 3, '</Name><Some_List><V><W><X><Y><Z>', array_join(items, ''),
             '</Z></Y></X></W></V></Some_List></Delay_type></AIRPORT_STATUS_INFORMATION>'))""",
    )


def airports_csv(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "CAST(s_suppkey AS STRING) AS id", "concat('S', s_suppkey) AS ident",
        "element_at(array('large_airport', 'small_airport', 'heliport', 'medium_airport', 'closed'), CAST(s_suppkey % 5 + 1 AS INT)) AS type",
        "concat(s_name, ', \"The\" Field') AS name", "CAST(s_suppkey % 90 AS STRING) AS latitude_deg",
        "CASE WHEN s_suppkey % 7 <> 0 THEN CAST(-s_suppkey % 180 AS STRING) ELSE 'west' END AS longitude_deg",
        "CASE WHEN s_suppkey % 3 <> 0 THEN concat(s_suppkey, '.0') END AS elevation_ft", "'NA' AS continent", "CAST(s_nationkey AS STRING) AS iso_country",
        "CAST(NULL AS STRING) AS iso_region", "s_name AS municipality", "CASE WHEN s_suppkey % 2 = 0 THEN 'yes' ELSE 'no' END AS scheduled_service",
        "CASE WHEN s_suppkey % 4 <> 0 THEN concat('K', s_suppkey) END AS icao_code", "CAST(NULL AS STRING) AS iata_code",
    )


def runways_csv(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "CAST(s_suppkey AS STRING) AS id", "concat('S', s_suppkey % 50) AS airport_ident", "CAST(s_suppkey * 10 AS STRING) AS length_ft",
        "CASE WHEN s_suppkey % 3 <> 0 THEN '150' END AS width_ft", "CASE WHEN s_suppkey % 4 <> 0 THEN 'ASP' END AS surface",
        "CAST(s_suppkey % 2 AS STRING) AS lighted", "'0' AS closed", "'09' AS le_ident", "CAST(s_suppkey % 90 AS STRING) AS le_latitude_deg",
        "CAST(s_suppkey % 180 AS STRING) AS le_longitude_deg", "'90.5' AS le_heading_degT", "'27' AS he_ident", "CAST(NULL AS STRING) AS he_latitude_deg",
        "CAST(NULL AS STRING) AS he_longitude_deg", "'' AS he_heading_degT",
    )


def registry_csv(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "CASE WHEN c_custkey % 50 <> 0 THEN concat('A', c_custkey) END AS icao24",
        "CASE WHEN c_custkey % 3 = 0 THEN concat('N', c_custkey) END AS registration",
        "CASE WHEN c_custkey % 3 = 1 THEN concat('T', c_custkey % 6) END AS typecode", "concat('Model \"', c_custkey % 9, '\"') AS model",
        "concat('O''Neil ', c_custkey % 4) AS manufacturerName", "CASE WHEN c_custkey % 6 = 2 THEN c_mktsegment END AS operator",
        "CAST(c_nationkey AS STRING) AS operatorIcao", "CAST(NULL AS STRING) AS operatorIata", "CAST(NULL AS STRING) AS operatorCallsign",
        "c_name AS owner", "CAST(NULL AS STRING) AS country", "CAST(NULL AS STRING) AS categoryDescription", "CAST(NULL AS STRING) AS built",
        "CAST(c_custkey AS STRING) AS serialNumber",
    )


def csv_pages(rows: DataFrame, key: str, quote: str) -> DataFrame:
    """Rows of text as CSV pages: a header line, then one record per row, all fields quoted. Pages are ranges of the
    unique number that ``key`` holds as text, so a page holds at most ``PAGE`` records."""
    cell = lambda c: F.concat(F.lit(quote), F.replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), F.lit(quote), F.lit(quote * 2)), F.lit(quote))
    header = ",".join(f"{quote}{c}{quote}" for c in rows.columns)
    record = F.concat_ws(",", *[cell(c) for c in rows.columns])
    return (
        rows.select(F.expr(f"CAST(CAST({key} AS BIGINT) DIV {PAGE} AS BIGINT)").alias("page"), record.alias("record"))
        .groupBy("page")
        .agg(F.collect_list("record").alias("records"))
        .select(
            F.format_string("page-%08d", "page").alias("page_id"),
            (F.lit(EPOCH_MS) + F.col("page") * 60_000).cast("bigint").alias("captured_at"),
            F.concat(F.lit(header + "\n"), F.array_join("records", "\n")).alias("payload"),
        )
    )
