"""The registered queries: each reads the driver's tables through an adapter and runs one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave import lake, streaming
from skyweave.bindings import payloads as P
from skyweave.bindings import tables as B
from skyweave.functions import geo
from skyweave.functions import normalise as N
from skyweave.operators import identity, interval, joins, latest, legs, nearest, segments
from skyweave.plans import marts, operations, pipeline, quality, warehouse
from skyweave.schemas import TABLES
from skyweave.session import configure, shared_folder, stage
from skyweave.sources import PARSERS, pages, reference

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        return run

    return register


# ---- shared inputs ------------------------------------------------------------------------------


def _positions(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return B.positions(B.load(spark, sf, "events"), *columns)


def _airports(spark: SparkSession, sf: str) -> DataFrame:
    return B.airports(B.load(spark, sf, "supplier"))


def _derived_legs(spark: SparkSession, sf: str) -> DataFrame:
    return legs.flight_legs(
        _positions(spark, sf), _airports(spark, sf), B.GAP_SECONDS, B.RADIUS_NM, B.MIN_LEG_SECONDS
    )


def _legs(spark: SparkSession, sf: str) -> DataFrame:
    """The leg table, which marts read as a stored table."""
    return stage(spark, _derived_legs(spark, sf))


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    fixes = B.identity_fixes(B.load(spark, sf, "events"))
    registry = B.registry(B.load(spark, sf, "customer"))
    before = identity.aircraft_dimension(fixes.where("early"), None, registry, F.col("event_id"))
    return identity.aircraft_dimension(fixes, before, registry, F.col("event_id"))


def _mart(name: str, table: str, binding: Callable[[SparkSession, str], DataFrame]) -> None:
    build = next(m.build for m in marts.MARTS if m.name == name)
    query(name)(lambda spark, sf: build({table: binding(spark, sf)}))


# ---- marts --------------------------------------------------------------------------------------

_mart("mart_traffic_density", "fct_position", _positions)
_mart("mart_fleet_utilisation", "fct_flight_leg", _legs)
_mart("mart_route_efficiency", "fct_flight_leg", _legs)
_mart("mart_weather_risk", "fct_weather_obs", lambda s, d: B.weather_obs(B.load(s, d, "events")))
_mart("mart_network_disruption", "fct_disruption", lambda s, d: B.disruption(B.load(s, d, "orders")))
_mart("mart_safety_event", "fct_position", _positions)
_mart("mart_punctuality_proxy", "fct_flight_leg", _legs)
_mart("mart_launch_slips", "fct_launch_window", lambda s, d: B.launch_windows(B.load(s, d, "lineitem")))
_mart("mart_orbital_decay", "fct_orbital_element", lambda s, d: B.orbital_elements(B.load(s, d, "lineitem")))
_mart("mart_fleet_identity", "dim_aircraft", _dimension)
_mart("mart_notam_impact", "fct_notam", lambda s, d: B.notams(B.load(s, d, "orders")))


@query("mart_launch_conflict")
def mart_launch_conflict(spark: SparkSession, sf: str) -> DataFrame:
    windows = B.launch_windows(B.load(spark, sf, "lineitem"))
    return marts.launch_conflict({"fct_launch_window": windows}, tie=("l_linenumber", "l_partkey", "vehicle", "provider", "probability", "status"))


@query("mart_fuel_exposure")
def mart_fuel_exposure(spark: SparkSession, sf: str) -> DataFrame:
    prices = B.fuel_prices(B.load(spark, sf, "orders"))
    return marts.fuel_exposure({"fct_flight_leg": _legs(spark, sf), "fct_fuel_price": prices})


@query("carrier_fleet")
def carrier_fleet(spark: SparkSession, sf: str) -> DataFrame:
    return marts.carrier_fleet(_dimension(spark, sf))


# ---- derivations --------------------------------------------------------------------------------


@query("segment_fixes")
def segment_fixes(spark: SparkSession, sf: str) -> DataFrame:
    return segments.segment_fixes(_positions(spark, sf), B.GAP_SECONDS).select("hex", "snapshot_time", "seg")


@query("track_distance")
def track_distance(spark: SparkSession, sf: str) -> DataFrame:
    return legs.track_distance(_positions(spark, sf), B.GAP_SECONDS)


@query("haversine_nm")
def haversine_nm(spark: SparkSession, sf: str) -> DataFrame:
    d = geo.great_circle_nm(F.col("latitude"), F.col("longitude"), F.lit(40.6392), F.lit(-73.7639))
    return _positions(spark, sf).select("hex", "snapshot_time", N.rounded(d, 3).alias("distance_nm"))


@query("flight_legs")
def flight_legs(spark: SparkSession, sf: str) -> DataFrame:
    return _derived_legs(spark, sf)


@query("nearest_airport")
def nearest_airport(spark: SparkSession, sf: str) -> DataFrame:
    fixes = _positions(spark, sf).select("hex", "snapshot_time", "latitude", "longitude")
    found = nearest.nearest_within(fixes, ["hex", "snapshot_time"], _airports(spark, sf), B.RADIUS_NM)
    return found.select("hex", "snapshot_time", "ident", N.rounded(F.col("distance_nm"), 3).alias("distance_nm"))


@query("aircraft_dimension")
def aircraft_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension(spark, sf)


@query("hub_coordinates")
def hub_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    hubs = B.load(spark, sf, "nation").selectExpr("concat('S', n_nationkey * 3) AS icao")
    return joins.hub_coordinates(hubs, _airports(spark, sf))


# ---- relational operators -----------------------------------------------------------------------


@query("dedupe_keep_last")
def dedupe_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    lines = B.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return latest.keep_last(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity"])


@query("union_by_name")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    events = B.load(spark, sf, "events")
    old = events.where("event_id % 2 = 0").selectExpr("event_id", "CAST(user_id AS STRING) AS hex")
    new = events.where("event_id % 2 = 1").selectExpr("CAST(user_id AS STRING) AS hex", "event_id", "event_type AS squawk")
    return latest.align(old, new)


# ---- parse jobs ---------------------------------------------------------------------------------


def _parse(name: str, source: str, table: str, build: Callable[[DataFrame], DataFrame]) -> None:
    @query(name)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return pages.without_origin(PARSERS[source].parse(build(B.load(spark, sf, table))))


_parse("parse_positions", "surveillance", "events", P.surveillance)
_parse("parse_states", "opensky", "events", P.states)
_parse("parse_metar", "metar", "events", P.metar)
_parse("parse_taf", "taf", "events", P.taf)
_parse("parse_sigmet", "sigmet", "orders", P.sigmet)
_parse("parse_gairmet", "gairmet", "orders", P.gairmet)
_parse("parse_disruption", "disruption", "orders", P.disruption)
_parse("parse_launches", "launches", "orders", P.launches)
_parse("parse_launch_updates", "launch_updates", "orders", P.launches)
_parse("parse_orbital", "orbital", "part", P.orbital)
_parse("parse_kp", "spaceweather", "events", P.kp)
_parse("parse_notam", "notam", "orders", P.notam)
_parse("parse_fuel", "fuel", "orders", P.fuel)


def _written_csv(spark: SparkSession, df: DataFrame, quote: str) -> str:
    path = shared_folder(spark, "csv")
    df.write.option("header", True).option("quote", quote).option("escape", quote).option("quoteAll", True).csv(path)
    return path


@query("parse_airports")
def parse_airports(spark: SparkSession, sf: str) -> DataFrame:
    path = _written_csv(spark, P.airports_csv(B.load(spark, sf, "supplier")), '"')
    return reference.parse_airports(reference.read_csv_lines(spark, path, '"', reference.AIRPORT_FILE))


@query("parse_runways")
def parse_runways(spark: SparkSession, sf: str) -> DataFrame:
    path = _written_csv(spark, P.runways_csv(B.load(spark, sf, "supplier")), '"')
    return reference.parse_runways(reference.read_csv_lines(spark, path, '"', reference.RUNWAY_FILE))


@query("parse_registry")
def parse_registry(spark: SparkSession, sf: str) -> DataFrame:
    path = _written_csv(spark, P.registry_csv(B.load(spark, sf, "customer")), "'")
    return reference.parse_registry(reference.read_csv_lines(spark, path, "'", ("icao24", *reference.REGISTRY_COLUMNS)))


@query("hazard_counts")
def hazard_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = B.load(spark, sf, "orders")
    both = latest.align(
        PARSERS["sigmet"].parse(P.sigmet(orders)), PARSERS["gairmet"].parse(P.gairmet(orders))
    )
    return marts.hazard_counts(both)


def _through_lake(spark: SparkSession, source: str, payloads: DataFrame, again: bool = False) -> DataFrame:
    """A reference file's pages ingested, perhaps replayed, and read back from their table."""
    root = shared_folder(spark, "lake")
    pipeline.ingest(spark, root, source, payloads, "run-1", keep_ledger=False)
    if again:
        pipeline.replay(spark, root, source)
    table = PARSERS[source].table
    return lake.read_table(spark, root, table).select(*TABLES[table].schema.names)


@query("ingest_airports")
def ingest_airports(spark: SparkSession, sf: str) -> DataFrame:
    return _through_lake(spark, "airports", P.csv_pages(P.airports_csv(B.load(spark, sf, "supplier")), "id", '"'))


@query("ingest_runways")
def ingest_runways(spark: SparkSession, sf: str) -> DataFrame:
    return _through_lake(spark, "runways", P.csv_pages(P.runways_csv(B.load(spark, sf, "supplier")), "id", '"'))


@query("replay_registry")
def replay_registry(spark: SparkSession, sf: str) -> DataFrame:
    return _through_lake(spark, "registry", P.csv_pages(P.registry_csv(B.load(spark, sf, "customer")), "serialNumber", "'"), again=True)


@query("normalisers")
def normalisers(spark: SparkSession, sf: str) -> DataFrame:
    """The column normalisers no parse query above shows by itself."""
    events = B.load(spark, sf, "events").selectExpr(
        "event_id",
        "CASE event_id % 4 WHEN 0 THEN CAST('10+' AS VARIANT) WHEN 1 THEN CAST(value AS VARIANT) WHEN 2 THEN CAST(' 2.5 ' AS VARIANT) "
        "ELSE CAST('M' AS VARIANT) END AS visib",
        "CASE event_id % 3 WHEN 0 THEN CAST('VRB' AS VARIANT) WHEN 1 THEN CAST(event_id AS VARIANT) ELSE CAST(1.5 AS VARIANT) END AS wdir",
        "CAST(event_id % 720 - 360 AS DOUBLE) AS lon",
        "CASE WHEN event_id % 5 = 0 THEN 'UNKNOWN' ELSE concat(1990 + event_id % 30, '-', lpad(CAST(event_id % 300 AS STRING), 3, '0'), 'AB') END AS object_id",
        "CASE WHEN event_id % 6 = 0 THEN 'now' ELSE concat(date_format(ts, 'EEE MMM d HH:mm:ss yyyy'), ' GMT') END AS update_time",
        "CASE WHEN event_id % 6 = 1 THEN '' ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") END AS time_tag",
        "CASE WHEN event_id % 2 = 0 THEN concat(' ''', event_type, ''' ') ELSE \"''\" END AS quoted",
        "CASE WHEN event_id % 2 = 0 THEN CAST(event_type AS VARIANT) ELSE parse_json(concat('{\"name\":\"', event_type, '\"}')) END AS status",
        "event_id % 90 / 10e0 AS kp",
        "unix_timestamp(ts) * 1000 + 999 AS millis",
        "value",
    )
    return events.select(
        "event_id",
        N.visibility(F.col("visib")).alias("visibility_sm"),
        N.integer_only(F.col("wdir")).alias("wind_dir_deg"),
        geo.wrapped_lon(F.col("lon")).alias("wrapped_lon"),
        N.launch_designator(F.col("object_id")).alias("launch_designator"),
        N.launch_year(F.col("object_id")).alias("launch_year"),
        N.orbital_period(F.col("value")).alias("period_minutes"),
        N.weekday_text_to_epoch(F.col("update_time")).alias("update_epoch"),
        N.iso_to_epoch(F.col("time_tag")).alias("tag_epoch"),
        N.unquoted(F.col("quoted")).alias("unquoted"),
        N.text_or_object(F.col("status")).alias("status"),
        N.is_storm(F.col("kp")).alias("storm"),
        N.millis_to_seconds(F.col("millis")).alias("seconds"),
    )


# ---- storage ------------------------------------------------------------------------------------


def _archived(spark: SparkSession, payloads: DataFrame, source: str) -> str:
    root = shared_folder(spark, "lake")
    lake.archive(payloads.withColumn("source", F.lit(source)), root)
    return root


@query("bronze_roundtrip")
def bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Archive pages, scan them back, and parse: nothing is lost or changed on the way."""
    root = _archived(spark, P.notam(B.load(spark, sf, "orders")), "notam")
    back = lake.scan_bronze(spark, root, "notam").where(F.sha2("payload", 256) == F.col("sha256"))
    return pages.without_origin(PARSERS["notam"].parse(back))


@query("bronze_scan")
def bronze_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Pages per capture hour, with unreadable ones counted apart."""
    orders = B.load(spark, sf, "orders")
    torn = F.when(F.substring("page_id", -1, 1) == "0", F.lit("{torn")).otherwise(F.col("payload"))
    root = _archived(spark, P.notam(orders).withColumn("payload", torn), "notam")
    scanned = lake.scan_bronze(spark, root, "notam")
    good, bad = lake.readable(scanned), lake.unreadable(scanned)
    both = latest.align(good.withColumn("ok", F.lit(1)), bad.withColumn("ok", F.lit(0)))
    return both.groupBy("dt", "hh").agg(
        F.sum("ok").alias("readable_pages"),
        F.sum(1 - F.col("ok")).alias("unreadable_pages"),
        F.min("captured_at").alias("first_captured_at"),
    )


_NOTAM_COLUMNS = ["notam_id", "location", "icao_location", "classification", "type", "effective_start", "effective_end"]


def _two_loads(spark: SparkSession, sf: str) -> str:
    """All notices, then a second load that changes the type of the urgent ones, then that load again."""
    root = shared_folder(spark, "lake")
    notices = B.notams(B.load(spark, sf, "orders"))
    second = notices.where("classification = '1-URGENT'").withColumn("type", F.lit("R"))
    for load_rows in (notices, second, second):
        lake.upsert(spark, root, "fct_notam", load_rows)
    return root


@query("upsert_merge")
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    return lake.read_table(spark, _two_loads(spark, sf), "fct_notam").select(*_NOTAM_COLUMNS)


@query("merge_late_page")
def merge_late_page(spark: SparkSession, sf: str) -> DataFrame:
    """The later load is merged first, the earlier one after it: the later values stay."""
    root = shared_folder(spark, "lake")
    notices = B.notams(B.load(spark, sf, "orders"))
    later = notices.where("classification = '1-URGENT'").withColumn("type", F.lit("R"))
    for rows, at in ((later, 5), (notices, 3)):
        lake.upsert(spark, root, "fct_notam", rows.withColumn("_captured_at", F.lit(at)))
    return lake.read_table(spark, root, "fct_notam").select(*_NOTAM_COLUMNS)


@query("merge_blank_partition")
def merge_blank_partition(spark: SparkSession, sf: str) -> DataFrame:
    """Element sets whose epoch has a day but no hour, merged in two loads into the same partitions."""
    root = shared_folder(spark, "lake")
    orders = B.load(spark, sf, "orders")
    rows = orders.select(F.col("o_orderkey").cast("int").alias("norad_cat_id"), F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("epoch"))
    for half in (0, 1):
        lake.upsert(spark, root, "fct_orbital_element", rows.where(F.col("norad_cat_id") % 2 == half))
    return lake.read_table(spark, root, "fct_orbital_element").select("norad_cat_id", "epoch")


@query("replay_window")
def replay_window(spark: SparkSession, sf: str) -> DataFrame:
    """Older versions of all pages come last, and their days are replayed: the table keeps the newer values."""
    root = shared_folder(spark, "lake")
    newer = P.notam(B.load(spark, sf, "orders"))
    older = newer.withColumn("captured_at", F.col("captured_at") - 40 * 86_400_000).withColumn("payload", F.replace("payload", F.lit('"type":"'), F.lit('"type":"was ')))
    pipeline.ingest(spark, root, "notam", newer, "run-1", keep_ledger=False)
    pipeline.ingest(spark, root, "notam", older, "run-2", keep_ledger=False)
    last_day = older.agg(F.date_format(F.timestamp_millis(F.max("captured_at")), "yyyy-MM-dd")).first()[0]
    pipeline.replay(spark, root, "notam", until=last_day)
    return lake.read_table(spark, root, "fct_notam").select("notam_id", "icao_location", "type", "formatted_text")


@query("read_table")
def read_table(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table next to one that was never written, which reads as empty."""
    root = shared_folder(spark, "lake")
    lake.upsert(spark, root, "fct_fuel_price", B.fuel_prices(B.load(spark, sf, "orders")))
    stored = lake.read_table(spark, root, "fct_fuel_price").select("period", "series", "price")
    missing = lake.read_table(spark, root, "dim_runway").select(F.lit("none").alias("period"))
    return latest.align(stored, missing)


@query("replay_rebuild")
def replay_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    root = _archived(spark, P.notam(B.load(spark, sf, "orders")), "notam")
    for _ in range(2):
        pipeline.replay(spark, root, "notam")
    return lake.read_table(spark, root, "fct_notam").select("notam_id", "icao_location", "type", "formatted_text")


def _ingested(spark: SparkSession, sf: str) -> str:
    """Two runs of the ingest job over one feed that is delivered twice."""
    root = shared_folder(spark, "lake")
    all_pages = P.notam(B.load(spark, sf, "orders"))
    pipeline.ingest(spark, root, "notam", all_pages, "run-1")
    pipeline.ingest(spark, root, "notam", all_pages, "run-2")
    return root


@query("ingest_batch")
def ingest_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The archive worked off as a stream of files into the merged table."""
    root = _archived(spark, P.notam(B.load(spark, sf, "orders")), "notam")
    streaming.run_ingest(spark, root, "notam", shared_folder(spark, "checkpoint")).awaitTermination()
    return lake.read_table(spark, root, "fct_notam").select("notam_id", "icao_location", "type", "formatted_text")


@query("load_ledger")
def load_ledger(spark: SparkSession, sf: str) -> DataFrame:
    runs = spark.read.parquet(f"{_ingested(spark, sf)}/ops/pipeline_run")
    return operations.recent_runs(runs).select("run_id", "source", "layer", "target", "status", "pages", "rows_read", "rows_written")


@query("lineage")
def lineage(spark: SparkSession, sf: str) -> DataFrame:
    sweeps = P.surveillance(B.load(spark, sf, "events"))
    return operations.lineage(PARSERS["surveillance"].parse(sweeps), "fct_position")


@query("table_stats")
def table_stats(spark: SparkSession, sf: str) -> DataFrame:
    names = ["events", "orders", "lineitem", "customer"]
    stats = operations.table_stats({name: B.load(spark, sf, name) for name in names})
    return stats.select("table_name", "row_count", "file_count")


@query("publish_gold")
def publish_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Legs and dimension published twice; the second time the aircraft of one half have no legs and no versions left."""
    root = shared_folder(spark, "lake")
    all_legs, versions = _legs(spark, sf), _dimension(spark, sf)
    kept = F.ascii(F.substring("hex", -1, 1)) % 2 == 0
    pipeline.publish_legs(spark, root, all_legs, all_legs)
    pipeline.publish_legs(spark, root, all_legs.where(kept), all_legs)
    pipeline.publish_dimension(spark, root, versions)
    pipeline.publish_dimension(spark, root, versions.where(kept))
    legs = lake.read_table(spark, root, "fct_flight_leg").select(F.lit("fct_flight_leg").alias("table"), "hex", F.col("start_time").alias("since"), "registration")
    stored = lake.read_table(spark, root, "dim_aircraft").select(F.lit("dim_aircraft").alias("table"), "hex", F.col("valid_from").alias("since"), "registration")
    return legs.unionByName(stored)


# ---- SQL surface --------------------------------------------------------------------------------


def _views(spark: SparkSession, sf: str) -> tuple[list[str], list[str]]:
    tables = {"fct_position": _positions(spark, sf), "fct_notam": B.notams(B.load(spark, sf, "orders"))}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return marts.refresh(tables)


@query("mart_refresh")
def mart_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Which marts the populated tables allow, each with its row count."""
    created, skipped = _views(spark, sf)
    parts = [spark.table(m).agg(F.count(F.lit(1)).alias("row_count")).withColumn("mart", F.lit(m)) for m in created]
    counted = latest.align(*parts).withColumn("created", F.lit(True))
    names = spark.sql(" UNION ALL ".join(f"SELECT '{m}' AS mart" for m in skipped))
    return latest.align(counted, names.withColumn("created", F.lit(False)))


@query("adhoc_sql")
def adhoc_sql(spark: SparkSession, sf: str) -> DataFrame:
    _views(spark, sf)
    text = (
        "SELECT m.hub, m.hour, m.fixes, m.aircraft FROM mart_traffic_density m "
        "WHERE m.on_ground > 0 ORDER BY m.fixes DESC, m.hub, m.hour"
    )
    return warehouse.adhoc(spark, text)


# ---- data quality -------------------------------------------------------------------------------


def _check(name: str, table: str, *checks: quality.Expectation) -> None:
    @query(name)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return quality.run_checks(B.raw_positions(B.load(spark, sf, "events")), table, checks)


_check("dq_not_empty", "fct_position", quality.not_empty())
_check("dq_row_count", "fct_position", quality.row_count_between(1, 5_000), quality.row_count_between(1, 10**9))
_check(
    "dq_not_null", "fct_position",
    quality.not_null("hex"), quality.not_null("callsign", 0.1), quality.not_null("registration", 0.25), quality.not_null("absent"),
)
_check(
    "dq_in_range", "fct_position",
    quality.in_range("ground_speed", 0, 100), quality.in_range("longitude", -180, 180), quality.in_range("hex", 0, 1),
)
_check("dq_unique", "fct_position", quality.unique(["hex", "snapshot_time"]), quality.unique(["hex", "hub"]))
_check(
    "dq_fresh", "fct_position",
    quality.fresh_within("snapshot_time", 3600, 2_000_000_000), quality.fresh_within("snapshot_time", 10**9, 2_000_000_000),
    quality.fresh_within("hex", 3600, 2_000_000_000),
)


@query("dq_referential")
def dq_referential(spark: SparkSession, sf: str) -> DataFrame:
    fixes, known = _positions(spark, sf), B.registry(B.load(spark, sf, "customer")).where("balance > 0")
    return quality.run_checks(fixes, "fct_position", [quality.referential("hex", known, "icao24")])


@query("dq_suite_position")
def dq_suite_position(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_suite(_positions(spark, sf), "fct_position")


@query("dq_blocking")
def dq_blocking(spark: SparkSession, sf: str) -> DataFrame:
    """Weather rows break two rules of their suite; only error-level failures block."""
    suite = quality.run_suite(B.weather_obs(B.load(spark, sf, "events")), "fct_weather_obs", [quality.row_count_between(0, 1)])
    return quality.blocking(suite)


@query("dq_results")
def dq_results(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes appended to the result table and read back."""
    root = shared_folder(spark, "lake")
    suite = quality.run_suite(B.notams(B.load(spark, sf, "orders")), "fct_notam")
    operations.append(suite.withColumn("checked_at", F.lit(1_704_067_200).cast("bigint")), root, "dq_result")
    return spark.read.parquet(f"{root}/ops/dq_result")


# ---- intervals, boxes, rollup -------------------------------------------------------------------


@query("hazard_exposure")
def hazard_exposure(spark: SparkSession, sf: str) -> DataFrame:
    """Advisories with their validity as the table stores it: epoch text of one feed, ISO text of the other."""
    hazards = B.hazards(B.load(spark, sf, "orders"))
    iso = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = lambda c: F.when(F.pmod(F.xxhash64("hazard_id"), F.lit(2)) == 0, F.col(c).cast("string")).otherwise(iso(F.col(c)))
    return interval.hazard_exposure(_positions(spark, sf, "latitude", "longitude"), hazards.withColumns({c: text(c) for c in ("valid_from", "valid_to")}))


@query("leg_identity_asof")
def leg_identity_asof(spark: SparkSession, sf: str) -> DataFrame:
    return interval.leg_identity_asof(_legs(spark, sf), _dimension(spark, sf))


@query("forecast_for_hour")
def forecast_for_hour(spark: SparkSession, sf: str) -> DataFrame:
    events = B.load(spark, sf, "events")
    hours = events.selectExpr("CAST(user_id % 20 AS STRING) AS station", "unix_timestamp(ts) DIV 3600 * 3600 AS hour_start")
    return interval.forecast_for_hour(hours, B.forecasts(events))


@query("objects_per_launch")
def objects_per_launch(spark: SparkSession, sf: str) -> DataFrame:
    return interval.objects_per_launch(B.orbital_elements(B.load(spark, sf, "lineitem")))


@query("rollup_positions")
def rollup_positions(spark: SparkSession, sf: str) -> DataFrame:
    return interval.rollup_positions(_positions(spark, sf), as_of=1_707_868_800, raw_days=30, rollup_days=365)


# ---- streams ------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table read as a stream of files."""
    schema = B.load(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query("stream_dedupe")
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Copies of every fix removed by the stream; what is left per aircraft."""
    fixes = B.raw_positions(_event_stream(spark, sf)).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    path = shared_folder(spark, "stream")
    once = streaming.deduplicated(fixes, "1 day").select("hex", "snapshot_time")
    sink = once.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared_folder(spark, "checkpoint"))
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(once.schema).parquet(path).groupBy("hex").agg(F.count(F.lit(1)).alias("fixes"))


@query("stream_upsert")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_folder(spark, "lake")
    prices = _event_stream(spark, sf).selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS period", "event_type AS series", "value AS price",
        "event_id AS _captured_at", "CAST(event_id AS STRING) AS _page_id", "event_id AS _ordinal",
    )
    streaming.run_upsert(prices, root, "fct_fuel_price", shared_folder(spark, "checkpoint")).awaitTermination()
    return lake.read_table(spark, root, "fct_fuel_price").select("period", "series", "price")


@query("stream_density")
def stream_density(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "density")
    fixes = B.raw_positions(_event_stream(spark, sf))
    streaming.run_density(fixes, path, shared_folder(spark, "checkpoint")).awaitTermination()
    hourly = streaming.latest_density(spark.read.parquet(path))
    return hourly.select("hub", "hour_start", "fixes", "ground_fixes", "max_alt_ft")


@query("stream_legs")
def stream_legs(spark: SparkSession, sf: str) -> DataFrame:
    """Legs kept current by the stream; equal to the batch result once the stream is drained."""
    root = shared_folder(spark, "lake")
    fixes = B.raw_positions(_event_stream(spark, sf)).withColumnRenamed("event_id", "_captured_at")
    airports = _airports(spark, sf)
    streaming.run_legs(
        fixes, airports, root, shared_folder(spark, "checkpoint"), B.GAP_SECONDS, B.RADIUS_NM, B.MIN_LEG_SECONDS
    ).awaitTermination()
    return lake.read_table(spark, root, "fct_flight_leg").drop("dt")


FRESH_EVERY_SECONDS, FRESH_MAX_AGE_SECONDS, FRESH_RUNS = 3600, 5400, 3


@query("stream_freshness")
def stream_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Arrivals of every event type recorded by one stream, then three runs of the watch without new files.

    Ticks start at the newest event and advance an hour a run, so silence grows by an hour each run and is
    noted on every run, though no data batch comes.
    """
    root, events = shared_folder(spark, "lake"), _event_stream(spark, sf)
    arrivals = events.select("event_type", F.unix_timestamp("ts").alias("arrived"))
    streaming.run_arrivals(arrivals, "event_type", "arrived", root, shared_folder(spark, "checkpoint")).awaitTermination()
    newest = streaming.jobs.newest_arrivals(spark, root)
    start = newest.agg(F.max("newest")).first()[0]
    feeds = B.load(spark, sf, "events").select(F.col("event_type").alias("feed")).distinct()
    watch_checkpoint = shared_folder(spark, "checkpoint")
    for _ in range(FRESH_RUNS):
        ticks = streaming.heartbeat(spark, FRESH_EVERY_SECONDS, start)
        streaming.run_watch(ticks, feeds, "events", FRESH_MAX_AGE_SECONDS, root, watch_checkpoint).awaitTermination()
    noted = spark.read.parquet(f"{root}/ops/freshness")
    return noted.select("batch_id", "feed", "tick", "newest", "age_seconds", "passed")
