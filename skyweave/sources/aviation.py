"""Surveillance and aerodrome weather feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions import normalise as N
from skyweave.sources.pages import ORIGIN, exploded, nested


def parse_positions(pages: DataFrame) -> DataFrame:
    """Position fixes, one per aircraft of a sweep; entries without a hex are skipped."""
    rows = exploded(
        pages,
        "now variant, _feed string, _hub string, ac array<variant>",
        "ac",
        now=F.try_variant_get("p.now", "$", "double"),
        feed=F.coalesce("p._feed", F.lit("unknown")),
        hub=F.col("p._hub"),
    )
    a = F.col("item")
    alt, squawk = N.part(a, "alt_baro"), N.field(a, "squawk")
    flag = F.when(N.kind(N.part(a, "emergency")) == "STRING", N.field(a, "emergency"))
    return rows.where(N.field(a, "hex") != "").select(
        *ORIGIN,
        F.lower(F.trim(N.field(a, "hex"))).alias("hex"),
        N.millis_to_seconds(F.coalesce("now", F.lit(0.0))).alias("snapshot_time"),
        "hub",
        F.col("feed").alias("source"),
        N.padded_text(a, "flight").alias("callsign"),
        N.padded_text(a, "r").alias("registration"),
        N.padded_text(a, "t").alias("aircraft_type"),
        N.field(a, "category").alias("category"),
        N.real(a, "lat").alias("latitude"),
        N.real(a, "lon").alias("longitude"),
        N.altitude(alt).alias("alt_baro"),
        N.whole(a, "alt_geom").alias("alt_geom"),
        N.is_ground(alt).alias("on_ground"),
        N.real(a, "gs").alias("ground_speed"),
        N.real(a, "track").alias("track"),
        N.whole(a, "baro_rate").alias("baro_rate"),
        N.whole(a, "geom_rate").alias("geom_rate"),
        squawk.alias("squawk"),
        N.emergency_state(flag, squawk).alias("emergency"),
        N.whole(a, "nav_altitude_mcp").alias("nav_altitude_mcp"),
        N.real(a, "nav_qnh").alias("nav_qnh"),
        N.real(a, "dst").alias("distance_nm"),
        N.real(a, "dir").alias("bearing_deg"),
        N.real(a, "rssi").alias("rssi"),
        N.whole(a, "messages").alias("messages"),
        N.real(a, "seen_pos").alias("seen_pos"),
        N.truthy(N.part(a, "mlat")).alias("mlat"),
    )


# Order of the positional state array (fixed values).
STATE_FIELDS = [
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude",
    "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate", "sensors", "geo_altitude",
    "squawk", "spi", "position_source",
]
# Which of them are numbers.
STATE_TYPES = {
    "time_position": "bigint", "last_contact": "bigint", "longitude": "double", "latitude": "double",
    "baro_altitude": "double", "velocity": "double", "true_track": "double", "vertical_rate": "double",
    "geo_altitude": "double", "position_source": "int",
}


def parse_states(pages: DataFrame) -> DataFrame:
    """State vectors: positional arrays, possibly shorter than the full list of fields."""
    rows = exploded(
        pages,
        "time bigint, _authenticated variant, states array<array<variant>>",
        "states",
        snapshot_time=F.col("p.time"),
        authenticated=N.truthy(F.col("p._authenticated")),
    )

    def at(name: str):
        return F.get("item", F.lit(STATE_FIELDS.index(name)))

    def column(name: str):
        if name == "callsign":
            return N.blank_to_null(F.trim(F.try_variant_get(at(name), "$", "string")))
        if name in ("on_ground", "spi"):
            return N.truthy_or_null(at(name))
        return F.try_variant_get(at(name), "$", STATE_TYPES.get(name, "string"))

    return rows.select(
        *ORIGIN,
        *[column(name).alias(name) for name in STATE_FIELDS if name != "sensors"],
        "snapshot_time",
        "authenticated",
        F.when(
            N.kind(at("sensors")).startswith("ARRAY"), F.size(F.try_variant_get(at("sensors"), "$", "array<variant>"))
        ).alias("sensor_count"),
    )


def parse_metar(pages: DataFrame) -> DataFrame:
    o = F.col("item")
    return exploded(pages, "observations array<variant>", "observations").select(
        *ORIGIN,
        N.field(o, "icaoId").alias("station"),
        N.field(o, "obsTime", as_type="bigint").alias("obs_time"),
        N.field(o, "reportTime").alias("report_time"),
        N.field(o, "name").alias("name"),
        N.real(o, "lat").alias("latitude"),
        N.real(o, "lon").alias("longitude"),
        N.whole(o, "elev").alias("elevation_m"),
        N.field(o, "fltCat").alias("flight_category"),
        N.real(o, "temp").alias("temp_c"),
        N.real(o, "dewp").alias("dewpoint_c"),
        N.integer_only(N.part(o, "wdir")).alias("wind_dir_deg"),
        N.whole(o, "wspd").alias("wind_speed_kt"),
        N.whole(o, "wgst").alias("wind_gust_kt"),
        N.visibility(N.part(o, "visib")).alias("visibility_sm"),
        N.ceiling(N.field(o, "clouds", as_type="array<variant>")).alias("ceiling_ft"),
        N.real(o, "altim").alias("altimeter_hpa"),
        N.real(o, "slp").alias("sea_level_pressure"),
        N.field(o, "rawOb").alias("raw"),
    )


def parse_taf(pages: DataFrame) -> DataFrame:
    """One row per forecast period; the forecast's own fields repeat on each."""
    f, p = F.col("item"), F.col("period")
    forecasts = exploded(pages, "forecasts array<variant>", "forecasts")
    return nested(forecasts, N.field(f, "fcsts", as_type="array<variant>"), "period").select(
        *ORIGIN,
        N.field(f, "icaoId").alias("station"),
        N.field(f, "issueTime").alias("issue_time"),
        N.field(p, "timeFrom", as_type="bigint").alias("period_from"),
        N.field(p, "timeTo", as_type="bigint").alias("period_to"),
        N.field(f, "validTimeFrom", as_type="bigint").alias("valid_from"),
        N.field(f, "validTimeTo", as_type="bigint").alias("valid_to"),
        N.field(p, "fcstChange").alias("change_indicator"),
        N.whole(p, "probability").alias("probability"),
        N.integer_only(N.part(p, "wdir")).alias("wind_dir_deg"),
        N.whole(p, "wspd").alias("wind_speed_kt"),
        N.whole(p, "wgst").alias("wind_gust_kt"),
        N.whole(p, "wshearHgt").alias("wind_shear_hgt"),
        N.visibility(N.part(p, "visib")).alias("visibility_sm"),
        N.ceiling(N.field(p, "clouds", as_type="array<variant>")).alias("ceiling_ft"),
        N.whole(p, "vertVis").alias("vertical_vis_ft"),
        N.field(p, "wxString").alias("weather"),
        N.field(f, "rawTAF").alias("raw"),
    )
