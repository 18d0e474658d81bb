"""Launches, orbital elements and space weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions import normalise as N
from skyweave.sources.pages import ORIGIN, exploded, nested


def parse_launches(pages: DataFrame) -> DataFrame:
    """Launch windows; many fields arrive either as text or as an object with a name."""
    i = F.col("item")
    named = lambda key, inner="name": N.text_or_object(N.part(i, key), inner)
    configuration = N.part(i, "rocket", "configuration")
    vehicle = F.when(N.truthy(configuration), N.text_or_object(configuration)).otherwise(
        F.when(N.truthy(N.part(i, "rocket")), named("rocket"))
    )
    return (
        exploded(pages, "results array<variant>", "results")
        .where(N.field(i, "id").isNotNull())
        .select(
            *ORIGIN,
            N.field(i, "id").alias("launch_id"),
            N.field(i, "net").alias("net"),
            named("status").alias("status"),
            named("status", "abbrev").alias("status_abbrev"),
            N.field(i, "last_updated").alias("observed_at"),
            N.field(i, "name").alias("name"),
            N.field(i, "slug").alias("slug"),
            named("launch_service_provider").alias("provider"),
            named("mission").alias("mission"),
            named("mission", "type").alias("mission_type"),
            N.text_or_object(N.part(i, "mission", "orbit")).alias("orbit"),
            vehicle.alias("vehicle"),
            N.joined_names(N.field(i, "program", as_type="array<variant>")).alias("program"),
            N.field(i, "window_start").alias("window_start"),
            N.field(i, "window_end").alias("window_end"),
            named("net_precision").alias("net_precision"),
            N.whole(i, "probability").alias("probability"),
            N.field(i, "weather_concerns").alias("weather_concerns"),
            N.blank_to_null(N.field(i, "holdreason")).alias("hold_reason"),
            N.blank_to_null(N.field(i, "failreason")).alias("fail_reason"),
            N.field(i, "pad", "name").alias("pad_name"),
            N.real(i, "pad", "latitude").alias("pad_latitude"),
            N.real(i, "pad", "longitude").alias("pad_longitude"),
            N.field(i, "pad", "location", "name").alias("pad_location"),
            N.field(i, "pad", "country_code").alias("country_code"),
            N.field(i, "pad_turnaround").alias("pad_turnaround"),
            N.whole(i, "orbital_launch_attempt_count_year").alias("orbital_attempt_count_year"),
            N.truthy(N.part(i, "webcast_live")).alias("webcast_live"),
        )
    )


def parse_launch_updates(pages: DataFrame) -> DataFrame:
    """The notes attached to launches, one row each."""
    i, u = F.col("item"), F.col("note")
    launches = exploded(pages, "results array<variant>", "results").where(N.field(i, "id").isNotNull())
    return nested(launches, N.field(i, "updates", as_type="array<variant>"), "note").select(
        *ORIGIN,
        N.composed_id(N.field(i, "id"), N.field(u, "id")).alias("update_id"),
        N.field(i, "id").alias("launch_id"),
        N.field(u, "created_on").alias("created_on"),
        N.field(u, "comment").alias("comment"),
        N.field(u, "info_url").alias("info_url"),
        N.field(u, "created_by").alias("created_by"),
    )


def parse_orbital(pages: DataFrame, group: str = "last-30-days") -> DataFrame:
    o = F.col("item")
    object_id = N.field(o, "OBJECT_ID")
    return exploded(
        pages, "_group string, objects array<variant>", "objects", in_group=F.coalesce("p._group", F.lit(group))
    ).select(
        *ORIGIN,
        N.whole(o, "NORAD_CAT_ID").alias("norad_cat_id"),
        N.field(o, "EPOCH").alias("epoch"),
        N.field(o, "OBJECT_NAME").alias("object_name"),
        object_id.alias("object_id"),
        N.launch_designator(object_id).alias("launch_designator"),
        N.launch_year(object_id).alias("launch_year"),
        N.real(o, "MEAN_MOTION").alias("mean_motion"),
        N.real(o, "ECCENTRICITY").alias("eccentricity"),
        N.real(o, "INCLINATION").alias("inclination"),
        N.real(o, "RA_OF_ASC_NODE").alias("ra_of_asc_node"),
        N.real(o, "ARG_OF_PERICENTER").alias("arg_of_pericenter"),
        N.real(o, "MEAN_ANOMALY").alias("mean_anomaly"),
        N.real(o, "BSTAR").alias("bstar"),
        N.real(o, "MEAN_MOTION_DOT").alias("mean_motion_dot"),
        N.whole(o, "REV_AT_EPOCH").alias("rev_at_epoch"),
        N.orbital_period(N.real(o, "MEAN_MOTION")).alias("period_minutes"),
        F.col("in_group").alias("group"),
    )


def parse_kp(pages: DataFrame) -> DataFrame:
    k = F.col("item")
    return exploded(pages, "kp array<variant>", "kp").select(
        *ORIGIN,
        N.iso_to_epoch(N.field(k, "time_tag")).alias("observed_at"),
        N.field(k, "time_tag").alias("time_tag"),
        N.whole(k, "kp_index").alias("kp_index"),
        N.real(k, "estimated_kp").alias("estimated_kp"),
        N.field(k, "kp").alias("kp_label"),
        N.is_storm(N.real(k, "estimated_kp")).alias("storm"),
        F.lit("noaa_swpc").alias("source"),
    )
