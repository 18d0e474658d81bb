"""Hazard advisories, notices and fuel prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions import normalise as N
from skyweave.functions.geo import polygon_box
from skyweave.sources.pages import ORIGIN, exploded


def _hazards(pages: DataFrame, items: str) -> DataFrame:
    h = F.col("item")
    return exploded(pages, f"{items} array<variant>", items).withColumn(
        "box", polygon_box(N.field(h, "coords", as_type="array<variant>"))
    )


def parse_sigmet(pages: DataFrame) -> DataFrame:
    """International advisories; no id is published, so one is composed of region, series, start and kind."""
    h = F.col("item")
    hazard = N.field(h, "hazard")
    return _hazards(pages, "sigmets").select(
        *ORIGIN,
        N.composed_id(N.field(h, "firId"), N.field(h, "seriesId"), N.field(h, "validTimeFrom"), hazard).alias("hazard_id"),
        F.lit("SIGMET").alias("kind"),
        N.field(h, "firId").alias("fir_id"),
        N.field(h, "firName").alias("fir_name"),
        N.field(h, "icaoId").alias("icao_id"),
        N.field(h, "seriesId").alias("series"),
        hazard.alias("hazard"),
        N.hazard_name(hazard).alias("hazard_name"),
        N.field(h, "qualifier").alias("qualifier"),
        N.field(h, "validTimeFrom").alias("valid_from"),
        N.field(h, "validTimeTo").alias("valid_to"),
        N.field(h, "base").alias("altitude_base_ft"),
        N.field(h, "top").alias("altitude_top_ft"),
        N.field(h, "dir").alias("movement_dir"),
        N.field(h, "spd").alias("movement_speed_kt"),
        N.field(h, "chng").alias("change"),
        N.field(h, "rawSigmet").alias("raw"),
        "box.*",
    )


def parse_gairmet(pages: DataFrame) -> DataFrame:
    """US graphical advisories, for the same table with another set of columns."""
    h = F.col("item")
    hazard = N.field(h, "hazard")
    return _hazards(pages, "gairmets").select(
        *ORIGIN,
        N.composed_id(
            F.lit("gairmet"), N.field(h, "productId"), N.field(h, "validTime"), hazard, N.field(h, "id")
        ).alias("hazard_id"),
        F.lit("GAIRMET").alias("kind"),
        hazard.alias("hazard"),
        N.hazard_name(hazard).alias("hazard_name"),
        N.field(h, "validTime").alias("valid_from"),
        N.field(h, "expireTime").alias("valid_to"),
        N.field(h, "issueTime").alias("issue_time"),
        N.field(h, "base").alias("altitude_base_ft"),
        N.field(h, "top").alias("altitude_top_ft"),
        N.field(h, "severity").alias("severity"),
        N.field(h, "frequency").alias("frequency"),
        "box.*",
    )


NOTAM_FIELDS = (
    "id", "number", "location", "icaoLocation", "type", "classification", "effectiveStart", "effectiveEnd", "issued",
    "affectedFIR", "selectionCode", "minimumFL", "maximumFL", "text",
)


def parse_notam(pages: DataFrame) -> DataFrame:
    """Notices; the number stands in for a missing id, and a notice with neither is skipped."""
    i = F.col("item")
    core = lambda key: N.field(i, "properties", "coreNOTAMData", "notam", key)
    # the notice is read out of its item as one struct: a path walked once, not once a column
    read = N.field(i, "properties", "coreNOTAMData", "notam", as_type="struct<" + ", ".join(f"{k}: string" for k in NOTAM_FIELDS) + ">")
    got = lambda key: F.col(f"_notam.{key}")
    rows = exploded(pages, "_location string, items array<variant>", "items", asked=F.col("p._location"))
    translations = N.field(i, "properties", "coreNOTAMData", "notamTranslation", as_type="array<variant>")
    return (
        rows.where((core("id") != "") | (core("number") != ""))
        .withColumn("_notam", read)
        .select(
            *ORIGIN,
            F.coalesce(N.blank_to_null(got("id")), N.blank_to_null(got("number"))).alias("notam_id"),
            got("number").alias("number"),
            F.coalesce(N.blank_to_null(got("location")), "asked").alias("location"),
            F.coalesce(N.blank_to_null(got("icaoLocation")), "asked").alias("icao_location"),
            got("type").alias("type"),
            got("classification").alias("classification"),
            got("effectiveStart").alias("effective_start"),
            got("effectiveEnd").alias("effective_end"),
            got("issued").alias("issued"),
            got("affectedFIR").alias("affected_fir"),
            got("selectionCode").alias("selection_code"),
            got("minimumFL").alias("minimum_fl"),
            got("maximumFL").alias("maximum_fl"),
            got("text").alias("text"),
            N.first_translation(translations).alias("formatted_text"),
        )
    )


def parse_fuel(pages: DataFrame, product: str = "EPJK") -> DataFrame:
    """Spot prices from an enveloped response; the area, then the product, names an unnamed series."""
    r = F.col("item")
    filled = lambda key: N.blank_to_null(N.field(r, key))
    return (
        exploded(pages, "response struct<data: array<variant>>", "response.data")
        .where(filled("period").isNotNull())
        .select(
            *ORIGIN,
            N.field(r, "period").alias("period"),
            F.coalesce(filled("series"), filled("duoarea"), F.lit(product)).alias("series"),
            F.coalesce(filled("product"), F.lit(product)).alias("product"),
            N.field(r, "product-name").alias("product_name"),
            F.coalesce(filled("area-name"), N.field(r, "duoarea")).alias("area"),
            N.real(r, "value").alias("price"),
            N.field(r, "units").alias("units"),
        )
    )
