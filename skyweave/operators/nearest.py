"""Nearest site within a radius, as an equi join on grid cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions.geo import cell_col, cell_degrees, cell_row, cells_within, great_circle_nm
from skyweave.operators.joins import salted_join

NEAR_PART = 4
NOWHERE = -(1 << 31)


def nearest_within(
    points: DataFrame,
    keys: Sequence[str],
    sites: DataFrame,
    radius_nm: float,
    ident: str = "ident",
) -> DataFrame:
    """Per point the closest site at most ``radius_nm`` away: ``keys + (ident, distance_nm)``.

    ``points`` carries ``keys`` (unique), ``latitude`` and ``longitude``; points without a site in
    reach are absent from the result. Equal distances go to the lowest ident. Each point is looked up
    within a part of the radius first, and only where that finds nothing within all of it: whatever
    lies within the part is closer than anything beyond, and among dense sites few pairs are measured.
    """
    # Of several sites on one spot only the lowest ident can win.
    spots = (
        sites.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .groupBy("latitude", "longitude")
        .agg(F.min(ident).alias("ident"))
    )
    placed = points.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        *keys, "latitude", "longitude", F.lit(False).alias("_done")
    )
    near = (
        _in_reach(placed, keys, spots, radius_nm / NEAR_PART)
        .groupBy(*keys, "latitude", "longitude")
        .agg(F.min("_found").alias("_near"))
        .withColumn("_done", F.col("_near").isNotNull())
    )
    return (
        _in_reach(near, keys, spots, radius_nm)
        .where(F.col("_done") | F.col("_found").isNotNull())
        .groupBy(*keys)
        .agg(F.min(F.coalesce("_near", "_found")).alias("best"))
        .select(*keys, "best.ident", "best.distance_nm")
    )


def _in_reach(points: DataFrame, keys: Sequence[str], spots: DataFrame, radius_nm: float) -> DataFrame:
    """Every point with each site of the cell it lies in: ``_found`` holds ``(distance_nm, ident)`` within
    ``radius_nm``, else null. Points that are ``_done`` or have no site in their cell come once.

    Each site is listed in the cells its disc touches and each point in its own cell only, so the large
    side never grows. Points of a crowded cell are salted, and their candidates collapse to one row per
    point before the next shuffle.
    """
    pitch = cell_degrees(radius_nm)
    listed = spots.select(
        "ident",
        F.col("latitude").alias("_site_lat"),
        F.col("longitude").alias("_site_lon"),
        F.explode(cells_within(F.col("latitude"), F.col("longitude"), radius_nm, pitch)).alias("_cell"),
    ).select("ident", "_site_lat", "_site_lon", F.col("_cell.row").alias("_row"), F.col("_cell.col").alias("_col"))
    # Points that are done meet no site; cells that do not exist spread them over all tasks.
    elsewhere = F.pmod(F.xxhash64(*keys), F.lit(1 << 30)).cast("int")
    placed = points.withColumns({
        "_row": F.when(F.col("_done"), F.lit(NOWHERE)).otherwise(cell_row(F.col("latitude"), pitch)),
        "_col": F.when(F.col("_done"), elsewhere).otherwise(cell_col(F.col("longitude"), pitch)),
    })
    distance = great_circle_nm(F.col("latitude"), F.col("longitude"), F.col("_site_lat"), F.col("_site_lon"))
    return (
        salted_join(placed, listed, on=["_row", "_col"], salt_by=keys, how="left")
        .withColumn("distance_nm", distance)
        .withColumn("_found", F.when(F.col("distance_nm") <= radius_nm, F.struct("distance_nm", "ident")))
        .drop("_row", "_col", "_site_lat", "_site_lon", "ident", "distance_nm")
    )
