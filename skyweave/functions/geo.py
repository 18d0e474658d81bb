"""Geometry on the sphere as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyweave.functions.normalise import real

EARTH_RADIUS_NM = 3440.065  # fixed value


def great_circle_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in nautical miles; null if any coordinate is null."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2)
    # Rounding can lift `a` a hair above one for antipodes, where asin would give NaN.
    bounded = F.when(a > 1.0, F.lit(1.0)).otherwise(a)
    return F.asin(F.sqrt(bounded)) * (2 * EARTH_RADIUS_NM)


def wrapped_lon(lon: Column) -> Column:
    """Any longitude brought into [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def polygon_box(coords: Column) -> Column:
    """Bounding box of a polygon (an array of ``{lat, lon}`` variants) as one struct.

    Some oceanic regions report longitudes beyond 180, and some polygons straddle the antimeridian.
    Both set ``crosses_antimeridian``; the box then runs east from ``min_lon`` through 180 to
    ``max_lon``, and a reader tests ``lon >= min_lon OR lon <= max_lon``.
    """
    lats = F.filter(F.transform(coords, lambda c: real(c, "lat")), lambda x: x.isNotNull())
    raw = F.filter(F.transform(coords, lambda c: real(c, "lon")), lambda x: x.isNotNull())
    lons = F.transform(raw, wrapped_lon)
    usable = (F.size(lats) > 0) & (F.size(raw) > 0)
    low, high = F.array_min(lons), F.array_max(lons)
    crosses = F.coalesce(
        usable & ((F.array_max(raw) > 180) | (F.array_min(raw) < -180) | (high - low > 180)), F.lit(False)
    )
    eastern = F.array_min(F.filter(lons, lambda x: x >= 0))
    western = F.array_max(F.filter(lons, lambda x: x < 0))
    return F.struct(
        F.when(usable, F.array_min(lats)).alias("min_lat"),
        F.when(usable, F.array_max(lats)).alias("max_lat"),
        F.when(usable, F.when(crosses, F.coalesce(eastern, low)).otherwise(low)).alias("min_lon"),
        F.when(usable, F.when(crosses, F.coalesce(western, high)).otherwise(high)).alias("max_lon"),
        crosses.alias("crosses_antimeridian"),
    )


def cell_degrees(radius_nm: float) -> float:
    """Grid pitch for a search radius: about two radii of latitude, dividing 360 exactly."""
    wanted = max(2 * math.degrees(radius_nm / EARTH_RADIUS_NM), 1e-3)
    return 360.0 / max(1, math.floor(360.0 / wanted))


def cell_row(lat: Column, pitch: float) -> Column:
    return F.floor((lat + 90.0) / pitch).cast("int")


def cell_col(lon: Column, pitch: float) -> Column:
    columns = round(360.0 / pitch)
    return F.pmod(F.floor((lon + 180.0) / pitch), F.lit(columns)).cast("int")


def cells_within(lat: Column, lon: Column, radius_nm: float, pitch: float) -> Column:
    """All grid cells that a disc around a point can touch, as an array of ``{row, col}``."""
    r = radius_nm / EARTH_RADIUS_NM
    # A hair wider than the radius, so a point exactly on it is not lost to rounding.
    half_lat = math.degrees(r) * (1 + 1e-9) + 1e-9
    columns = round(360.0 / pitch)
    reaches_pole = F.abs(lat) + half_lat >= 90.0
    ratio = F.lit(math.sin(min(r, math.pi / 2))) / F.cos(F.radians(lat))
    half_lon = F.degrees(F.asin(F.when(ratio > 1.0, F.lit(1.0)).otherwise(ratio))) * (1 + 1e-9) + 1e-9
    first_row = F.floor((F.greatest(lat - half_lat, F.lit(-90.0)) + 90.0) / pitch)
    last_row = F.floor((F.least(lat + half_lat, F.lit(90.0)) + 90.0) / pitch)
    first_col = F.floor((lon - half_lon + 180.0) / pitch)
    last_col = F.floor((lon + half_lon + 180.0) / pitch)
    whole_turn = reaches_pole | (last_col - first_col + 1 >= columns)
    cols = F.when(whole_turn, F.sequence(F.lit(0), F.lit(columns - 1))).otherwise(
        F.transform(
            F.sequence(first_col, last_col), lambda c: F.pmod(c, F.lit(columns)).cast("int")
        )
    )
    rows = F.sequence(first_row.cast("int"), last_row.cast("int"))
    return F.flatten(F.transform(rows, lambda i: F.transform(cols, lambda j: F.struct(i.alias("row"), j.alias("col")))))
