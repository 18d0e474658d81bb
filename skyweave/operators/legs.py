"""Flight legs from position fixes.

Fixes are reduced to one row per piece (see :mod:`skyweave.operators.segments`) in the stage that
reads them; everything after works on pieces, a few per aircraft and day. Pieces are also what the
streaming job stores, so legs can be refreshed without reading old fixes again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions.geo import great_circle_nm
from skyweave.functions.normalise import blank_to_null, rounded
from skyweave.operators.nearest import nearest_within
from skyweave.operators.segments import (
    DEFAULT_CHUNK_SECONDS,
    DEFAULT_GAP_SECONDS,
    local_pieces,
    numbered_pieces,
    piece_facts,
)
from skyweave.session import stage

DEFAULT_RADIUS_NM = 3.0
MIN_LEG_SECONDS = 5 * 60

LEG_COLUMNS = [
    "leg_id", "hex", "callsign", "registration", "aircraft_type", "hub", "start_time", "end_time",
    "duration_s", "dep_airport", "arr_airport", "dep_observed", "arr_observed", "complete", "fix_count",
    "max_alt_ft", "max_ground_speed_kt", "track_distance_nm", "direct_distance_nm", "track_efficiency",
    "emergency",
]
FIRST_SEEN_TEXT = ["callsign", "registration", "aircraft_type", "emergency"]
FIX_COLUMNS = [
    "hex", "snapshot_time", "hub", "callsign", "registration", "aircraft_type", "latitude", "longitude",
    "alt_baro", "on_ground", "ground_speed", "emergency",
]


def leg_pieces(
    positions: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    tie: Sequence[str] = (),
) -> DataFrame:
    """One row per ``(hex, chunk, piece)`` with all that legs need; a chunk depends on its own fixes only."""
    fixes = positions.select(*FIX_COLUMNS, *[c for c in tie if c not in FIX_COLUMNS])
    here, there = [F.col("_from_lat"), F.col("_from_lon")], [F.col("latitude"), F.col("longitude")]
    local = local_pieces(fixes, gap_seconds, chunk_seconds, tie, locate=True).withColumn(
        "_step", great_circle_nm(*here, *there)
    )
    first_text = [
        F.min_by(c, F.when(blank_to_null(F.col(c)).isNotNull(), F.col("_n"))).alias(c) for c in FIRST_SEEN_TEXT
    ]
    n = F.col("_n")
    located = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), n)
    place = F.struct("latitude", "longitude")
    ends = {
        "first": F.min_by(F.struct("latitude", "longitude", "hub"), n), "last": F.max_by(place, n),
        "from": F.min_by(place, located), "to": F.max_by(place, located),
    }
    places = [F.col(f"_{end}.{c}").alias(f"{end}_{c}") for c in ("latitude", "longitude") for end in ends]
    pieces = local.groupBy("hex", "chunk", "piece").agg(
        *piece_facts(),
        *first_text,
        *[end.alias(f"_{name}") for name, end in ends.items()],
        F.bool_or(~F.col("_ground")).alias("airborne"),
        F.count(F.lit(1)).alias("fix_count"),
        F.max("alt_baro").alias("max_alt_ft"),
        F.max("ground_speed").alias("max_ground_speed_kt"),
        F.coalesce(F.sum("_step"), F.lit(0.0)).alias("flown"),
    )
    return pieces.select("*", F.col("_first.hub").alias("hub"), *places).drop(*[f"_{end}" for end in ends])


def segments_from_pieces(pieces: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """Merge pieces into whole segments: one row per ``(hex, seg)``, unrounded, nothing filtered."""
    numbered = numbered_pieces(pieces, gap_seconds)
    in_order = Window.partitionBy("hex").orderBy("chunk", "piece")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    n, located = F.col("_n"), F.col("to_latitude").isNotNull()
    reached = {
        f"_{c}": F.last(F.when(located, F.col(c)), ignorenulls=True).over(earlier)
        for c in ("_n", "to_latitude", "to_longitude")
    }
    bridge = great_circle_nm(F.col("_to_latitude"), F.col("_to_longitude"), F.col("from_latitude"), F.col("from_longitude"))
    bridged = numbered.withColumns(reached).withColumn("bridge", F.when(F.col("__n") >= F.col("_start"), bridge))
    first_text = [F.min_by(c, F.when(F.col(c).isNotNull(), n)).alias(c) for c in FIRST_SEEN_TEXT]
    first = F.struct("hub", "first_ground", F.struct(F.col("first_latitude").alias("latitude"), F.col("first_longitude").alias("longitude")).alias("fix"))
    last = F.struct("last_ground", F.struct(F.col("last_latitude").alias("latitude"), F.col("last_longitude").alias("longitude")).alias("fix"))
    merged = bridged.groupBy("hex", "seg").agg(
        *first_text,
        F.min_by(first, n).alias("_first"),
        F.max_by(last, n).alias("_last"),
        F.min("first_t").alias("start_time"),
        F.max("last_t").alias("end_time"),
        F.bool_or("airborne").alias("airborne"),
        F.sum("fix_count").alias("fix_count"),
        F.max("max_alt_ft").alias("max_alt_ft"),
        F.max("max_ground_speed_kt").alias("max_ground_speed_kt"),
        F.sum(F.col("flown") + F.coalesce(F.col("bridge"), F.lit(0.0))).alias("flown"),
    )
    return merged.withColumns({
        "hub": F.col("_first.hub"),
        "dep_observed": F.col("_first.first_ground"),
        "arr_observed": F.col("_last.last_ground"),
        "first_fix": F.col("_first.fix"),
        "last_fix": F.col("_last.fix"),
    }).drop("_first", "_last")


def unnamed_legs(
    pieces: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS, min_leg_seconds: int = MIN_LEG_SECONDS
) -> DataFrame:
    """Legs without airports, from stored pieces covering each aircraft's whole history.

    ``first_fix`` and ``last_fix`` are carried for :func:`name_airports`.
    """
    first, last = F.col("first_fix"), F.col("last_fix")
    direct = great_circle_nm(first["latitude"], first["longitude"], last["latitude"], last["longitude"])
    kept = [c for c in LEG_COLUMNS if c not in ("dep_airport", "arr_airport")]
    return (
        segments_from_pieces(pieces, gap_seconds)
        .withColumn("duration_s", F.col("end_time") - F.col("start_time"))
        .where(F.col("airborne") & (F.col("duration_s") >= min_leg_seconds))
        .withColumn("leg_id", F.concat_ws("-", "hex", "start_time"))
        .withColumn("complete", F.col("dep_observed") & F.col("arr_observed"))
        .withColumn("direct", direct)
        .withColumn("track_distance_nm", rounded(F.col("flown"), 2))
        .withColumn("direct_distance_nm", rounded(F.col("direct"), 2))
        .withColumn("track_efficiency", F.when(F.col("direct") > 1, rounded(F.col("flown") / F.col("direct"), 3)))
        .select(*kept, "first_fix", "last_fix")
    )


def name_airports(legs: DataFrame, airports: DataFrame | None, radius_nm: float = DEFAULT_RADIUS_NM) -> DataFrame:
    """Name an airport only for an end that was seen on the ground within reach of one.

    ``legs`` (of :func:`unnamed_legs`) is read twice, so it should be staged.
    """
    if airports is None:
        nowhere = F.lit(None).cast("string")
        return legs.withColumn("dep_airport", nowhere).withColumn("arr_airport", nowhere).select(*LEG_COLUMNS)
    ends = legs.select(
        "leg_id",
        F.explode(
            F.array(
                F.struct(F.lit("dep").alias("which"), F.col("dep_observed").alias("seen"), F.col("first_fix").alias("at")),
                F.struct(F.lit("arr").alias("which"), F.col("arr_observed").alias("seen"), F.col("last_fix").alias("at")),
            )
        ).alias("end"),
    ).where("end.seen").select("leg_id", "end.which", "end.at.latitude", "end.at.longitude")
    named = (
        nearest_within(ends, ["leg_id", "which"], airports, radius_nm)
        .groupBy("leg_id")
        .agg(
            F.max(F.when(F.col("which") == "dep", F.col("ident"))).alias("dep_airport"),
            F.max(F.when(F.col("which") == "arr", F.col("ident"))).alias("arr_airport"),
        )
    )
    return legs.join(named, "leg_id", "left").select(*LEG_COLUMNS)


def flight_legs(
    positions: DataFrame,
    airports: DataFrame | None = None,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    airport_radius_nm: float = DEFAULT_RADIUS_NM,
    min_leg_seconds: int = MIN_LEG_SECONDS,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Legs of every aircraft in ``positions`` (unique on ``(hex, snapshot_time)``, or ordered by ``tie``).

    Fixes are read and shuffled once: the pieces, a small fraction of them, are staged when this is
    called, and numbering and merging read the staged pieces. So are the legs before the airport lookup.
    """
    spark = positions.sparkSession
    pieces = stage(spark, leg_pieces(positions, gap_seconds, chunk_seconds, tie))
    legs = unnamed_legs(pieces, gap_seconds, min_leg_seconds)
    return name_airports(stage(spark, legs) if airports is not None else legs, airports, airport_radius_nm)


def track_distance(
    positions: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Distance flown per segment, fix to fix; fixes without coordinates are bridged over."""
    pieces = stage(positions.sparkSession, leg_pieces(positions, gap_seconds, chunk_seconds, tie))
    whole = segments_from_pieces(pieces, gap_seconds)
    return whole.select("hex", "seg", "fix_count", rounded(F.col("flown"), 2).alias("track_distance_nm"))
