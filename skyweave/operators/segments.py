"""Cut each aircraft's fixes into segments without walking them one by one.

The rule: fixes of one aircraft, in time order, form a segment until (a) the next fix comes more
than ``gap_seconds`` later, or (b) two ground fixes in a row follow an airborne fix seen since the
segment began. The second of the two ground fixes then opens the next segment.

Rule (b) depends on everything since the last cut, and one aircraft may own a large share of all
rows, so neither a per-aircraft window nor a per-aircraft loop will do. Instead time is divided into
chunks and the work is a two-level scan:

1. Within ``(hex, chunk)`` every cut is decided from local rows, except at most one: the first event
   of a chunk, when it is a ground pair and no airborne fix came before it in the chunk, counts only
   if the aircraft arrives in the chunk "armed" (airborne since its last cut). Rows between candidate
   cuts form a *piece*.
2. One summary row per ``(hex, chunk)`` says what the chunk does to the armed state: sets it, clears
   it, or leaves it. Scanning these few rows per aircraft settles the open cut of every chunk and
   numbers the segments.

A chunk holds at most ``chunk_seconds`` fixes of an aircraft, because the position table is unique
on ``(hex, snapshot_time)``, and an aircraft has one summary row per chunk of its history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyweave.session import stage

DEFAULT_GAP_SECONDS = 15 * 60
DEFAULT_CHUNK_SECONDS = 86_400


def local_pieces(
    fixes: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    tie: Sequence[str] = (),
    locate: bool = False,
) -> DataFrame:
    """Step 1: add ``chunk``, ``piece`` and the working columns ``_n _ground _air _event _maybe``.

    ``tie`` orders fixes of equal time, for inputs that are not unique on ``(hex, snapshot_time)``. With
    ``locate``, ``_from_lat`` and ``_from_lon`` hold the last known place of the aircraft within the
    piece. Everything is computed over one sort, in three window steps that each need the one before.
    """
    t = F.col("snapshot_time")
    by_time = Window.partitionBy("hex", "chunk").orderBy("snapshot_time", *tie)
    earlier = by_time.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n, no = F.col("_n"), F.lit(False)

    rows = (
        fixes.where((F.col("hex") != "") & t.isNotNull())
        .withColumns({
            "chunk": F.floor(t / chunk_seconds).cast("bigint"),
            "_ground": F.coalesce(F.col("on_ground"), no),
        })
        .withColumn("_air", ~F.col("_ground") & (F.coalesce(F.col("alt_baro"), F.lit(0)) > 0))
        .withColumns({
            "_n": F.row_number().over(by_time),
            "_gap": F.coalesce(t - F.lag(t).over(by_time) > gap_seconds, no),
            "_pair": F.coalesce(F.col("_ground") & F.lag("_ground").over(by_time), no),
        })
        .withColumn("_event", F.col("_gap") | F.col("_pair"))
    )
    before = {
        "_last_air": F.max(F.when(F.col("_air"), n)).over(earlier),
        "_last_event": F.max(F.when(F.col("_event"), n)).over(earlier),
    }
    if locate:
        located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        for name, value in {"_from_n": n, "_from_lat": F.col("latitude"), "_from_lon": F.col("longitude")}.items():
            before[name] = F.last(F.when(located, value), ignorenulls=True).over(earlier)
    armed_here = F.col("_last_air").isNotNull() & (F.coalesce(F.col("_last_event"), F.lit(0)) <= F.col("_last_air"))
    undecided = F.col("_last_air").isNull() & F.col("_last_event").isNull()
    pieces = (
        rows.withColumns(before)
        .withColumn("_maybe", F.col("_pair") & ~F.col("_gap") & undecided)
        .withColumn("_cut", F.col("_gap") | (F.col("_pair") & armed_here) | F.col("_maybe"))
        .withColumns({
            "piece": F.sum(F.col("_cut").cast("int")).over(so_far).cast("int"),
            "_start": F.coalesce(F.max(F.when(F.col("_cut"), n)).over(so_far), F.lit(1)),
        })
    )
    if locate:
        within = F.col("_from_n") >= F.col("_start")
        pieces = pieces.withColumns({c: F.when(within, F.col(c)) for c in ("_from_lat", "_from_lon")})
    return pieces.drop("_gap", "_pair", "_last_air", "_last_event", "_cut", "_start", "_from_n")


def piece_facts() -> list:
    """Aggregates over the rows of one piece that step 2 reads."""
    return [
        F.min("snapshot_time").alias("first_t"),
        F.max("snapshot_time").alias("last_t"),
        F.min_by("_ground", "_n").alias("first_ground"),
        F.max_by("_ground", "_n").alias("last_ground"),
        F.max(F.when(F.col("_air"), F.col("_n"))).alias("air_n"),
        F.max(F.when(F.col("_event"), F.col("_n"))).alias("event_n"),
        F.bool_or("_maybe").alias("maybe"),
    ]


def number_segments(pieces: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """Step 2: per ``(hex, chunk)``, the segment number of its first piece and whether its open cut is void.

    ``pieces`` has one row per ``(hex, chunk, piece)`` with the columns of :func:`piece_facts`.
    """
    chunks = pieces.groupBy("hex", "chunk").agg(
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
        F.min_by("first_ground", "piece").alias("first_ground"),
        F.max_by("last_ground", "piece").alias("last_ground"),
        F.max("air_n").alias("air_n"),
        F.max("event_n").alias("event_n"),
        F.bool_or("maybe").alias("maybe"),
        F.max("piece").alias("cuts"),
    )
    by_chunk = Window.partitionBy("hex").orderBy("chunk")
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    no = F.lit(False)
    return (
        chunks.withColumn(
            "gap0", F.coalesce(F.col("first_t") - F.lag("last_t").over(by_chunk) > gap_seconds, no)
        )
        .withColumn("pair0", F.coalesce(F.col("first_ground") & F.lag("last_ground").over(by_chunk), no))
        .withColumn(
            "leaves_armed",
            F.when(F.col("air_n").isNotNull(), F.coalesce(F.col("event_n"), F.lit(0)) <= F.col("air_n")).when(
                F.col("event_n").isNotNull() | F.col("gap0") | F.col("pair0"), no
            ),
        )
        .withColumn("armed", F.coalesce(F.last("leaves_armed", ignorenulls=True).over(earlier), no))
        .withColumn("cut0", (F.col("gap0") | (F.col("pair0") & F.col("armed"))).cast("int"))
        .withColumn("void_cut", F.col("maybe") & ~(F.col("armed") & ~F.col("gap0") & ~F.col("pair0")))
        .withColumn("cuts", F.col("cuts") - F.col("void_cut").cast("int") + F.col("cut0"))
        .select(
            "hex",
            "chunk",
            (F.coalesce(F.sum("cuts").over(earlier), F.lit(0)) + F.col("cut0")).alias("base"),
            "void_cut",
        )
    )


def numbered_pieces(pieces: DataFrame, gap_seconds: int = DEFAULT_GAP_SECONDS) -> DataFrame:
    """Add ``seg`` to pieces, with the same numbers as :func:`number_segments` and :func:`with_segment`, and
    the working columns ``_n`` (order within the aircraft) and ``_start`` (``_n`` of the segment's first piece).

    Pieces are few, so they are scanned themselves, in one shuffle and without a join: every piece sets the
    armed state, clears it or leaves it, and opens a segment unless its cut is open and finds it unarmed.
    """
    in_order = Window.partitionBy("hex").orderBy("chunk", "piece")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    no, opens = F.lit(False), ~F.lag("chunk").over(in_order).eqNullSafe(F.col("chunk"))
    gap0 = opens & (F.col("first_t") - F.lag("last_t").over(in_order) > gap_seconds)
    pair0 = opens & F.col("first_ground") & F.lag("last_ground").over(in_order)
    leaves = F.when(F.col("air_n").isNotNull(), F.coalesce(F.col("event_n"), F.lit(0)) <= F.col("air_n")).when(
        F.col("event_n").isNotNull() | F.col("_gap0") | F.col("_pair0"), no
    )
    cut = F.when(F.col("_opens"), F.col("_gap0") | (F.col("_pair0") & F.col("_armed"))).otherwise(
        ~F.col("maybe") | F.col("_armed")
    )
    return (
        pieces.withColumns({
            "_n": F.row_number().over(in_order),
            "_opens": opens,
            "_gap0": F.coalesce(gap0, no),
            "_pair0": F.coalesce(pair0, no),
        })
        .withColumn("_leaves", leaves)
        .withColumn("_armed", F.coalesce(F.last("_leaves", ignorenulls=True).over(earlier), no))
        .withColumn("_cut", cut)
        .withColumns({
            "seg": F.sum(F.col("_cut").cast("int")).over(so_far),
            "_start": F.coalesce(F.max(F.when(F.col("_cut"), F.col("_n"))).over(so_far), F.lit(1)),
        })
        .drop("_opens", "_gap0", "_pair0", "_leaves", "_armed", "_cut")
    )


def with_segment(rows: DataFrame, numbering: DataFrame) -> DataFrame:
    """Add ``seg`` (0 for an aircraft's first segment) to rows carrying ``hex, chunk, piece``."""
    voided = (F.col("void_cut") & (F.col("piece") > 0)).cast("int")
    return (
        rows.join(numbering, ["hex", "chunk"])
        .withColumn("seg", (F.col("base") + F.col("piece") - voided).cast("bigint"))
        .drop("base", "void_cut")
    )


def segment_fixes(
    fixes: DataFrame,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Every usable fix with its segment number ``seg``.

    The windows run once: their result is written to the shared folder and read again, first for the few
    columns that number the segments, then with them.
    """
    local = stage(fixes.sparkSession, local_pieces(fixes, gap_seconds, chunk_seconds, tie))
    facts = local.groupBy("hex", "chunk", "piece").agg(*piece_facts())
    numbered = with_segment(local, number_segments(facts, gap_seconds))
    return numbered.select(*fixes.columns, "seg")
