"""Streams over the payload archive and over parsed rows.

Every job writes through ``foreachBatch`` into tables merged by key, so a batch that is repeated
after a failure changes nothing. Jobs run with ``availableNow`` by default: they work off what is
there and stop, which suits a scheduler; pass another trigger to keep one running.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyweave import lake
from skyweave.operators.latest import keep_last
from skyweave.operators.legs import leg_pieces, name_airports, unnamed_legs
from skyweave.operators.segments import DEFAULT_CHUNK_SECONDS, DEFAULT_GAP_SECONDS
from skyweave.plans import operations, quality
from skyweave.session import staged
from skyweave.sources import PARSERS

AVAILABLE_NOW = {"availableNow": True}
ARRIVALS = "arrivals"
ARRIVAL_SCHEMA = "feed string, newest long, rows long, batch_id long"


def bronze_stream(spark: SparkSession, root: str, source: str, files_per_batch: int = 1000) -> DataFrame:
    """New archived payloads of one source as they arrive."""
    pages = (
        spark.readStream.schema(lake.BRONZE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{root}/bronze")
    )
    return pages.where(F.col("source") == source)


def _start(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict[str, Any] | None,
    mode: str = "append",
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def deduplicated(fixes: DataFrame, late: str = "1 hour") -> DataFrame:
    """First fix per ``(hex, snapshot_time)`` within the watermark; state older than it is let go.

    Keeping the last fix instead needs the stored table: see :func:`run_upsert`.
    """
    timed = fixes.withColumn("event_time", F.timestamp_seconds("snapshot_time")).withWatermark("event_time", late)
    return timed.dropDuplicatesWithinWatermark(["hex", "snapshot_time"])


def run_upsert(
    rows: DataFrame, root: str, table: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Merge a stream of parsed rows into a table by key; the last row per key wins."""

    def each(batch: DataFrame, _: int) -> None:
        lake.upsert(batch.sparkSession, root, table, batch)

    return _start(rows, each, checkpoint, trigger)


def run_ingest(
    spark: SparkSession, root: str, source: str, checkpoint: str, files_per_batch: int = 1000,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Parse new archived payloads of a source and merge them into its table."""
    parser = PARSERS[source]
    rows = parser.parse(bronze_stream(spark, root, source, files_per_batch))
    return run_upsert(rows, root, parser.table, checkpoint, trigger)


def density(fixes: DataFrame, late: str = "1 hour") -> DataFrame:
    """Hourly traffic per hub; aircraft are counted approximately, as streams cannot count them exactly."""
    timed = fixes.withColumn("event_time", F.timestamp_seconds("snapshot_time")).withWatermark("event_time", late)
    grouped = timed.groupBy("hub", F.window("event_time", "1 hour"))
    return grouped.agg(
        F.count(F.lit(1)).alias("fixes"),
        F.approx_count_distinct("hex", 0.02).alias("approx_aircraft"),
        F.count_if("on_ground").alias("ground_fixes"),
        F.max("alt_baro").alias("max_alt_ft"),
    ).select("hub", F.unix_timestamp("window.start").alias("hour_start"), "fixes", "approx_aircraft", "ground_fixes", "max_alt_ft")


def run_density(
    fixes: DataFrame, path: str, checkpoint: str, late: str = "1 hour", trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Append each batch's updated hours; :func:`latest_density` reads the current value of every hour."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(path)

    return _start(density(fixes, late), each, checkpoint, trigger, mode="update")


def latest_density(updates: DataFrame) -> DataFrame:
    return keep_last(updates, ["hub", "hour_start"], ["batch_id"]).drop("batch_id")


def run_legs(
    rows: DataFrame,
    airports: DataFrame | None,
    root: str,
    checkpoint: str,
    gap_seconds: int = DEFAULT_GAP_SECONDS,
    airport_radius_nm: float = 3.0,
    min_leg_seconds: int = 300,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Keep positions and legs current, also for late and corrected fixes.

    A batch rereads fixes only for the aircraft-days it touches. Their pieces are replaced, and legs
    are rebuilt from the pieces of the touched aircraft, a few rows per aircraft and day. Of the leg
    table only partitions with changed legs are rewritten.
    """

    def each(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        chunk = F.floor(F.col("snapshot_time") / DEFAULT_CHUNK_SECONDS).cast("bigint")
        with staged(spark, batch) as fresh:
            usable = fresh.where((F.col("hex") != "") & F.col("snapshot_time").isNotNull())
            with staged(spark, usable.select("hex", chunk.alias("chunk")).distinct()) as touched:
                lake.upsert(spark, root, "fct_position", fresh, is_staged=True)
                refresh_pieces(spark, touched, chunk)
                refresh_legs(spark, touched.select("hex").distinct())

    def refresh_pieces(spark: SparkSession, touched: DataFrame, chunk: Column) -> None:
        day = F.date_format(F.timestamp_seconds(F.col("chunk") * DEFAULT_CHUNK_SECONDS), "yyyy-MM-dd").alias("dt")
        stored = lake.read_table(spark, root, "fct_position")
        fixes = lake.in_partitions(stored, touched.select(day).distinct(), ["dt"])
        again = fixes.withColumn("chunk", chunk).join(touched, ["hex", "chunk"], "left_semi").drop("chunk")
        lake.replace_rows(spark, root, "leg_piece", leg_pieces(again, gap_seconds), touched, ["hex", "chunk"])

    def refresh_legs(spark: SparkSession, aircraft: DataFrame) -> None:
        pieces = lake.read_table(spark, root, "leg_piece").join(aircraft, "hex", "left_semi").drop("dt")
        with staged(spark, unnamed_legs(pieces, gap_seconds, min_leg_seconds)) as legs:
            named = name_airports(legs, airports, airport_radius_nm)
            lake.replace_rows(spark, root, "fct_flight_leg", named, aircraft, ["hex"])

    return _start(rows, each, checkpoint, trigger)


def run_freshness(
    rows: DataFrame, table: str, column: str, max_age_seconds: int, root: str, checkpoint: str,
    now: float | None = None, trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Note per batch of rows whether the newest row is recent enough.

    A feed that delivers nothing makes no batch here, so this alone never notes silence; for that, record
    arrivals with :func:`run_arrivals` and let :func:`run_watch` judge them on every tick of :func:`heartbeat`.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        outcome = quality.run_checks(batch, table, [quality.fresh_within(column, max_age_seconds, now)])
        operations.append(outcome.withColumn("batch_id", F.lit(batch_id)), root, "freshness")

    return _start(rows, each, checkpoint, trigger)


def run_arrivals(
    rows: DataFrame, feed: str, column: str, root: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Append, per batch, the newest ``column`` value (epoch seconds) and the row count of each feed to
    ``ops/arrivals``. A batch repeated after a failure appends the same maxima again, which changes no newest."""

    def each(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy(F.col(feed).cast("string").alias("feed")).agg(
            F.max(F.col(column).cast("long")).alias("newest"), F.count(F.lit(1)).alias("rows"),
        )
        operations.append(newest.withColumn("batch_id", F.lit(batch_id).cast("long")), root, ARRIVALS)

    return _start(rows, each, checkpoint, trigger)


def heartbeat(spark: SparkSession, every_seconds: int = 60, start_seconds: int | None = None) -> DataFrame:
    """A stream of one tick a batch, stamped ``start + batch * every`` (start: now), whatever data arrive.

    Time itself makes the batches, so checks that run on ticks also run while every feed is silent; with
    ``availableNow`` each run takes exactly one tick.
    """
    start = int(time.time()) if start_seconds is None else int(start_seconds)
    return (
        spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1)
        .option("startTimestamp", start * 1000).option("advanceMillisPerBatch", every_seconds * 1000).load()
    )


def newest_arrivals(spark: SparkSession, root: str) -> DataFrame:
    """Newest value per feed over all recorded arrivals (no rows before the first)."""
    path = f"{root}/ops/{ARRIVALS}"
    try:
        arrivals = spark.read.schema(ARRIVAL_SCHEMA).parquet(path)
    except Exception:  # nothing recorded yet
        arrivals = spark.createDataFrame([], ARRIVAL_SCHEMA)
    return arrivals.groupBy("feed").agg(F.max("newest").alias("newest"))


def watch(arrivals: DataFrame, feeds: DataFrame, tick: Column, table: str, max_age_seconds: int) -> DataFrame:
    """Freshness of every expected feed at ``tick`` (epoch seconds): one outcome a feed; a feed without any
    arrival fails with ``no timestamps``."""
    known = feeds.select(F.col("feed").cast("string").alias("feed")).distinct().join(arrivals, "feed", "left")
    age = tick - F.col("newest")
    observed = F.when(F.col("newest").isNull(), F.lit("no timestamps")).otherwise(F.format_string("%ds old", age))
    return known.select(
        F.lit(table).alias("table"), F.concat(F.lit("fresh_within["), F.col("feed"), F.lit("]")).alias("check"),
        F.coalesce(age <= max_age_seconds, F.lit(False)).alias("passed"), observed.alias("observed"),
        F.lit(f"<={max_age_seconds}s old").alias("expected"), F.lit("warn").alias("severity"),
        "feed", tick.cast("long").alias("tick"), F.col("newest"), age.cast("long").alias("age_seconds"),
    )


def run_watch(
    ticks: DataFrame, feeds: DataFrame, table: str, max_age_seconds: int, root: str, checkpoint: str,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """On every tick, judge the newest arrival of each expected feed and append the outcomes to ``ops/freshness``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        stamp = batch.agg(F.max(F.col("timestamp").cast("long"))).first()[0]  # one tick a batch
        if stamp is None:
            return
        spark = batch.sparkSession
        outcome = watch(newest_arrivals(spark, root), feeds, F.lit(stamp), table, max_age_seconds)
        operations.append(outcome.withColumn("batch_id", F.lit(batch_id).cast("long")), root, "freshness")

    return _start(ticks, each, checkpoint, trigger)
