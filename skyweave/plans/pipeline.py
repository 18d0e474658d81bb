"""Batch ingest and replay: archived payloads to merged tables, with a run ledger."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave import lake
from skyweave.operators.identity import aircraft_dimension
from skyweave.operators.legs import flight_legs
from skyweave.plans import operations
from skyweave.session import LONG_ROWS, staged
from skyweave.sources import PARSERS


def parse(pages: DataFrame, source: str) -> DataFrame:
    return PARSERS[source].parse(pages)


def ingest(spark: SparkSession, root: str, source: str, payloads: DataFrame, run_id: str, keep_ledger: bool = True) -> None:
    """Archive payloads, parse them, merge the rows, and note the run.

    ``payloads`` has ``page_id, captured_at, payload``. A failed run is noted with its error before
    the error is raised again; what was archived by then stays and can be replayed.
    """
    started = int(time.time())
    table = PARSERS[source].table
    received = payloads.select(F.lit(source).alias("source"), "page_id", "captured_at", "payload")
    with staged(spark, lake.with_hash(received), LONG_ROWS) as pages:
        try:
            lake.archive(pages, root, is_staged=True)
            with staged(spark, parse(pages, source)) as rows:
                lake.upsert(spark, root, table, rows, is_staged=True)
                if keep_ledger:
                    operations.append(operations.load_ledger(pages, rows, source, table, run_id, started), root, "pipeline_run")
                    fed = operations.lineage(rows, table).withColumn("run_id", F.lit(run_id))
                    operations.append(fed, root, "lineage")
        except Exception as err:
            if keep_ledger:
                failed = operations.failed_run(spark, run_id, source, table, started, f"{type(err).__name__}: {err}"[:500])
                operations.append(failed, root, "pipeline_run")
            raise


def replay(spark: SparkSession, root: str, source: str, since: str | None = None, until: str | None = None) -> str:
    """Rebuild a table from the archive; running it again gives the same rows and partitions."""
    table = PARSERS[source].table
    rows = parse(lake.scan_bronze(spark, root, source, since, until), source)
    lake.upsert(spark, root, table, rows)
    return table


def publish_legs(spark: SparkSession, root: str, legs: DataFrame, recomputed: DataFrame) -> None:
    """Replace the legs of every aircraft (``hex``) in ``recomputed``, also of those left without any.

    Each leg is stored in the day it starts.
    """
    lake.replace_rows(spark, root, "fct_flight_leg", legs, recomputed, ["hex"])


def publish_dimension(spark: SparkSession, root: str, versions: DataFrame) -> None:
    """Store all identity versions; the dimension is always replaced as a whole."""
    lake.replace_table(spark, root, "dim_aircraft", versions)


def derive_legs(spark: SparkSession, root: str, **options: float) -> None:
    """Flight legs of all stored positions, with stored airports, to the leg table."""
    positions = lake.read_table(spark, root, "fct_position")
    legs = flight_legs(positions, lake.read_table(spark, root, "dim_airport"), **options)
    publish_legs(spark, root, legs, positions.select("hex").distinct())


def derive_dimension(spark: SparkSession, root: str, since: str | None = None) -> None:
    """Merge stored positions (from the day ``since`` on), with the stored registry, into the dimension."""
    positions = lake.read_table(spark, root, "fct_position")
    if since:
        positions = positions.where(F.col("dt") >= since)
    registry = lake.read_table(spark, root, "dim_aircraft_registry")
    stored = lake.read_table(spark, root, "dim_aircraft")
    publish_dimension(spark, root, aircraft_dimension(positions, stored, registry))
