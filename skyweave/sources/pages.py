"""Turning archived pages into rows: explode the item list, keep where each row came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows remember the page they came from; the lake orders equal keys by these.
ORIGIN = ["_captured_at", "_page_id", "_ordinal"]


def exploded(pages: DataFrame, envelope: str, items: str, **page_values: Column) -> DataFrame:
    """One row per element of the array ``items`` of a payload: ``item`` plus the page's own values.

    ``envelope`` is the DDL of the payload's top level. Payloads that are not JSON, or have no such
    list, give no rows. ``page_values`` are expressions over the parsed struct ``p``.
    """
    parsed = pages.select(
        F.col("captured_at").alias("_captured_at"),
        F.col("page_id").alias("_page_id"),
        F.from_json("payload", envelope).alias("p"),
    )
    with_values = parsed.withColumns(page_values) if page_values else parsed
    return with_values.select(
        "_captured_at", "_page_id", *page_values, F.posexplode(F.col(f"p.{items}")).alias("_ordinal", "item")
    ).withColumn("_ordinal", F.col("_ordinal").cast("bigint"))


def nested(rows: DataFrame, array: Column, name: str) -> DataFrame:
    """Explode an array inside ``item``; ``_ordinal`` keeps counting in payload order."""
    inner = rows.select("*", F.posexplode(array).alias("_inner", name))
    return inner.withColumn("_ordinal", F.shiftleft("_ordinal", 24) + F.col("_inner")).drop("_inner")


def without_origin(rows: DataFrame) -> DataFrame:
    return rows.drop(*ORIGIN)
