"""Join helpers for skewed keys, and membership joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SALTS = 8


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    condition: Column | None = None,
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Equi join in which rows of ``big`` that share a key are spread over ``salts`` tasks.

    ``small`` is repeated once per salt, so it should be the side with few rows per key (an
    aggregate or a dimension). Nothing is dropped: each row of ``big`` meets every row of ``small``
    with its key exactly once. No broadcast is forced; AQE still picks one when the measured size of
    ``small`` allows it. ``how`` may be ``inner`` or ``left``.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = [*on, "_salt"]
    if condition is None:
        return left.join(right, keys, how).drop("_salt")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    matches = condition
    for k in keys:
        matches = (left[k] == renamed[f"_r_{k}"]) & matches
    return left.join(renamed, matches, how).drop("_salt", *[f"_r_{k}" for k in keys])


def hub_coordinates(hubs: DataFrame, airports: DataFrame) -> DataFrame:
    """Coordinates of the configured hubs (``icao`` column); hubs without a located airport drop out."""
    located = airports.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return hubs.join(located.withColumnRenamed("ident", "icao"), "icao").select("icao", "latitude", "longitude")


def unknown_values(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Distinct non-empty values of ``column`` that the reference set lacks."""
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull())
    if dict(df.dtypes)[column] == "string":
        values = values.where(F.col("value") != "")
    known = reference.select(F.col(reference_column).alias("value"))
    return values.distinct().join(known, "value", "left_anti")
