"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    nullable_keys: Sequence[str] = (),
) -> DataFrame:
    """The last row per key by ``order``; rows missing a key part are dropped.

    ``nullable_keys`` are key parts for which null is a value of its own. Without keys the input is
    returned as it is. An aggregate is used rather than ``row_number``: copies of one key are
    reduced before the shuffle, so a key that holds a large share of all rows costs one row per map
    task instead of one oversized reduce task.
    """
    if not keys:
        return df
    required = [k for k in keys if k not in nullable_keys]
    kept = df.dropna(subset=required) if required else df
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return kept.distinct()
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return kept.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def align(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column some frames lack is null in their rows."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
