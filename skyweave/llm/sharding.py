"""Sharding by bytes with Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.llm.common import table, text_key
from skyweave.session import stage

GROUPS_PER_TASK = 20_000  # groups that one task differences
LARGE = 64  # a group is large from such a part of a mean shard on, so at most so many a shard are
ROWS_PER_RUN = 5_000  # rows numbered together


def difference(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions until one is left.

    ``parts`` is (n, shards), the sums of n partial partitions. Always the two with the largest spread
    are combined, the heaviest shard of one with the lightest of the other. Returns (n, shards), the
    final shard of each shard of each part, and the final sums. Ties go to the lower row.
    """
    n, k = parts.shape
    order = np.argsort(-parts, axis=1, kind="stable")
    sums = list(np.take_along_axis(parts, order, axis=1))
    heap = [(-int(s[0] - s[-1]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums[a] + sums[b][::-1]
        by = np.argsort(-both, kind="stable")
        merged.append((a, b, by))
        sums[a] = sums[b] = None
        sums.append(both[by])
        heapq.heappush(heap, (-int(sums[-1][0] - sums[-1][-1]), len(sums) - 1))
    final: list[np.ndarray | None] = [None] * len(sums)
    final[-1] = np.arange(k)
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, by = merged[node - n]
        to = np.empty(k, dtype=np.int64)
        to[by] = final[node]
        final[a], final[b], final[node] = to, to[::-1], None
    out = np.empty((n, k), dtype=np.int64)
    np.put_along_axis(out, order, np.stack(final[:n]), axis=1)
    return out, sums[-1]


def _deal(shards: int, loads: list[int] | None, share: float):
    """Difference the groups of a task; ``share`` of the loads that shards already have takes part as one
    more partial partition, which also tells which shard is which."""

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "key"], ascending=[False, True], kind="stable")
        parts = np.zeros((len(pdf) + 1, shards), dtype=np.int64)
        parts[:-1, 0] = pdf["bytes"]
        if loads is not None:
            parts[-1] = np.array(loads, dtype=np.float64) * (float(pdf["bytes"].sum()) * share)
        to, _ = difference(parts)
        name = np.empty(shards, dtype=np.int64)
        name[to[-1]] = np.arange(shards)
        return pdf.assign(shard=name[to[:-1, 0]])[["key", "bytes", "shard"]]

    return deal


def balanced_shards(spark: SparkSession, docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", extra_bytes: int = 16) -> DataFrame:
    """Put documents into shards of near equal bytes; equal texts share a shard.

    A group is all documents with one text; it is never divided, so a group above the mean shard makes
    its shard larger than the others. The large groups, at most ``LARGE`` per shard, are differenced
    by one task. The others are dealt to tasks by hash; each differences about ``GROUPS_PER_TASK`` of them
    together with its share of the loads that the large ones gave the shards, so that it fills up what
    those left. Nothing is sampled, and reruns agree.

    Null texts have ``extra_bytes`` bytes, no checksum, and form one group; empty texts form another.
    Null ids are kept and come first in their shard. Repeated rows are kept. Other columns of ``docs``
    are not looked at. An empty table gives no rows.

    Returns doc_id, size, text_crc32, shard, slot; slots count from 0 without gaps in each shard.
    """
    text = F.col(text_col)
    rows = stage(spark, docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(extra_bytes)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key(text).alias("key"),
    ))
    groups = stage(spark, rows.groupBy("key").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = F.col("bytes") * (shards * LARGE) >= total
    schema = "key string, bytes long, shard long"
    first = stage(spark, groups.where(large).groupBy(F.lit(0).alias("all")).applyInPandas(_deal(shards, None, 0.0), schema))
    sums = {r["shard"]: r["bytes"] for r in first.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    loads = [sums.get(s, 0) for s in range(shards)]
    small = groups.where(~large)
    buckets = max(1, -(-small.count() // GROUPS_PER_TASK))
    share = 1.0 / max(1, total - sum(loads))
    second = small.groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")).applyInPandas(_deal(shards, loads, share), schema)
    shard_of = stage(spark, first.unionByName(second).select("key", F.col("shard").cast("int").alias("shard")))
    placed = stage(spark, rows.join(shard_of, "key").select("doc_id", "size", "text_crc32", "key", "shard"))
    runs = max(16, -(-placed.count() // (shards * ROWS_PER_RUN)))
    placed = placed.withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(runs)))
    counts = placed.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "run").orderBy("doc_id", "key")
    numbered = placed.withColumn("nth", F.row_number().over(within))
    return numbered.join(starts, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("nth") - 1).cast("long").alias("slot")
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards under the law ``bytes``."""
    out = balanced_shards(spark, table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
