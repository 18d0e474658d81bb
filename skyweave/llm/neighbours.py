"""Approximate nearest neighbours by collision counting."""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.llm.common import small_batches, table
from skyweave.session import stage

PROJECTIONS = 128
SHARE = 0.81  # of the projections that a vector must share a window with to be verified
REACH = 1.5  # windows of this half-width, in distances of the k-th found, end the search
GROWTH = 1.4  # of the radius from one level to the next
LEVELS = 8  # level 0 covers such a part of a projection's values
BLOCK, QUERIES = 32_768, 128  # vectors and queries that one task compares


class SortedProjections:
    """An index over a block of vectors: for each random projection, its values in order."""

    def __init__(self, vectors: np.ndarray, projections: int = PROJECTIONS, seed: int = 11):
        self.vectors = vectors
        self.lines = np.random.default_rng(seed).normal(size=(vectors.shape[1], projections))
        values = vectors @ self.lines
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.values = np.sort(values, axis=0).T.copy()
        self.width = float(np.mean(self.values[:, -1] - self.values[:, 0])) / LEVELS or 1.0

    def search(self, query: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of the vectors found, in no order; ``own`` is left out.

        Windows around the query's values widen level by level (a virtual rehashing: what collided stays
        counted). A vector that shares enough windows is verified, that is, its distance is computed. The
        search ends when windows reach past the distance of the k-th vector verified, or cover all.
        """
        need = int(np.ceil(SHARE * len(self.values)))
        at = query @ self.lines
        n = len(self.vectors)
        counts, done = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
        if own >= 0:
            done[own] = True
        lows = [int(np.searchsorted(v, x)) for v, x in zip(self.values, at)]
        highs = list(lows)
        places, distances = [], []
        best = np.empty(0)
        radius = self.width
        while True:
            whole, newly = True, []
            for p, (v, x) in enumerate(zip(self.values, at)):
                low, high = np.searchsorted(v, (x - radius, x + radius), side="left").tolist()
                newly += [self.order[p, low : lows[p]], self.order[p, highs[p] : high]]
                lows[p], highs[p] = low, max(high, highs[p])
                whole &= low == 0 and high == n
            counts += np.bincount(np.concatenate(newly), minlength=n)
            whole |= not np.isfinite(radius)  # values too large for any window
            some = np.flatnonzero(((counts >= need) | whole) & ~done)
            if len(some):
                done[some] = True
                d = np.sqrt(((self.vectors[some] - query) ** 2).sum(axis=1))
                places.append(some)
                distances.append(d)
                best = np.sort(np.concatenate((best, d)))[:k]
            if whole or (len(best) >= k and radius >= REACH * best[-1]):
                break
            radius = min(radius * GROWTH, REACH * best[-1]) if len(best) >= k else radius * GROWTH
        return (np.concatenate(places), np.concatenate(distances)) if places else (np.empty(0, int), np.empty(0))


COLUMNS = "query_id long, vec_id long, score double"


def _search(k: int, block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    found = []
    if len(block) and len(queries):
        index = SortedProjections(np.stack(block["vector"]).astype(np.float64))
        ids = block["vec_id"].to_numpy()
        place = {int(v): i for i, v in enumerate(ids)}
        for name, query in zip(queries["vec_id"], queries["vector"]):
            at, d = index.search(np.asarray(query, dtype=np.float64), k, place.get(int(name), -1))
            first = np.lexsort((ids[at], d))[:k]
            found.append(pd.DataFrame({"query_id": int(name), "vec_id": ids[at][first], "score": d[first]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})


def nearest(spark: SparkSession, vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest vectors found for each query, a row of ``vectors`` where ``is_query`` holds.

    Vectors are dealt into blocks by a hash of their id, queries into blocks likewise; a task indexes one
    block of vectors and searches it for one block of queries, so its memory is bounded and every vector
    is indexed. The best of all blocks are merged per query. Distances are Euclidean on the original
    vectors in double precision, nearest first, ties to the smaller id.

    Null ids, and vectors that are null, zero, or hold null or non-finite components, take no part. Vectors
    are compared with those of their own length only. An id that repeats counts once, with its least
    vector, so a query never meets its own id. Other columns are not looked at. An empty table gives no
    rows.

    Returns query_id, rank (from 1), vec_id, score.
    """
    small_batches(spark)
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("query")
    )
    rows = rows.where(F.coalesce(fine, F.lit(False))).groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("query").alias("query"))
    rows = stage(spark, rows.withColumn("length", F.size("vector")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("query").alias("queries")).first()
    blocks, query_blocks = max(1, -(-size["n"] // BLOCK)), max(1, -(-size["queries"] // QUERIES))
    of = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select("length", of(blocks).alias("block"), every(query_blocks).alias("part"), "vec_id", "vector")
    queries = rows.where("query").select("length", every(blocks).alias("block"), of(query_blocks).alias("part"), "vec_id", "vector")
    key = ("length", "block", "part")
    found = data.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(partial(_search, k), COLUMNS)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest of every vector whose id is divisible by 100, among all vectors."""
    return nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)
