"""Near-duplicates by SimHash, found through per-segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import small_batches, table
from skyweave.llm.components import components
from skyweave.session import stage

SEED = 42  # of the shingle hash; a fixed value
SEGMENTS = 32  # of two bits each
HASHES_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 18  # rows of the join that a task looks at together, whole cells at least
SMALL_CELL = 64  # up to here all pairs of a cell are compared directly
LOW = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of word shingles: bit set where over half of the shingle hashes have it; 0 without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends, starts = ends[words - 1 :].tolist(), starts[: len(parts) - words + 1].tolist()
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, len(starts), HASHES_AT_ONCE):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[low : low + HASHES_AT_ONCE], ends[low : low + HASHES_AT_ONCE])]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(spark: SparkSession, docs: DataFrame, words: int, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``fp``, the fingerprint as a signed long."""
    small_batches(spark)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).astype(np.int64))

    return docs.withColumn("fp", of(F.col(text_col)))


def unary(bits: np.ndarray) -> np.ndarray:
    """Bit counts of the two-bit segments, written as 00, 01, 11: the Manhattan distance of the counts is
    then the number of differing bits, and never above the distance of the fingerprints themselves."""
    right = bits >> np.uint64(1)
    return ((bits | right) & LOW) | (((bits & right) & LOW) << np.uint64(1))


def _near(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    """Lower bound first, exact distance for what it leaves."""
    near = np.bitwise_count(unary(x) ^ unary(y)) <= distance
    near[near] = np.bitwise_count((x ^ y)[near]) <= distance
    return near


def cell_links(bits: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the members of one large cell exactly as all its close pairs would.

    Members join the first representative within reach. Two groups are compared member by member only
    where their representatives are near enough for a link and nothing has connected them yet.
    """
    rest, reps, groups, links = bits, [], [], []
    while len(rest):
        near = _near(rest, np.broadcast_to(rest[:1], rest.shape), distance)
        reps.append(rest[0])
        groups.append(rest[near])
        links.append((np.full(int(near.sum()) - 1, rest[0]), rest[near][1:]))
        rest = rest[~near]
    heads = np.array(reps)
    root = np.arange(len(heads))
    for i in range(len(heads) - 1):
        close = i + 1 + np.flatnonzero(np.bitwise_count(heads[i + 1 :] ^ heads[i]) <= 3 * distance)
        for j in close[root[close] != root[i]]:
            if root[j] == root[i]:
                continue
            for x in groups[i]:
                hit = np.flatnonzero(_near(groups[j], np.broadcast_to(x, groups[j].shape), distance))
                if len(hit):
                    links.append((np.array([x]), groups[j][hit[:1]]))
                    root[root == root[j]] = root[i]
                    break
    return links


def _links(distance: int):
    def flush(keys: np.ndarray, bits: np.ndarray) -> pd.DataFrame:
        cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        sizes = np.diff(cuts)
        found = []
        for k in np.flatnonzero(sizes > SMALL_CELL):
            found += cell_links(np.unique(bits[cuts[k] : cuts[k + 1]]), distance)
        at = np.flatnonzero(np.repeat(sizes <= SMALL_CELL, sizes))
        for step in range(1, SMALL_CELL):
            at = at[at + step < len(keys)]
            at = at[keys[at] == keys[at + step]]
            if not len(at):
                break
            near = at[_near(bits[at], bits[at + step], distance)]
            found.append((bits[near], bits[near + step]))
        if not found:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        both = np.unique(np.stack([np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])], axis=1), axis=0)
        both = both[both[:, 0] != both[:, 1]].view(np.int64)
        return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by key; whole cells are worked on, an unfinished last one is kept back."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, limit = 0, ROWS_AT_ONCE
        for pdf in batches:
            held.append((pdf["cell"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64)))
            size += len(pdf)
            if size >= limit:
                keys, bits = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield flush(keys[:cut], bits[:cut])
                held, size = [(keys[cut:], bits[cut:])], len(keys) - cut
                limit = max(ROWS_AT_ONCE, 2 * size)
        if size:
            yield flush(*(np.concatenate(x) for x in zip(*held)))

    return run


def fingerprint_links(spark: SparkSession, fps: DataFrame, distance: int) -> DataFrame:
    """Links between distinct fingerprints (column fp) that differ in ``distance`` bits or fewer.

    A fingerprint becomes the vector of its segments' bit counts, a point whose Manhattan distance to
    another never exceeds the number of differing bits. Segments are dealt into distance + 3 groups: two
    points within ``distance`` agree on all counts of three groups at least, so each point is put into one
    grid cell for every choice of three groups, and points are compared within cells only: first by
    Manhattan distance, then exactly. Not all links come back, but enough to connect the same
    fingerprints; a cell of many close fingerprints gives a few links per member, not all its pairs.
    """
    groups = distance + 3
    masks = [sum(3 << (2 * s) for s in range(SEGMENTS) if s % groups in chosen) for chosen in combinations(range(groups), 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    right = F.shiftrightunsigned("fp", 1)
    low = F.lit(int(LOW))
    counts = fps.select("fp", (F.col("fp").bitwiseOR(right).bitwiseAND(low)).alias("one"), F.col("fp").bitwiseAND(right).bitwiseAND(low).alias("two"))
    point = counts.select("fp", F.col("one").bitwiseOR(F.shiftleft("two", 1)).alias("point"))
    cells = point.select("fp", "point", F.posexplode(F.array(*[F.lit(m) for m in signed])).alias("choice", "mask")).select(
        F.xxhash64("choice", F.col("point").bitwiseAND(F.col("mask"))).alias("cell"), "fp"
    )
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "fp")
    return dealt.mapInPandas(_links(distance), "a long, b long")


def fingerprint_roots(spark: SparkSession, rows: DataFrame, distance: int) -> DataFrame:
    """fp and root of every fingerprint in ``rows``; equal roots mean one component."""
    classes = stage(spark, rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).select("fp"))
    roots = components(spark, fingerprint_links(spark, classes, distance))
    return stage(spark, classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(
    spark: SparkSession, docs: DataFrame, words: int, distance: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents with their fingerprint and the least id of their component.

    Fingerprints link at ``distance`` or fewer differing bits, and components follow links. Null texts
    count as empty; empty texts have fingerprint 0 and link like any other. Equal texts share a
    fingerprint, so copies never meet as pairs. Null ids are kept; a component's least id is null only if
    all its ids are. Repeated rows are kept. Other columns of ``docs`` are not looked at. An empty table
    gives no rows.

    Returns doc_id, fp (signed long), component_id.
    """
    rows = stage(spark, fingerprints(spark, docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), words).select("doc_id", "fp"))
    roots = fingerprint_roots(spark, rows, distance)
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).join(roots, "fp")
    least = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(stage(spark, roots.join(least, "root").select("fp", "component_id")), "fp").select("doc_id", "fp", "component_id")


def deduplicate(
    spark: SparkSession, docs: DataFrame, words: int, distance: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: that of the least id, of several such the first read.

    Components are those of :func:`near_duplicates`; a null id is kept only where a component has no
    other. Repeated rows count as copies. All columns stay, whatever their names.
    """
    packed = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # numbers are written with the rows, so they stay the same however often these are read
    packed = stage(spark, fingerprints(spark, packed, words).select("doc", "doc_id", "fp", F.monotonically_increasing_id().alias("row")))
    rows = packed.select("doc_id", "fp", "row")
    roots = fingerprint_roots(spark, rows, distance)
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")).join(roots, "fp")
    kept = first.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    return packed.select("doc", "row").join(kept, "row", "left_semi").select("doc.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of four-word shingles over all documents, linked at four bits or fewer."""
    out = near_duplicates(spark, table(spark, sf_dir, "documents"), words=4, distance=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
