"""Spelling variants: words one edit apart, each pointed to a far more frequent form.

Words are counted by Spark over all texts. Two words are one edit apart exactly when their common prefix
plus their common suffix reaches the longer length minus one (both at most one apart in length). Such a
pair shares, with its longer length n and h = ceil((n - 1) / 2), either its first h or its last h code
points, since prefix + suffix >= n - 1. So each word is listed under four blocks (its first and last h code
points for n = its length and its length + 1); only words of a block can be near each other. A block is
cut into tiles of at most TILE words, and each pair of tiles of a block is one group: its two tiles become
padded code-point matrices, compared all at once in NumPy, prefix and suffix lengths from running
products of equal columns. Big blocks thus spread over many tasks, each group holding at most 2 * TILE
words. Rows are dealt by group and sorted, and a task walks its groups one after the other, as most
blocks are tiny and a call per group would cost more than the comparison.
A word's form is then the most frequent near word (aggregated by Spark), and roots follow forms by joins.

Defined results:
  * null texts have no runs; a null ``doc_id`` writes as no id, so its runs are never shortened.
  * only A-Z are lower-cased; other letters of the class stay as they are.
  * ties of the form's count go to the smaller word in code-point order.
  * repeated rows count their runs again (occurrences are counted over rows).
  * extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import table
from skyweave.session import stage

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
SHORTEN_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
# Words of one tile; a group holds two tiles. One comparison holds at most CELLS code points.
TILE = 512
CELLS = 1 << 24
# Groups of one tile with at most this many words are compared word by word, which costs less than matrices.
FEW = 8

_PAIRS = "word string, near string, near_n long"


def word_counts(docs: DataFrame) -> DataFrame:
    """Distinct words (runs after the deletion rule) of at least MIN_LENGTH code points and MIN_COUNT occurrences."""
    runs = docs.select(F.col("doc_id").cast("long").alias("_id"), F.explode(F.regexp_extract_all(F.col("text"), F.lit(RUN), 0)).alias("_run"))
    low = runs.select("_id", F.translate("_run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("_low"))
    h = F.crc32(F.concat(F.col("_id").cast("string"), F.lit(":"), F.col("_low")).cast("binary"))
    marked = low.select("_low", h.alias("_h"))
    cut = F.concat(F.expr("substring(_low, 1, cast(_h % char_length(_low) as int))"), F.expr("substring(_low, cast(_h % char_length(_low) as int) + 2)"))
    word = F.when(F.coalesce(F.col("_h") % SHORTEN_EVERY == 0, F.lit(False)), cut).otherwise(F.col("_low"))
    counted = marked.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.char_length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def blocks(words: DataFrame) -> DataFrame:
    """Each word under its four blocks, with the tile it falls in and the number of tiles of the block."""
    length = F.char_length("word")
    listed = words.select("word", "n", F.explode(F.array(
        *[F.struct(F.lit(side).alias("side"), (length + grow).alias("len")) for side in ("p", "s") for grow in (0, 1)]
    )).alias("b"))
    key = F.when(F.col("b.side") == "p", F.expr("substring(word, 1, cast(ceil((b.len - 1) / 2) as int))")).otherwise(
        F.expr("substring(word, char_length(word) - cast(ceil((b.len - 1) / 2) as int) + 1)")
    )
    keyed = listed.select("word", "n", F.col("b.side").alias("side"), F.col("b.len").alias("len"), key.alias("key"))
    sizes = keyed.groupBy("side", "len", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    return keyed.join(sizes, ["side", "len", "key"]).select(
        "word", "n", "side", "len", "key", tiles.alias("tiles"), F.pmod(F.xxhash64("word"), tiles).alias("tile"),
    )


def tile_pairs(blocked: DataFrame) -> DataFrame:
    """Every word once in each group (tile pair) of its block that holds its tile."""
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    dealt = blocked.select("*", other)
    lo, hi = F.least("tile", "other"), F.greatest("tile", "other")
    return dealt.select("word", "n", "side", "len", "key", lo.alias("t1"), hi.alias("t2"), (F.col("tile") == lo).alias("first"))


def _codes(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points of the words in rows of ``width``, padded with -1 on the right (or on the left)."""
    out = np.full((len(words), width), -1, dtype=np.int32)
    for i, w in enumerate(words):
        cps = np.frombuffer(w.encode("utf-32-le"), dtype=np.int32)
        if right:
            out[i, width - len(cps):] = cps
        else:
            out[i, : len(cps)] = cps
    return out


def near_pairs(u: list[str], v: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of words u[i], v[j] one edit apart, by prefix and suffix lengths of padded matrices.

    Rows of u are taken in slices so that no comparison holds more than CELLS code points.
    """
    if not u or not v:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = max(max(map(len, u)), max(map(len, v)))
    rows = max(1, CELLS // (len(v) * width))
    if len(u) > rows:
        found = [near_pairs(u[s : s + rows], v) for s in range(0, len(u), rows)]
        return np.concatenate([i + s for (i, _), s in zip(found, range(0, len(u), rows))]), np.concatenate([j for _, j in found])
    lu = np.array([len(w) for w in u])[:, None]
    lv = np.array([len(w) for w in v])[None, :]
    left_u, left_v = _codes(u, width, False), _codes(v, width, False)
    right_u, right_v = _codes(u, width, True), _codes(v, width, True)
    same = left_u[:, None, :] == left_v[None, :, :]
    prefix = np.cumprod(same, axis=2).sum(axis=2)
    same = right_u[:, None, ::-1] == right_v[None, :, ::-1]
    suffix = np.cumprod(same, axis=2).sum(axis=2)
    longer, shorter = np.maximum(lu, lv), np.minimum(lu, lv)
    prefix, suffix = np.minimum(prefix, shorter), np.minimum(suffix, shorter)  # padding may match padding
    hit = (longer - shorter <= 1) & (prefix + suffix >= longer - 1) & ~((lu == lv) & (prefix >= longer))
    return np.nonzero(hit)


def one_edit(u: str, v: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(u) < len(v):
        u, v = v, u
    if len(u) - len(v) > 1 or u == v:
        return False
    i = 0
    while i < len(v) and u[i] == v[i]:
        i += 1
    return u[i + 1 :] == (v[i + 1 :] if len(u) == len(v) else v[i:])


_GROUP = ["side", "len", "key", "t1", "t2"]


def compare_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near pairs of all groups of a partition whose rows come sorted by group; a group that a batch cuts
    off is carried into the next. Groups are found by comparing neighbouring keys, and each is compared
    with NumPy on plain arrays, without a pandas frame per group."""
    carry = None
    for pdf in batches:
        if carry is not None:
            pdf = pd.concat([carry, pdf], ignore_index=True)
        if pdf.empty:
            continue
        cols = [pdf[c].to_numpy() for c in _GROUP]
        change = np.zeros(len(pdf), bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change)
        carry = pdf.iloc[starts[-1] :].reset_index(drop=True)
        found = _compare_slices(pdf, starts[:-1], starts[-1])
        if len(found):
            yield found
    if carry is not None and not carry.empty:
        found = _compare_slices(carry, np.array([0]), len(carry))
        if len(found):
            yield found


def _compare_slices(pdf: pd.DataFrame, starts: np.ndarray, stop: int) -> pd.DataFrame:
    words, counts, first = pdf["word"].tolist(), pdf["n"].to_numpy(), pdf["first"].to_numpy()
    same_tile = (pdf["t1"].to_numpy() == pdf["t2"].to_numpy())
    out_w, out_v, out_n = [], [], []
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), stop]):
        if same_tile[lo] and hi - lo <= FEW:
            for x in range(lo, hi - 1):
                for y in range(x + 1, hi):
                    if one_edit(words[x], words[y]):
                        out_w += [words[x], words[y]]
                        out_v += [words[y], words[x]]
                        out_n += [int(counts[y]), int(counts[x])]
            continue
        if same_tile[lo]:
            a = b = np.arange(lo, hi)
        else:
            a = lo + np.flatnonzero(first[lo:hi])
            b = lo + np.flatnonzero(~first[lo:hi])
        if len(a) == 0 or len(b) == 0 or (same_tile[lo] and len(a) < 2):
            continue
        i, j = near_pairs([words[x] for x in a], [words[x] for x in b])
        if len(i):
            ga, gb = a[i], b[j]
            out_w += [words[x] for x in ga] + [words[x] for x in gb]
            out_v += [words[x] for x in gb] + [words[x] for x in ga]
            out_n += counts[gb].tolist() + counts[ga].tolist()
    return pd.DataFrame({"word": pd.Series(out_w, dtype=object), "near": pd.Series(out_v, dtype=object), "near_n": np.array(out_n, dtype=np.int64)})


def compare_group(group: pd.DataFrame) -> pd.DataFrame:
    """Near pairs between the two tiles of a group (within the tile when both are one), both ways round."""
    first = group[group["first"]]
    second = first if group["t1"].iloc[0] == group["t2"].iloc[0] else group[~group["first"]]
    u, v = first["word"].tolist(), second["word"].tolist()
    i, j = near_pairs(u, v)
    un, vn = first["n"].to_numpy(), second["n"].to_numpy()
    uw, vw = np.array(u, dtype=object), np.array(v, dtype=object)
    return pd.DataFrame({"word": np.concatenate([uw[i], vw[j]]), "near": np.concatenate([vw[j], uw[i]]), "near_n": np.concatenate([vn[j], un[i]]).astype(np.int64)})


def spelling_variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every counted word."""
    words = stage(spark, word_counts(docs))
    dealt = tile_pairs(blocks(words)).repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    pairs = dealt.mapInPandas(compare_sorted, _PAIRS).dropDuplicates(["word", "near"])
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("top"),
    )
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.m") >= FORM_RATIO * F.col("n"), F.col("top.w")).alias("form"),
        F.when(-F.col("top.m") >= FORM_RATIO * F.col("n"), -F.col("top.m")).cast("long").alias("form_n"),
    )
    formed = stage(spark, formed)
    # forms strictly grow tenfold in count, so a chain is at most log10(largest n) + 1 long
    largest = formed.agg(F.max("n")).first()[0] or 1
    steps = len(str(int(largest))) + 1
    links = formed.where("form is not null").select(F.col("word").alias("_at"), F.col("form").alias("_next"))
    walk = formed.select("word", F.coalesce("form", "word").alias("root"))
    for _ in range(steps):
        walk = stage(spark, walk.join(links, walk["root"] == links["_at"], "left").select("word", F.coalesce("_next", "root").alias("root")))
    return formed.join(walk, "word").select("word", "form", "root", "n", "n_near", "form_n")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of all words of all documents."""
    return spelling_variants(spark, table(spark, sf_dir, "documents"))
