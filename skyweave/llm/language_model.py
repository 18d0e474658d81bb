"""Scoring texts with a smoothed bigram model, run as a weighted automaton with failure arcs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import id_share, small_batches, table
from skyweave.session import stage

BLOCK_TOKENS = 1 << 19  # tokens of a block of documents, at least one document
SHARD_ENTRIES = 1 << 21  # n-grams that one task counts, on average
BACKOFF = 0.9  # weight of the failure arcs: the share of a state's mass that goes to the empty history
ADDED = 0.1  # of the additive base model
END = np.uint64(0x9E3779B97F4A7C15)  # stands for the end token; words hash to 64 bits
MIX = np.uint64(0xD6E8FEB86659FD93)


def _words(text: str | None, memo: dict[bytes, int]) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case, and of its end."""
    out = []
    for w in (text or "").encode("utf-8", "surrogatepass").lower().split():
        h = memo.get(w)
        if h is None:
            h = memo[w] = xxhash.xxh64_intdigest(w)
        out.append(h)
    return np.array([*out, int(END)], dtype=np.uint64)


def _pairs(tokens: np.ndarray) -> np.ndarray:
    """Hash of each neighbouring pair of tokens."""
    h = (tokens[:-1] * MIX) ^ ((tokens[1:] << np.uint64(29)) | (tokens[1:] >> np.uint64(35)))
    h ^= h >> np.uint64(32)
    h *= MIX
    return h ^ (h >> np.uint64(29))


def _pack(sorted_keys: np.ndarray) -> bytes:
    """Differences of sorted keys, byte plane by byte plane, so that the zero planes compress to nothing."""
    return np.diff(sorted_keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(planes: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(planes, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _small(counts: np.ndarray) -> bytes:
    """Counts as byte planes."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _counts(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the shards begin in sorted keys; a shard is a range of hashes."""
    bounds = (np.arange(shards, dtype=object) * (1 << 64) // shards).astype(np.uint64)
    return np.append(np.searchsorted(keys, bounds), len(keys))


BLOCKS = "block long, doc_ids array<string>, held_out array<boolean>, sizes array<int>, words binary, seq binary, train_tokens long"


def _make_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    block = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    names, held, rows, memo = [], [], [], {}
    size = 0

    def flush() -> pd.DataFrame:
        nonlocal block, names, held, rows, size, memo
        words, seq = np.unique(np.concatenate(rows), return_inverse=True)
        sizes = [len(r) for r in rows]
        out = pd.DataFrame({
            "block": [block], "doc_ids": [names], "held_out": [held], "sizes": [sizes], "words": [_pack(words)],
            "seq": [_small(seq)], "train_tokens": [sum(n for n, h in zip(sizes, held) if not h)],
        })
        block, names, held, rows, size, memo = block + 1, [], [], [], 0, {}
        return out

    for pdf in batches:
        for name, out, text in zip(pdf["doc_id"], pdf["held_out"], pdf["text"]):
            rows.append(_words(text, memo))
            names.append(name)
            held.append(bool(out))
            size += len(rows[-1])
            if size >= BLOCK_TOKENS:
                yield flush()
    if rows:
        yield flush()


def _parts(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, token positions in them, document sizes, and where training tokens and training pairs are."""
    words, seq, sizes = _unpack(row.words), _counts(row.seq), np.asarray(row.sizes, dtype=np.int64)
    train = np.repeat(~np.asarray(row.held_out, dtype=bool), sizes)
    inside = np.ones(len(seq), dtype=bool)
    inside[np.cumsum(sizes) - 1] = False  # a pair begins at every token but a document's last
    return words, seq, sizes, train, inside


def _grams(row) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Sorted distinct words with training counts, the same of pairs, and each pair's place among the latter."""
    words, seq, _, train, inside = _parts(row)
    pairs = _pairs(words[seq])[inside[:-1]] if len(seq) > 1 else np.empty(0, np.uint64)
    keys, place = np.unique(pairs, return_inverse=True)
    pair_train = train[:-1][inside[:-1]] if len(seq) > 1 else np.empty(0, bool)
    return (words, np.bincount(seq[train], minlength=len(words))), (keys, np.bincount(place[pair_train], minlength=len(keys))), place


def _send(shards: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What a block has of each shard: its n-grams, and how often training texts have them."""
    for pdf in batches:
        for row in pdf.itertuples():
            words, pairs, _ = _grams(row)
            for order, (keys, counts) in ((1, words), (2, pairs)):
                cuts = _cuts(keys, shards)
                some = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
                yield pd.DataFrame({
                    "shard": some, "order": order, "block": row.block,
                    "keys": [_pack(keys[cuts[s] : cuts[s + 1]]) for s in some],
                    "counts": [_small(counts[cuts[s] : cuts[s + 1]]) for s in some],
                })


def _count(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum the counts of a shard and give each block those of its own n-grams."""
    sent = [_unpack(k) for k in pdf["keys"]]
    keys, place = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.bincount(place, np.concatenate([_counts(c) for c in pdf["counts"]]), len(keys)).astype(np.int64)
    back = np.split(totals[place], np.cumsum([len(s) for s in sent])[:-1])
    # sums of the shard, once: training types of this order, and those seen once
    types, once = np.zeros(len(sent), np.int64), np.zeros(len(sent), np.int64)
    types[0], once[0] = int((totals > 0).sum()), int((totals == 1).sum())
    return pd.DataFrame({"shard": pdf["shard"], "order": pdf["order"], "block": pdf["block"], "totals": [_small(b) for b in back], "types": types, "once": once})


class Automaton:
    """The states of a bigram model that a block of texts can reach.

    A state is a history: one word, or none. Its arcs carry smoothed probabilities of the words seen
    after it, c(hw) / c(h) mixed with the word's own; a word without an arc takes the failure arc, which
    costs log10 of ``BACKOFF``, to the state without history. There every known word has an arc, and the
    unknown word has the mass that words seen once have in training.
    """

    def __init__(self, words: np.ndarray, pairs: np.ndarray, tokens: int, once: int):
        unknown = min(max(once, 1) / max(tokens, 1), 0.5)
        with np.errstate(divide="ignore"):
            self.alone = np.where(words > 0, (1 - unknown) * words / max(tokens, 1), unknown)
        self.words, self.pairs = words, pairs

    def run(self, seq: np.ndarray, arcs: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of each token, left to right: ``seq`` are the words, ``arcs`` the pair that ends
        in each token (any where ``first``, at a document's beginning). The state after a token is its word."""
        alone = self.alone[seq]
        before = self.words[np.concatenate((seq[:1], seq[:-1]))]
        state = ~first & (before > 0)  # an unknown word is no history
        seen = np.where(state, self.pairs[arcs] if len(self.pairs) else 0, 0)
        arc = (1 - BACKOFF) * seen / np.maximum(before, 1) + BACKOFF * alone
        return np.log10(np.where(state, arc, alone))


def _score(tokens: int, types: int, once: int, key: tuple, blocks: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
    """Scores of a block's documents from its n-grams' counts."""
    frames = []
    sent = sent.sort_values(["order", "shard"], kind="stable")
    totals = {o: np.concatenate([_counts(t) for t in sent["totals"][sent["order"] == o]] or [np.empty(0, np.int64)]) for o in (1, 2)}
    for row in blocks.itertuples():
        _, _, place = _grams(row)
        _, seq, sizes, _, inside = _parts(row)
        first = np.zeros(len(seq), dtype=bool)
        first[np.cumsum(sizes) - sizes] = True
        arcs = np.zeros(len(seq), dtype=np.int64)
        arcs[~first] = place
        logs = Automaton(totals[1], totals[2], tokens, once).run(seq, arcs, first)
        count = totals[1][seq]
        base = np.log10((count + ADDED) / (tokens + ADDED * (types + 1)))
        starts = np.cumsum(sizes) - sizes
        frames.append(pd.DataFrame({
            "doc_id": list(row.doc_ids), "held_out": list(row.held_out), "n_tokens": sizes, "n_known": np.add.reduceat((count > 0).astype(np.int64), starts),
            "train_tokens": tokens, "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(logs, starts),
        }))
    return pd.concat(frames) if frames else pd.DataFrame({c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")})


def lm_scores(spark: SparkSession, docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """log10 probabilities of all texts under models learnt from those not ``held_out`` (a boolean column).

    Tokens are words, A-Z in lower case, and one end per text. Documents are read once into blocks of about
    ``BLOCK_TOKENS`` tokens. A block sends its distinct words and pairs, already counted, to the shards of
    the hash range; a shard sums them and answers each block for its own n-grams only. With the answers a
    block has the part of the automaton that its texts can reach, and walks it once from left to right.
    Work, and what the shards gather, grow with the texts; no table of counts is held whole anywhere, and
    a frequent n-gram is one entry per block. N-grams are told apart by 64-bit hashes.

    Null and empty texts are a single end token. Null ids and repeated rows are scored like others; a null
    ``held_out`` counts as training. Other columns are not looked at. An empty table gives no rows;
    without training texts every token is unknown.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    blocks = stage(spark, rows.mapInPandas(_make_blocks, BLOCKS))
    size = blocks.agg(F.sum("train_tokens").alias("tokens"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("all")).first()
    tokens = size["tokens"] or 0
    shards = max(16, -(-(size["all"] or 0) // SHARD_ENTRIES))
    sent = blocks.mapInPandas(partial(_send, shards), "shard int, order int, block long, keys binary, counts binary")
    summed = stage(spark, sent.groupBy("shard", "order").applyInPandas(_count, "shard int, order int, block long, totals binary, types long, once long"))
    known = summed.where("order = 1").agg(F.sum("types").alias("types"), F.sum("once").alias("once")).first()
    answer = summed.select("block", "order", "shard", "totals")
    score = partial(_score, tokens, known["types"] or 0, known["once"] or 0)
    out = blocks.groupBy("block").cogroup(answer.groupBy("block")).applyInPandas(
        score, "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those whose id has remainder 0 are held out."""
    return lm_scores(spark, table(spark, sf_dir, "documents"), id_share(F.col("doc_id"), 10) == 0)
