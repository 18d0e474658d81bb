"""Packing token sequences with balanced attention cost."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import small_batches, table

END = 0  # the id after each document
BLOCK_TOKENS = 1 << 20  # tokens packed together in a task
LINEAR = 2048  # cost of a token, where a pair of tokens of one piece costs 1


def load_encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file. Ids of such a vocabulary are its merge ranks, so tiktoken
    gives the same ids several times faster. Strings of the file's added tokens are single tokens, also inside
    a text, when ``allowed_special`` is "all". Flags that make an added token take in white space, need whole words
    or match by a normalised text are refused, as tiktoken does not know them."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] and model["normalizer"] for t in model["added_tokens"]):
        raise ValueError("flags of added tokens that are not supported")
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    # the byte alphabet of byte-level BPE: printable Latin-1 stands for itself, other bytes for 256 and up
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode_ids(encoding: tiktoken.Encoding, path: str, text: str) -> np.ndarray:
    """Ids of a text by tiktoken; where tiktoken gives up (runs of about a million blanks or line breaks
    exceed its stack), by ``tokenizers`` from the same file, which gives the same ids."""
    try:
        return np.asarray(encoding.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
    except ValueError:
        from tokenizers import Tokenizer

        return np.asarray(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, dtype="<u4")


def pack_block(lengths: np.ndarray, capacity: int, linear: int = LINEAR) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Cut and pack documents of the given lengths (at least 1 each).

    Whole multiples of ``capacity`` become sequences of their own. The remainders fill as many full
    sequences as they have tokens for, and what is over fills sequences of descending powers of two, so
    no sequence needs padding. Remainders go in descending length, each to the sequence of lowest cost
    that has room for it; one that fits nowhere is cut, beginning with the lowest cost.
    Returns (document, start, length, sequence, offset) of each piece, and the number of sequences.
    """
    pieces = []
    made = 0
    for doc in np.flatnonzero(lengths >= capacity):
        for start in range(0, int(lengths[doc]) - capacity + 1, capacity):
            pieces.append((int(doc), start, capacity, made, 0))
            made += 1
    rest = lengths % capacity
    total = int(rest.sum())
    room = [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if (total % capacity) >> b & 1]
    room = np.array(room, dtype=np.int64)
    size, cost = room.copy(), np.zeros(len(room))
    for doc in np.argsort(-rest, kind="stable"):
        left, at = int(rest[doc]), int(lengths[doc] - rest[doc])
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room > 0)
            to = int(fits[np.argmin(cost[fits])])
            take = min(left, int(room[to]))
            pieces.append((int(doc), at, take, made + to, int(size[to] - room[to])))
            room[to] -= take
            cost[to] += take * (linear + take)
            left, at = left - take, at + take
    return pieces, made + len(room)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 1024, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents packed into sequences of at most ``capacity`` (a power of two) tokens.

    Each task packs its own documents in blocks of about ``BLOCK_TOKENS``, so no text is shuffled; a
    document is never split over blocks. Strings of the tokenizer's added tokens become their ids. Sequence ids hold the task's partition and count up from there,
    so a task that runs again gives the same ones. Null and empty texts are a single end id. Null ids
    and repeated rows are packed like others. Other columns are not looked at. An empty table gives no
    rows. Costs are estimated as ``LINEAR`` a token plus one a pair of tokens of one piece.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.
    """
    small_batches(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = load_encoding(tokenizer)
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pd.DataFrame:
            nonlocal sequence, held, names, ids
            pieces, made = pack_block(np.array([len(x) for x in ids], dtype=np.int64), capacity)
            of, start, length, place, offset = (np.array(x, dtype=np.int64) for x in zip(*pieces))
            cuts = [ids[d][s : s + n] for d, s, n, *_ in pieces]
            out = pd.DataFrame({
                "doc_id": pd.array([names[d] for d in of], dtype="Int64"), "start": start, "length": length,
                "ids_crc32": [zlib.crc32(x.tobytes()) for x in cuts], "doc_tokens": [len(ids[d]) for d in of],
                "sequence_id": sequence + place, "offset": offset,
            })
            if with_ids:
                out["ids"] = [x.astype(np.int64) for x in cuts]
            sequence, held, names, ids = sequence + made, 0, [], []
            return out

        for pdf in batches:
            for name, text in zip(pdf["doc_id"], pdf["text"]):
                tokens = encode_ids(encoding, tokenizer, text or "")
                names.append(None if name is None else int(name))
                ids.append(np.append(tokens, np.array([END], dtype="<u4")))
                held += len(ids[-1])
                if held >= BLOCK_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    # ids go as text, since pandas would turn longs with nulls among them into floats
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, PIECES + (", ids array<long>" if with_ids else ""))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024)
