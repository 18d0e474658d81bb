"""Removing repeated passages with suffix arrays built by two-stage sorting."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import small_batches, table
from skyweave.session import shared_folder, stage

GRAM = 32  # bytes of an anchor; every passage of the wanted length has one
BLOCK_BYTES = 2 << 20  # text of a block of documents, at least one document
CHUNK = 1 << 18  # bytes hashed at once; below 2**POSITION_BITS - 2**18
POSITION_BITS = 20
SHARD_HASHES = 1 << 19  # anchors that one task counts, on average
SORT_BYTES = 2 << 20  # text whose suffixes one task sorts, on average
BUSY = 4_096  # an anchor with more occurrences is dealt out passage by passage
NO_ID = np.iinfo(np.int64).max  # null ids come last
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """``wanted`` positions of ``text`` in the order of their suffixes, to ``depth`` bytes at least.

    Two-stage sorting: only suffixes smaller than their successors are sorted by comparison. One scan over
    the buckets of first bytes, from low to high, then places each larger suffix when its successor
    is passed. ``text`` begins and ends with a zero byte, which ends suffixes, and is followed by ``depth`` more;
    positions that are neither wanted nor needed to place a wanted one are left out of both stages.
    """
    n = len(text) - depth
    # smaller than the successor: the next byte that differs is greater
    differs = np.flatnonzero(text[: n - 1] != text[1:n])
    up = text[differs] < text[differs + 1]
    smaller = np.zeros(n, dtype=bool)
    runs = np.diff(np.concatenate(([-1], differs)))
    smaller[: differs[-1] + 1 if len(differs) else 0] = np.repeat(up, runs)
    smaller[n - 1] = True
    # a wanted larger suffix is placed by its successor, that by its own, up to a smaller one
    sure = np.flatnonzero(smaller)
    ends = np.flatnonzero(wanted[:n] & ~smaller & ~np.append(wanted[1:n], False))
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, ends, 1)
    np.add.at(change, sure[np.searchsorted(sure, ends)] + 1, -1)
    needed = wanted[:n] | (np.cumsum(change[:n]) > 0)
    # the smaller suffix behind each needed larger one
    behind = np.flatnonzero(needed & ~smaller & smaller[np.minimum(np.arange(n) + 1, n - 1)]) + 1
    needed[behind] = True
    direct = np.flatnonzero(needed & smaller)
    rows = np.lib.stride_tricks.sliding_window_view(text, depth)[direct].view(f"S{depth}").ravel()
    direct = direct[np.argsort(rows, kind="stable")]
    induced = needed & ~smaller
    bytes_of = text[direct]
    cuts = np.searchsorted(bytes_of, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def pass_on(found: np.ndarray, byte: int) -> np.ndarray:
        """Place the larger suffixes right before ``found``; returns those of the same bucket."""
        before = found - 1
        before = before[induced[before]]
        first = text[before]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        edges = np.searchsorted(first, np.arange(257))
        for b in np.unique(first):
            if b != byte:
                waiting[b].append(before[edges[b] : edges[b + 1]])
        return before[edges[byte] : edges[byte + 1]]

    for byte in range(256):
        level = np.concatenate(waiting[byte]) if waiting[byte] else np.empty(0, np.int64)
        while len(level):
            out.append(level)
            level = pass_on(level, byte)
        level = direct[cuts[byte] : cuts[byte + 1]]
        if len(level):
            out.append(level)
            pass_on(level, byte)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[wanted[order]]


def repeated_starts(text: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """Mask of the wanted positions whose next ``length`` bytes also start at a lower wanted position."""
    order = suffix_order(text, wanted, length)
    view = np.lib.stride_tricks.sliding_window_view(text, length)
    same = np.zeros(len(order), dtype=bool)  # the common prefix with the suffix before reaches the length
    for low in range(1, len(order), 1 << 16):
        high = min(low + (1 << 16), len(order))
        rows = view[order[low - 1 : high]].view(f"S{length}").ravel()
        same[low:high] = rows[1:] == rows[:-1]
    heads = np.flatnonzero(~same)
    mask = np.zeros(len(text), dtype=bool)
    if len(order):
        mask[order] = True
        mask[np.minimum.reduceat(order, heads)] = False
    return mask


def passages(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, anchor) of runs of windows of ``length`` bytes that share their anchor.

    A window's anchor is the k-gram in it with the least hash, the leftmost of equal ones; it depends on the
    window's bytes alone, so equal windows have equal anchors at equal places. ``starts`` are the
    beginnings of documents in ``data`` and its end; windows across documents are left out.
    """
    wide = length - GRAM + 1  # k-grams of a window
    valid = np.zeros(len(data) + 1, dtype=np.int32)
    sizes = np.diff(starts)
    some = sizes >= length
    np.add.at(valid, starts[:-1][some], 1)
    np.add.at(valid, starts[1:][some] - length + 1, -1)
    valid = np.cumsum(valid[:-1]) > 0
    firsts, lasts, anchors = [], [], []
    for low in range(0, len(data) - length + 1, CHUNK):
        high = min(low + CHUNK, len(data) - length + 1)  # windows low..high-1
        if not valid[low:high].any():
            continue
        x = data[low : high + length - 1].astype(np.uint64)
        for step in (1, 2, 4):
            x = x[:-step] | (x[step:] << np.uint64(8 * step))
        for step, m in ((8, M1), (16, M2)):
            x = (x[:-step] * m) ^ ((x[step:] << np.uint64(27)) | (x[step:] >> np.uint64(37)))
            x ^= x >> np.uint64(31)
        x *= M3
        x ^= x >> np.uint64(32)
        least = ((x >> np.uint64(POSITION_BITS)) << np.uint64(POSITION_BITS)) | np.arange(len(x), dtype=np.uint64)
        covered = 1
        while covered < wide:
            step = min(covered, wide - covered)
            least = np.minimum(least[:-step], least[step:])
            covered += step
        at = (least & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        ok = valid[low:high]
        edge = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (ok[1:] != ok[:-1]), [True])))
        kept = ok[edge[:-1]]
        firsts.append(low + edge[:-1][kept])
        lasts.append(low + edge[1:][kept] - 1)
        anchors.append(x[at[edge[:-1][kept]]])
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(anchors)


BLOCKS = "block long, doc_ids array<string>, keys array<string>, sizes array<int>, data binary"


def _make_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    block = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    held: list[tuple[int, str | None, bytes]] = []
    size = 0

    def flush() -> pd.DataFrame:
        nonlocal block, held, size
        held.sort(key=lambda d: d[0])
        out = pd.DataFrame({
            "block": [block], "doc_ids": [[d[1] for d in held]], "keys": [[hashlib.sha256(d[2]).hexdigest() for d in held]],
            "sizes": [[len(d[2]) for d in held]], "data": [b"".join(d[2] for d in held)],
        })
        block, held, size = block + 1, [], 0
        return out

    for pdf in batches:
        for name, text in zip(pdf["doc_id"], pdf["text"]):
            held.append((NO_ID if name is None else int(name), name, (text or "").encode("utf-8", "surrogatepass")))
            size += len(held[-1][2])
            if size >= BLOCK_BYTES:
                yield flush()
    if held:
        yield flush()


def _originals(row, notes: pd.DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and sizes of a block's documents, which are copies, the text without copies, its starts, and the
    documents that these belong to."""
    sizes = np.asarray(row.sizes, dtype=np.int64)
    ids = np.array([NO_ID if d is None else int(d) for d in row.doc_ids], dtype=np.int64)
    copy = np.zeros(len(sizes), dtype=bool)
    for places in notes.loc[notes["kind"] == "copies", "body"]:
        copy[np.frombuffer(places, "<i4")] = True
    data = np.frombuffer(row.data, np.uint8)
    kept = np.flatnonzero(~copy)
    text = data[np.repeat(~copy, sizes)]
    starts = np.concatenate(([0], np.cumsum(sizes[kept])))
    return ids, sizes, copy, text, starts, kept


def _bounds(shards: int) -> np.ndarray:
    return (np.arange(shards, dtype=object) * (1 << 64) // shards).astype(np.uint64)


def _send_anchors(length: int, shards: int, key: tuple, blocks: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
    frames = []
    for row in blocks.itertuples():
        *_, text, starts, _ = _originals(row, notes, length)
        keys, counts = np.unique(passages(text, starts, length)[2], return_counts=True)
        cuts = np.append(np.searchsorted(keys, _bounds(shards)), len(keys))
        some = [s for s in range(shards) if cuts[s] < cuts[s + 1]]
        frames.append(pd.DataFrame({
            "shard": some, "block": row.block, "anchors": [np.diff(keys[cuts[s] : cuts[s + 1]], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes() for s in some],
            "counts": [counts[cuts[s] : cuts[s + 1]].astype("<u4").tobytes() for s in some],
        }))
    return pd.concat(frames) if frames else pd.DataFrame({"shard": [], "block": [], "anchors": [], "counts": []})


def _class_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    """Tell each block which of its anchors occur once (0), more often (1), or very often (2)."""
    sent = [np.cumsum(np.frombuffer(a, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64) for a in pdf["anchors"]]
    counts = np.concatenate([np.frombuffer(c, "<u4") for c in pdf["counts"]])
    keys, place = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.bincount(place, counts, len(keys))[place]
    classes = ((totals > 1).astype(np.uint8) + (totals > BUSY)).astype(np.uint8)
    cuts = np.cumsum([len(s) for s in sent])[:-1]
    shared = [int(c[k > 0].sum()) for c, k in zip(np.split(counts, cuts), np.split(classes, cuts))]
    return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"], "classes": [c.tobytes() for c in np.split(classes, cuts)], "shared": shared})


PIECES = "shard int, block long, ids binary, docs binary, starts binary, windows binary, data binary, done binary"


def _send_passages(length: int, shards: int, key: tuple, blocks: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
    """Send shared passages to be sorted. Of equal passages of a block only the first goes; the others repeat it."""
    frames = []
    for row in blocks.itertuples():
        ids, _, _, text, starts, kept = _originals(row, notes, length)
        first, last, anchor = passages(text, starts, length)
        keys, place = np.unique(anchor, return_inverse=True)
        answers = notes[notes["kind"] == "classes"].sort_values("shard", kind="stable")["body"]
        kind = np.frombuffer(b"".join(answers), np.uint8)[place] if len(keys) else np.empty(0, np.uint8)
        raw = text.tobytes()
        doc = np.searchsorted(starts, first, side="right") - 1
        seen: set[bytes] = set()
        repeats, pieces = [], [[] for _ in range(shards)]
        for i in np.flatnonzero(kind).tolist():
            a, b, d = int(first[i]), int(last[i]), int(doc[i])
            body = raw[a : b + length]
            digest = xxhash.xxh3_128_digest(body)
            if digest in seen:
                repeats.append((int(kept[d]), a - int(starts[d]), b - int(starts[d]) + length))
                continue
            seen.add(digest)
            if kind[i] == 1:
                pieces[int(anchor[i]) % shards].append((d, a, body))
            else:
                for at in range(a, b + 1):
                    pieces[xxhash.xxh64_intdigest(raw[at : at + length]) % shards].append((d, at, raw[at : at + length]))
        home = row.block % shards
        for s in range(shards):
            if pieces[s] or (s == home and repeats):
                docs = np.array([p[0] for p in pieces[s]], dtype=np.int64)
                frames.append((
                    s, row.block, ids[kept[docs]].astype("<i8").tobytes(), kept[docs].astype("<i4").tobytes(),
                    np.array([p[1] for p in pieces[s]], dtype=np.int64).__sub__(starts[docs]).astype("<i8").tobytes(),
                    np.array([len(p[2]) - length + 1 for p in pieces[s]], dtype="<i4").tobytes(), b"".join(p[2] for p in pieces[s]),
                    np.array(repeats if s == home else [], dtype="<i8").tobytes(),
                ))
    return pd.DataFrame(frames, columns=["shard", "block", "ids", "docs", "starts", "windows", "data", "done"])


def _sort_passages(length: int, pdf: pd.DataFrame) -> pd.DataFrame:
    """Repeated runs among the passages of a shard, as (document, start, end), by block."""
    out = [(int(b), d) for b, d in zip(pdf["block"], pdf["done"]) if len(d)]
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in pdf["ids"]])
    if len(ids):
        docs = np.concatenate([np.frombuffer(x, "<i4") for x in pdf["docs"]]).astype(np.int64)
        starts = np.concatenate([np.frombuffer(x, "<i8") for x in pdf["starts"]])
        windows = np.concatenate([np.frombuffer(x, "<i4") for x in pdf["windows"]]).astype(np.int64)
        block = np.repeat(pdf["block"].to_numpy(), [len(x) // 8 for x in pdf["ids"]])
        data = np.frombuffer(b"".join(pdf["data"]), np.uint8)
        sizes = windows + length - 1
        offset = np.cumsum(sizes) - sizes
        order = np.lexsort((starts, docs, block, ids))  # positions in the text are then in document order
        # text: a zero, then each passage and a zero; bytes are raised by one, which UTF-8 leaves room for
        text = np.zeros(1 + len(data) + len(order) + length, dtype=np.uint8)
        begin = 1 + np.cumsum(sizes[order] + 1) - (sizes[order] + 1)
        inner = np.arange(len(data)) - np.repeat(np.cumsum(sizes[order]) - sizes[order], sizes[order])
        text[np.repeat(begin, sizes[order]) + inner] = data[np.repeat(offset[order], sizes[order]) + inner] + 1
        change = np.zeros(len(text) + 1, dtype=np.int32)
        change[begin] += 1
        change[begin + windows[order]] -= 1
        wanted = np.cumsum(change[:-1]) > 0
        mask = repeated_starts(text, wanted, length)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
        low, high = edges[0::2], edges[1::2]
        piece = np.searchsorted(begin, low, side="right") - 1
        of = order[piece]
        runs = np.stack([docs[of], starts[of] + low - begin[piece], starts[of] + high - begin[piece] + length - 1], axis=1).astype("<i8")
        by = np.argsort(block[of], kind="stable")
        runs, blocks = runs[by], block[of][by]
        for low in np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))) if len(blocks) else []:
            high = np.searchsorted(blocks, blocks[low], side="right")
            out.append((int(blocks[low]), runs[low:high].tobytes()))
    return pd.DataFrame(out, columns=["block", "body"])


RESULT = "doc_id string, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start:long,end:long>>"


def _cut_out(length: int, keep: bool, key: tuple, blocks: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
    """Results of a block's documents."""
    frames = []
    for row in blocks.itertuples():
        _, sizes, copy, *_ = _originals(row, notes, length)
        runs = [np.frombuffer(x, "<i8").reshape(-1, 3) for x in notes.loc[notes["kind"] == "runs", "body"]]
        whole = np.flatnonzero(copy)
        runs.append(np.stack([whole, np.zeros_like(whole), sizes[whole]], axis=1))
        runs = np.concatenate(runs)
        starts = np.cumsum(sizes) - sizes
        change = np.zeros(len(row.data) + 1, dtype=np.int32)
        np.add.at(change, starts[runs[:, 0]] + runs[:, 1], 1)
        np.add.at(change, starts[runs[:, 0]] + runs[:, 2], -1)
        gone = np.cumsum(change[:-1]) > 0
        data = np.frombuffer(row.data, np.uint8)
        rows = []
        for name, a, n in zip(row.doc_ids, starts.tolist(), sizes.tolist()):
            mask = gone[a : a + n]
            edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))).tolist()
            rest = data[a : a + n][~mask].tobytes() if edges else row.data[a : a + n]
            spans = [{"start": s, "end": e} for s, e in zip(edges[0::2], edges[1::2])]
            rows.append((name, n, int(mask.sum()), len(spans), rest if keep else hashlib.sha256(rest).digest(), spans))
        frames.append(pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans"]))
    return pd.concat(frames) if frames else pd.DataFrame({c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans")})


def remove_repeats(
    spark: SparkSession, docs: DataFrame, length: int = 100, keep: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut out of each text all bytes in strings of ``length`` bytes that start earlier too: in a document of
    smaller id, or earlier in the same one. Texts are UTF-8 bytes; matches never cross documents.

    1. Texts are written once, in blocks of about ``BLOCK_BYTES`` with their documents in order of id, as a table
       bucketed by block: later steps come back to a block's text without moving it.
    2. Of equal texts the first stands for all; the others are wholly removed (from ``length`` bytes on).
    3. Every string has an anchor, the k-gram in it with the least hash. Anchors are counted by shards of
       the hash range, and only passages around anchors that occur again go on: a repeated string is in
       such a passage wherever it occurs, at the same place around the same anchor.
    4. Passages are dealt out by anchor, those of very frequent anchors string by string; equal passages of
       a block go once. A task sorts the suffixes of its passages by two-stage sorting and compares
       neighbours; of strings with a common prefix of ``length`` all but the earliest are repeats.
    5. Each block cuts the repeats out of its texts.

    Null texts count as empty. Null ids come last, rows of one id as they are read. Other columns are not
    looked at. An empty table gives no rows. Bytes that are left may not be valid UTF-8 where a cut falls
    inside a character.

    Returns doc_id, n_bytes, n_removed, n_spans, kept (binary; only its SHA-256 unless ``keep``), spans.
    """
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    name, path = f"blocks_{uuid.uuid4().hex}", shared_folder(spark, "blocks")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.mapInPandas(_make_blocks, BLOCKS).write.option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, "block").saveAsTable(name)
    blocks = spark.table(name)

    each = blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", "keys", "sizes")).alias("place", "d")).select(
        "block", "place", F.coalesce(F.col("d.doc_ids").cast("long"), F.lit(int(NO_ID))).alias("id"), F.col("d.keys").alias("key"), F.col("d.sizes").alias("size")
    )
    each = stage(spark, each.where(F.col("size") >= length))
    firsts = each.groupBy("key").agg(F.min(F.struct("id", "block", "place")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = each.join(firsts.select("key", "first"), "key").where("block <> first.block or place <> first.place")
    places = F.pandas_udf(lambda x: x.map(lambda p: np.asarray(p, dtype="<i4").tobytes()), "binary")
    copies = copies.groupBy("block").agg(places(F.collect_list("place")).alias("body"))
    copies = stage(spark, copies.select("block", F.lit("copies").alias("kind"), F.lit(0).alias("shard"), "body"))

    total = blocks.agg(F.sum(F.length("data"))).first()[0] or 0
    shards = max(16, -(-total // (SHARD_HASHES * 30)))
    by_block = blocks.groupBy("block")
    anchors = by_block.cogroup(copies.groupBy("block")).applyInPandas(
        partial(_send_anchors, length, shards), "shard int, block long, anchors binary, counts binary"
    )
    classes = stage(spark, anchors.groupBy("shard").applyInPandas(_class_anchors, "block long, shard int, classes binary, shared long"))
    shared = classes.agg(F.sum("shared")).first()[0] or 0
    shards = max(16, -(-(shared * 3 * length // 2) // SORT_BYTES))
    notes = copies.unionByName(classes.select("block", F.lit("classes").alias("kind"), "shard", F.col("classes").alias("body")))
    pieces = by_block.cogroup(notes.groupBy("block")).applyInPandas(partial(_send_passages, length, shards), PIECES)
    runs = stage(spark, pieces.groupBy("shard").applyInPandas(partial(_sort_passages, length), "block long, body binary"))
    notes = copies.unionByName(runs.select("block", F.lit("runs").alias("kind"), F.lit(0).alias("shard"), "body"))
    out = by_block.cogroup(notes.groupBy("block")).applyInPandas(partial(_cut_out, length, keep), RESULT)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without repeated strings of 100 bytes."""
    out = remove_repeats(spark, table(spark, sf_dir, "documents"), length=100, keep=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))
