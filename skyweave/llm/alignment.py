"""Alignment of two tokenizations of the same texts, and how often each pair of tokens is linked.

Each text is encoded twice: by a byte-level BPE (A, given a leading space) and by a piece BPE (B, which
adds the space itself). Both tokenizations cover the same bytes, so their token ends can be merged like two
sorted lists. The merge is done in lockstep for all documents of an Arrow batch at once: one NumPy state
vector holds the A and B pointers of every unfinished document, every step advances all of them, emits one
link per document (the current A and B tokens overlap) and a cut where both tokens end on the same byte;
finished documents are compacted out of the state. Corpus-wide counts of linked id pairs are then Spark
aggregations over the link rows.

Defined results:
  * null, empty texts, and texts whose joined A or B token bytes are not the bytes of space + text (a
    tokenizer that normalises) have no tokens: all counts 0 and ``groups`` ''.
  * null ids are kept; for corpus counts, a document is a distinct ``doc_id`` (all null ids are one), so
    repeated rows count once. Every input row gives one output row, repeats included.
  * very long texts are encoded whole; the lockstep loop then runs as many steps as that text has links.
  * extra columns are not carried: the result has its own columns only, so names cannot clash.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import table
from skyweave.llm.packing import load_encoding
from skyweave.session import stage

# The tokenizer files of the contract.
A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
# Distinct linked pairs up to this many are sent to every task with the links; beyond it they are joined by key.
BROADCAST_PAIRS = 2_000_000
# Characters of text encoded at a time in a worker.
SLICE_CHARS = 1 << 20

_ROWS = "_row long, kind int, doc_id long, n_a long, n_b long, n_groups long, groups string, a int, b int, k long"


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes each byte as one character: printable Latin-1 bytes as themselves, the others
    as the characters from U+0100 on, in byte order."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    shifted = [b for b in range(256) if b not in kept]
    alphabet = {chr(b): b for b in kept}
    alphabet.update({chr(256 + i): b for i, b in enumerate(shifted)})
    return alphabet


def token_bytes(a_path: str, b_path: str) -> tuple[list[bytes], list[bytes]]:
    """The bytes of every A id (byte-level decoded entry) and of every B id (piece, U+2581 as space,
    ``<0xHH>`` as the byte HH)."""
    import sentencepiece
    from tokenizers import Tokenizer

    alphabet = _byte_alphabet()
    vocab = Tokenizer.from_file(a_path).get_vocab(with_added_tokens=True)
    a_bytes = [b""] * (max(vocab.values()) + 1)
    for entry, i in vocab.items():
        a_bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i):
            b_bytes.append(b"")
        else:
            b_bytes.append(piece.replace("▁", " ").encode())
    return a_bytes, b_bytes


def lockstep(a_ends: list[np.ndarray], b_ends: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Merge the token ends of all documents at once.

    ``a_ends[d]`` and ``b_ends[d]`` are the increasing end offsets of document d's tokens, both ending at the
    same total. Each step writes one link for every unfinished document, at its own place in arrays laid
    out in advance (a document has at most n_a + n_b - 1 links). Returns per document the A and B token
    positions of each link in merge order, and whether that link closes a group.
    """
    n = len(a_ends)
    na = np.array([len(x) for x in a_ends], dtype=np.int64)
    nb = np.array([len(x) for x in b_ends], dtype=np.int64)
    a_all = np.concatenate([*a_ends, np.zeros(1, np.int64)]).astype(np.int64)
    b_all = np.concatenate([*b_ends, np.zeros(1, np.int64)]).astype(np.int64)
    a_base = np.concatenate([[0], np.cumsum(na)]).astype(np.int64)
    b_base = np.concatenate([[0], np.cumsum(nb)]).astype(np.int64)
    room = np.concatenate([[0], np.cumsum(na + nb)]).astype(np.int64)
    link_a, link_b = np.zeros(room[-1], np.int64), np.zeros(room[-1], np.int64)
    closes = np.zeros(room[-1], bool)
    steps = np.zeros(n, np.int64)
    live = np.flatnonzero((na > 0) & (nb > 0))
    # the state holds global pointers, their ends, and where each document writes its next link
    ga, gb, out = a_base[live].copy(), b_base[live].copy(), room[live].copy()
    end_a, end_b, first = ga + na[live], gb + nb[live], out.copy()
    while len(live):
        ea, eb = a_all[ga], b_all[gb]
        link_a[out], link_b[out], closes[out] = ga, gb, ea == eb
        ga += ea <= eb
        gb += eb <= ea
        out += 1
        going = (ga < end_a) & (gb < end_b)
        if not going.all():  # compact: finished documents leave the state
            done = ~going
            steps[live[done]] = out[done] - first[done]
            live, ga, gb, out, end_a, end_b, first = (x[going] for x in (live, ga, gb, out, end_a, end_b, first))
    doc_of = np.repeat(np.arange(n), na + nb)
    link_a -= a_base[doc_of]
    link_b -= b_base[doc_of]
    ranges = [slice(room[d], room[d] + steps[d]) for d in range(n)]
    return [link_a[r] for r in ranges], [link_b[r] for r in ranges], [closes[r] for r in ranges]


def groups_text(a_ids: np.ndarray, b_ids: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: A ids, then B ids, of each group in order; ``cut_a``, ``cut_b`` are the
    positions of the last A and B token of each group."""
    return groups_texts([a_ids], [b_ids], [cut_a], [cut_b])[0]


_NAMES: list = [np.zeros(0, dtype=object)]


def _names(size: int) -> np.ndarray:
    """Decimal names of ids below ``size``, as an object array to gather from."""
    if len(_NAMES[0]) < size:
        _NAMES[0] = np.array([str(i) for i in range(max(size, 65536))], dtype=object)
    return _NAMES[0]


def groups_texts(a_ids: list[np.ndarray], b_ids: list[np.ndarray], cut_a: list[np.ndarray], cut_b: list[np.ndarray]) -> list[str]:
    """:func:`groups_text` of many documents at once: every id becomes an item keyed by (document, group,
    side, place), items are sorted by key with NumPy, and each item is followed by its separator (``,``
    inside a side, ``|`` after a group's last A id, ``;`` after its last B id, nothing at the end)."""
    n = len(a_ids)
    na, nb = np.array([len(x) for x in a_ids], np.int64), np.array([len(x) for x in b_ids], np.int64)
    if n == 0 or (na + nb).sum() == 0:
        return [""] * n

    def side(ids: list[np.ndarray], cuts: list[np.ndarray], counts: np.ndarray, mark: str):
        base = np.concatenate([[0], np.cumsum(counts)[:-1]])
        flat = np.concatenate(ids).astype(np.int64) if counts.sum() else np.zeros(0, np.int64)
        closes = np.zeros(len(flat), bool)
        closes[np.concatenate([c + b for c, b in zip(cuts, base)]).astype(np.int64)] = True
        doc = np.repeat(np.arange(n), counts)
        before = np.cumsum(closes) - closes  # closed groups before each id, over all documents
        group = before - (np.cumsum(np.concatenate([[0], [c.size for c in cuts]]))[:-1])[doc]
        place = np.arange(len(flat)) - base[doc]
        return flat, doc, group, place, np.where(closes, mark, ",")

    fa, da, ga, pa, sa = side(a_ids, cut_a, na, "|")
    fb, db, gb, pb, sb = side(b_ids, cut_b, nb, ";")
    order = np.lexsort((np.concatenate([pa, pb]), np.concatenate([np.zeros(len(fa), int), np.ones(len(fb), int)]), np.concatenate([ga, gb]), np.concatenate([da, db])))
    items = np.concatenate([_names(fa.max(initial=0) + 1)[fa], _names(fb.max(initial=0) + 1)[fb]])[order].tolist()
    seps = np.concatenate([sa, sb])[order].tolist()
    bounds = np.concatenate([[0], np.cumsum(na + nb)])
    out = []
    for d in range(n):
        lo, hi = bounds[d], bounds[d + 1]
        if lo == hi:
            out.append("")
            continue
        seps[hi - 1] = ""  # the last B id of the last group
        joined = [None] * (2 * (hi - lo))
        joined[0::2], joined[1::2] = items[lo:hi], seps[lo:hi]
        out.append("".join(joined))
    return out


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of a batch in runs of at most SLICE_CHARS characters of text (a longer text alone), so that a
    worker holds the encodings of little text at a time. Rows go by length, so that the texts of a run,
    which the lockstep merge walks together, are about as long as each other."""
    batch = batch.iloc[np.argsort(batch["text"].str.len().fillna(0).to_numpy(), kind="stable")]
    sizes = batch["text"].str.len().fillna(0).to_numpy()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > SLICE_CHARS:
            yield batch.iloc[start:i]
            start, total = i, 0
        total += size
    if start < len(batch):
        yield batch.iloc[start:]


def _encode_a(fast, slow, text: str) -> list[int]:
    """A's ids of a text: by tiktoken, or by ``tokenizers`` where tiktoken gives up (very long runs of white space)."""
    try:
        return fast.encode_ordinary(text)
    except ValueError:
        return slow.encode(text, add_special_tokens=False).ids


def align_batches(batches: Iterator[pd.DataFrame], a_path: str, b_path: str) -> Iterator[pd.DataFrame]:
    """Per document a summary row (kind 0) and its linked id pairs with their number (kind 1)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task, as Spark counts it
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(a_path)
    a_tok.encode_special_tokens = True  # strings of special tokens inside texts are plain text
    a_fast = load_encoding(a_path)  # the same ids, by merge ranks
    b_tok = sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_bytes, b_bytes = token_bytes(a_path, b_path)
    a_len = np.array([len(x) for x in a_bytes], np.int64)
    b_len = np.array([len(x) for x in b_bytes], np.int64)
    for batch in (piece for whole in batches for piece in _slices(whole)):
        texts = batch["text"].tolist()
        ok = [isinstance(t, str) and t != "" for t in texts]
        use = [t for t, good in zip(texts, ok) if good]
        a_enc = [_encode_a(a_fast, a_tok, " " + t) for t in use]
        b_enc = b_tok.encode(use, num_threads=1) if use else []
        a_ids, b_ids, at = [], [], 0
        for i, good in enumerate(ok):
            if not good:
                a_ids.append(np.zeros(0, np.int64)), b_ids.append(np.zeros(0, np.int64))
                continue
            want = (" " + use[at]).encode()
            ia, ib = a_enc[at], b_enc[at]
            at += 1
            if b"".join(map(a_bytes.__getitem__, ia)) != want or b"".join(map(b_bytes.__getitem__, ib)) != want:
                ia, ib = [], []
            a_ids.append(np.asarray(ia, np.int64)), b_ids.append(np.asarray(ib, np.int64))
        a_ends = [np.cumsum(a_len[x]) for x in a_ids]
        b_ends = [np.cumsum(b_len[x]) for x in b_ids]
        link_a, link_b, closes = lockstep(a_ends, b_ends)
        cut_a, cut_b = [x[c] for x, c in zip(link_a, closes)], [x[c] for x, c in zip(link_b, closes)]
        rows, doc_ids = batch["_row"].to_numpy(), batch["doc_id"]
        n_groups = np.array([len(c) for c in cut_a], np.int64)
        summary = pd.DataFrame({
            "_row": rows, "kind": 0, "doc_id": doc_ids.astype("Int64"),
            "n_a": [len(x) for x in a_ids], "n_b": [len(x) for x in b_ids], "n_groups": n_groups,
            "groups": groups_texts(a_ids, b_ids, cut_a, cut_b),
            "a": None, "b": None, "k": None,
        })
        yield summary
        # linked id pairs of each document with their number, by one unique over the batch
        counts = np.array([len(x) for x in link_a], np.int64)
        if counts.sum() == 0:
            continue
        doc = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
        pair_a = np.concatenate([a[x] for a, x in zip(a_ids, link_a)])
        pair_b = np.concatenate([b[x] for b, x in zip(b_ids, link_b)])
        keys, k = np.unique((doc << 32) | (pair_a << 16) | pair_b, return_counts=True)
        which = keys >> 32
        yield pd.DataFrame({
            "_row": rows[which], "kind": 1, "doc_id": doc_ids.iloc[which].astype("Int64").to_numpy(),
            "n_a": None, "n_b": None, "n_groups": None, "groups": None,
            "a": ((keys >> 16) & 0xFFFF).astype(np.int32), "b": (keys & 0xFFFF).astype(np.int32), "k": k,
        })


def align(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups, groups_sha256.

    ``count_sum`` adds, over the document's links, how many documents hold that id pair linked; ``n_best``
    counts the links whose pair is the most linked of its A id (ties included).
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    aligned = stage(spark, rows.mapInPandas(lambda it: align_batches(it, a_path, b_path), _ROWS))
    links = aligned.where("kind = 1").select("_row", "doc_id", "a", "b", "k")
    # a document is a distinct id: a row's pairs are distinct already, so only links of ids that rows share are
    # made distinct; partial aggregation keeps hot pairs small
    shared = stage(spark, aligned.where("kind = 0").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.col("doc_id").alias("_shared")))
    is_shared = links["doc_id"].eqNullSafe(shared["_shared"])
    once = links.join(shared, is_shared, "left_anti").select("a", "b")
    several = links.join(shared, is_shared, "left_semi").select("doc_id", "a", "b").dropDuplicates().select("a", "b")
    pair_docs = once.unionAll(several).groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))
    best = pair_docs.groupBy("a").agg(F.max("docs").alias("most"))
    pairs = stage(spark, pair_docs.join(best, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).cast("long").alias("best")))
    if pairs.count() <= BROADCAST_PAIRS:  # a measured bound: the pair table goes to every task
        pairs = F.broadcast(pairs)
    per_row = links.join(pairs, ["a", "b"]).groupBy("_row").agg(
        F.sum("k").alias("n_links"), F.sum(F.col("k") * F.col("best")).alias("n_best"), F.sum(F.col("k") * F.col("docs")).alias("count_sum"),
    )
    summary = aligned.where("kind = 0").select("_row", "doc_id", "n_a", "n_b", "n_groups", "groups")
    zero = F.lit(0).cast("long")
    return summary.join(per_row, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups",
        F.coalesce("n_links", zero).alias("n_links"), F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups", F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the two tokenizations of every document, with corpus-wide counts of linked pairs."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return align(spark, docs, public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)).drop("groups")


def groups_digest(groups: str) -> str:
    """The digest of a groups text as the query gives it ('' stays '')."""
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""
