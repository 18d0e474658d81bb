"""Personal data in texts: fixed patterns, and a character tagger trained on what they find.

The base finds e-mail addresses, IP addresses, card numbers and phone numbers by patterns and checks them
(parts at most 255, Luhn, digit counts). The tagger is a character-level bidirectional LSTM with a CRF
over BIO tags of the four kinds, written and trained in NumPy. It learns from the base spans of a bounded
sample of text windows (``TRAIN_WINDOWS``, picked by a hash of their place, so reruns agree), gathered by
Spark from all documents. It then reads every document in overlapping windows of ``WIDTH`` characters
(every ``STRIDE``); the emission scores of the windows that cover a character are averaged, and one
Viterbi pass over each covered stretch of the document decodes the tags, so windows are reconciled
globally. Only windows that hold a digit or ``@`` are read: every kind holds one, and the rest is outside.
Tagged spans of a plausible shape (``plausible``) that overlap no base span are added; base spans always stay.

Defined results:
  * null texts are read as empty: all counts 0, ``spans`` '', ``base_sha256`` the digest of ''.
  * null ids stay null; repeated rows give repeated results; extra columns are not carried.
  * very long texts are read whole; patterns run in linear time (no backtracking over long runs).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import table
from skyweave.session import stage

# Fixed values of the contract: kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# An IP or card match always ends where its digits end, so starting only after a non-digit changes no match
# and keeps long digit runs from being tried again at every position.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Parameters of the tagger.
WIDTH, STRIDE = 48, 24
EMBED, HIDDEN = 12, 20
TRAIN_WINDOWS = 4000  # bound of the labelled sample
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.02, 7
TAGS = ("O", *[f"{p}-{k}" for k in KINDS for p in ("B", "I")])
VOCAB = 130  # code points below 128 as themselves, 128 for all others, 129 for padding


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches of the e-mail pattern, found from each ``@``.

    The local part cannot hold ``@``, so a match ends its local part right before an ``@``; from the
    position the scan has reached, the leftmost start is the start of the run of local characters there.
    """
    at, scan = text.find("@"), 0
    while at >= 0:
        start = at
        while start > scan and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1)
        if start < at and domain:
            yield start, domain.end()
            scan = domain.end()
            at = text.find("@", scan)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Checked pattern matches of all kinds, ordered by start, then kind."""
    if not text:
        return []
    found = [("email", a, b) for a, b in emails(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() and c.isascii() for c in m.group()) <= 15:
            found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def encode(text: str) -> np.ndarray:
    cps = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.where(cps < 128, cps, 128).astype(np.int64)


def tag_ids(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        tags[a:b] = 2 + 2 * k
        tags[a] = 1 + 2 * k
    return tags


# ---------------------------------------------------------------- the network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def init_model(seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    k = len(TAGS)
    m = {"emb": rng.normal(0, 0.3, (VOCAB, EMBED)), "out": rng.normal(0, 0.1, (2 * HIDDEN, k)), "out_b": np.zeros(k)}
    for d in ("f", "b"):
        m[f"wx_{d}"] = rng.normal(0, 1 / np.sqrt(EMBED), (EMBED, 4 * HIDDEN))
        m[f"wh_{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        m[f"b_{d}"] = np.zeros(4 * HIDDEN)
        m[f"b_{d}"][HIDDEN : 2 * HIDDEN] = 1.0  # forget gates start open
    m["trans"], m["start"], m["end"] = np.zeros((k, k)), np.zeros(k), np.zeros(k)
    return m


def _lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool):
    """One direction over (batch, time, embed); returns hidden states and, if ``keep``, what backprop needs."""
    n, t, _ = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    hs, cache = np.zeros((n, t, HIDDEN)), []
    pre = x @ wx + b
    for s in range(t):
        z = pre[:, s] + h @ wh
        i, f, o, g = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN : 2 * HIDDEN]), _sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        c_prev, h_prev = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        hs[:, s] = h
        if keep:
            cache.append((i, f, o, g, c_prev, h_prev, tc))
    return hs, cache


def _lstm_back(dhs: np.ndarray, x: np.ndarray, wx: np.ndarray, wh: np.ndarray, cache) -> tuple[np.ndarray, ...]:
    n, t, _ = x.shape
    dwx, dwh, db = np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN)
    dx = np.zeros_like(x)
    dh_next, dc_next = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    for s in range(t - 1, -1, -1):
        i, f, o, g, c_prev, h_prev, tc = cache[s]
        dh = dhs[:, s] + dh_next
        dc = dc_next + dh * o * (1 - tc**2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c_prev * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        dwx += x[:, s].T @ dz
        dwh += h_prev.T @ dz
        db += dz.sum(0)
        dx[:, s] = dz @ wx.T
        dh_next, dc_next = dz @ wh.T, dc * f
    return dx, dwx, dwh, db


def emissions(m: dict[str, np.ndarray], ids: np.ndarray, keep: bool = False):
    """Emission scores (batch, time, tags) of windows of character ids."""
    x = m["emb"][ids]
    hf, cf = _lstm(x, m["wx_f"], m["wh_f"], m["b_f"], keep)
    hb, cb = _lstm(x[:, ::-1], m["wx_b"], m["wh_b"], m["b_b"], keep)
    hcat = np.concatenate([hf, hb[:, ::-1]], axis=2)
    e = hcat @ m["out"] + m["out_b"]
    return (e, (x, hcat, cf, cb)) if keep else e


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_loss(m: dict[str, np.ndarray], e: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """Mean negative log-likelihood of tag paths ``y`` and its gradients, by forward-backward."""
    n, t, k = e.shape
    tr = m["trans"]
    alpha = np.zeros((n, t, k))
    alpha[:, 0] = m["start"] + e[:, 0]
    for s in range(1, t):
        alpha[:, s] = _logsumexp(alpha[:, s - 1, :, None] + tr[None], 1) + e[:, s]
    beta = np.zeros((n, t, k))
    beta[:, -1] = m["end"]
    for s in range(t - 2, -1, -1):
        beta[:, s] = _logsumexp(tr[None] + (e[:, s + 1] + beta[:, s + 1])[:, None, :], 2)
    log_z = _logsumexp(alpha[:, -1] + m["end"], 1)
    rows = np.arange(n)
    gold = m["start"][y[:, 0]] + m["end"][y[:, -1]] + e[rows[:, None], np.arange(t)[None], y].sum(1) + tr[y[:, :-1], y[:, 1:]].sum(1)
    marg = np.exp(alpha + beta - log_z[:, None, None])
    de = marg.copy()
    de[rows[:, None], np.arange(t)[None], y] -= 1
    pair = np.exp(alpha[:, :-1, :, None] + tr[None, None] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - log_z[:, None, None, None])
    dtr = pair.sum((0, 1))
    np.add.at(dtr, (y[:, :-1], y[:, 1:]), -1)
    dstart = marg[:, 0].sum(0) - np.bincount(y[:, 0], minlength=k)
    dend = marg[:, -1].sum(0) - np.bincount(y[:, -1], minlength=k)
    return float((log_z - gold).mean()), {"trans": dtr / n, "start": dstart / n, "end": dend / n}, de / n


def train(windows: np.ndarray, labels: np.ndarray, seed: int = SEED) -> dict[str, np.ndarray]:
    """Fit the tagger on windows of character ids and their tags by Adam."""
    m = init_model(seed)
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for s in range(0, len(order), BATCH):
            pick = order[s : s + BATCH]
            ids, y = windows[pick], labels[pick]
            e, (x, hcat, cf, cb) = emissions(m, ids, keep=True)
            _, grads, de = crf_loss(m, e, y)
            grads["out"] = hcat.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, de.shape[2])
            grads["out_b"] = de.sum((0, 1))
            dh = de @ m["out"].T
            dxf, grads["wx_f"], grads["wh_f"], grads["b_f"] = _lstm_back(dh[:, :, :HIDDEN], x, m["wx_f"], m["wh_f"], cf)
            dxb, grads["wx_b"], grads["wh_b"], grads["b_b"] = _lstm_back(dh[:, ::-1, HIDDEN:], x[:, ::-1], m["wx_b"], m["wh_b"], cb)
            dx = dxf + dxb[:, ::-1]
            grads["emb"] = np.zeros_like(m["emb"])
            np.add.at(grads["emb"], ids, dx)
            step += 1
            for k, g in grads.items():
                g = np.clip(g, -5, 5)
                mo, ve = moments[k]
                mo *= 0.9
                mo += 0.1 * g
                ve *= 0.999
                ve += 0.001 * g * g
                m[k] -= RATE * (mo / (1 - 0.9**step)) / (np.sqrt(ve / (1 - 0.999**step)) + 1e-8)
    return m


def viterbi(m: dict[str, np.ndarray], e: np.ndarray) -> np.ndarray:
    """Best tag path of one stretch of emission scores (time, tags)."""
    t = len(e)
    score = m["start"] + e[0]
    back = np.zeros((t, len(TAGS)), np.int64)
    for s in range(1, t):
        cand = score[:, None] + m["trans"]
        back[s] = cand.argmax(0)
        score = cand.max(0) + e[s]
    path = np.zeros(t, np.int64)
    path[-1] = int((score + m["end"]).argmax())
    for s in range(t - 1, 0, -1):
        path[s - 1] = back[s, path[s]]
    return path


def tagged_spans(m: dict[str, np.ndarray], text: str) -> list[tuple[str, int, int]]:
    """Spans the tagger finds in a whole text, windows reconciled by averaged emissions and one Viterbi pass a stretch."""
    n = len(text)
    if n == 0:
        return []
    ids = encode(text)
    starts = np.arange(0, max(n - WIDTH, 0) + STRIDE, STRIDE)
    starts = np.unique(np.minimum(starts, max(n - WIDTH, 0)))
    marks = np.concatenate([[0], np.cumsum((ids >= 48) & (ids <= 57) | (ids == 64))])
    starts = starts[marks[np.minimum(starts + WIDTH, n)] > marks[starts]]
    if len(starts) == 0:
        return []
    padded = np.concatenate([ids, np.full(WIDTH, VOCAB - 1)])
    windows = padded[starts[:, None] + np.arange(WIDTH)[None]]
    e = emissions(m, windows)
    total, cover = np.zeros((n + WIDTH, len(TAGS))), np.zeros(n + WIDTH)
    for at, scores in zip(starts, e):
        total[at : at + WIDTH] += scores
        cover[at : at + WIDTH] += 1
    covered = cover[:n] > 0
    spans = []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    for a, b in zip(edges[::2], edges[1::2]):
        path = viterbi(m, total[a:b] / cover[a:b, None])
        s = None
        for i, tag in enumerate(path.tolist() + [0]):
            kind = (tag - 1) // 2 if tag else None
            begins = tag and (tag % 2 == 1 or s is None or kind != s[0])
            if s is not None and (not tag or begins):
                spans.append((KINDS[s[0]], a + s[1], a + i))
                s = None
            if begins:
                s = (kind, i)
    return spans


def plausible(kind: str, piece: str) -> bool:
    """What a tagged span of each kind must hold to be added: an ``@`` for e-mail; for the others no letters
    and the checks of the base (four parts at most 255; 14 to 19 digits passing Luhn; 10 to 15 digits), so
    the tagger adds what the patterns miss by its writing (other separators, no ``+``), not by its value."""
    if kind == "email":
        return "@" in piece
    if re.search("[A-Za-z]", piece):
        return False
    digits = re.sub("[^0-9]", "", piece)
    if kind == "ip":
        parts = re.findall("[0-9]+", piece)
        return len(parts) == 4 and all(int(p) <= 255 for p in parts)
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return 10 <= len(digits) <= 15


def all_spans(m: dict[str, np.ndarray], text: str | None) -> tuple[list, list]:
    """Base spans, and base spans with the tagger's plausible spans that overlap none of them."""
    base = base_spans(text)
    tagged = [s for s in tagged_spans(m, text or "") if plausible(s[0], (text or "")[s[1] : s[2]])]
    extra = [s for s in tagged if not any(s[1] < b and a < s[2] for _, a, b in base)]
    return base, sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0])))


def training_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows around base spans and windows at every 16th stride, with tags and a hash of their place."""
    for batch in batches:
        out = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            if not text:
                continue
            spans = base_spans(text)
            places = {max(0, min(a - WIDTH // 3, len(text) - WIDTH)) for _, a, _ in spans}
            places |= set(range(0, max(len(text) - WIDTH, 0) + 1, 16 * STRIDE))
            tags = tag_ids(len(text), spans)
            for at in sorted(places):
                piece = text[at : at + WIDTH]
                if len(piece) == WIDTH:
                    key = hashlib.blake2b(f"{doc_id}:{at}".encode(), digest_size=8).digest()
                    out.append((int.from_bytes(key, "big") >> 1, piece, tags[at : at + WIDTH].tolist(), bool(spans)))
        yield pd.DataFrame(out, columns=["key", "piece", "tags", "labelled"])


def fit(spark: SparkSession, docs: DataFrame) -> dict[str, np.ndarray]:
    """Train on at most TRAIN_WINDOWS windows, half of them holding base spans where there are so many."""
    windows = stage(spark, docs.select("doc_id", "text").mapInPandas(training_windows, "key long, piece string, tags array<int>, labelled boolean"))
    windows = windows.where(F.exists("tags", lambda t: t > 0)).orderBy("key").limit(TRAIN_WINDOWS // 2).unionByName(
        windows.where(~F.exists("tags", lambda t: t > 0)).orderBy("key").limit(TRAIN_WINDOWS // 2)
    )
    rows = windows.collect()
    if not rows:
        return init_model()
    ids = np.stack([encode(r.piece) for r in rows])
    tags = np.array([r.tags for r in rows], np.int64)
    return train(ids, tags)


def find_pii(spark: SparkSession, docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, base spans and all spans (as kind:start:end lists) of every row."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, spans = zip(*[all_spans(model, t) for t in batch["text"]]) if len(batch) else ((), ())
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                **{f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in KINDS},
                "base": [joined(b) for b in base], "spans": [joined(s) for s in spans],
            })

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(scan, schema)


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: base counts, a digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    found = find_pii(spark, docs, fit(spark, docs))
    return found.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
