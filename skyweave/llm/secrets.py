"""Finding secrets: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm.common import small_batches, table

KINDS = ("assign", "access", "hex", "entropy")
SPANS = "array<struct<kind:string,start:int,end:int>>"
# The patterns of the base kinds. Runs of hex digits are maximal, so the length can be asked for
# in the pattern; an assignment is matched at any length first, since a short one uses up its text.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# A character class: its maximal runs are candidates. Windows of `width` characters are secret with at least `bits`
# of entropy, at least `digits` digits and at least `breaks` neighbours that words and numbers seldom have. The wide
# windows are for keys that look like words with numbers, the others for short ones and those of letters only.
CLASSES = (
    {"name": "hex", "run": re.compile(r"[0-9A-Fa-f]{20,}"), "width": 20, "bits": 2.9, "digits": 5},
    {"name": "base64", "run": re.compile(r"[0-9A-Za-z+/_=-]{20,}"), "width": 20, "bits": 3.7, "digits": 2},
    {"name": "short hex", "run": re.compile(r"[0-9A-Fa-f]{16,}"), "width": 16, "bits": 2.7, "digits": 0, "breaks": 3},
    {"name": "short base64", "run": re.compile(r"[0-9A-Za-z+/_=-]{16,}"), "width": 16, "bits": 3.0, "digits": 0, "breaks": 9},
)
# Strings that are no secrets although they look random: what matches one of these is cut out of a candidate,
# and what is left on either side is looked at.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",  # UUID
    r"^[0-9_=+/-]+$",  # numbers, dates, rules
    r"(?i)0123456789|abcdefghij|example|placeholder|xxxxxx",  # stated stand-ins
)
# The 150 most frequent letter pairs of English prose, 87 % of its pairs; of random pairs they are 22 %.
COMMON = frozenset(
    "ab ac ad ag ai al am an ap ar as at ba be bj bl bu ca ce ch ci ck cl co ct da de di do ea ec ed ee ef el em en ep er es et ex fa "
    "fi fo fr fu ge gi ha he hi ho ic id ie ig il im in io ir is it iv je ke la le li ll lo ls lt lu ly ma me mo mp na nc nd ne ng ni "
    "no ns nt ob oc od ol om on op or os ot ou ow pa pe pl po pr pt qu ra re rg ri rm rn ro rr rs rt ru ry se si so sp ss st su ta te "
    "th ti to tr ts tt tu ty ue ul um un up ur us ut va ve wh wi xt".split()
)


def unusual(a: str, b: str) -> bool:
    """If ``b`` seldom follows ``a`` in words, numbers and names joined from them: a letter beside a digit, a capital
    after a small letter, or a pair not in ``COMMON``. Repeats and the order of the alphabet are usual, and so is
    what stands beside a separator."""
    if not (a.isalnum() and b.isalnum()) or a.isdigit() and b.isdigit():
        return False
    if a.isdigit() or b.isdigit() or a.islower() and b.isupper():
        return True
    return abs(ord(a) - ord(b)) > 1 and (a + b).lower() not in COMMON


def entropy_spans(candidate: str, width: int, bits: float, digits: int, breaks: int = 0) -> Iterator[tuple[int, int]]:
    """Unions of the windows of ``candidate`` that reach ``bits``, ``digits`` and ``breaks``; counts change by two
    characters a step."""
    gain = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    inner = 0.0  # sum of c log2 c over the window
    number = 0
    odd = [False, *map(unusual, candidate, candidate[1:])] if breaks else [False] * len(candidate)  # after the character before
    broken = 0
    start = end = -1
    for i, char in enumerate(candidate):
        c = counts.get(char, 0)
        broken += odd[i]
        if i >= width:
            old = candidate[i - width]
            n = counts[old]
            inner += gain[n - 1] - gain[n]
            counts[old] = n - 1
            number -= old.isdigit()
            broken -= odd[i - width + 1]
            c = counts.get(char, 0)
        counts[char] = c + 1
        inner += gain[c + 1] - gain[c]
        number += char.isdigit()
        if i >= width - 1 and number >= digits and broken >= breaks and math.log2(width) - inner / width >= bits:
            low = i - width + 1
            if start >= 0 and low <= end:
                end = i + 1
            else:
                if start >= 0:
                    yield start, end
                start, end = low, i + 1
    if start >= 0:
        yield start, end


def pieces(run: str, allowed: re.Pattern | None) -> Iterator[tuple[int, str]]:
    """Where what is left of a candidate begins, and what it is, without the matches of ``allowed``."""
    at = 0
    for m in allowed.finditer(run) if allowed else ():
        yield at, run[at : m.start()]
        at = m.end()
    yield at, run[at:]


def find_spans(text: str | None, classes: Iterable[dict] = CLASSES, allowed: re.Pattern | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start, then kind as in ``KINDS``; null texts have none.

    Positions count code points, ends are exclusive. Spans of one pattern never overlap each other;
    entropy spans are found by themselves and may overlap those of the patterns and each other. ``allowed`` is
    cut out of the candidates of the entropy scan only.
    """
    if not text:
        return []
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    extra: set[tuple[int, int]] = set()
    for kind in classes:
        for m in kind["run"].finditer(text):
            for at, piece in pieces(m.group(), allowed):
                at += m.start()
                extra.update((a + at, b + at) for a, b in entropy_spans(piece, kind["width"], kind["bits"], kind["digits"], kind.get("breaks", 0)))
    found += [("entropy", a, b) for a, b in extra]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(spark: SparkSession, docs: DataFrame, allowed: tuple[str, ...] = ALLOWED, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``secrets``: kind, start and end of every secret of the text, in order.

    A row is looked at by itself, so nothing is shuffled. Null and empty texts give an empty list; all
    columns and repeated rows stay. A column named ``secrets`` is replaced. An empty table gives no rows.
    """
    small_batches(spark)
    pattern = "|".join(f"(?:{p})" if not p.startswith("(?i)") else f"(?i:{p[4:]})" for p in allowed)

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        let = re.compile(pattern) if pattern else None
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t, CLASSES, let)] for t in texts], dtype=object)

    return docs.withColumn("secrets", spans(F.col(text_col)))


def redact(spark: SparkSession, docs: DataFrame, mark: str = "[secret]", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping secrets become one mark.

    Texts without a secret, null and empty ones stay as they are.
    """
    hidden = find_secrets(spark, docs, text_col=text_col)

    @F.pandas_udf("string")
    def hide(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(texts, spans):
            if found is not None and len(found):
                pieces, at = [], 0
                for s in found:
                    if s["start"] >= at:
                        pieces += [text[at : s["start"]], mark]
                    at = max(at, s["end"])
                text = "".join(pieces) + text[at:]
            out.append(text)
        return pd.Series(out, dtype=object)

    return hidden.withColumn(text_col, F.when(F.size("secrets") > 0, hide(F.col(text_col), F.col("secrets"))).otherwise(F.col(text_col))).drop("secrets")


def _joined(spans) -> str:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, as counts, a digest of the base spans, and all spans."""
    found = find_secrets(spark, table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"),
    )
