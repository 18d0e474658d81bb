"""Alignment of tokenizations, spelling variants and personal data against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyweave.llm import alignment, pii, variants

A_PATH, B_PATH = public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE)

# alignment ----------------------------------------------------------------------------------------------


def plain_alignment(rows):
    """Overlapping pairs by looking at every pair of tokens; groups by common ends; counts over distinct ids."""
    a_tok = Tokenizer.from_file(A_PATH)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a_bytes, b_bytes = alignment.token_bytes(A_PATH, B_PATH)
    per_doc = []
    for doc_id, text in rows:
        a, b = [], []
        if text:
            a = a_tok.encode(" " + text, add_special_tokens=False).ids
            b = b_tok.encode(text)
            want = (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
                a, b = [], []

        def ranges(ids, table):
            out, at = [], 0
            for i in ids:
                out.append((at, at + len(table[i])))
                at += len(table[i])
            return out

        ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
        links = [(a[i], b[j]) for i, (s, e) in enumerate(ra) for j, (t, f) in enumerate(rb) if s < f and t < e]
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, sa, sb = [], 0, 0
        for end in ends:
            ea = next(i for i, (_, e) in enumerate(ra) if e == end)
            eb = next(j for j, (_, e) in enumerate(rb) if e == end)
            groups.append(",".join(map(str, a[sa : ea + 1])) + "|" + ",".join(map(str, b[sb : eb + 1])))
            sa, sb = ea + 1, eb + 1
        per_doc.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    holders = Counter()
    seen = set()
    for doc_id, *_, links, _ in per_doc:
        for pair in set(links):
            if (doc_id, pair) not in seen:
                seen.add((doc_id, pair))
                holders[pair] += 1
    most = Counter()
    for (x, _), n in holders.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, na, nb, ng, links, groups in per_doc:
        out.append((doc_id, na, nb, ng, len(links), sum(holders[p] == most[p[0]] for p in links), sum(holders[p] for p in links), groups))
    return sorted(out, key=repr)


ALIGN_TEXTS = [
    None, "", "one", "Hello  world\n\nx 😀 <|endoftext|> <s> </s>", "naïve café — ünïcode", "\t tabs\tand  spaces ",
    "x" * 3000, "the same text", "the same text", "numbers 1234567 and 3.14159", "日本語のテキスト",
]


def test_alignment_matches_plain_pairs(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(5000 + i, t) for i, t in enumerate(ALIGN_TEXTS)] + [(None, "null id text"), (None, "null id text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = alignment.align(spark, df.repartition(3), A_PATH, B_PATH).collect()
    mine = sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got), key=repr)
    assert mine == plain_alignment(rows)
    for r in got:
        assert r.groups_sha256 == alignment.groups_digest(r.groups)
        assert r.n_links == (r.n_a + r.n_b - r.n_groups if r.n_a else 0)


def test_lockstep_against_two_pointers():
    rng = np.random.default_rng(3)
    a_ends, b_ends = [], []
    for n in [0, 1, 5, 40, 300]:
        total = max(n, 1) * 4
        a_ends.append(np.sort(rng.choice(np.arange(1, total), size=min(n, total - 1), replace=False)).tolist() + [total])
        b_ends.append(np.sort(rng.choice(np.arange(1, total), size=min(2 * n, total - 1), replace=False)).tolist() + [total])
    link_a, link_b, closes = alignment.lockstep([np.array(x) for x in a_ends], [np.array(x) for x in b_ends])
    for ea, eb, la, lb, cl in zip(a_ends, b_ends, link_a, link_b, closes):
        i = j = 0
        want = []
        while i < len(ea) and j < len(eb):
            want.append((i, j, ea[i] == eb[j]))
            i, j = i + (ea[i] <= eb[j]), j + (eb[j] <= ea[i])
        assert list(zip(la.tolist(), lb.tolist(), cl.tolist())) == want


def test_alignment_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, groups string, n_a int")
    assert alignment.align(spark, empty, A_PATH, B_PATH).count() == 0
    clash = spark.createDataFrame([(1, "a b", "x", 3)], "doc_id long, text string, groups string, n_a int")
    row = alignment.align(spark, clash, A_PATH, B_PATH).first()
    assert row.n_a == 2 and row.n_groups == 2


def test_alignment_long_white_space(spark):
    text = " " * 200_000 + "end\n" * 1000
    row = alignment.align(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), A_PATH, B_PATH).first()
    assert row.n_links == row.n_a + row.n_b - row.n_groups or row.n_a == 0


# spelling variants ---------------------------------------------------------------------------------------


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for m in re.finditer("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group())
            word = low
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{low}".encode())
                if h % 31 == 0:
                    word = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        top = min(close, key=lambda v: (-words[v], v)) if close else None
        form = top if top and words[top] >= 10 * n else None
        out[w] = (form, n, len(close), words[form] if form else None)
    result = {}
    for w, (form, n, k, fn) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result[w] = (form, root, n, k, fn)
    return result


def variant_rows():
    rows = [(1, "aaaaaaab " * 2 + "aaaaaabb " * 20 + "aaaaabbb " * 200), (2, "Kitchens KITCHENS kitchenz kitchen kitchen"), (3, None), (None, "kitchens kitchens")]
    rows += [(4, "tiebreak tiebreaks tiebreaky " * 3 + "tiebreakx " * 30 + "tiebreakz " * 30), (5, "àéîõüàéîõü àéîõüàéîõü Àéîõüàéîõü short words only")]
    rows += [(10 + i, "misspelt misspelled mispelled misspeled " * (i % 3 + 1)) for i in range(12)]
    return rows


@pytest.mark.parametrize("tile", [512, 2])
def test_variants_match_plain(spark, docs, monkeypatch, tile):
    monkeypatch.setattr(variants, "TILE", tile)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()] + variant_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.spelling_variants(spark, df).collect()}
    want = plain_variants(rows)
    assert got == want
    assert want["aaaaaaab"][1] == "aaaaabbb"  # a chain of two forms
    assert want["tiebreaks"][0] == "tiebreakx"  # ties go to the smaller word


def test_near_pairs_of_padded_matrices():
    u = ["abcdefg", "abcdefgh", "bcdefgh", "abcxefg", "abcdefg"]
    i, j = variants.near_pairs(u, u)
    found = {(u[a], u[b]) for a, b in zip(i, j)}
    assert ("abcdefg", "abcdefgh") in found and ("abcdefgh", "bcdefgh") in found and ("abcdefg", "abcxefg") in found
    assert ("abcdefg", "abcdefg") not in found and ("bcdefgh", "abcdefg") not in found


def test_variants_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, word string")
    assert variants.spelling_variants(spark, empty).count() == 0


# personal data -------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d)))
    return s % 10 == 0


def plain_base(text):
    spans = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            g, digits = m.group(), re.sub("[^0-9]", "", m.group())
            checks = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in g.split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15,
            }
            ok = checks[kind]()
            if ok:
                spans.append((kind, m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PII_TEXTS = [
    None, "", "mail jane.doe+x@mail.example.org, or a@b.c now", "a@b @c.d x@y z.q@host.co.uk.", "@@a@b.cc",
    "ip 192.168.0.1 and 256.1.1.1 and 1.2.3.4.5 and 10.0.0.255x", "card 4111 1111 1111 1111 or 4111-1111-1111-1112",
    "4539578763621486 and 45395787636214861234567", "call +1 (555) 123-4567 or +44 20 7946 0958 or +1 555",
    "+12345678901234567 too long", "mixed 1.2.3.4@x.org 4111111111111111", "ünïcode 😀 a@b.de 😀 +49 30 1234567",
]


@pytest.mark.parametrize("text", PII_TEXTS)
def test_pii_base_matches_plain_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


def test_pii_patterns_are_linear_on_long_runs():
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "1." * 100_000 + " " + "+" + "1 " * 100_000
    start = time.time()
    pii.base_spans(text)
    assert time.time() - start < 20
    assert pii.base_spans("x" * 5000 + "@b.cd") == [("email", 0, 5005)]


def test_pii_tagger_learns_and_keeps_base(spark):
    rng = np.random.default_rng(1)
    texts = []
    for i in range(300):
        ip = ".".join(str(x) for x in rng.integers(0, 256, 4))
        texts.append(f"note {i}: write to user{i}@mail{i % 7}.example.com from {ip} today, page {i} of 300")
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, None), (999, "")], "doc_id long, text string")
    model = pii.fit(spark, df)
    got = pii.find_pii(spark, df, model).collect()
    for r in got:
        base = pii.joined(pii.base_spans(texts[r.doc_id] if r.doc_id is not None and r.doc_id < 300 else None))
        assert r.base == base
        assert set(filter(None, r.spans.split(","))) >= set(filter(None, base.split(",")))
    # the tagger alone finds most base spans of held texts
    found = total = 0
    for t in texts[:40]:
        mine = set(pii.tagged_spans(model, t))
        for s in pii.base_spans(t):
            total += 1
            found += s in mine
    assert found >= 0.8 * total


def test_pii_crf_gradient():
    m = pii.init_model(3)
    rng = np.random.default_rng(0)
    e = rng.normal(size=(2, 5, len(pii.TAGS)))
    y = rng.integers(0, len(pii.TAGS), (2, 5))
    m["trans"] = rng.normal(size=m["trans"].shape)
    loss, grads, de = pii.crf_loss(m, e, y)
    eps = 1e-6
    e2 = e.copy()
    e2[1, 2, 3] += eps
    assert abs((pii.crf_loss(m, e2, y)[0] - loss) / eps - de[1, 2, 3]) < 1e-4
    m2 = {**m, "trans": m["trans"].copy()}
    m2["trans"][4, 1] += eps
    assert abs((pii.crf_loss(m2, e, y)[0] - loss) / eps - grads["trans"][4, 1]) < 1e-4


def test_pii_query_digest(spark, docs):
    rows = pii.find_pii(spark, docs, pii.init_model()).collect()
    assert len(rows) == docs.count()
    assert hashlib.sha256(b"").hexdigest() == hashlib.sha256("".encode()).hexdigest()


# packing on very long white space ------------------------------------------------------------------------


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "\t" * 2_000_000, "a" * 2_000_000])
def test_packing_ids_on_very_long_runs(text):
    from skyweave.llm import packing

    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.encode_ids(packing.load_encoding(path), path, text).tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_packing_query_survives_a_long_blank_run(spark):
    from skyweave.llm import packing

    df = spark.createDataFrame([(1, " " * 1_200_000 + "end"), (2, "short text")], "doc_id long, text string")
    rows = packing.pack(spark, df, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024).collect()
    per_doc = Counter()
    for r in rows:
        per_doc[r.doc_id] += r.length
    assert per_doc[2] == 3 and per_doc[1] == rows[[r.doc_id for r in rows].index(1)].doc_tokens


def test_small_groups_need_no_matrices(monkeypatch):
    """Groups of a few words, which most blocks are, give the pairs of the matrices without building any."""
    import itertools
    import random

    import pandas as pd

    from skyweave.llm import variants

    pick = random.Random(5)
    words = ["".join(pick.choice("abé") for _ in range(pick.randrange(5))) for _ in range(300)]
    for u, v in itertools.combinations(sorted(set(words)), 2):
        assert variants.one_edit(u, v) == variants.one_edit(v, u) == bool(len(variants.near_pairs([u], [v])[0]))
    monkeypatch.setattr(variants, "near_pairs", None)
    rows = [("abcd", 5), ("abce", 3), ("xbcd", 2)]
    pdf = pd.DataFrame([(w, n, "p", 4, k, 0, 0, True) for k in ("ab", "ac") for w, n in rows], columns=["word", "n", "side", "len", "key", "t1", "t2", "first"])
    found = pd.concat(variants.compare_sorted(iter([pdf])))
    want = {("abcd", "abce", 3), ("abce", "abcd", 5), ("abcd", "xbcd", 2), ("xbcd", "abcd", 5)}
    assert set(found.itertuples(index=False, name=None)) == want and len(found) == 2 * len(want)


def test_pairs_of_shared_ids_count_once(spark):
    """Rows that share an id (or have none) are one document in the counts; other rows need no distinct step."""
    import public_tokenizers

    from skyweave.llm import alignment

    paths = public_tokenizers.path(alignment.A_FILE), public_tokenizers.path(alignment.B_FILE)
    rows = [(1, "hello"), (1, "hello"), (2, "hello"), (None, "hello"), (None, "hello"), (3, None), (3, "hello")]
    out = alignment.align(spark, spark.createDataFrame(rows, "doc_id long, text string"), *paths).collect()
    assert len(out) == len(rows) and {r.count_sum for r in out if r.n_links} == {4 * r.n_links for r in out if r.n_links}
    alone = alignment.align(spark, spark.createDataFrame([(1, "hello"), (2, "hello")], "doc_id long, text string"), *paths)
    assert [r.count_sum for r in alone.collect()] == [2 * r.n_links for r in alone.collect()]
