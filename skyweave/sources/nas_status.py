"""Airport status XML, whose blocks are open-ended.

Any element with an ``ARPT`` child is one programme, whatever its container is called and however deep it
lies, so blocks added later still produce rows. The XML text of a page is cut into tags and texts, and one walk
over them with a stack of open elements finds programmes and their leaves, so work grows with the text; text
stays text. Nothing is shuffled, and a task holds one page and a piece of its rows at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions import normalise as N

# Comments, CDATA, instructions, tags (quotes may hold angle brackets), text.
TOKEN = re.compile(r"""<!--[\s\S]*?-->|<!\[CDATA\[[\s\S]*?\]\]>|<\?[\s\S]*?\?>|<(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>|[^<]+""")
ATTRIBUTE = re.compile(r"""[^\s=<>"'/]+\s*=\s*("[^"]*"|'[^']*')""", re.ASCII)
NAME = re.compile(r"<([^\s/>]+)", re.ASCII)
NUMBER = re.compile(r"&#(x?[0-9A-Fa-f]+);")
BLANKS = " \t\n\x0b\f\r"
PIECE = 8192  # rows handed back at a time

# Leaf key to column (fixed values).
NAMED_LEAVES = {
    "reason": "reason",
    "avg": "avg_delay",
    "max": "max_delay",
    "min": "min_delay",
    "arrival_departure_arrival_min": "arrival_delay_min",
    "arrival_departure_arrival_max": "arrival_delay_max",
    "arrival_departure_departure_min": "departure_delay_min",
    "arrival_departure_departure_max": "departure_delay_max",
    "end_time": "end_time",
    "reopen": "reopen_time",
}

ROWS = "_captured_at bigint, _page_id string, _ordinal bigint, observed_at bigint, " + ", ".join(
    f"{c} string" for c in ("airport", "delay_type", *NAMED_LEAVES.values(), "extra")
)


def _unescaped(text: str) -> str:
    """Text with entities resolved; the ampersand comes last, since others may follow from it."""
    if "&" not in text:
        return text
    for number in dict.fromkeys(NUMBER.findall(text)):
        if number.startswith("x"):
            code = int(number[1:9] or "0", 16)
        else:
            code = int(re.match("[0-9]*", number)[0] or "0")
        valid = code < 0xD800 or 0xDFFF < code <= 0x10FFFF
        text = text.replace(f"&#{number};", chr(code) if valid else "\ufffd")
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = text.replace(f"&{name};", char)
    return text


@lru_cache(maxsize=4096)
def _opened(tag: str) -> tuple[str, str]:
    """Name and key of the element that a tag opens; attribute values are part of the key."""
    found = NAME.match(tag)
    name = found[1] if found else ""
    return name, name.lower() + "".join("_" + _unescaped(v[1:-1]).lower() for v in ATTRIBUTE.findall(tag))


def _texts(xml: str) -> list[tuple[tuple[int, ...], tuple[str, ...], str, str]]:
    """Texts below ``Delay_type`` in order: ids and keys of the elements around each, the innermost's name, the value."""
    names: list[str] = []
    keys: list[str] = []
    ids: list[int] = []
    texts = []
    for at, token in enumerate(TOKEN.findall(xml)):
        if token[0] != "<":
            value = _unescaped(token).strip(BLANKS)
        elif token.startswith("<![CDATA["):
            value = token[9:-3].strip(BLANKS)
        elif token[1] in "!?" or token.endswith("/>"):  # comments, declarations, and elements that hold nothing
            continue
        elif token[1] == "/":
            if ids:
                names.pop(), keys.pop(), ids.pop()
            continue
        else:
            name, key = _opened(token)
            names.append(name), keys.append(key), ids.append(at)
            continue
        if value and len(ids) > 1 and names[1] == "Delay_type":
            texts.append((tuple(ids), tuple(keys), names[-1], value))
    return texts


def _programmes(xml: str) -> list[tuple[str, dict[str, str]]]:
    """Title and leaves (the last value per key) of every programme of a page, in order of their first ``ARPT``."""
    texts = _texts(xml)
    titles = {ids[1]: value for ids, _, name, value in texts if len(ids) == 3 and name == "Name"}
    found: dict[int, tuple[str, dict[str, str]]] = {}
    for ids, _, name, _ in texts:
        if len(ids) > 2 and name == "ARPT":
            found.setdefault(ids[-2], (titles.get(ids[1], ""), {}))
    for ids, keys, _, value in texts:
        for depth, element in enumerate(ids, 1):
            if element in found and depth < len(ids):
                key = "_".join(keys[depth:])
                if key:
                    found[element][1][key] = value
    return list(found.values())


def programme_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per programme of the pages in ``batches``, in pieces of about ``PIECE`` rows."""
    schema = pa.schema([("_captured_at", pa.int64()), ("_page_id", pa.string()), ("_ordinal", pa.int64()), ("observed_at", pa.int64()),
                        *[(c, pa.string()) for c in ("airport", "delay_type", *NAMED_LEAVES.values(), "extra")]])
    rows: list[tuple] = []

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        columns = (batch.column(c) for c in ("_captured_at", "_page_id", "observed_at", "xml"))
        for captured_at, page_id, observed_at, xml in zip(*columns):
            page = (captured_at.as_py(), page_id.as_py())
            for ordinal, (title, leaves) in enumerate(_programmes(xml.as_py())):
                airport = leaves.pop("arpt", None)
                named = [leaves.pop(key, None) for key in NAMED_LEAVES]
                extra = "; ".join(f"{k}={leaves[k]}" for k in sorted(leaves)) or None
                rows.append((*page, ordinal, observed_at.as_py(), airport, title, *named, extra))
            if len(rows) >= PIECE:
                yield piece()
                rows.clear()
    if rows:
        yield piece()


def parse_disruption(pages: DataFrame) -> DataFrame:
    """Delay programmes, ground stops and closures: one row per element naming an airport.

    The payload is a JSON object holding the XML text. Malformed XML gives no rows.
    """
    xml = F.from_json("payload", "xml string")["xml"]
    checked = pages.select(
        F.col("captured_at").alias("_captured_at"),
        F.col("page_id").alias("_page_id"),
        xml.alias("xml"),
        F.from_xml(xml, "Update_Time string, _corrupt_record string").alias("head"),
    ).where(F.col("xml").isNotNull() & F.col("head._corrupt_record").isNull())
    found = checked.select("_captured_at", "_page_id", N.weekday_text_to_epoch(F.col("head.Update_Time")).alias("observed_at"), "xml")
    return found.mapInArrow(programme_rows, ROWS).withColumn("airport", F.upper("airport"))
