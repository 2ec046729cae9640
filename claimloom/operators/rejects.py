"""Rows that fail to parse: load delivered lines, keep those that break the contract apart with a reason.

Structural indexing. A batch of CSV lines is laid out as one byte buffer. A numpy mask marks the quotes, the prefix parity of the
mask says for each byte whether it lies inside quotes, and from this come delimiters (commas at even parity), record ends and the
places where a quote breaks RFC 4180. Only then are fields cut. JSON lines are one object each and are read by the JSON parser,
with the pairs of the outer object counted so that repeated names show.

Defined results: a null line counts as an empty one; an empty CSV line has one field (`count`), an empty JSON line is `syntax`; an
unknown layout is `syntax`; an empty table gives empty tables; other columns of the input are ignored, whatever their names.
Repeated lines are each judged. The work is one narrow pass: no shuffle, and memory is bounded by the Arrow batch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The contract of the delivered lines.
CSV_FIELDS = ["review_id", "section", "claim_id", "claim_text", "citation_text", "stated_page", "source_pdf_path", "evidence"]
JSON_FIELDS = [
    "review_id", "section", "claim_id", "claim_text", "citation_text", "citation_type", "is_secondary", "primary_mentioned_author",
    "primary_mentioned_year", "stated_page", "citation_author", "citation_year", "source_pdf_path", "evidence",
]
TEXT_FIELDS = [f for f in JSON_FIELDS if f not in ("is_secondary", "evidence")]
CLAIM_ID = re.compile(r"[0-9a-f]{16}")
PAGES = re.compile(r"[0-9]+(?:-[0-9]+)?")

EVIDENCE_TYPE = "array<struct<page_range:string,text:string,score:int>>"
PARSED_SCHEMA = (
    "line_id long, reason string, detail string, "
    + ", ".join(f"{f} {'boolean' if f == 'is_secondary' else EVIDENCE_TYPE if f == 'evidence' else 'string'}" for f in JSON_FIELDS)
)


def clean_line(text: str | None) -> str:
    """A leading byte-order mark and a trailing carriage return are not part of the line."""
    text = "" if text is None else text
    text = text[1:] if text.startswith("﻿") else text
    return text[:-1] if text.endswith("\r") else text


def index_csv(lines: list[str]) -> list[list[str] | None]:
    """The fields of each line, or None where the quoting is not RFC 4180."""
    if not lines:
        return []
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    sizes = np.fromiter((len(x) for x in raw), np.int64, len(raw))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])  # one zero byte ends each record
    buf = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
    record = np.repeat(np.arange(len(raw)), sizes + 1)
    quote = buf == 0x22
    before = np.cumsum(quote) - quote  # quotes before each byte
    inside = ((before - before[starts][record]) & 1).astype(bool)
    ends = starts + sizes
    is_end = np.zeros(len(buf), bool)
    is_end[ends] = True
    is_start = np.zeros(len(buf), bool)
    is_start[starts] = True
    comma = (buf == 0x2C) & ~inside & ~is_end
    bad = np.zeros(len(raw), bool)
    bad[record[is_end & inside]] = True  # an odd number of quotes
    prev, nxt = np.roll(buf, 1), np.roll(buf, -1)
    prev_comma, next_comma = np.roll(comma, 1), np.roll(comma, -1)
    prev_quote = (prev == 0x22) & ~is_start
    opens = quote & ~inside
    bad[record[opens & ~(is_start | prev_comma | prev_quote)]] = True
    closes = quote & inside
    bad[record[closes & ~((nxt == 0x22) | next_comma | np.roll(is_end, -1))]] = True
    loose = ((buf == 0x0A) | (buf == 0x0D)) & ~inside  # a line break outside quotes ends the record too early
    bad[record[loose & ~is_end]] = True
    out: list[list[str] | None] = []
    commas = np.flatnonzero(comma)
    cut = np.searchsorted(commas, starts), np.searchsorted(commas, ends)
    for k, line in enumerate(raw):
        if bad[k]:
            out.append(None)
            continue
        at = [-1, *(commas[cut[0][k] : cut[1][k]] - starts[k]).tolist(), len(line)]
        fields = [line[a + 1 : b] for a, b in zip(at, at[1:])]
        out.append([(f[1:-1].replace(b'""', b'"') if f[:1] == b'"' else f).decode("utf-8", "surrogatepass") for f in fields])
    return out


def evidence_fault(value: object) -> str | None:
    if not isinstance(value, list):
        return "evidence is not an array"
    for k, item in enumerate(value):
        if not isinstance(item, dict) or set(item) != {"page_range", "text", "score"}:
            return f"evidence[{k}] has other names"
        if not isinstance(item["page_range"], str) or not PAGES.fullmatch(item["page_range"]):
            return f"evidence[{k}].page_range"
        if not isinstance(item["text"], str) or not item["text"].strip():
            return f"evidence[{k}].text"
        if type(item["score"]) is not int or not 0 <= item["score"] <= 100:
            return f"evidence[{k}].score"
    return None


def judge(values: dict[str, object]) -> str | None:
    claim = values["claim_id"]
    if not isinstance(claim, str) or not CLAIM_ID.fullmatch(claim):
        return "claim_id"
    return evidence_fault(values["evidence"])


def _as_text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _utf8(text: str | None) -> str | None:
    """A lone surrogate escape is legal JSON but no Unicode text; it becomes the replacement character."""
    return text if text is None else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def parse_batch(layouts: list[str | None], texts: list[str | None]) -> list[tuple[str | None, str | None, dict[str, object]]]:
    """(reason, detail, values) for each line; reason is None for a row that loads."""
    lines = [clean_line(x) for x in texts]
    csv_at = [k for k, layout in enumerate(layouts) if layout == "csv"]
    cut = dict(zip(csv_at, index_csv([lines[k] for k in csv_at])))
    out: list[tuple[str | None, str | None, dict[str, object]]] = []
    for k, (layout, line) in enumerate(zip(layouts, lines)):
        if layout == "csv":
            fields = cut[k]
            if fields is None:
                out.append(("syntax", "quoting", {}))
                continue
            if len(fields) != len(CSV_FIELDS):
                out.append(("count", f"{len(fields)} fields", {}))
                continue
            values: dict[str, object] = dict(zip(CSV_FIELDS, fields))
            try:
                values["evidence"] = json.loads(fields[-1])
            except (ValueError, RecursionError):
                out.append(("value", "evidence is no JSON", {}))
                continue
        elif layout == "jsonl":
            try:
                pairs: list = []

                def keep(items: list) -> dict:
                    pairs[:] = [name for name, _ in items]  # the outer object ends last
                    return dict(items)

                value = json.loads(line, object_pairs_hook=keep)
            except (ValueError, RecursionError) as e:
                out.append(("syntax", str(e)[:80], {}))
                continue
            if not isinstance(value, dict) or sorted(pairs) != sorted(JSON_FIELDS):
                out.append(("count", "names", {}))
                continue
            values = value
        else:
            out.append(("syntax", "unknown layout", {}))
            continue
        fault = judge(values)
        out.append(("value", fault, {}) if fault else (None, None, values))
    return out


def parse_lines(raw: DataFrame, id_col: str = "raw_id", layout_col: str = "layout", text_col: str = "raw_text") -> DataFrame:
    """One row for each line: line_id, reason and detail (null where it loads), and the loaded fields."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            none = [None if x is None or x != x else x for x in pdf["t"]]
            judged = parse_batch(list(pdf["l"]), none)
            rows = {"line_id": pdf["i"].to_numpy(), "reason": [r for r, _, _ in judged], "detail": [_utf8(d) for _, d, _ in judged]}
            for f in TEXT_FIELDS:
                rows[f] = [_utf8(_as_text(v.get(f))) for _, _, v in judged]
            rows["is_secondary"] = pd.Series([v.get("is_secondary") if isinstance(v.get("is_secondary"), bool) else None for _, _, v in judged], dtype="boolean")
            rows["evidence"] = [[{**e, "text": _utf8(e["text"])} for e in v["evidence"]] if v else None for _, _, v in judged]
            yield pd.DataFrame(rows)[["line_id", "reason", "detail", *JSON_FIELDS]]

    cols = raw.select(F.col(id_col).cast("long").alias("i"), F.col(layout_col).alias("l"), F.col(text_col).alias("t"))
    return cols.mapInPandas(run, PARSED_SCHEMA)


def rejects(parsed: DataFrame, id_col: str = "raw_id") -> DataFrame:
    return parsed.filter("reason IS NOT NULL").select(F.col("line_id").alias(id_col), "reason", "detail")


def loaded(parsed: DataFrame, id_col: str = "raw_id") -> DataFrame:
    return parsed.filter("reason IS NULL").select(F.col("line_id").alias(id_col), *JSON_FIELDS)
