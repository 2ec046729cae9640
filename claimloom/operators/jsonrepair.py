"""Recover JSON objects from broken files: whole document, arrays, lines (real or literal line ends), or objects side by side with any rubbish between."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys under which a document keeps its rows.
ROW_KEYS = ["records", "items", "data", "rows", "results", "lines", "entries", "docs", "objects", "payload"]


DECODER = json.JSONDecoder()
# A line end, real or literal, whose next line comes to an object before any quote or other brace; its indent is kept.
LINE_OBJECT = re.compile(r"(?:\r?\n|\r|\\n)\ufeff?([ \t]*)(?=[^\"'{}\r\n]*\{)")


def closing(text: str, start: int, stop: int) -> int | None:
    """The end of the {...} span at start if it closes before stop; braces and escaped quotes inside strings do not count."""
    depth, in_string, escaped = 0, False, False
    for m in re.compile(r'[{}"\\]|(?<=\\)[^{}"\\]').finditer(text, start, stop):
        c = m.group()
        if in_string:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                in_string = False
        elif c == '"':
            in_string = True
        elif c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
            if depth == 0:
                return m.end()
    return None


def without_commas(raw: str) -> object:
    """Parsed with its trailing commas dropped."""
    return json.loads(re.sub(r",(\s*[}\]])", r"\1", raw))


def stands_alone(text: str, at: int) -> bool:
    """Is the object of the line that begins after at whole, and no item of a list?"""
    try:
        end = DECODER.raw_decode(text, text.index("{", at))[1]
    except ValueError:
        return False
    return not re.match(r"\s*[,\]}]", text[end : end + 100])


def split_objects(text: str) -> Iterator[tuple[object, str | None]]:
    """(value, None) or (None, raw) for each top-level object. One that does not parse ends at its own brace, or else at the next line
    with an object that is indented no deeper, so that a cut line takes no other with it; what stays open at the end is bad too."""
    at = 0
    while (i := text.find("{", at)) >= 0:
        try:
            value, at = DECODER.raw_decode(text, i)
            yield value, None
            continue
        except ValueError:
            pass
        head = re.split(r"[\r\n\ufeff]|\\n", text[at:i])[-1]
        indent = len(head) - len(head.lstrip(" \t"))
        cut = next((m.start() for m in LINE_OBJECT.finditer(text, i) if len(m[1]) <= indent), len(text))
        ends = [closing(text, i, cut)]
        # open at a comma or bracket, it may go on over lines that begin with its own parts
        if ends[0] is None and cut < len(text) and text[i:cut].rstrip()[-1] in ",[{:" and not stands_alone(text, cut):
            ends.append(closing(text, i, len(text)))
        for end in ends:
            try:
                if end is not None:
                    value, at = without_commas(text[i:end]), end
                    yield value, None
                    break
            except ValueError:
                continue
        else:
            at = cut if ends[0] is None else ends[0]
            yield None, text[i:at].rstrip()


def no_nan(value: object) -> object:
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {k: no_nan(v) for k, v in value.items()}
    return [no_nan(v) for v in value] if isinstance(value, list) else value


def rows_of(value: object) -> list | None:
    """The rows of a parsed document: a list of objects, a known or the only list field, an object of objects, or itself."""
    if isinstance(value, list):
        return value if all(isinstance(x, dict) for x in value) else None
    if isinstance(value, dict):
        lists = [k for k, v in value.items() if isinstance(v, list) and v and all(isinstance(x, dict) for x in v)]
        for k in [*(k for k in ROW_KEYS if k in lists), *(lists if len(lists) == 1 else [])]:
            return value[k]
        if len(value) > 1 and all(isinstance(x, dict) for x in value.values()):
            return list(value.values())
        return [value]
    return None


def recover(text: str | None) -> list[tuple[str | None, str | None]]:
    """(object as strict JSON, None) or (None, raw) in order. NaN and infinities become null; trailing commas are dropped. Text outside
    objects gives no row."""
    text = (text or "").lstrip("﻿").strip()
    if not text:
        return []
    try:
        rows = rows_of(json.loads(text))
        if rows is not None:
            return [(json.dumps(no_nan(r), ensure_ascii=False), None) for r in rows]
    except ValueError:
        pass
    return [(None, raw) if raw is not None else (json.dumps(no_nan(v), ensure_ascii=False), None) for v, raw in split_objects(text)]


def recover_files(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, ord from 1, object, bad: one row for each object found; the input is never overwritten."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, n, good, bad) for k, t in zip(pdf["k"], pdf["t"]) for n, (good, bad) in enumerate(recover(t), 1)]
            yield pd.DataFrame(rows, columns=["k", "ord", "object", "bad"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, ord int, object string, bad string").withColumnRenamed("k", key)
