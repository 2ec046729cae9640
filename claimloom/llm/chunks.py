"""Splitting oversized texts at natural boundaries by content-defined chunking.

A rolling hash over the last WINDOW characters marks landmarks, which depend on nearby characters only. From the piece's start the
first landmark past the minimum size is taken and snapped to the nearest natural boundary that keeps the piece within the minimum and
maximum: the end of a paragraph, line or sentence, else a clause or word, else the landmark itself between two graphemes. Without a
landmark the last boundary in reach is used. As landmarks and boundaries do not depend on where the text began, an edit changes the
pieces around it and the later cuts fall into step again. Each piece but the first repeats up to `overlap` characters of the one
before, from the start of a sentence or word, and its whole length stays within `limit`.

Defined results: null, empty and short texts are one piece or none (null and empty); the pieces without their overlaps put together
are the text, character for character; a text of any length is cut in one pass in linear time; repeated rows give repeated pieces.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP, MINIMUM = 1200, 150, 400
WINDOW, LANDMARK_EVERY = 24, 128

# What ends a sentence or clause, in any of the scripts at hand.
STRONG = re.compile(r"(?:\n\s*\n\s*|\n\s*|[.!?…]+[\"”»“’')\]]*(?:\s+)|[。！？｡۔؟।॥።፧]+[\"”»」』）)]*\s*|(?<=[฀-๿])\s+(?=[฀-๿]))")
WEAK = re.compile(r"(?:[,;:·|/]\s+|[，；：、،؛፣]\s*|\s+)")


def landmarks(text: str) -> np.ndarray:
    """Places (cut before this character) where the rolling hash of the WINDOW characters before hits."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = (cp + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    h = np.zeros(len(cp), np.uint64)
    for j in range(min(WINDOW, len(cp))):
        h[j:] += mixed[: len(cp) - j] * np.uint64((2 * j + 1) ** 3 | 1)
    hit = (h >> np.uint64(32)) % np.uint64(LANDMARK_EVERY) == 0
    return np.flatnonzero(hit) + 1


def whole_grapheme(text: str, at: int, low: int) -> int:
    """Step back so that no combining mark, joiner or variation selector is parted from its base."""
    while at > low and at < len(text) and (unicodedata.combining(text[at]) or unicodedata.category(text[at]) in ("Mn", "Me", "Mc") or text[at] in "‍︎️" or text[at - 1] == "‍" or text[at - 1 : at + 1] == "\r\n"):
        at -= 1
    return at


def nearest(sorted_places: list[int], at: int, low: int, high: int) -> int | None:
    k = bisect_left(sorted_places, at)
    near = [p for p in sorted_places[max(0, k - 1) : k + 1] if low <= p <= high]
    if near:
        return min(near, key=lambda p: (abs(p - at), p))
    a, b = bisect_left(sorted_places, low), bisect_right(sorted_places, high)
    return min(sorted_places[a:b], key=lambda p: (abs(p - at), p)) if a < b else None


def last_in(sorted_places: list[int], low: int, high: int) -> int | None:
    k = bisect_right(sorted_places, high)
    return sorted_places[k - 1] if k and sorted_places[k - 1] >= low else None


def chunk(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP, minimum: int = MINIMUM) -> list[tuple[int, int, int]]:
    """(start, content_start, end) of each piece: text[start:end], of which text[start:content_start] repeats the piece before."""
    if not text:
        return []
    if len(text) <= limit:
        return [(0, 0, len(text))]
    if not 0 <= overlap < limit or not 0 < minimum <= limit - overlap:
        raise ValueError("need 0 <= overlap < limit and 0 < minimum <= limit - overlap")
    marks = landmarks(text).tolist()
    strong = [m.end() for m in STRONG.finditer(text)]
    weak = [m.end() for m in WEAK.finditer(text)]
    out, begin, start = [], 0, 0  # start: with the overlap; begin: without
    while len(text) - start > limit:
        low, high = begin + minimum, start + limit
        k = bisect_left(marks, low)
        mark = marks[k] if k < len(marks) and marks[k] <= high else None
        at = mark if mark is not None else high
        cut = nearest(strong, at, low, high) if mark is not None else last_in(strong, low, high)
        if cut is None:
            cut = nearest(weak, at, low, high) if mark is not None else last_in(weak, low, high)
        if cut is None:
            cut = whole_grapheme(text, at, begin + 1)
        out.append((start, begin, cut))
        start = cut
        if overlap:
            floor = max(begin, cut - overlap)
            k = bisect_left(strong, floor)
            if k < len(strong) and strong[k] < cut:
                start = strong[k]
            else:
                k = bisect_left(weak, floor)
                start = weak[k] if k < len(weak) and weak[k] < cut else whole_grapheme(text, floor, begin)
                start = start if cut - start <= overlap else cut
        begin = cut
    out.append((start, begin, len(text)))
    return out


def split_texts(df: DataFrame, keys: list[str], text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, minimum: int = MINIMUM) -> DataFrame:
    """keys + piece_no from 1, n_pieces, start_char, content_start, end_char, piece, for each piece of each text."""
    types = dict(df.select(*keys).dtypes)
    cols = df.select(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)], F.col(text_col).alias("t")).filter("t <> ''")
    schema = ", ".join([f"k{n} {types[k]}" for n, k in enumerate(keys)] + ["piece_no int", "n_pieces int", "start_char int", "content_start int", "end_char int", "piece string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = pdf[[c for c in pdf.columns if c != "t"]]
            at, rows = [], []
            for k, t in enumerate(pdf["t"]):
                pieces = chunk(t, limit, overlap, minimum)
                at += [k] * len(pieces)
                rows += [(n, len(pieces), a, b, e, t[a:e]) for n, (a, b, e) in enumerate(pieces, 1)]
            body = pd.DataFrame(rows, columns=["piece_no", "n_pieces", "start_char", "content_start", "end_char", "piece"])
            yield pd.concat([own.iloc[at].reset_index(drop=True), body], axis=1)

    out = cols.mapInPandas(run, schema)
    return out.select(*[F.col(f"k{n}").alias(k) for n, k in enumerate(keys)], "piece_no", "n_pieces", "start_char", "content_start", "end_char", "piece")


def long_evidence(inputs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """claim_id, ev_pos, ev_text of the evidence items longer than limit; rows without one are dropped before anything is exploded."""
    has = inputs.select("claim_id", "evidence").filter(F.exists("evidence", lambda e: F.length(e["text"]) > limit))
    items = has.select("claim_id", F.posexplode("evidence").alias("ev_pos", "item"))
    return items.select("claim_id", "ev_pos", F.col("item.text").alias("ev_text")).filter(F.length("ev_text") > limit)
