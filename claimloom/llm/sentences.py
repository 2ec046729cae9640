"""Sentence boundaries across languages and scripts, by a maximum-entropy classifier of candidate boundaries.

1. One pass over all texts counts for each token how often it stands with and without a full stop, in lower and in upper case, and by
   which words it is followed after a full stop. The counts are exact and summed in the cluster. The model takes the tokens that make up
   at least TOKEN_SHARE of all: at most 1 / TOKEN_SHARE of them, a proven bound whatever the corpus; rarer tokens count as unknown.
   All that is asked of the counts are shares, so more of the same text changes no answer.
2. Candidates are end marks with the closing marks behind them, and in Thai the spaces between statements. A mark inside an open
   quotation or bracket is no candidate; brackets that never close count as no brackets.
3. Reliable candidates of a bounded sample (TRAIN_TEXTS texts in hash order and TRAIN_MARKS candidates of them, parameters) train a
   logistic model on hashed features: mark, neighbouring tokens, their case, length, digits and script, and the counts' shares. It then
   decides every candidate.

Defined results: null, empty and blank texts give no sentences; a text without a boundary is one sentence; offsets count code points
of the whole text, whatever its length; repeated texts give repeated rows. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut

TOKEN_SHARE = 1e-6
TRAIN_TEXTS, TRAIN_MARKS = 12_000, 200_000
FEATURES = 1 << 14
# A word seen in lower case in this share of its places is one that a name is not.
LOW_SHARE = 0.05

# End marks and bracket pairs.
LATIN_MARKS = ".?!…"
OTHER_MARKS = "。！？｡؟۔।॥።፧"
PAIRS = {")": "(", "]": "[", "}": "{", "）": "（", "】": "【", "」": "「", "』": "『", "”": "“", "»": "«", "“": "„", "》": "《"}
OPENERS = set(PAIRS.values())
ENDS = re.compile(rf"[{LATIN_MARKS}]+|[{OTHER_MARKS}]+|(?<=[฀-๿)\]])[^\S\n]+(?=[฀-๿])")
BRACKETS = re.compile("[" + re.escape("".join(sorted({*PAIRS, *OPENERS, '"'}))) + "]")
TOKEN = re.compile(r"[^\W\d_](?:[^\W_]|[.'’](?=[^\W\d_])|[̀-ͯऀ-ःऺ-ॏั-๎])*")
BORDER = set("()[]{}\"“”«»„「」（）,;:.?!…。")
FOLLOWED = re.compile(r"(?<![\w.])((?:\w|\.(?=\w))+)\.\s+([^\W\d_]\w*)")
AFTER = re.compile(r"[^\s()\[\]{}\"“”«»„「」（）,;:.?!…。]+")
LEADING = re.compile(r"[\"“„«¿¡「『‘']*")


@dataclass
class Counts:
    """token -> (share of it that carries a full stop, share of lower-case words among its followers), word -> is it seen in lower case."""

    stops: dict[str, tuple[float, float]]
    low: set[str]


def spans_of_brackets(text: str) -> tuple[list[tuple[int, int]], set[int]]:
    """Matched brackets and quotations, and the places of their closing marks."""
    stack: list[tuple[str, int]] = []
    waiting: Counter[str] = Counter()
    found: list[tuple[int, int]] = []
    for m in BRACKETS.finditer(text):
        c, at = m.group(), m.start()
        if c == '"':
            if not stack or stack[-1][0] != c:
                stack.append((c, at))
                waiting[c] += 1
                continue
            want = c
        elif c in PAIRS and waiting[PAIRS[c]]:
            want = PAIRS[c]
        else:
            if c in OPENERS:
                stack.append((c, at))
                waiting[c] += 1
            continue
        while True:  # what was opened inside and never closed falls away
            opener, begin = stack.pop()
            waiting[opener] -= 1
            if opener == want:
                break
        found.append((begin, at))
    return found, {b for _, b in found}


def outermost(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the spans that lie in no other, in order."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start of the mark, end of the sentence it would close, start of the next one) for each candidate before the last."""
    spans, closers = spans_of_brackets(text)
    starts, ends = outermost(spans)
    last = len(text.rstrip())
    out = []
    for m in ENDS.finditer(text, len(text) - len(text.lstrip())):
        a, b = m.span()
        if text[a].isspace():
            end, nxt = a, b
        else:
            end = b
            while True:
                k = end
                while k < last and text[k] in " \xa0 ":
                    k += 1
                if end in closers:
                    end += 1
                elif k in closers and text[k] == "»":
                    end = k + 1
                else:
                    break
            nxt = end
            while nxt < len(text) and text[nxt].isspace():
                nxt += 1
        k = bisect_left(starts, end) - 1
        if end >= last or (k >= 0 and end <= ends[k]):
            continue
        out.append((a, end, nxt))
    return out


def kind_of(c: str) -> str:
    if c.isdigit():
        return "9"
    if c.isupper() or unicodedata.category(c) == "Lt":
        return "A"
    if c.islower():
        return "a"
    if c.isalpha():
        return "x"
    return "p"


def script_of(c: str) -> str:
    o = ord(c) if c else 0
    return "latin" if o < 0x370 else "cyr" if o < 0x530 else "sem" if o < 0x780 else "ind" if o < 0xE00 else "thai" if o < 0xE80 else "eth" if 0x1200 <= o < 0x1400 else "han" if 0x2E80 <= o < 0xFB00 else "other"


def alone(text: str, cand: tuple[int, int, int], prev: str) -> bool:
    """Is the token before all that stands since the start or the last end mark?"""
    head = text[max(0, cand[0] - len(prev) - 8) : cand[0] - len(prev)].rstrip(" \xa0\n\t\"“„«¿¡(")
    return not head or head[-1] in LATIN_MARKS + OTHER_MARKS


def token_before(text: str, at: int) -> str:
    """What stands without a border or white space before a place; a full stop inside belongs to it."""
    k = at
    while k and ((text[k - 1] not in BORDER and not text[k - 1].isspace()) or (text[k - 1] == "." and k < at and (text[k].isalnum() or text[k] == "_"))):
        k -= 1
    return text[k:at]


def context(text: str, cand: tuple[int, int, int]) -> tuple[str, str, str, str, str, str]:
    """mark, token before, gap, what stands between, token after, kind of what comes after."""
    a, end, nxt = cand
    prev = token_before(text, a) or text[max(0, a - 1) : a]
    if "." in prev and max(map(len, prev.split("."))) > 3:  # no dotted abbreviation but a stop without a space
        prev = prev.rpartition(".")[2]
    lead = LEADING.match(text, nxt).end()
    n = AFTER.match(text, lead)
    nxt_token = n.group() if n else ""
    first = text[lead : lead + 1]
    gap = text[end:nxt]
    return text[a], prev, "none" if not gap else "line" if "\n" in gap else "one" if len(gap) == 1 else "more", text[a + 1 : end].strip()[:2], nxt_token, kind_of(first) if first else "p"


def ratios(c: Counts, prev: str, nxt: str) -> tuple[float, float, bool]:
    """Share of the token before that carries a full stop, share of lower-case words among its followers, is the next word one."""
    share, follow = c.stops.get(prev, (0.0, 0.5))
    return share, follow, nxt.lower() in c.low


@lru_cache(1 << 16)
def plain_features(mark: str, gap: str, size: int, shape: str, kind: str, full: str, after: str, starts: bool, nshape: str, script: str, between: str, opened: bool, single: bool) -> tuple[int, ...]:
    """Numbers of all features but those of the tokens themselves."""
    quoted = "q" if between else ""
    basic = [f"m{mark}", f"g{gap}", f"s{size}", f"h{shape}", f"k{kind}", f"f{full}", f"a{after}", f"t{starts}", f"n{nshape}", f"c{script}", f"b{between}", f"o{opened}", f"l{single}"]
    pairs = [
        f"hk{shape}{kind}{quoted}", f"fk{full}{kind}{gap == 'none'}", f"fat{full}{after}{starts}{kind}", f"sft{size}{full}{starts}{kind}",
        f"mk{mark}{kind}{gap}", f"qc{quoted}{script}{gap}{kind}", f"hat{shape}{after}{starts}{kind}", f"ls{single}{size}{shape}{starts}", f"og{opened}{gap}{full}",
    ]
    return tuple(_number(x) for x in ("bias", *basic, *pairs))


@lru_cache(1 << 16)
def _number(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) & (FEATURES - 1)


def features(text: str, cand: tuple[int, int, int], c: Counts) -> tuple[int, ...]:
    """Numbers of the features of a candidate, as many for each."""
    mark, prev, gap, between, nxt, kind = context(text, cand)
    share, follow, starts = ratios(c, prev, nxt)
    size = min(len(prev), 6)
    shape = "one" if size == 1 else "dots" if "." in prev else "end)" if prev in ")]）" else "num" if prev[-1:].isdigit() else "caps" if prev.isupper() else "cap" if prev[:1].isupper() else "low"
    full = "9" if share >= 0.97 else "6" if share >= 0.6 else "2" if share > 0 else "0"
    after = "8" if follow >= 0.6 else "3" if follow >= 0.2 else "0"
    nshape = "initial" if len(nxt) == 1 and kind == "A" else "word"
    opened = text[cand[2] : cand[2] + 1] in "“„«\"¿¡"
    plain = plain_features(mark, gap, size, shape, kind, full, after, starts, nshape, script_of(nxt[:1]), between, opened, alone(text, cand, prev))
    return (*plain, _number(f"p{prev}"), _number(f"x{nxt}"), _number(f"pk{prev}{kind}"))


def reliable(text: str, cand: tuple[int, int, int], c: Counts) -> int | None:
    """1 or 0 where the place itself leaves no doubt, else None."""
    mark, prev, gap, between, nxt, kind = context(text, cand)
    if mark.isspace():
        return 1
    if mark in OTHER_MARKS:
        return 0 if between and gap == "none" and kind != "A" else 1
    if kind == "a" or nxt == "" or text[cand[2] : cand[2] + 1] in "([（,;:":
        return 0
    if mark in "?!":
        return 1 if kind in "A9x" and gap != "none" else None
    share, follow, starts = ratios(c, prev, nxt)
    if between and kind in "A9":
        return 1 if gap != "none" else None
    if kind == "9":
        if gap == "none":
            return 0
        return 0 if share >= 0.97 and len(prev) <= 5 else 1 if prev in ")]" or (len(prev) >= 3 and share < 0.9 and prev.islower()) else None
    if prev in ")]）" or (len(prev) >= 4 and prev.islower() and share < 0.97):
        return 1
    if kind == "x":
        return 0 if len(prev) <= 3 and share >= 0.9 else 1 if gap != "none" and len(prev) >= 3 else None
    if len(prev) == 1 and not prev.isdigit():
        return 0
    if alone(text, cand, prev) and (len(prev) <= 4 or "." in prev):
        return 0
    if gap != "none" and follow >= 0.25 and text[cand[2] : cand[2] + 1] in "“„«":
        return 1
    if (gap != "none" or starts) and len(prev) >= 5 and prev.isalpha() and share < 0.97:
        return 1
    if prev.isdigit() and len(prev) <= 2 and not starts:
        return 0
    if share >= 0.97 and follow < 0.25 and not starts:
        return 0
    if starts and gap != "none" and follow >= 0.5:
        return 1
    return None


def fit(rows: list[tuple[int, ...]], labels: list[int], steps: int = 160) -> np.ndarray:
    """Logistic regression (maximum entropy) on labelled candidates, full batches, L2."""
    w = np.zeros(FEATURES)
    if not len(rows):
        w[_number("bias")] = 1.0
        return w
    x, y = np.array(rows), np.array(labels, float)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    m, v = np.zeros(FEATURES), np.zeros(FEATURES)
    flat = x.ravel()
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(w[x].sum(1), -30, 30)))
        g = np.bincount(flat, np.repeat((p - y) * weight, x.shape[1]), FEATURES) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w


@dataclass
class Model:
    weights: np.ndarray | list[float]
    counts: Counts


def boundaries(text: str, model: Model) -> list[tuple[int, int]]:
    """(start, end) of each sentence, without outer white space."""
    out, begin = [], len(text) - len(text.lstrip())
    last = len(text.rstrip())
    weights = model.weights.tolist() if not isinstance(model.weights, list) else model.weights
    for cand in candidates(text):
        if sum(map(weights.__getitem__, features(text, cand, model.counts))) > 0:
            if cand[1] > begin:
                out.append((begin, cand[1]))
            begin = cand[2]
    if last > begin:
        out.append((begin, last))
    return out


def count_tokens(df: DataFrame, col: str, token_share: float = TOKEN_SHARE) -> Counts:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            dot, plain, low, up, followers = Counter(), Counter(), Counter(), Counter(), Counter()
            for t in pdf["t"]:
                for m in TOKEN.finditer(t):
                    w = m.group()
                    (dot if t[m.end() : m.end() + 1] == "." else plain)[w] += 1
                followers.update(x for x in FOLLOWED.findall(t) if x[1][0].isupper())
            for w in {*dot, *plain}:
                small = w.lower()
                (low if w == small and w.islower() else up)[small] += dot[w] + plain[w]
            rows = [("t", w, None, dot[w], plain[w]) for w in {*dot, *plain}] + [("c", w, None, low[w], up[w]) for w in {*low, *up}] + [("f", a, b.lower(), n, 0) for (a, b), n in followers.items()]
            yield pd.DataFrame(rows, columns=["kind", "a", "b", "x", "y"])

    counted = df.select(F.col(col).alias("t")).filter("t IS NOT NULL").mapInPandas(run, "kind string, a string, b string, x long, y long")
    counted = cut(counted.groupBy("kind", "a", "b").agg(F.sum("x").alias("x"), F.sum("y").alias("y")))
    tokens = counted.filter("kind = 't'").select(F.col("a").alias("token"), "x", "y")
    least = token_share * float(tokens.agg(F.sum(F.col("x") + F.col("y"))).first()[0] or 0)
    words = cut(counted.filter("kind = 'c'").filter(F.col("x") + F.col("y") >= least).filter(F.col("x") >= LOW_SHARE * (F.col("x") + F.col("y"))).select(F.col("a").alias("b")))
    follow = counted.filter("kind = 'f'").join(words.withColumn("starts", F.lit(True)), "b", "left").groupBy(F.col("a").alias("token"))
    follow = follow.agg((F.sum(F.when(F.col("starts"), F.col("x")).otherwise(0)) / F.sum("x")).alias("follow"))
    stops = tokens.filter((F.col("x") > 0) & (F.col("x") + F.col("y") >= least)).select("token", (F.col("x") / (F.col("x") + F.col("y"))).alias("share"), (F.col("x") + F.col("y")).alias("n")).join(follow, "token", "left")
    # both sides hold at most 1 / token_share rows
    seen = {r["token"]: (r["share"] if r["n"] > 1 else min(r["share"], 0.5), 0.5 if r["follow"] is None else r["follow"]) for r in stops.toLocalIterator()}
    return Counts(seen, {r["b"] for r in words.toLocalIterator()})


def train(df: DataFrame, col: str, train_texts: int = TRAIN_TEXTS, train_marks: int = TRAIN_MARKS) -> Model:
    counts = count_tokens(df, col)
    shared = df.sparkSession.sparkContext.broadcast(counts)  # at most 1 / TOKEN_SHARE tokens and words
    sample = df.select(F.col(col).alias("t")).filter("t IS NOT NULL").orderBy(F.xxhash64("t"), "t").limit(train_texts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(list(features(t, cand, shared.value)), y) for t in pdf["t"] for cand in candidates(t) if (y := reliable(t, cand, shared.value)) is not None]
            yield pd.DataFrame(rows, columns=["x", "y"])

    labelled = sample.mapInPandas(run, "x array<int>, y int").limit(train_marks).collect()  # rows of fixed size
    return Model(fit([r["x"] for r in labelled], [r["y"] for r in labelled]), counts)


def split_sentences(df: DataFrame, id_col: str, text_col: str, model: Model | None = None) -> DataFrame:
    """id, sent_no from 1, start_char, end_char and sentence for each sentence of each text."""
    texts = df.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    if model is None:
        texts = cut(texts)  # read twice more: what it is made of is not done again
        model = train(texts, "t")
    shared = df.sparkSession.sparkContext.broadcast(model)  # FEATURES weights and at most 1 / TOKEN_SHARE tokens and words

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(shared.value.weights.tolist(), shared.value.counts)
        for pdf in batches:
            rows = [(i, k, a, b, t[a:b]) for i, t in zip(pdf["i"], pdf["t"]) for k, (a, b) in enumerate(boundaries(t, own), 1)]
            yield pd.DataFrame(rows, columns=[id_col, "sent_no", "start_char", "end_char", "sentence"])

    return texts.mapInPandas(run, f"`{id_col}` string, sent_no int, start_char int, end_char int, sentence string")
