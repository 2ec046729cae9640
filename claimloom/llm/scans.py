"""Noise in text from scanned pages: page furniture, words broken over lines, misread characters; repair into paragraphs.

Furniture is found within each text: number lines, "Page n of m", and a page's first or last line when, apart from numbers and misread
characters, it repeats on other pages or repeats the title or author of the first page.

Each text is read once: what it says is kept as arrays of word numbers beside the counts.

Misread characters: a noisy channel. Words and word pairs are counted over all texts. A printed word and any misreading of it, of
however many characters, have the same strokes (n is ri, m is rri, d is cl, ...), so words meet their possible printed forms by an
equi-join on their strokes; an alignment then says which confusions lead from one to the other. How often each character is confused, and
before which next one, is estimated from the words that are plainly misread. Words with a printed form other than their own are marked in a bit table of fixed
size (BITS); of the kept arrays only such words go on, with the word before and after: words in between that have one reading part the text into
pieces that can be decoded by themselves. Viterbi decodes each piece: confusion probabilities times an interpolated bigram model. A
word with a character that no alphabet has inside words can stand for itself in no reading.

Words at a line's end with a hyphen are judged once for each pair of halves: the joined word against the compound, by the counts of
their best printed forms and the confusions that lead there. A soft hyphen or a not sign is never part of a word.

No threshold is an absolute count: a printed form must have a share of the most frequent word of its strokes, and halves are words of
their own if they have a share of all words.

Defined results: null and empty texts give no rows; a redelivered text counts once; a text without page markers is one page; lines are
split at line feeds and counted with the markers. Whole texts are read, CHUNK characters of them at a time. Nothing but fixed-size
tables reaches the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.session import cut

BITS = 1 << 22
CHUNK = 1 << 23
# Prior rate of a confusion and how many characters it counts for; weight of the plain frequency in a pair's; share of its strokes' most
# frequent word that a printed form has; how many times as frequent as the word read; share of all words that makes a half a word.
P_ERROR, P_WEIGHT, PRIOR, FORM_SHARE, FORM_RATIO, HALF_SHARE = 0.008, 500.0, 50.0, 0.02, 100, 1.5e-5
# What comes after a character, as far as its confusion may depend on it: a letter of the alphabet, other, nothing.
NEXT = [*"abcdefghijklmnopqrstuvwxyz", "*", "$"]
# What an unseen reading counts; how many times the expected number a misreading may stand and be no word of its own.
UNSEEN, SLACK = 0.02, 6.0

# What a scanner reads -> what was printed.
CONFUSIONS = {
    "c": "e", "ri": "n", "rn": "m", "cl": "d", "li": "h", "ii": "u", "vv": "w", "f": "t", "ɑ": "a", "†": "t", "!": "i", "|": "l", "1": "l", "0": "o", "5": "s", "9": "g", "6": "b",
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl",
}
# Letters as the strokes that their misreadings have too.
STROKES = {"n": "ri", "m": "rri", "d": "cl", "e": "c", "h": "li", "u": "ii", "w": "vv", "f": "t"}
CERTAIN = re.compile(r"[ɑ†ﬀﬁﬂﬃﬄ]|(?<=[^\W\d_])[!|](?=[^\W\d_])|^[!|](?=[^\W\d_]{2})|(?<=[^\W\d_])[01569](?=[^\W\d_])|^[01569](?=[^\W\d_]{2})|(?<=[^\W\d_]{2})[01569]$")
ORDINAL = re.compile(r"\d+(?:st|nd|rd|th|s|[a-d])?", re.I)
MARKER = re.compile(r"<<<PAGE=\d+>>>\s*$")
SOFT, HARD = "¬\xad", "‐‑-"  # the hyphen last: it stands in character classes
BROKEN = re.compile(rf"([^\W\d_][^\s]*?)([{SOFT}{HARD}])$")
NUMBER_LINE = re.compile(r"[\s\-–—\[(|.]*(?:page |p\. ?)?[\dlO]{1,4}(?: ?(?:of|0f|o†|o|/) ?[\dlO]{1,4})?[\s\-–—\])|.]*", re.I)
ROMAN_LINE = re.compile(r"[\s\-–—\[(]*(?=[ivxlc])(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})[\s\-–—\])]*", re.I)
PAGE_OF = re.compile(r"\s*\S{1,2}[aɑ]\S{1,2}\s+[\dlO]{1,4}\s+\S{2}\s+[\dlO]{1,4}\s*")
EDGE_NUMBER = re.compile(r"^\s*[\dlO]{1,4}\s*[|·•–—]\s*|\s*[|·•–—]\s*[\dlO]{1,4}\s*$")
STRIP = ".,;:()[]{}\"“”‘’'?«»…"


def skeleton(s: str) -> str:
    """The line as a scanner might at worst have read it: misread and well-read copies agree."""
    s = EDGE_NUMBER.sub("", s).lower()
    for read in ("ﬀ", "ﬁ", "ﬂ", "ﬃ", "ﬄ", "ɑ", "†", "!", "|", "1", "0", "5", "9", "6", "vv", "rn", "ri", "cl", "li", "ii"):
        s = s.replace(read, CONFUSIONS[read])
    return re.sub(r"[\W_]+", " ", s.replace("e", "c").replace("f", "t").replace("n", "r").replace("h", "l")).strip()


def line_kinds(lines: list[str]) -> list[str]:
    """marker, blank, furniture or text for each line."""
    kinds = ["marker" if MARKER.match(x) else "text" if x.strip() else "blank" for x in lines]
    pages: list[list[int]] = [[]]
    for k, kind in enumerate(kinds):
        if kind == "marker":
            pages.append([])
        elif kind == "text":
            pages[-1].append(k)
    pages = [p for p in pages if p]
    for p in pages:
        for k in p:
            if len(lines[k].strip(" \t-–—[](|).")) > 24 and k not in (p[0], p[-1]):  # no number line is longer
                continue
            if NUMBER_LINE.fullmatch(lines[k]) and re.search(r"\d", lines[k]):
                kinds[k] = "furniture"
            elif ROMAN_LINE.fullmatch(lines[k]):
                kinds[k] = "furniture"
            elif k in (p[0], p[-1]) and PAGE_OF.fullmatch(lines[k]) and re.search(r"\d", lines[k]):
                kinds[k] = "furniture"
    front = [k for k in (pages[0] if pages else []) if kinds[k] == "text"][:2]
    titles = [skeleton(lines[k]) for k in front]
    heads: Counter[str] = Counter()
    edges: list[tuple[int, str]] = []
    for n, p in enumerate(pages):
        body = [k for k in p if kinds[k] == "text"]
        for k in dict.fromkeys(body[:1] + body[-1:]):
            if n == 0 and k in front:
                continue
            edges.append((k, skeleton(lines[k])))
            heads[edges[-1][1]] += 1
    for k, s in edges:
        author = len(titles) > 1 and titles[1] and (s == titles[1] or (s.startswith(titles[1] + " ") and len(s) <= len(titles[1]) + 24))
        if s and (s in titles[:1] or author or (heads[s] >= 2 and len(s) >= 4 and not re.search(r"[.!?]\s*$", lines[k]))):
            kinds[k] = "furniture"
    return kinds


@lru_cache(1 << 16)
def core(token: str) -> str:
    """A mark of exclamation at the end stays: it may be a misread i."""
    return token.strip(STRIP)


class Word:
    """A token of a line, or a word broken over two lines."""

    __slots__ = ("line", "index", "text", "next_line", "right", "mark")

    def __init__(self, line: int, index: int, text: str, next_line: int = 0, right: str = "", mark: str = "") -> None:
        self.line, self.index, self.text, self.next_line, self.right, self.mark = line, index, text, next_line, right, mark


def read(text: str) -> tuple[list[str], list[str], list[Word]]:
    """Lines, their kinds (numbered from 0) and the words of the running text in order."""
    lines = text.split("\n")
    kinds = line_kinds(lines)
    body = [k for k, kind in enumerate(kinds) if kind == "text"]
    words: list[Word] = []
    skip = False
    for at, k in enumerate(body):
        tokens = lines[k].split()
        for n, t in enumerate(tokens):
            if skip and n == 0:
                skip = False
                continue
            m = BROKEN.search(t) if n == len(tokens) - 1 and at + 1 < len(body) else None
            if m:
                nxt = lines[body[at + 1]].split()[0]
                if nxt[:1].islower() or CERTAIN.match(nxt) or nxt[:1] in "†ɑﬀﬁ!01569":
                    words.append(Word(k, n, m.group(1), body[at + 1], nxt, m.group(2)))
                    skip = True
                    continue
            words.append(Word(k, n, t))
        skip = skip and len(tokens) > 0
    return lines, kinds, words


@lru_cache(1 << 16)
def parts_of(token: str) -> tuple[str, ...]:
    """The words of a token, lower case: a compound is several."""
    return tuple(p for p in re.split(r"[-‐‑–—/]", core(token).lower()) if p)


@lru_cache(1 << 16)
def certain_part(part: str) -> bool:
    """Has a word without hyphens a character that no word has there?"""
    return bool(CERTAIN.search(part)) and not ORDINAL.fullmatch(part) and sum(c.isalpha() for c in part) >= sum(c.isdigit() for c in part)


@lru_cache(1 << 16)
def certain_misread(token: str) -> bool:
    return any(certain_part(core(x)) for x in re.split(r"[-‐‑–—/]", core(token)))


@lru_cache(1 << 16)
def goes_on(token: str) -> bool:
    """Can a line's first token be the rest of a broken word?"""
    return token[:1].islower() or bool(CERTAIN.match(token)) or token[:1] in "†ɑﬀﬁ!01569"


_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _read, _printed in CONFUSIONS.items():
    _BY_FIRST.setdefault(_read[0], []).append((_read, _printed))


def explain(printed: str, seen: str) -> list[tuple[int, str]] | None:
    """The fewest confusions, (place in seen, what was read), that make seen of printed; None if none do."""
    layers: list[dict[int, tuple[int, tuple]]] = [{} for _ in range(len(seen) + 1)]
    layers[0][0] = (0, ())
    for i, c in enumerate(seen):
        for j, (k, steps) in layers[i].items():
            ways = [(i + 1, j + 1, k, steps)] if j < len(printed) and printed[j] == c else []
            ways += [(i + len(r), j + len(q), k + 1, (*steps, (i, r))) for r, q in _BY_FIRST.get(c, ()) if seen.startswith(r, i) and printed.startswith(q, j)]
            for i2, j2, k2, steps2 in ways:
                if j2 not in layers[i2] or k2 < layers[i2][j2][0]:
                    layers[i2][j2] = (k2, steps2)
    found = layers[-1].get(len(printed))
    return None if found is None else list(found[1])


def undone(word: str) -> str:
    """The word with the characters that no word has replaced by what was printed, as far as each has one meaning."""
    return "".join(CONFUSIONS.get(c, c) if c in "ɑ†ﬀﬁﬂﬃﬄ!|10596" else c for c in word)


_STEPS = T.StructType([T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("read", T.ArrayType(T.StringType()))])


def after(word: str, at: int) -> str:
    return "$" if at >= len(word) else word[at] if "a" <= word[at] <= "z" else "*"


@F.pandas_udf(_STEPS)
def confusions(printed: pd.Series, seen: pd.Series) -> pd.DataFrame:
    """Places, and what was read there with what comes after it."""
    found = [explain(p, s) for p, s in zip(printed, seen)]
    read = [None if f is None else [f"{r} {after(s, i + len(r))}" for i, r in f] for f, s in zip(found, seen)]
    return pd.DataFrame({"at": [None if f is None else [i for i, _ in f] for f in found], "read": read})


def strokes(c: Column) -> Column:
    for table in ({r: p for r, p in CONFUSIONS.items() if not r.isalpha() or ord(r[0]) > 127}, STROKES):
        for old, new in table.items():
            c = F.replace(c, F.lit(old), F.lit(new))
    return c


def bit_of(words: list[str]) -> np.ndarray:
    h = pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)
    return h % np.uint64(BITS)


def chunked(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows in pieces of about CHUNK characters."""
    part = pdf["text"].str.len().cumsum() // CHUNK
    yield from (rows for _, rows in pdf.groupby(part.to_numpy(), sort=False))


class Parsed:
    """The running text of several texts as arrays: one entry for each word, in order.

    word: its number in vocab, -1 for a gap (a token without a word, a word broken at a hyphen that may be its own); text, line: where
    it stands; whole: does it stand in one line? breaks: (text, line, left, right, mark, next line) of the broken words."""

    def __init__(self, texts: list[str]) -> None:
        self.kinds: list[list[str]] = []
        body: list[str] = []
        owner: list[int] = []
        number: list[int] = []
        for i, t in enumerate(texts):
            lines = t.split("\n")
            kinds = line_kinds(lines)
            self.kinds.append(kinds)
            at = [k for k, kind in enumerate(kinds) if kind == "text"]
            body += [lines[k] for k in at]
            number += at
            owner += [i] * len(at)
        split = pc.utf8_split_whitespace(pa.array(body, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        unique, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        line = np.repeat(np.arange(len(body)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
        if "" in unique:
            keep = code != unique.index("")
            code, line = code[keep], line[keep]
        owner_of, number_of = np.array(owner, np.int64), np.array(number, np.int64)
        present, first = np.unique(line, return_index=True)  # every line of running text has a token
        last = np.append(first[1:], len(code)) - 1
        marks = [BROKEN.search(u) for u in unique]
        broken = np.array([m is not None for m in marks], bool)
        rest = np.array([goes_on(u) for u in unique], bool)
        self.vocab: dict[str, int] = {}
        parts = [[self.vocab.setdefault(p, len(self.vocab)) for p in parts_of(u)] for u in unique]
        gone = np.zeros(len(code), bool)
        joined = np.zeros(len(code), bool)
        self.breaks: list[tuple[int, int, str, str, str, int]] = []
        if len(present):
            can = np.append(broken[code[last[:-1]]] & rest[code[first[1:]]] & (owner_of[present[1:]] == owner_of[present[:-1]]), False)
            units: dict[tuple[str, str, str], int] = {}
            for k in np.flatnonzero(can).tolist():
                if first[k] == last[k] and gone[first[k]]:  # the rest of a word is not broken itself
                    continue
                m, right = marks[code[last[k]]], unique[code[first[k + 1]]]
                a, b = core(m.group(1)).lower(), core(right).lower()
                self.breaks.append((int(owner_of[present[k]]), int(number_of[present[k]]), m.group(1), right, m.group(2), int(number_of[present[k + 1]])))
                unit = units.setdefault((a, b, m.group(2)), len(parts))
                if unit == len(parts):
                    parts.append([self.vocab.setdefault(a + b, len(self.vocab))] if m.group(2) in SOFT and a + b else [])
                code[last[k]] = unit
                joined[last[k]] = True
                gone[first[k + 1]] = True
        code, line, joined = code[~gone], line[~gone], joined[~gone]
        # compounds are counted as wholes too
        self.compounds = Counter()
        for j, n in enumerate(np.bincount(code, minlength=len(unique))[: len(unique)].tolist()):
            if n and len(parts[j]) > 1:
                self.compounds[core(unique[j]).lower()] += n
        filled = [p or [-1] for p in parts]
        size = np.array([len(p) for p in filled], np.int64)
        flat = np.array([x for p in filled for x in p], np.int64)
        start = np.cumsum(size) - size
        n = size[code] if len(code) else np.zeros(0, np.int64)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.word = flat[np.repeat(start[code], n) + inner] if len(code) else np.zeros(0, np.int64)
        lines = np.repeat(line, n)
        self.text, self.line, self.whole = owner_of[lines] if len(lines) else lines, number_of[lines] if len(lines) else lines, ~np.repeat(joined, n)
        self.words = list(self.vocab)

    def counts(self) -> list[tuple]:
        """Rows of words, of pairs by the hash that Spark gives their two words, and of breaks."""
        w = self.word
        uni = Counter(dict(zip(self.words, np.bincount(w[w >= 0], minlength=len(self.words)).tolist()))) + self.compounds
        both = (w[:-1] >= 0) & (w[1:] >= 0) & (self.text[:-1] == self.text[1:])
        pair, n = np.unique(w[:-1][both] * len(self.words) + w[1:][both], return_counts=True)
        raw = [x.encode() for x in self.words]
        seed = [xxhash.xxh64_intdigest(x, 42) for x in raw]
        size = max(len(raw), 1)
        key = np.array([xxhash.xxh64_intdigest(raw[b], seed[a]) for a, b in zip((pair // size).tolist(), (pair % size).tolist())], np.uint64).view(np.int64)
        rows = [("u", x, None, None, None, c) for x, c in uni.items()] + [("b", None, None, None, k, c) for k, c in zip(key.tolist(), n.tolist())]
        broken = Counter((core(a).lower(), core(b).lower(), m) for _, _, a, b, m, _ in self.breaks)
        return rows + [("h", a, b, m, None, c) for (a, b, m), c in broken.items()]

    def found(self, stems: list[str]) -> list[tuple]:
        """Rows of furniture, broken words and misread halves of them."""
        out = [(stems[i], k + 1, "furniture", None, None, None, None) for i, kinds in enumerate(self.kinds) for k, kind in enumerate(kinds) if kind == "furniture"]
        for i, k, left, right, mark, nxt in self.breaks:
            out.append((stems[i], k + 1, "break", core(left).lower(), core(right).lower(), mark, nxt + 1))
            out += [(stems[i], n + 1, "misread", None, None, None, None) for n, half in ((k, left + "x"), (nxt, "x" + right)) if certain_misread(half)]
        return out

    def packed(self, stems: list[str]) -> tuple[list[str], list[str], bytes]:
        """Texts, vocabulary and arrays, the lines of words in no whole line as -1."""
        line = np.where(self.whole, self.line, -1)
        return stems, self.words, np.stack([self.word, self.text, line]).astype(np.int32).tobytes()


def doubtful_pieces(stems: list[str], words: list[str], arrays: bytes, doubtful: np.ndarray) -> list[tuple[str, int, list[int], list[str | None]]]:
    """(stem, place, lines, words) of each run of doubtful words, the words with one neighbour on each side, null at a gap."""
    w, text, line = np.frombuffer(arrays, np.int32).reshape(3, -1)
    bad = (w >= 0) & (line >= 0)
    bad[bad] = doubtful[w[bad]]
    at = np.flatnonzero(bad)
    if not len(at):
        return []
    new = np.append(True, (np.diff(at) > 1) | (text[at[1:]] != text[at[:-1]]))
    ends = np.append(np.flatnonzero(new)[1:], len(at))
    near = lambda k, own: words[w[k]] if 0 <= k < len(w) and w[k] >= 0 and text[k] == own else None
    out = []
    for a, b in zip(np.flatnonzero(new).tolist(), ends.tolist()):
        run, own = at[a:b], int(text[at[a]])
        out.append((stems[own], int(run[0]), (line[run] + 1).tolist(), [near(run[0] - 1, own), *(words[w[k]] for k in run), near(run[-1] + 1, own)]))
    return out


_READ = "part string, kind string, a string, b string, mark string, key long, n long, stem string, line_no int, next_line int, stems array<string>, words array<string>, arrays binary"


def read_texts(texts: DataFrame) -> DataFrame:
    """The one pass over the texts: rows of counts (part c), of findings (f) and of what the texts say, as arrays (p)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _READ.split(", ")]
        for pdf in batches:
            for rows in chunked(pdf):
                stems, p = list(rows["stem"]), Parsed(list(rows["text"]))
                out = [("c", *row, None, None, None, None, None, None) for row in p.counts()]
                out += [("f", kind, left, right, mark, None, None, stem, k, nxt, None, None, None) for stem, k, kind, left, right, mark, nxt in p.found(stems)]
                out.append(("p", *[None] * 9, *p.packed(stems)))
                yield pd.DataFrame(out, columns=columns).astype({c: "Int64" for c in ("key", "n", "line_no", "next_line")})

    return cut(texts.select("stem", "text").mapInPandas(run, _READ))


def summed(read_rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """words(word, n), pairs(key, n), breaks(left, right, mark, n)."""
    c = read_rows.filter("part = 'c'")
    words = cut(c.filter("kind = 'u'").groupBy(F.col("a").alias("word")).agg(F.sum("n").alias("n")))
    pairs = c.filter("kind = 'b'").groupBy("key").agg(F.sum("n").alias("n"))
    return words, pairs, c.filter("kind = 'h'").groupBy(F.col("a").alias("left"), F.col("b").alias("right"), "mark").agg(F.sum("n").alias("n"))


def printed_forms(asked: DataFrame, words: DataFrame) -> DataFrame:
    """asked(word, ...) -> the same with cand, n_cand, at, read: each word of the counts that it may be a misreading of, itself among them.
    A form has FORM_SHARE of the most frequent word of its strokes, so a word meets few, however many misreadings those have."""
    known = words.filter(F.length("word") > 1).withColumn("strokes", strokes(F.col("word")))
    top = known.groupBy("strokes").agg(F.max("n").alias("top"))
    forms = known.join(top, "strokes").filter(F.col("n") >= FORM_SHARE * F.col("top")).select("strokes", F.col("word").alias("cand"), F.col("n").alias("n_cand"))
    met = asked.withColumn("strokes", strokes(F.col("word"))).join(forms, "strokes").drop("strokes")
    return met.withColumn("how", confusions("cand", "word")).filter("how.at IS NOT NULL").select(*met.columns, "how.at", "how.read")


def confusion_rates(words: DataFrame, forms: DataFrame) -> dict[str, float]:
    """For each confusion and next character, how often what was printed is read so: over words that are plainly one misreading of a far
    more frequent one; the rate whatever comes next stands in where there is little of it. What comes back is of fixed size."""
    printed = sorted(set(CONFUSIONS.values()))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got: Counter = Counter()
            for w, n in zip(pdf["word"], pdf["n"]):
                for p in printed:
                    at = w.find(p)
                    while at >= 0:
                        got[(p, after(w, at + len(p)))] += n
                        at = w.find(p, at + 1)
            yield pd.DataFrame([(p, x, n) for (p, x), n in got.items()], columns=["p", "next", "n"])

    plain = forms.filter((F.size("read") == 1) & (F.col("n_cand") >= 20 * F.col("n")))
    seen = {r["r"]: r["n"] for r in plain.groupBy(F.col("read")[0].alias("r")).agg(F.sum("n").alias("n")).collect()}
    chances = {(r["p"], r["next"]): r["n"] for r in words.mapInPandas(count, "p string, next string, n long").groupBy("p", "next").agg(F.sum("n").alias("n")).collect()}
    rates = {}
    for r, p in CONFUSIONS.items():
        usual = (sum(seen.get(f"{r} {x}", 0) for x in NEXT) + P_ERROR * P_WEIGHT) / (sum(chances.get((p, x), 0) for x in NEXT) + P_WEIGHT)
        rates |= {f"{r} {x}": (seen.get(f"{r} {x}", 0) + usual * P_WEIGHT) / (chances.get((p, x), 0) + P_WEIGHT) for x in NEXT}
    return rates


def channel(read: Column, rates: dict[str, float]) -> Column:
    """Log probability of the confusions of a word."""
    table = F.create_map(*[F.lit(x) for r, p in rates.items() for x in (r, math.log(p))])
    return F.aggregate(read, F.lit(0.0), lambda a, r: a + table[r])


def alternatives(words: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """word, cand, k, lp, n_cand for words that may be misread, the word itself among its candidates with what its misread forms leave of
    its count; and the rates of the confusions. A misreading stands as often as its printed form and the confusion's rate let expect,
    whatever the size of the corpus: only what goes beyond SLACK times that speaks for a word of its own."""
    forms = cut(printed_forms(words.filter(F.length("word") > 1), words).filter(F.col("n_cand") * FORM_RATIO >= F.col("n")))
    rates = confusion_rates(words, forms)
    others = forms.filter(F.size("read") > 0)
    others = others.select("word", "n", "cand", F.size("read").alias("k"), channel(F.col("read"), rates).alias("lp"), F.col("n_cand").cast("double").alias("n_cand"))
    expected = others.groupBy("word", "n").agg(F.sum(F.col("n_cand") * F.exp("lp")).alias("expected"))
    own = expected.select("word", F.col("word").alias("cand"), F.lit(0).alias("k"), F.lit(0.0).alias("lp"), F.greatest(F.col("n") - SLACK * F.col("expected"), F.lit(0.0)).alias("n_cand"))
    return cut(others.drop("n").unionByName(own)), rates


def judge_breaks(breaks: DataFrame, words: DataFrame, rates: dict[str, float], total: float) -> DataFrame:
    """left, right, mark -> hyphen, bad_left, bad_right, word: is the mark no part of the word, and which half is misread."""
    b = cut(breaks.select("left", "right", "mark").distinct().withColumn("joined", F.concat("left", "right")).withColumn("compound", F.concat_ws("-", "left", "right")))
    asked = b.select(F.explode(F.array("joined", "compound", "left", "right")).alias("word")).filter("word <> ''").distinct()
    f = printed_forms(asked, words)
    score = F.struct((F.log("n_cand") + channel(F.col("read"), rates)).alias("s"), "cand")
    best = cut(f.groupBy("word").agg(F.max_by(F.struct("cand", "at", F.col("n_cand").alias("n")), score).alias("best")))
    j = b
    for col, name in (("joined", "j"), ("compound", "c"), ("left", "l"), ("right", "r")):
        j = j.join(best.select(F.col("word").alias(col), F.col("best").alias(name)), col, "left")
    nj, nc = F.coalesce("j.n", F.lit(0)), F.coalesce("c.n", F.lit(0))
    both = F.coalesce(F.least("l.n", "r.n"), F.lit(0)) >= HALF_SHARE * total
    hyphen = F.col("mark").isin(*SOFT) | F.when(nj + nc > 0, nj > nc).otherwise(~both)
    any_at = lambda c, test: F.coalesce(F.exists(c, test), F.lit(False))
    size = F.length("left")
    bad_left = F.when(hyphen, any_at("j.at", lambda p: p < size)).otherwise(F.coalesce(F.size("l.at") > 0, F.lit(False)))
    bad_right = F.when(hyphen, any_at("j.at", lambda p: p >= size)).otherwise(F.coalesce(F.size("r.at") > 0, F.lit(False)))
    fixed = F.when(hyphen, F.coalesce("j.cand", "joined")).otherwise(F.coalesce("c.cand", "compound"))
    return j.select("left", "right", "mark", hyphen.alias("hyphen"), bad_left.alias("bad_left"), bad_right.alias("bad_right"), fixed.alias("word"))


def _bit_table(words: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(BITS, bool)
        for pdf in batches:
            bits[bit_of(list(pdf["word"]))] = True
        yield pd.DataFrame({"bits": [np.packbits(bits).tobytes()]})

    out = np.zeros(BITS // 8, np.uint8)
    for row in words.select("word").distinct().coalesce(8).mapInPandas(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(row["bits"], np.uint8)
    return out


def pieces_to_decode(read_rows: DataFrame, table: np.ndarray) -> DataFrame:
    """stem, place, lines, words: the runs of words that the bit table knows or that hold a character no word has."""
    shared = read_rows.sparkSession.sparkContext.broadcast(table)  # BITS / 8 bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(shared.value).astype(bool)
        for pdf in batches:
            for stems, words, arrays in zip(pdf["stems"], pdf["words"], pdf["arrays"]):
                words = list(words)
                doubtful = bits[bit_of(words)] | np.array([certain_part(x) for x in words], bool)
                yield pd.DataFrame(doubtful_pieces(list(stems), words, arrays, doubtful), columns=["stem", "place", "lines", "words"])

    return read_rows.filter("part = 'p'").select("stems", "words", "arrays").mapInPandas(run, "stem string, place long, lines array<int>, words array<string>")


@lru_cache(1 << 16)
def _seed(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode(), 42)


def pair_key(a: str, b: str) -> int:
    """The hash that Spark gives two words."""
    k = xxhash.xxh64_intdigest(b.encode(), _seed(a))
    return k - (1 << 64) if k >> 63 else k


def viterbi(choices: list[list[tuple[str, float, float, float | None]]], pair: dict[int, int], total: float) -> list[str]:
    """The best word at each place, by the counts of pairs by their keys; choices for each place: (word, log probability of its confusions, count, for the word as read the share
    of its count that is its own, else None).

    Counts hold this text's own words, so a word as read counts one less, and so does a pair of words as read: a misread word must not
    be its own evidence. Pair counts are smoothed by PRIOR counts of the plain frequency, so that rare words' pairs say little."""
    best: list[dict[str, tuple[float, str]]] = []
    before: dict[str, tuple[float, float | None]] = {}
    for place in choices:
        now = {}
        for w, channel_, n, own in place:
            plain = (max(n - 1, 0) + UNSEEN if own is not None else max(n, UNSEEN)) / total
            if not best:
                now[w] = (math.log(plain) + channel_, "")
                continue
            options = []
            for p, (s, _) in best[-1].items():
                seen, (n_p, own_p) = pair.get(pair_key(p, w), 0) if pair else 0, before[p]
                if own is not None and own_p is not None:
                    seen, n_p = max(seen - 1, 0), max(n_p - 1, 0)
                seen *= (1 if own is None else own) * (1 if own_p is None else own_p)
                options.append((s + math.log((seen + PRIOR * plain) / (max(n_p, seen) + PRIOR)) + channel_, p))
            now[w] = max(options)
        best.append(now)
        before = {w: (n, own) for w, _, n, own in place}
    out = []
    if best:
        w = max(best[-1], key=lambda x: (best[-1][x][0], x))
        for now in reversed(best):
            out.append(w)
            w = now[w][1]
    return out[::-1]


def decode(pieces: DataFrame, alts: DataFrame, words: DataFrame, pairs: DataFrame, total: float) -> DataFrame:
    """stem, line_no, place, seen, printed: the words of the pieces that were misread."""
    key = ["stem", "place"]
    tok = pieces.select(*key, "lines", F.posexplode("words").alias("pos", "word")).filter("word IS NOT NULL")
    tok = tok.select(*key, "pos", "word", F.when(F.col("pos") > 0, F.try_element_at("lines", F.greatest("pos", F.lit(1)))).alias("line"))  # none for the neighbours
    options = alts.groupBy("word").agg(F.collect_list(F.struct("cand", "lp", F.col("n_cand").alias("n"))).alias("alts"))  # printed forms of one word
    tok = tok.join(words.select("word", F.col("n").alias("n_word")).join(options, "word", "left"), "word", "left")
    own = F.struct("pos", F.coalesce("line", F.lit(0)).alias("line"), "word", F.lit(0.0).alias("lp"), F.coalesce("n_word", F.lit(1)).cast("double").alias("n"))
    others = F.transform(F.coalesce("alts", F.array()), lambda a: F.struct(F.col("pos"), F.lit(-1).alias("line"), a["cand"].alias("word"), a["lp"].alias("lp"), a["n"].alias("n")))
    # the words of one piece, then their printed forms, in flat arrays
    line = tok.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", F.concat(F.array(own), others).alias("forms")))).alias("ts"))
    # keys of all pairs of forms of neighbours: each place meets the next one only
    hashes = lambda x, y: F.flatten(F.transform(x["forms"], lambda a: F.transform(y["forms"], lambda b: F.xxhash64(a["word"], b["word"]))))
    none = F.array().cast("array<bigint>")
    steps = F.transform(F.sequence(F.lit(1), F.size("ts")), lambda k: F.struct(F.element_at("ts", k).alias("x"), F.try_element_at("ts", k + 1).alias("y")))
    near = F.flatten(F.transform(steps, lambda s: F.when(s["y"]["pos"] == s["x"]["pos"] + 1, hashes(s["x"], s["y"])).otherwise(none)))
    forms = F.flatten(F.col("ts.forms"))
    line = cut(line.select(*key, forms.alias("f"), F.array_distinct(near).alias("near")).select(*key, "near", *[F.col(f"f.{c}").alias(c) for c in ("pos", "line", "word", "lp", "n")]))
    seen = line.select(*key, F.explode("near").alias("key")).join(pairs, "key")
    seen = seen.groupBy(*key).agg(F.collect_list(F.struct("key", "n")).alias("p")).select(*key, F.col("p.key").alias("keys"), F.col("p.n").alias("counts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for stem, pos, line_no, word, lp, n, keys, counts in pdf.itertuples(index=False):
                pair = dict(zip(keys.tolist(), counts.tolist())) if keys is not None else {}
                places: dict[int, list] = {}
                for at, no, w, c, m in zip(pos.tolist(), line_no.tolist(), word, lp.tolist(), n.tolist()):
                    places.setdefault(at, []).append((no, w, c, m))
                choices = []
                for found in places.values():
                    no, w, _, count = found[0]
                    inside = no > 0
                    others = [(x, c, m, None) for _, x, c, m in found[1:] if x != w] if inside else []
                    if inside and certain_part(w):  # it stands for itself in no reading
                        printed = undone(w)
                        choices.append(others or [(printed if printed != w else w + "\0", 0.0, 0.0, None)])
                    else:
                        kept = next((m for _, x, _, m in found[1:] if x == w), count)
                        choices.append([(w, 0.0, kept, kept / max(count, 1)), *others])
                for (at, found), w in zip(places.items(), viterbi(choices, pair, total)):
                    if w != found[0][1]:
                        out.append((stem, found[0][0], at, found[0][1], w.rstrip("\0")))
            yield pd.DataFrame(out, columns=["stem", "line_no", "place", "seen", "printed"])

    both = line.join(seen, key, "left").select("stem", "pos", "line", "word", "lp", "n", "keys", "counts")
    return both.mapInPandas(run, "stem string, line_no int, place int, seen string, printed string")


def _texts(sources: DataFrame, stem_col: str, text_col: str) -> DataFrame:
    return sources.select(F.col(stem_col).alias("stem"), F.col(text_col).alias("text")).filter("text <> ''").distinct()


def analyse(texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """texts(stem, text) -> findings, judged breaks, decoded words."""
    read_rows = read_texts(texts)
    words, pairs, breaks = summed(read_rows)
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    alts, rates = alternatives(words)
    found = read_rows.filter("part = 'f'").select("stem", "line_no", "kind", F.col("a").alias("left"), F.col("b").alias("right"), "mark", "next_line")
    judged = found.filter("kind = 'break'").join(judge_breaks(breaks, words, rates, total), ["left", "right", "mark"])
    return found, judged, decode(pieces_to_decode(read_rows, _bit_table(alts)), alts, words, pairs, total)


def noisy_lines(sources: DataFrame, stem_col: str = "stem", text_col: str = "text") -> DataFrame:
    """stem, line_no, kind (furniture, hyphen, misread); a furniture line has no other kind."""
    found, judged, decoded = analyse(_texts(sources, stem_col, text_col))
    judged = cut(judged)
    rows = found.filter("kind IN ('furniture', 'misread')").select("stem", "line_no", "kind")
    rows = rows.unionByName(judged.filter("hyphen").select("stem", "line_no", F.lit("hyphen").alias("kind")))
    rows = rows.unionByName(judged.filter("bad_left").select("stem", "line_no", F.lit("misread").alias("kind")))
    rows = rows.unionByName(judged.filter("bad_right").select("stem", F.col("next_line").alias("line_no"), F.lit("misread").alias("kind")))
    return rows.unionByName(decoded.select("stem", "line_no", F.lit("misread").alias("kind"))).distinct()


def put_right(token: str, fixes: dict[str, str]) -> str:
    """The token with its misread parts replaced, case kept."""

    def one(m: re.Match) -> str:
        w = m.group()
        new = fixes.get(w.lower())
        if new is None and certain_misread(w):
            new = undone(w.lower())
        if new is None:
            return w
        return new.upper() if w.isupper() and len(w) > 1 else new[:1].upper() + new[1:] if w[:1].isupper() else new

    bare = core(token)
    if not bare:
        return token
    at = token.index(bare)
    return token[:at] + re.sub(r"[^-‐‑–—/]+", one, bare) + token[at + len(bare) :]


def repaired_paragraphs(sources: DataFrame, stem_col: str = "stem", text_col: str = "text") -> DataFrame:
    """stem, para_no, text: the running text without furniture, broken words joined, misread words put right; paragraphs end at blank
    lines and at lines that end a sentence before one that is a heading; a page's end does not end one."""
    texts = cut(_texts(sources, stem_col, text_col))
    _, judged, decoded = analyse(texts)
    a = decoded.select("stem", F.struct("line_no", F.lit(0).alias("next_line"), "seen", "printed").alias("fix"))
    b = judged.select("stem", F.struct("line_no", "next_line", F.col("left").alias("seen"), F.when(F.col("hyphen"), F.col("word")).otherwise(F.lit(None)).alias("printed")).alias("fix"))
    fixes = a.unionByName(b).groupBy("stem").agg(F.collect_list("fix").alias("fixes"))  # of one text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for stem, t, fx in zip(pdf["stem"], pdf["text"], pdf["fixes"]):
                swap: dict[int, dict[str, str]] = {}
                join: dict[int, str | None] = {}
                for f in fx if fx is not None else ():
                    if f["next_line"]:
                        join[f["line_no"] - 1] = f["printed"]
                    else:
                        swap.setdefault(f["line_no"] - 1, {})[f["seen"]] = f["printed"]
                lines, kinds, words = read(t)
                paras: list[list[str]] = [[]]
                gaps = [k for k, kind in enumerate(kinds) if kind == "blank" and 0 < k < len(kinds) - 1 and kinds[k - 1] == "text" and kinds[k + 1] == "text"]
                g = 0
                for w in words:
                    while g < len(gaps) and gaps[g] < w.line:
                        g += 1
                        if paras[-1]:
                            paras.append([])
                    if w.index == 0 and re.match(r"\d+(?:\.\d+)+ \S", lines[w.line]) and paras[-1] and re.search(r"[.!?]\W*$", paras[-1][-1]):
                        paras.append([])
                    if w.right:
                        new = join.get(w.line)
                        tail = w.right[len(w.right.rstrip(STRIP)) :]
                        head = w.text[: len(w.text) - len(w.text.lstrip(STRIP))]
                        made = (new[:1].upper() + new[1:] if core(w.text)[:1].isupper() else new) if new else f"{core(w.text)}{'' if w.mark in SOFT else '-'}{core(w.right)}"
                        paras[-1].append(head + made + tail)
                    else:
                        paras[-1].append(put_right(w.text, swap.get(w.line, {})))
                rows += [(stem, n, " ".join(p)) for n, p in enumerate((p for p in paras if p), 1)]
            yield pd.DataFrame(rows, columns=["stem", "para_no", "text"])

    return texts.join(fixes, "stem", "left").select("stem", "text", "fixes").mapInPandas(run, "stem string, para_no int, text string")
