"""Evaluation texts leaking into training text: size-partitioned MinHash containment search, verified by exact shingle containment.

Texts become words apart from case, punctuation, spacing, invisible characters and markup, and words become shingles of five. A short
test item inside a long document has a tiny Jaccard similarity with the whole document, so documents are cut into overlapping blocks
of BLOCK words, any run of LEAST words lying wholly in one, and items into windows of LEAST words. Blocks and windows are partitioned
by their number of shingles; the larger a block against a window, the more permutations its class gets, so that containment is found
in each class alike. A block and a window that share the minimum of any permutation make a candidate.

Items shorter than a window are a size class of their own, searched exactly, with no chance of a miss: up to seven words as one n-gram,
from eight on, where one word may be replaced, as two halves of which one stays whole.

The items' keys are also folded into a bit table of BITS_A_KEY bits a key, at most MAX_BITS, a proven bound: more items are gone through
in rounds. The table goes to the executors, so block keys that no item has never leave the Python worker. The rest is an equi-join on
the key. Candidate pairs are verified on whole texts: shingles that both hold exactly give the diagonals, and along one of them there
must be a run of at least LEAST words (or the whole item, if shorter) that begins and ends with equal words and has at most REPLACED of
its words replaced.

Defined results: null and empty texts match nothing; an item without a word likewise; repeated documents are each reported under their
own id; repeated items likewise. Work is linear in the text; no pair of documents is formed, and texts go through memory CHUNK
characters at a time.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut

SHINGLE, LEAST, BLOCK, STRIDE = 5, 15, 32, 16
REPLACED = 0.14
BITS_A_KEY, MIN_BITS, MAX_BITS = 16, 1 << 16, 1 << 27
CHUNK = 1 << 21
#: permutations by size class: the upper bound of shingles in a block, and the permutations that find a window of LEAST words in it
CLASSES = ((7, 8), (14, 20), (BLOCK - SHINGLE + 1, 40))
PERMUTATIONS = max(p for _, p in CLASSES)

_TAG = re.compile(r"</?[A-Za-z][^<>]*+>")
_WORD = re.compile(r"[぀-ヿ㐀-鿿]|[^\W_぀-ヿ㐀-鿿]+")
_RNG = np.random.default_rng(20240607)
_MUL = _RNG.integers(1, 1 << 62, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(1, 1 << 62, PERMUTATIONS, dtype=np.uint64)
_POS = _RNG.integers(1, 1 << 62, LEAST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
        text = "".join(c for c in text if unicodedata.category(c) not in ("Cf", "Mn"))
    return _WORD.findall(text.lower())


def word_hashes(words: list[str]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    codes, unique = pd.factorize(np.array(words, dtype=object))
    return pd.util.hash_array(unique, categorize=False)[codes].astype(np.uint64)


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * _POS[k]
    out ^= out >> np.uint64(31)
    return out


def min_keys(sh: np.ndarray, starts: np.ndarray, ends: np.ndarray, permutations: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, key) for each segment sh[start:end] and each of its permutations; the key holds the permutation's number."""
    seg, key = [], []
    for p in range(int(permutations.max(initial=0))):
        use = np.flatnonzero(permutations > p)
        v = sh * _MUL[p] + _ADD[p]
        v ^= v >> np.uint64(33)
        pairs = np.empty(2 * len(use), np.int64)
        pairs[0::2], pairs[1::2] = starts[use], ends[use]
        low = np.minimum.reduceat(np.append(v, np.uint64(0)), pairs)[0::2]
        seg.append(use)
        key.append((low >> np.uint64(6) << np.uint64(6)) | np.uint64(p))
    return np.concatenate(seg) if seg else np.zeros(0, np.int64), np.concatenate(key) if key else np.zeros(0, np.uint64)


def segments(n_shingles: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, start and end of the segments of `size` shingles (the last one flush with the end) over texts laid end to end."""
    offs = np.concatenate([[0], np.cumsum(n_shingles)])
    owner, start, end = [], [], []
    for k, n in enumerate(n_shingles.tolist()):
        if n <= 0:
            continue
        a = np.arange(0, max(n - size, 0) + 1, stride)
        if a[-1] + size < n:
            a = np.append(a, n - size)
        owner.append(np.full(len(a), k))
        start.append(offs[k] + a)
        end.append(offs[k] + np.minimum(a + size, n))
    z = np.zeros(0, np.int64)
    return (np.concatenate(owner), np.concatenate(start), np.concatenate(end)) if owner else (z, z, z)


def block_permutations(sizes: np.ndarray) -> np.ndarray:
    out = np.full(len(sizes), CLASSES[-1][1])
    for bound, p in reversed(CLASSES):
        out[sizes <= bound] = p
    return out


def pieces(n: int) -> list[tuple[int, int]]:
    """(start, length) of the n-grams of a short item of n words, one of which stays whole if at most REPLACED of its words are replaced."""
    cuts = 1 + int(REPLACED * n)
    at = [n * k // cuts for k in range(cuts + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def gram_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """Keys of all n-grams of one size; they hold the size where window keys hold a permutation's number."""
    return (shingles(hashes, size) >> np.uint64(6) << np.uint64(6)) | np.uint64(PERMUTATIONS + size)


def keys_of(texts: list[str | None], size: int, stride: int, every: bool, grams: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the distinct minimum keys of each text's segments. every: all permutations, as any block class may meet them, and
    for texts shorter than a window the keys of their pieces. grams: sizes of n-grams to give keys of too."""
    lists = [words_of(t) for t in texts]
    flat = word_hashes([w for x in lists for w in x])
    cuts = np.cumsum([0] + [len(x) for x in lists])
    short = np.array([every and len(x) < LEAST for x in lists], bool)
    parts = [shingles(flat[a:b]) if not s else np.zeros(0, np.uint64) for a, b, s in zip(cuts, cuts[1:], short)]
    owner, start, end = segments(np.array([len(p) for p in parts], np.int64), size, stride)
    own, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    if len(owner):
        perms = np.full(len(owner), PERMUTATIONS) if every else block_permutations(end - start)
        seg, key = min_keys(np.concatenate(parts), start, end, perms)
        own.append(owner[seg].astype(np.uint64))
        keys.append(key)
    for k in np.flatnonzero(short):
        for at, n in pieces(len(lists[k])):
            if n:
                keys.append(gram_keys(flat[cuts[k] + at : cuts[k] + at + n], n))
                own.append(np.full(len(keys[-1]), k, np.uint64))
    for n in grams or ():
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            keys.append(gram_keys(flat[a:b], n))
            own.append(np.full(len(keys[-1]), k, np.uint64))
    both = np.stack([np.concatenate(own), np.concatenate(keys)], 1)
    both = np.unique(both, axis=0) if every else both
    return both[:, 0].astype(np.int64), both[:, 1]


def chunked(pdf: pd.DataFrame, col: str = "text", limit: int = CHUNK) -> Iterator[pd.DataFrame]:
    """The rows in pieces of about limit characters, so that memory does not grow with the texts of a batch."""
    part = pdf[col].str.len().fillna(0).cumsum() // limit
    yield from (rows for _, rows in pdf.groupby(part.to_numpy(), sort=False))


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % np.uint64(bits)


def _has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _bit(keys, 8 * len(table))
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def item_keys(items: DataFrame) -> DataFrame:
    """items(item_id, text) -> item_id, key, gram (the size of the n-gram, or null)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for rows in chunked(pdf):
                own, key = keys_of(list(rows["text"]), LEAST - SHINGLE + 1, 1, True)
                gram = pd.Series((key & np.uint64(63)).astype(np.int64) - PERMUTATIONS, dtype="Int64")
                yield pd.DataFrame({"item_id": rows["item_id"].to_numpy()[own], "key": key.view(np.int64), "gram": gram.where(gram > 0)})

    return items.select("item_id", "text").mapInPandas(run, "item_id long, key long, gram int")


def bit_table(keys: DataFrame, bits: int) -> np.ndarray:
    """The keys' bits as a table of bits / 8 bytes; each of at most eight partitions sends one such table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.zeros(bits, bool)
        for pdf in batches:
            flags[_bit(pdf["key"].to_numpy(np.int64).view(np.uint64), bits)] = True
        yield pd.DataFrame({"bits": [np.packbits(flags, bitorder="little").tobytes()]})

    out = np.zeros(bits // 8, np.uint8)
    for row in keys.select("key").coalesce(8).mapInPandas(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(row["bits"], np.uint8)
    return out


def longest_run(doc: list[str], item: list[str], least: int = LEAST, replaced: float = REPLACED) -> tuple[int, int]:
    """Words and replaced words of the longest verified run, (0, 0) if there is none."""
    least = min(least, len(item))
    size = SHINGLE if len(item) >= LEAST else min(n for _, n in pieces(len(item)))
    if not size or len(doc) < size:
        return 0, 0
    at = defaultdict(list)
    for j in range(len(item) - size + 1):
        at[tuple(item[j : j + size])].append(j)
    diagonals = {i - j for i in range(len(doc) - size + 1) for j in at.get(tuple(doc[i : i + size]), ())}
    best = (0, 0)
    for d in sorted(diagonals):
        low, high = max(0, -d), min(len(item), len(doc) - d)
        same = np.fromiter((doc[j + d] == item[j] for j in range(low, high)), bool, high - low)
        hits = np.flatnonzero(same)
        wrong = np.cumsum(~same)
        for a in hits:
            if high - low - a <= max(best[0], least - 1):
                break
            ends = hits[hits >= a + max(best[0], least - 1)]
            if not len(ends):
                break
            n = ends - a + 1
            bad = wrong[ends] - wrong[a]
            ok = np.flatnonzero(bad <= replaced * n)
            if len(ok) and n[ok[-1]] > best[0]:
                best = (int(n[ok[-1]]), int(bad[ok[-1]]))
    return best


def _round(documents: DataFrame, keys: DataFrame, n_keys: int, grams: list[int]) -> DataFrame:
    bits = min(MAX_BITS, max(MIN_BITS, 1 << (BITS_A_KEY * n_keys - 1).bit_length()))
    table = documents.sparkSession.sparkContext.broadcast(bit_table(keys, bits))  # bits / 8 bytes, at most MAX_BITS / 8

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for rows in chunked(pdf):
                own, key = keys_of(list(rows["text"]), BLOCK - SHINGLE + 1, STRIDE, False, grams)
                keep = _has(table.value, key)
                yield pd.DataFrame({"doc_id": rows["doc_id"].to_numpy()[own[keep]], "key": key[keep].view(np.int64)}).drop_duplicates()

    found = documents.select("doc_id", "text").filter("text <> ''").mapInPandas(run, "doc_id long, key long")
    return found.join(keys.select("item_id", "key"), "key").select("doc_id", "item_id").distinct()


def candidates(documents: DataFrame, items: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, item_id of the pairs that share a minimum key. More items than a table of max_bits can tell apart take several rounds."""
    keys = cut(item_keys(items))
    sizes = keys.agg(F.count("*").alias("n"), F.collect_set("gram").alias("grams")).first()  # at most LEAST sizes
    if not sizes["n"]:
        return keys.select(F.col("item_id").alias("doc_id"), "item_id")
    rounds = math.ceil(BITS_A_KEY * sizes["n"] / max_bits)
    parts = [_round(documents, keys.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r) if rounds > 1 else keys, math.ceil(sizes["n"] / rounds), sorted(sizes["grams"])) for r in range(rounds)]
    return reduce(DataFrame.unionByName, parts)


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, run_words, replaced_words for each document and the items that leaked into it."""
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(doc_text).alias("text"))
    tests = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).filter("text <> ''")
    pairs = candidates(docs, tests)
    joined = pairs.join(docs, "doc_id").join(tests.withColumnRenamed("text", "item_text"), "item_id")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            memo: dict[str, list[str]] = {}

            def words(t: str) -> list[str]:
                if t not in memo:
                    memo[t] = words_of(t)
                return memo[t]

            runs = [longest_run(words(t), words(i)) for t, i in zip(pdf["text"], pdf["item_text"])]
            out = pd.DataFrame({"doc_id": pdf["doc_id"], "item_id": pdf["item_id"], "run_words": [a for a, _ in runs], "replaced_words": [b for _, b in runs]})
            yield out[out["run_words"] > 0]

    return joined.select("doc_id", "item_id", "text", "item_text").mapInPandas(verify, "doc_id long, item_id long, run_words int, replaced_words int").distinct()
