"""Token-set similarity: the parts Spark can express, and the longest common subsequence as an Arrow UDF."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.scalars import SPACE

GAP = SPACE.replace("[", r"[\x1C-\x1F", 1)


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence by bit-parallel addition on big integers: a step for each character of the shorter text, on as many bits
    as the longer one has characters."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return 0
    codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    where = {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in set(b)}
    full = (1 << len(a)) - 1
    row = full
    for mask in map(where.__getitem__, b):
        u = row & mask
        if u:
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


@lru_cache(256)
def _tokens(text: str) -> frozenset[str]:
    return frozenset(text.split())


def token_set_ratio(a: str | None, b: str | None) -> float:
    """0..100 over the sets of white-space tokens, case kept."""
    x, y = _tokens(a or ""), _tokens(b or "")
    if not x or not y:
        return 0.0
    both, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not left or not right):
        return 100.0
    s, l, r = " ".join(both), " ".join(left), " ".join(right)
    sep = 1 if both else 0
    la, lb = len(s) + sep + len(l), len(s) + sep + len(r)
    best = 100 * (1 - (len(l) + len(r) - 2 * lcs_length(l, r)) / (la + lb))
    if both:
        best = max(best, 100 * (1 - (1 + len(l)) / (len(s) + la)), 100 * (1 - (1 + len(r)) / (len(s) + lb)))
    return best


@F.pandas_udf(T.DoubleType())
def token_set_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_ratio(x, y) for x, y in zip(a, b)])


def _words(c: Column) -> Column:
    """White-space tokens as Python's split gives them, white space of any script."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{GAP}+"), lambda t: t != "")


def token_sets(c: Column) -> Column:
    """Sorted distinct white-space tokens."""
    return F.array_sort(F.array_distinct(_words(c)))


def _bounds(s: Column, l: Column, r: Column, common: Column, any_x: Column, any_y: Column, any_l: Column, any_r: Column) -> tuple[Column, Column]:
    """From the lengths of the common tokens and of both rests, joined by blanks."""
    sep = F.when(common, 1).otherwise(0)
    la, lb = s + sep + l, s + sep + r
    r1 = F.when(common, F.greatest(100 * (1 - (sep + l) / (s + la)), 100 * (1 - (sep + r) / (s + lb)))).otherwise(F.lit(0.0))
    top = 100 * (1 - F.abs(l - r) / (la + lb))
    empty, full = ~any_x | ~any_y, common & (~any_l | ~any_r)
    native = F.when(empty, 0.0).when(full, 100.0).otherwise(r1)
    return native, F.when(empty, 0.0).when(full, 100.0).otherwise(F.greatest(r1, top))


def token_set_bounds(x: Column, y: Column) -> tuple[Column, Column]:
    """(native, bound) for two token arrays: what the ratio is without the common subsequence, and the most it can be with it.

    A common subsequence is no longer than the shorter rest, so bound >= ratio >= native: pruning by the bound loses nothing."""
    both, left, right = F.array_intersect(x, y), F.array_except(x, y), F.array_except(y, x)
    s, l, r = (F.length(F.array_join(v, " ")) for v in (both, left, right))
    return _bounds(s, l, r, F.size(both) > 0, F.size(x) > 0, F.size(y) > 0, F.size(left) > 0, F.size(right) > 0)


LENGTH_BITS = 0xFFFF


def token_codes(c: Column) -> Column:
    """The distinct white-space tokens as numbers: a hash, and in its low bits the token's length."""
    code = lambda t: F.xxhash64(t).bitwiseAND(F.lit(~LENGTH_BITS)).bitwiseOR(F.least(F.length(t), F.lit(LENGTH_BITS)).cast("long"))
    return F.array_distinct(F.transform(_words(c), code))


def code_chars(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(0), lambda a, v: a + v.bitwiseAND(F.lit(LENGTH_BITS)).cast("int"))


def bounds_of_common(both: Column, nx: Column, ny: Column, x_chars: Column, y_chars: Column) -> tuple[Column, Column]:
    """token_set_bounds from the common token codes, the numbers of codes and the characters of each side: all lengths follow from these,
    so a pair costs one intersection of numbers."""
    n, chars = F.size(both), code_chars(both)
    joined = lambda chars, n: F.greatest(chars + n - 1, F.lit(0))
    return _bounds(joined(chars, n), joined(x_chars - chars, nx - n), joined(y_chars - chars, ny - n), n > 0, nx > 0, ny > 0, nx > n, ny > n)
