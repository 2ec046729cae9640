"""Several values packed in one field: split a citation field into one row for each cited work, with its position.

The text is split on quote characters: odd pieces are literals, even pieces are open text. An array fold puts the pieces together
again with the literals' digits, separators and doubled marks replaced by private-use characters, so that the one pattern of a
value's end (a year, perhaps a page, then a separator) sees open text only. Then the text is split there, the ordinals are the array
positions, and the private-use characters are put back. Everything is a built-in SQL expression: one narrow pass inside the JVM.

Defined results: null, empty and blank fields give no rows; unbalanced quotes are ordinary characters; a field with one value gives
one row (pos 1); repeated fields give repeated rows, which the caller makes distinct; other columns are kept only if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Private-use stand-ins for characters inside literals (digits, separators, doubled mark).
PLAIN = "0123456789;；|/·,&\n\t–—"
MASKED = "".join(chr(0xE100 + k) for k in range(len(PLAIN)))
DOUBLED = "\ue200"  # a doubled mark inside a literal
OPEN, CLOSE, CLOSE_PART = "\ue201", "\ue202", "\ue203"  # straight marks; CLOSE ends a literal that has a year
COPEN, CCLOSE, CCLOSE_PART = "\ue204", "\ue205", "\ue206"  # curly marks
CITED = "\ue207"  # a comma that leads on to "as cited in"
END = "\ue208"

YEAR = r"(?:\b(?:1[5-9]|20)\d\d[A-Za-z]?|\bn\.\s?d\.|\bin press\b|\bforthcoming\b)"
PAGE = r"(?:\s*,\s*pp?\.?\s*\d+(?:\s?[-–]\s?\d+)?)?"
SEPARATOR = r"(?:[;；|/·,&\n\t–—]|\band\b)"
COMPLETE = rf"{YEAR}\)?{PAGE}"


def _mask_literals(df: DataFrame, col: str, marks: str, opened: str, closed: str, part: str, doubled: bool, complete: str) -> DataFrame:
    """Fold the pieces between quote marks; unbalanced marks leave the text as it is. The pieces are a column of their own, so that
    the fold does not split the text again at each step."""
    df = df.withColumn("_pieces", F.split(F.col(col), f"[{marks}]")).withColumn("_n", F.size("_pieces"))
    n = F.col("_n")

    def step(acc: Column, pair: Column) -> Column:
        piece, k = pair["p"], pair["k"]
        twice = F.lit(doubled) & (k > 0) & (k < n - 1) & (piece == "")
        done = F.when(acc["lit"].rlike(complete), F.lit(closed)).otherwise(F.lit(part))
        even = F.concat(acc["s"], F.when(k > 0, done).otherwise(F.lit("")), piece, F.when(k < n - 1, F.lit(opened)).otherwise(F.lit("")))
        literal = F.struct(F.concat(acc["s"], F.translate(piece, PLAIN, MASKED)).alias("s"), F.concat(acc["lit"], piece).alias("lit"))
        mark = F.struct(F.concat(acc["s"], F.lit(DOUBLED)).alias("s"), acc["lit"].alias("lit"))
        return F.when(k % 2 == 1, literal).when(twice, mark).otherwise(F.struct(even.alias("s"), F.lit("").alias("lit")))

    pairs = F.transform(F.col("_pieces"), lambda p, k: F.struct(p.alias("p"), k.alias("k")))
    folded = F.aggregate(pairs, F.struct(F.lit("").alias("s"), F.lit("").alias("lit")), step)["s"]
    return df.withColumn(col, F.when((n > 1) & (n % 2 == 1), folded).otherwise(F.col(col))).drop("_pieces", "_n")


def _strip_brackets(text: Column) -> Column:
    """Take away brackets only where they stand around the whole field."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    inner = F.regexp_replace(t, r"^[(\[]|[)\]]$", "")
    # pairs within are taken out first; a bracket that is left over belongs to an outer one (no nested quantifier: long texts are safe)
    round_ = t.rlike(r"(?s)^\(.*\)$") & ~F.regexp_replace(inner, r"\([^()]*+\)", "").rlike("[()]")
    square = t.rlike(r"(?s)^\[.*\]$") & ~F.regexp_replace(inner, r"\[[^\[\]]*+\]", "").rlike(r"[\[\]]")
    return F.when(round_ | square, inner).otherwise(t)


def unpack_field(df: DataFrame, text_col: str, keep: list[str], complete: str = COMPLETE, separator: str = SEPARATOR) -> DataFrame:
    """keep + n_values, pos (from 1), cite_value: one row for each value. A separator counts only behind what completes a value: a pattern
    (without groups that capture), by default a year, "n.d." or "in press" and perhaps a page; "" lets every separator count. A quoted
    value is complete if it holds such an end."""
    value_end = rf"({complete}|[{CLOSE}{CCLOSE}])(?:\s*(?:{separator}\s*)+|\s*$)"
    work = df.select(*keep, _strip_brackets(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    work = _mask_literals(work, "_text", "“”", COPEN, CCLOSE, CCLOSE_PART, False, complete)
    work = _mask_literals(work, "_text", '"', OPEN, CLOSE, CLOSE_PART, True, complete)
    masked = F.regexp_replace("_text", r"(?i),(\s*as cited in\b)", CITED + "$1")
    cut = F.split(F.regexp_replace(masked, value_end, "$1" + END), END)

    def finish(v: Column) -> Column:
        v = F.trim(F.regexp_replace(v, r"\s+", " "))
        v = F.regexp_replace(v, f"^{OPEN}([^{OPEN}{CLOSE}{CLOSE_PART}]*)[{CLOSE}{CLOSE_PART}]$", "$1")
        v = F.regexp_replace(v, f"^{COPEN}([^{COPEN}{CCLOSE}{CCLOSE_PART}]*)[{CCLOSE}{CCLOSE_PART}]$", "$1")
        v = F.translate(v, MASKED + DOUBLED + OPEN + CLOSE + CLOSE_PART + COPEN + CCLOSE + CCLOSE_PART + CITED, PLAIN + '"' + '"""' + "“””" + ",")
        return F.trim(F.regexp_replace(v, r"\s+", " "))

    arr = work.select(*keep, F.filter(F.transform(cut, finish), lambda v: v != "").alias("_values"))
    out = arr.select(*keep, F.size("_values").alias("n_values"), F.posexplode("_values").alias("_pos", "cite_value"))
    return out.select(*keep, "n_values", (F.col("_pos") + 1).alias("pos"), "cite_value")
