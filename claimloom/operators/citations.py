"""Author-year citations in sentences: parenthetical, narrative, and the secondary forms of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The citation patterns.
PAIR = r"([A-Z][^,;()]+?)\s*,\s*(\d{4}[a-z]?)"
CITED_IN = r"(?i)\bas cited in\s+([A-Z][^,;()]+?)\s*,\s*(\d{4}[a-z]?)"
PAGE = r"(?i)\bpp?\.\s*(\d+(?:\s*[-–]\s*\d+)?)"
NARRATIVE = r"\b([A-Z][A-Za-z'’\-]+(?:\s+(?:&|and)\s+[A-Z][A-Za-z'’\-]+)?(?:\s+et al\.)?)\s*\(\s*(\d{4}[a-z]?)\s*\)"


def _record(text: Column, kind: str, author: Column, year: Column, page: Column, start: Column, p_author: Column | None = None, p_year: Column | None = None) -> Column:
    null = F.lit(None).cast("string")
    return F.struct(
        text.alias("citation_text"), F.lit(kind).alias("citation_type"), author.alias("citation_author"), year.alias("citation_year"), F.lit(kind.startswith("secondary")).alias("is_secondary"),
        (null if p_author is None else p_author).alias("primary_mentioned_author"), (null if p_year is None else p_year).alias("primary_mentioned_year"), F.nullif(page, F.lit("")).alias("stated_page"), start.alias("span_start"),
    )


def parenthetical(s: Column) -> Column:
    """A block with "as cited in" is one secondary citation of the host; else each author-year pair of the block is a citation."""
    blocks = F.regexp_extract_all(F.coalesce(s, F.lit("")), F.lit(r"\(([^()]+)\)"), F.lit(1))

    def one(block: Column, k: Column) -> Column:
        whole = F.concat(F.lit("("), block, F.lit(")"))
        page = F.regexp_extract(block, PAGE, 1)
        host, host_year = F.trim(F.regexp_extract(block, CITED_IN, 1)), F.regexp_extract(block, CITED_IN, 2)
        authors, years = F.regexp_extract_all(block, F.lit(PAIR), F.lit(1)), F.regexp_extract_all(block, F.lit(PAIR), F.lit(2))
        pairs = F.transform(F.arrays_zip(authors.alias("a"), years.alias("y")), lambda p: _record(whole, "parenthetical", F.trim(p["a"]), p["y"], page, k))
        return F.when(host != "", F.array(_record(whole, "secondary_parenthetical", host, host_year, page, k))).otherwise(pairs)

    return F.flatten(F.transform(blocks, one))


def narrative(s: Column, compat: bool = False) -> Column:
    """Name (year); the page is looked for after the match, then before it. Match ends come from the lengths of the pieces between.
    compat: the text of a chain has "as cited in" twice."""
    s = F.coalesce(s, F.lit(""))
    full, names, years = (F.regexp_extract_all(s, F.lit(NARRATIVE), F.lit(k)) for k in (0, 1, 2))
    gaps = F.split(s, NARRATIVE, -1)
    rows = F.arrays_zip(full.alias("m"), names.alias("a"), years.alias("y"), gaps.alias("g"))

    def one(r: Column, k: Column) -> Column:
        end = F.aggregate(F.slice(rows, 1, k + 1), F.lit(0), lambda acc, x: acc + F.length(x["g"]) + F.length(x["m"]))
        tail, head = F.substr(s, end + 1), F.substr(s, F.lit(1), end - F.length(r["m"]))
        page = F.coalesce(F.nullif(F.regexp_extract(tail, PAGE, 1), F.lit("")), F.regexp_extract(head, PAGE, 1))
        host, host_year = F.trim(F.regexp_extract(tail, CITED_IN, 1)), F.regexp_extract(tail, CITED_IN, 2)
        start = end - F.length(r["m"])
        secondary = _record(F.concat(r["m"], F.lit(", as cited in " if compat else ", "), F.regexp_extract(tail, CITED_IN, 0)), "secondary_narrative", host, host_year, page, start, F.trim(r["a"]), r["y"])
        return F.when(host != "", secondary).otherwise(_record(r["m"], "narrative", F.trim(r["a"]), r["y"], page, start))

    return F.transform(F.filter(rows, lambda r: r["m"].isNotNull()), one)


def citation_array(s: Column, compat: bool = False) -> Column:
    """Parenthetical, then narrative; of equal (author, year, type, place) the first."""
    return F.array_distinct(F.concat(parenthetical(s), narrative(s, compat)))


def citations(sentences: DataFrame, keys: list[str], sentence: str = "sentence", compat: bool = False) -> DataFrame:
    """keys, cit_no and the fields of each citation; sentences without one give no row."""
    rows = sentences.filter(F.col(sentence).rlike(r"\(")).select(*keys, F.posexplode(citation_array(F.col(sentence), compat)).alias("cit_no", "c"))
    return rows.select(*keys, "cit_no", "c.*")
