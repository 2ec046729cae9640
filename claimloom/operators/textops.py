"""From texts to lines, sections, sentences, references, pages, windows and quotations: array expressions and explodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.config import DEFAULTS
from claimloom.functions.scalars import SPACE, blank_to_null, strip, straight_quotes

# The patterns of a sentence's end and of a reference entry.
SENTENCE_GAP = rf"(?<=[.!?]){SPACE}+(?=[A-Z(“\"\[])"
SENTENCE_GAP_KEEPING_ET_AL = rf"(?<=[.!?])(?<!\bal\.(?={SPACE}{{1,9}}\()){SPACE}+(?=[A-Z(“\"\[])"
REFERENCE_ENTRY = r"^\s*([A-Z][A-Za-z'’\-]+)[^()]*\(\s*(\d{4}[a-z]?)\s*\)"


def line_array(text: Column) -> Column:
    """Lines as Python's splitlines gives them, but for the rare separators U+001C to U+001E."""
    parts = F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0B\x0C\x{85}\x{2028}\x{2029}]", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no from 0, line."""
    return df.select(key, F.posexplode(line_array(F.col(text))).alias("line_no", "line"))


def sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no, section, line: the running section label of each line that is not blank.

    A label holds from its heading to the next, so a text's lines are cut at its headings, inside its own row: no shuffle, no window."""

    def label(line: Column) -> Column:
        few = F.size(F.split(line, f"{SPACE}+")) <= 8
        loud = (F.upper(line) == line) & (F.lower(line) != line)
        return (
            F.when(F.startswith(line, F.lit("#")), F.lower(strip(F.regexp_replace(line, "^#+", ""))))
            .when(loud & few, F.lower(line))
            .when(F.endswith(line, F.lit(":")) & few, F.lower(strip(F.regexp_replace(line, ":$", ""))))
        )

    t = df.select(key, F.transform(line_array(F.col(text)), strip).alias("ls"))
    t = t.withColumn("heads", F.filter(F.transform("ls", lambda x, k: F.struct(k.alias("at"), F.when(x != "", label(x)).alias("label"))), lambda h: h["label"].isNotNull()))
    t = t.withColumn("heads", F.concat(F.array(F.struct(F.lit(0).alias("at"), F.lit("unknown").alias("label"))), "heads"))
    part = F.transform("heads", lambda h, k: F.struct(h["at"].alias("at"), h["label"].alias("label"), F.coalesce(F.try_element_at("heads", k + 2)["at"], F.size("ls")).alias("to")))
    spread = t.select(key, "ls", F.explode(part).alias("h")).select(key, "h.at", "h.label", F.posexplode(F.slice("ls", F.col("h.at") + 1, F.col("h.to") - F.col("h.at"))).alias("k", "line"))
    return spread.filter("line <> ''").select(key, (F.col("at") + F.col("k")).alias("line_no"), F.col("label").alias("section"), "line")


def sentence_array(text: Column, compat: bool = False) -> Column:
    """Cut at a gap after an end mark and before a capital or opener. compat: also between "et al." and its year in brackets."""
    parts = F.split(strip(F.coalesce(text, F.lit(""))), SENTENCE_GAP if compat else SENTENCE_GAP_KEEPING_ET_AL, -1)
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def sentences(df: DataFrame, keys: list[str], text: str, compat: bool = False) -> DataFrame:
    return df.select(*keys, F.posexplode(sentence_array(F.col(text), compat)).alias("sent_no", "sentence"))


def reference_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """Lines after the first line that is just "references" or "bibliography"."""
    all_lines = line_array(F.col(text))
    head = F.array_position(F.transform(all_lines, lambda x: x.rlike(r"(?i)^\s*(references|bibliography)\s*$")), True)
    rest = df.select(key, all_lines.alias("ls"), head.alias("h")).filter("h > 0")
    return rest.select(key, F.posexplode(F.slice("ls", F.col("h") + 1, F.size("ls"))).alias("k", "line"), "h").select(key, (F.col("h") + F.col("k")).cast("int").alias("line_no"), strip(F.col("line")).alias("line"))


def reference_entries(df: DataFrame, key: str, line: str) -> DataFrame:
    """key, first_author, year, raw_line of the lines that are reference entries."""
    parsed = df.select(key, F.regexp_extract(line, REFERENCE_ENTRY, 1).alias("first_author"), F.regexp_extract(line, REFERENCE_ENTRY, 2).alias("year"), strip(F.col(line)).alias("raw_line"))
    return parsed.filter("first_author <> ''")


def pages(df: DataFrame, key: str, text: str, tidy: bool = True) -> DataFrame:
    """key, page_no, page_ord, text. What stands before the first marker goes to the first page; of pages with one number the last stays;
    a text without markers has no pages. The cut is by the markers themselves: no explode by line and no shuffle."""
    t = F.concat(F.lit("\n"), F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\r\n?", "\n"), F.lit("\n"))
    marker = r"\n<<<PAGE=\d+>>>(?=\n)"
    cut = df.select(key, F.regexp_extract_all(t, F.lit(r"\n<<<PAGE=(\d+)>>>(?=\n)"), F.lit(1)).alias("nos"), F.split(t, marker, -1).alias("parts")).filter(F.size("nos") > 0)
    first = F.element_at("parts", 1)
    bodies = F.transform(F.slice("parts", 2, F.size("parts")), lambda b, k: F.when(k == 0, F.concat(first, b)).otherwise(b))
    rows = cut.select(key, F.posexplode(F.arrays_zip(F.col("nos").alias("no"), bodies.alias("body"))).alias("page_ord", "p"), "nos")
    last = F.size("nos") - F.array_position(F.reverse("nos"), F.col("p.no"))
    kept = rows.filter(F.col("page_ord") == last) if tidy else rows
    return kept.select(key, F.col("p.no").cast("int").alias("page_no"), "page_ord", strip(F.col("p.body")).alias("text"))


def windows(page_rows: DataFrame, key: str, width: int = DEFAULTS.chunk_words, stride: int = DEFAULTS.chunk_stride, keep_tail: bool = False) -> DataFrame:
    """key, page_no, win_no, text: sliding word windows of each page. keep_tail: one more window for words no full step reaches."""
    w = page_rows.select(key, "page_no", F.when(strip(F.col("text")) == "", F.array().cast("array<string>")).otherwise(F.split(strip(F.col("text")), f"{SPACE}+")).alias("ws"))
    top = F.greatest(F.lit(0), F.size("ws") - width)
    starts = F.sequence(F.lit(0), top, F.lit(stride))
    if keep_tail:
        starts = F.array_distinct(F.concat(starts, F.array(top)))
    spread = w.select(key, "page_no", "ws", F.posexplode(starts).alias("win_no", "start"))
    return spread.select(key, "page_no", "win_no", F.array_join(F.slice("ws", F.col("start") + 1, F.lit(width)), " ").alias("text"))


def quotation_array(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[\"“](.+?)[\"”]"), F.lit(1))


def quote_pages(claims: DataFrame, page_rows: DataFrame, claim_key: str, source_key: str, claim_text: str, first_only: bool = False) -> DataFrame:
    """claim_key, source_key, page_no, page_ord: pages of the claim's source that hold a quotation of the claim, quotes made straight.
    An equi-join on the source with a containment test behind it."""
    quotes = quotation_array(F.col(claim_text))
    q = claims.select(claim_key, source_key, F.explode(F.slice(quotes, 1, 1) if first_only else F.array_distinct(quotes)).alias("quote"))
    hit = q.join(page_rows, source_key).filter(F.contains(straight_quotes(F.col("text")), straight_quotes(F.col("quote"))))
    return hit.select(claim_key, source_key, "page_no", "page_ord").distinct()


def page_offsets(claims: DataFrame, page_rows: DataFrame, source_key: str, claim_text: str, stated: str) -> DataFrame:
    """source_key, offset, n_examples: the median of stated minus found page over claims whose first quotation is found."""
    said = F.regexp_extract(F.coalesce(F.col(stated), F.lit("")), r"^(\d{1,9})", 1).try_cast("int")
    c = claims.withColumn("_said", said).filter(F.col("_said").isNotNull() & F.col(claim_text).rlike("[\"“].+?[\"”]"))
    found = quote_pages(c, page_rows, "claim_id", source_key, claim_text, first_only=True)
    first = found.groupBy("claim_id", source_key).agg(F.min_by("page_no", "page_ord").alias("page"))
    diff = c.select("claim_id", source_key, "_said").distinct().join(first, ["claim_id", source_key]).select(source_key, (F.col("_said") - F.col("page")).alias("d"))
    return diff.groupBy(source_key).agg(F.floor(F.percentile("d", F.lit(0.5))).cast("int").alias("logical_minus_pdf_offset"), F.count("*").cast("int").alias("n_examples"))


def citation_parts(text: Column) -> Column:
    """One outer pair of round brackets off, cut at semicolons, trimmed, blanks dropped."""
    t = strip(F.coalesce(text, F.lit("")))
    t = F.when(t.rlike(r"^\(.*\)$"), F.regexp_replace(t, r"^\(|\)$", "")).otherwise(t)
    return F.filter(F.transform(F.split(t, ";"), strip), lambda p: p != "")


def fill_blank(df: DataFrame, col: str, value: Column) -> DataFrame:
    """Fill a column where it is null or blank; what stays empty is the empty string."""
    return df.withColumn(col, F.coalesce(blank_to_null(F.col(col)), value, F.lit("")))
