"""Scalar functions on columns: all built-in expressions, so they stay inside generated code."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no topic.
STOPWORDS = (
    "the and a an of to in for on with as by from at that this these those "
    "is are was were be been being it its their there which or not but if than "
    "can may might should would could will shall do does did done such into over "
    "about across per vs via within between among both also more most much many some "
    "any each other another however therefore thus so because while where when"
).split()
# Surname particles, and headings that are weighed down.
PARTICLES = ["de", "van", "von", "da", "del", "di"]
WEAK_HEADINGS = r"(?i)\b(?:executive\s+summary|abstract|overview)\b"
# Patterns of the flags.
QUOTE_MARKS = "[\"“”']"
CAUSAL = r"(?i)\b(lead(?:s|ing)?\s+to|cause(?:s|d)?|result(?:s|ed)?\s+in|should|must|best\s+practice|therefore|hence)\b"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
SPACE = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}]"


def strip(c: Column) -> Column:
    """Outer white space of any script off."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def norm_spaces(c: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), f"{SPACE}+", " "))


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def or_else(c: Column, other: Column) -> Column:
    """The first value unless it is null or blank."""
    return F.coalesce(F.when(c != "", c), other)


def default_if_missing(fields: Column, key: str, default: str) -> Column:
    """A map's value of a key, null if it is null there; the default only where the key is missing."""
    return F.when(F.map_contains_key(fields, key), fields[key]).otherwise(F.lit(default))


def joined(json: Column, sep: str = ";") -> Column:
    """A JSON array of texts as one text; a value that is no array counts as the one item of one, null as none."""
    items = F.from_json(json, "array<string>")
    one = F.when(json.isNull() | (F.trim(json) == "null"), "").otherwise(F.regexp_replace(json, '^"|"$', ""))
    return F.when(F.startswith(F.trim(F.coalesce(json, F.lit(""))), F.lit("[")), F.array_join(items, sep)).otherwise(one)


def tokens(c: Column) -> Column:
    """Lower-case ASCII words of two letters and more that are no stopwords; repeats stay."""
    words = F.split(strip(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), PUNCTUATION, " ")), f"{SPACE}+")
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*STOPWORDS) & w.rlike(r"^[\x00-\x7F]+$"))


def is_quote(c: Column) -> Column:
    return c.rlike(QUOTE_MARKS)


def has_numbers(c: Column) -> Column:
    return c.rlike(r"\d")


def is_causal_or_normative(c: Column) -> Column:
    return c.rlike(CAUSAL)


def norm_stem(c: Column) -> Column:
    """File stems and citations in one shape: words joined by single underscores."""
    s = F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit(" and "))
    s = F.regexp_replace(F.regexp_replace(s, PUNCTUATION, " "), "[^A-Za-z0-9_ ]+", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(s), " +", " ")), " ", "_")


def first_year(c: Column, compat: bool = False) -> Column:
    """First year with its suffix, lower case, or null. compat: needs word borders, of which an underscore is none."""
    pattern = r"(?i)\b((?:19|20)\d{2}[a-z]?)\b" if compat else r"(?i)(?:^|[^0-9])((?:19|20)\d{2}(?:[a-z](?![a-z]))?)(?![0-9])"
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, 1)), F.lit(""))


def year_digits(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"((?:19|20)\d{2})", 1), F.lit(""))


def strip_et_al(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)\bet\.?\s*al\.?\b", "")


def author_key(c: Column) -> Column:
    """The first author or body as an underscored key."""
    a = F.replace(strip_et_al(c), F.lit("&"), F.lit(" and "))
    a = F.trim(F.regexp_replace(F.regexp_replace(a, r"[()\[\]{},.;:]", " "), r"\s+", " "))
    piece = F.lower(F.trim(F.element_at(F.split(a, r"(?i)\band\b|[–—]", 2), 1)))
    piece = F.regexp_replace(F.replace(piece, F.lit("-"), F.lit("_")), "[’']", "")
    return F.regexp_replace(F.regexp_replace(piece, r"\s+", "_"), "^_+|_+$", "")


def author_variants(c: Column) -> Column:
    """The key, its last word, both without underscores, and without a particle in front."""
    key = author_key(c)
    last = F.element_at(F.split(key, "_"), -1)
    rest = F.when(F.element_at(F.split(key, "_"), 1).isin(*PARTICLES) & key.contains("_"), F.regexp_replace(key, "^[^_]+_", ""))
    bare = lambda x: F.replace(x, F.lit("_"), F.lit(""))
    return F.filter(F.array_distinct(F.array(key, last, bare(key), bare(last), rest, bare(rest))), lambda v: v.isNotNull() & (v != ""))


def mined_authors(c: Column) -> Column:
    """Names in a citation's text before its first year."""
    t = F.regexp_replace(F.replace(strip_et_al(c), F.lit("&"), F.lit(" and ")), "[()]", " ")
    head = F.element_at(F.split(t, r"(?i)\b(?:19|20)\d{2}[a-z]?\b", 2), 1)
    chunks = F.filter(F.transform(F.split(head, r"(?i),|\band\b"), lambda x: F.regexp_replace(norm_stem(x), "^_+|_+$", "")), lambda x: x != "")
    names = F.flatten(F.transform(chunks, lambda x: F.array(F.element_at(F.split(x, "_"), -1), x)))
    return F.array_distinct(F.concat(names, F.transform(names, lambda x: F.replace(x, F.lit("_"), F.lit("")))))


def norm_lead(c: Column) -> Column:
    s = F.regexp_replace(strip_et_al(F.trim(F.coalesce(c, F.lit("")))), "-", "_")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"[^\w.]+", "_"), "_+", "_"), "^_+|_+$", "")


def candidate_names(citation: Column) -> Column:
    """[lead_year, lead] of a citation."""
    lead = norm_lead(F.element_at(F.split(F.coalesce(citation, F.lit("")), ","), 1))
    lead = F.regexp_replace(lead, r"^[(_]+", "")
    year = year_digits(citation)
    return F.array_compact(F.array(F.when(year.isNotNull(), F.concat_ws("_", lead, year)), lead))


def _decomposed() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that compatibility decomposition without marks makes one ASCII character, and Latin letters it makes several."""
    one, many = {}, {}
    for k in (*range(0xC0, 0x2200), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(k)) if not unicodedata.combining(c))
        if plain != chr(k) and plain.isascii() and plain:
            if len(plain) == 1:
                one[chr(k)] = plain
            elif plain.isalpha():
                many[chr(k)] = plain
    return one, many


_ONE, _MANY = _decomposed()


def plain_letters(c: Column) -> Column:
    """Compatibility decomposition with the marks dropped, for every character that it makes ASCII."""
    c = F.translate(F.coalesce(c, F.lit("")), "".join(_ONE), "".join(_ONE.values()))
    ligature = F.split(F.regexp_replace(c, f"([{''.join(_MANY)}])", "\ue000$1\ue000"), "\ue000", -1)  # few texts have one
    parts = F.transform(ligature, lambda x: F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in _MANY.items() for v in kv]), x), x))
    return F.regexp_replace(F.when(c.rlike(f"[{''.join(_MANY)}]"), F.array_join(parts, "")).otherwise(c), r"\p{Mn}+", "")


def surname_key(c: Column) -> Column:
    """One surname-like word of the first author, for strict keys."""
    s = F.trim(F.regexp_replace(F.translate(plain_letters(c), "–—‐", "---"), r"\s+", " "))
    s = F.regexp_replace(F.replace(s, F.lit("CLEARAA"), F.lit("CLEAR-AA")), r"[’']s\b", "")
    s = F.element_at(F.split(s, r"\s+(?:&|and)\s+"), 1)
    s = F.element_at(F.split(F.trim(F.regexp_replace(s, r"(?i)\bet\s+al\.?\b", "")), ","), 1)
    return F.lower(F.regexp_extract(s, r"([A-Za-z\-]+)", 1))


def first_author_key(c: Column, compat: bool = False) -> Column:
    """First word of the first author. compat: splits at the letters "and" anywhere, so "Brandt" becomes "br"."""
    s = F.element_at(F.split(F.coalesce(c, F.lit("")), "&"), 1)
    s = F.element_at(F.split(s, "and" if compat else r"\band\b"), 1)
    s = F.trim(F.element_at(F.split(s, ","), 1))
    return F.lower(F.element_at(F.split(s, r"\s+"), 1))


def straight_quotes(c: Column) -> Column:
    return F.translate(c, "“”‘’", "\"\"''")


def heading_penalty(c: Column) -> Column:
    return F.when(c.rlike(WEAK_HEADINGS), 0.60).otherwise(1.0)


def level_boost(level: Column) -> Column:
    return F.when(level == 4, 1.15).when(level == 3, 1.10).when(level == 2, 1.00).when(level == 1, 0.90).otherwise(1.00)


def leading_page(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"^(\d{1,9})", 1).try_cast("int")


def page_label(start: Column, end: Column) -> Column:
    return F.when(start == end, start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))


def basename(c: Column) -> Column:
    return F.element_at(F.split(F.translate(c, "\\", "/"), "/"), -1)


def stem(c: Column) -> Column:
    return F.regexp_replace(F.trim(basename(c)), r"(?i)(?:\.pdf)+$", "")


def any_of(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cols)
