"""Queries of the claim pipeline's operators over the given tables, and the SQL they are checked against.

Where a query has a documented-intent and a literal mode, it runs in the documented-intent mode unless its name ends in _compat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import scalars as X
from claimloom.functions.lcs import token_set_bounds, token_set_ratio_udf, token_sets
from claimloom.operators import citations, jsonrepair, reports, resolve, retrieval, sections, textops
from claimloom.schemas import FLAGS
from claimloom.session import table

# ---------------------------------------------------------------- inputs


def _claims(s: SparkSession, d: str) -> DataFrame:
    """The last delivery of each claim."""
    return reports.last_of(table(s, d, "ccp_registry"), ["claim_id"], ["loaded_at"])


_CLAIMS = "claims AS (SELECT * FROM ccp_registry QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY loaded_at DESC) = 1)"


def _texts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "ccp_registry").select("claim_id", "claim_text").filter("claim_text IS NOT NULL").distinct()


_TEXTS = "texts AS (SELECT DISTINCT claim_id, claim_text FROM ccp_registry WHERE claim_text IS NOT NULL)"
_SP = r"[\s\x{000B}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}]"


def _sources(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "sources_text").select("stem", "text").filter("text <> ''").distinct()


def _verdicts(s: SparkSession, d: str) -> DataFrame:
    """A verdict for each claim from its best evidence score."""
    a = reports.last_of(table(s, d, "adjudication_inputs").select("claim_id", "review_id", "section", "evidence", "built_at"), ["claim_id"], ["built_at"])
    best = F.coalesce(F.array_max(F.transform("evidence", lambda e: e["score"])), F.lit(0))
    verdict = F.when(best >= 90, "EXACT_QUOTE_PASS").when(best >= 60, "FAITHFUL_PARAPHRASE_PASS").when(best >= 30, "AMBIGUOUS_REVIEW").otherwise("UNSUPPORTED_FAIL")
    return a.select("claim_id", "review_id", "section", best.alias("best"), verdict.alias("verdict"))


_VERDICTS = """v0 AS (SELECT claim_id, review_id, section, coalesce(list_max(list_transform(evidence, lambda e: e.score)), 0) AS best FROM adjudication_inputs
 QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY built_at DESC) = 1),
verdicts AS (SELECT *, CASE WHEN best >= 90 THEN 'EXACT_QUOTE_PASS' WHEN best >= 60 THEN 'FAITHFUL_PARAPHRASE_PASS' WHEN best >= 30 THEN 'AMBIGUOUS_REVIEW' ELSE 'UNSUPPORTED_FAIL' END AS verdict FROM v0)"""

# ---------------------------------------------------------------- text


def q_lines(s: SparkSession, d: str) -> DataFrame:
    return textops.lines(table(s, d, "documents"), "doc_id", "text")


def q_sections(s: SparkSession, d: str) -> DataFrame:
    return textops.sections(table(s, d, "documents"), "doc_id", "text")


def q_sentences(s: SparkSession, d: str) -> DataFrame:
    return textops.sentences(table(s, d, "documents"), ["doc_id"], "text")


def q_sentences_compat(s: SparkSession, d: str) -> DataFrame:
    return textops.sentences(table(s, d, "documents"), ["doc_id"], "text", compat=True)


def q_claim_flags(s: SparkSession, d: str) -> DataFrame:
    c = F.col("claim_text")
    t = _texts(s, d).select("claim_id", "claim_text", X.is_quote(c).alias("is_quote"), X.has_numbers(c).alias("has_numbers"), X.is_causal_or_normative(c).alias("is_causal_or_normative"))
    return t.withColumn("priority", F.when(X.any_of([F.col(f) for f in FLAGS]), "High").otherwise("Low")).drop("claim_text")


def _cited(s: SparkSession, d: str) -> DataFrame:
    sent = textops.sentences(_texts(s, d), ["claim_id"], "claim_text")
    return citations.citations(sent, ["claim_id", "sent_no"])


def q_parenthetical(s: SparkSession, d: str) -> DataFrame:
    """Author-year pairs of every bracket of a claim that is no chain."""
    rows = _texts(s, d).select("claim_id", F.explode(citations.parenthetical(F.col("claim_text"))).alias("c")).select("claim_id", "c.*").filter("citation_type = 'parenthetical'")
    return rows.select("claim_id", "citation_text", "citation_author", "citation_year", F.coalesce("stated_page", F.lit("")).alias("stated_page"))


def q_secondary(s: SparkSession, d: str) -> DataFrame:
    rows = _texts(s, d).select("claim_id", F.explode(citations.parenthetical(F.col("claim_text"))).alias("c")).select("claim_id", "c.*").filter("citation_type = 'secondary_parenthetical'")
    return rows.select("claim_id", "citation_text", "citation_author", "citation_year")


def q_narrative(s: SparkSession, d: str) -> DataFrame:
    """Narrative citations, plain or leading to the host that a chain behind them names, each with its place and page."""
    rows = _texts(s, d).select("claim_id", F.explode(citations.narrative(F.col("claim_text"))).alias("c")).select("claim_id", "c.*")
    return rows.select("claim_id", "citation_text", "citation_author", "citation_year", "citation_type", "primary_mentioned_author", "primary_mentioned_year", "stated_page", "span_start")


def q_multi_citation_split(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "ccp_registry").select("claim_id", "citation_text").distinct()
    return t.select("claim_id", F.posexplode(textops.citation_parts(F.col("citation_text"))).alias("part_no", "part"))


def q_quotations(s: SparkSession, d: str) -> DataFrame:
    return _texts(s, d).select("claim_id", F.posexplode(textops.quotation_array(F.col("claim_text"))).alias("quote_no", "quote"))


# ---------------------------------------------------------------- references


def q_reference_entries(s: SparkSession, d: str) -> DataFrame:
    refs = table(s, d, "references_index").filter("raw_line IS NOT NULL").select("review_id", "raw_line").distinct().withColumnRenamed("raw_line", "line")
    return textops.reference_entries(refs, "review_id", "line")


def q_reference_index(s: SparkSession, d: str) -> DataFrame:
    """Lists as texts with a heading, cut at it, and parsed again."""
    refs = table(s, d, "references_index").filter("raw_line <> ''").select("review_id", "raw_line").distinct()
    text = refs.groupBy("review_id").agg(F.concat(F.lit("Findings\n\nReferences \n"), F.array_join(F.array_sort(F.collect_set("raw_line")), "\n")).alias("text"))
    return textops.reference_entries(textops.reference_lines(text, "review_id", "text"), "review_id", "line")


def q_in_reference_list(s: SparkSession, d: str) -> DataFrame:
    keys = table(s, d, "references_index").select(X.first_author_key(F.col("first_author")).alias("a"), F.lower("year").alias("y")).distinct().withColumn("listed", F.lit(True))
    c = _claims(s, d).select("claim_id", X.first_author_key(F.col("citation_author")).alias("a"), F.lower("citation_year").alias("y"))
    return c.join(keys, ["a", "y"], "left").select("claim_id", F.coalesce("listed", F.lit(False)).alias("in_reference_list"))


def q_in_reference_list_per_review(s: SparkSession, d: str) -> DataFrame:
    keys = table(s, d, "references_index").select("review_id", X.first_author_key(F.col("first_author")).alias("a"), F.lower("year").alias("y")).distinct().withColumn("listed", F.lit(True))
    c = _claims(s, d).select("claim_id", "review_id", X.first_author_key(F.col("citation_author")).alias("a"), F.lower("citation_year").alias("y"))
    return c.join(keys, ["review_id", "a", "y"], "left").select("claim_id", F.coalesce("listed", F.lit(False)).alias("in_reference_list"))


# ---------------------------------------------------------------- pages and windows


def _pages(s: SparkSession, d: str) -> DataFrame:
    return textops.pages(_sources(s, d), "stem", "text")


def q_pages(s: SparkSession, d: str) -> DataFrame:
    return _pages(s, d)


def q_windows(s: SparkSession, d: str) -> DataFrame:
    return textops.windows(_pages(s, d), "stem").select("stem", "page_no", "win_no", F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


def q_windows_with_tail(s: SparkSession, d: str) -> DataFrame:
    w = textops.windows(_pages(s, d), "stem", keep_tail=True)
    return w.groupBy("stem").agg(F.count("*").alias("windows"), F.sum(F.length("text")).alias("chars"))


def _sourced(s: SparkSession, d: str) -> DataFrame:
    """Claims with the stem of the file they point at."""
    c = _claims(s, d).filter("trim(source_pdf_path) <> ''")
    return c.select("claim_id", F.lower(X.stem(F.col("source_pdf_path"))).alias("stem"), "claim_text", "stated_page", X.is_quote(F.col("claim_text")).alias("is_quote"))


def _low(df: DataFrame) -> DataFrame:
    return df.withColumn("stem", F.lower("stem"))


def _asked(s: SparkSession, d: str) -> DataFrame:
    """Claims with their own quotations and, as claims of their own, the opening words of their excerpts as quotations."""
    own = _sourced(s, d).select("claim_id", "stem", "claim_text", "stated_page", "is_quote")
    a = reports.last_of(table(s, d, "adjudication_inputs").select("claim_id", "source_pdf_path", "stated_page", "evidence", "built_at"), ["claim_id"], ["built_at"]).filter("trim(source_pdf_path) <> ''")
    openings = a.select("claim_id", F.lower(X.stem(F.col("source_pdf_path"))).alias("stem"), "stated_page", F.posexplode("evidence").alias("pos", "e"))
    text = F.concat(F.lit("It says “"), F.substr(F.regexp_replace("e.text", "\\s+", " "), F.lit(1), F.lit(30)), F.lit("” there."))
    return own.unionByName(openings.select(F.concat_ws("#", "claim_id", "pos").alias("claim_id"), "stem", text.alias("claim_text"), "stated_page", F.lit(True).alias("is_quote")))


def _flat(s: SparkSession, d: str) -> DataFrame:
    """Pages as one line each, their sources in lower case as the claims' are."""
    return _low(_pages(s, d)).withColumn("text", F.regexp_replace("text", "\\s+", " "))


def _offsets(s: SparkSession, d: str) -> DataFrame:
    return textops.page_offsets(_asked(s, d), _flat(s, d), "stem", "claim_text", "stated_page")


def q_quote_pages(s: SparkSession, d: str) -> DataFrame:
    return textops.quote_pages(_asked(s, d), _flat(s, d), "claim_id", "stem", "claim_text").select("claim_id", "stem", "page_no")


def q_quote_hits(s: SparkSession, d: str) -> DataFrame:
    """Every claim that quotes, with the number of pages of its source that hold one of its quotations."""
    asked = _asked(s, d).filter(F.size(textops.quotation_array(F.col("claim_text"))) > 0).select("claim_id", "stem")
    return asked.join(q_quote_pages(s, d).groupBy("claim_id").agg(F.count("*").alias("pages")), "claim_id", "left").select("claim_id", "stem", F.coalesce("pages", F.lit(0)).alias("pages"))


def q_page_offsets(s: SparkSession, d: str) -> DataFrame:
    return _offsets(s, d)


def q_stated_page_evidence(s: SparkSession, d: str) -> DataFrame:
    """Only sources with an offset, which quotations found with a stated page give."""
    w = _low(textops.windows(_pages(s, d), "stem"))
    return retrieval.stated_tier(_asked(s, d), _offsets(s, d), w, "stem").select("claim_id", "page_no", "win_no", "score")


def q_exact_evidence(s: SparkSession, d: str) -> DataFrame:
    p = _flat(s, d)
    return retrieval.exact_tier(_asked(s, d), p, textops.windows(p, "stem"), "stem").select("claim_id", "page_no", "win_no", "score")


def q_topk_evidence(s: SparkSession, d: str) -> DataFrame:
    w = _low(textops.windows(_pages(s, d), "stem"))
    return retrieval.fuzzy_top_k(_sourced(s, d), w, "stem").select("claim_id", "page_no", "win_no", "score", "rank")


def q_evidence(s: SparkSession, d: str) -> DataFrame:
    """All three tiers, the second by the offsets that the first stage found."""
    p = _flat(s, d)
    got = retrieval.evidence(_sourced(s, d), p, textops.windows(p, "stem"), _offsets(s, d), "stem")
    return got.select("claim_id", F.transform("evidence", lambda e: F.struct(e["page_range"].alias("page_range"), e["score"].alias("score"))).alias("evidence"))


def _claim_evidence(s: SparkSession, d: str) -> DataFrame:
    a = reports.last_of(table(s, d, "adjudication_inputs").select("claim_id", "claim_text", "evidence", "built_at"), ["claim_id"], ["built_at"])
    return a.select("claim_id", "claim_text", F.posexplode("evidence").alias("pos", "e")).select("claim_id", "pos", "claim_text", F.col("e.text").alias("text"))


def q_token_set_native(s: SparkSession, d: str) -> DataFrame:
    native, bound = token_set_bounds(F.col("a"), F.col("b"))
    t = _claim_evidence(s, d).select("claim_id", "pos", token_sets(F.col("claim_text")).alias("a"), token_sets(F.col("text")).alias("b"))
    return t.select("claim_id", "pos", F.round(native, 4).alias("native"), F.round(bound, 4).alias("bound"))


def q_token_set_ratio(s: SparkSession, d: str) -> DataFrame:
    return _claim_evidence(s, d).select("claim_id", "pos", F.round(token_set_ratio_udf("claim_text", "text"), 4).alias("ratio"))


# ---------------------------------------------------------------- sections


def _doc_sections(s: SparkSession, d: str) -> DataFrame:
    """Sections of the documents with headings: # lines, level 2 under an opening level 1."""
    t = textops.sections(table(s, d, "documents"), "doc_id", "text")
    body = t.filter("NOT startswith(line, '#') AND section <> 'unknown'").groupBy("doc_id", "section").agg(F.min("line_no").alias("sec_no"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), " ").alias("body"))
    return body.select(F.col("doc_id").alias("review_id"), "sec_no", F.when(F.col("sec_no") % 3 == 0, 3).otherwise(2).alias("level"), F.col("section").alias("title"), "body")


def _doc_claims(s: SparkSession, d: str) -> DataFrame:
    sent = textops.sentences(table(s, d, "documents").select(F.col("doc_id").alias("review_id"), F.regexp_replace("text", "(?m)^#.*$", "").alias("text")), ["review_id"], "text")
    return sent.filter(F.col("sentence").rlike(r"\([^()]*\d{4}")).select("review_id", F.concat_ws("#", "review_id", "sent_no").alias("claim_id"), F.col("sentence").alias("claim_text"))


def q_tfidf_section(s: SparkSession, d: str) -> DataFrame:
    return sections.match_sections(_doc_claims(s, d), _doc_sections(s, d))


def q_section_fallback(s: SparkSession, d: str) -> DataFrame:
    """Each section's own title asked as a claim of a review whose sections have no bodies, and the claims' years: titles decide, else the
    first section."""
    secs = _doc_sections(s, d).withColumn("body", F.lit(""))
    c = _doc_claims(s, d).select("review_id", "claim_id", F.regexp_extract("claim_text", r"(\d{4})[a-z]?\s*\)", 1).alias("claim_text"))
    titles = secs.select("review_id", F.concat_ws("#t", "review_id", "sec_no").alias("claim_id"), F.col("title").alias("claim_text"))
    return sections.match_sections(c.unionByName(titles), secs).select("claim_id", "sec_no", "title", "score")


# ---------------------------------------------------------------- resolution


def _files(s: SparkSession, d: str) -> DataFrame:
    return resolve.inventory(table(s, d, "file_inventory"))


def q_file_inventory(s: SparkSession, d: str) -> DataFrame:
    return _files(s, d)


def q_resolve_strict(s: SparkSession, d: str) -> DataFrame:
    return resolve.strict(_claims(s, d), _files(s, d))


def q_unresolved(s: SparkSession, d: str) -> DataFrame:
    return q_resolve_strict(s, d).filter("mapping_note = 'no_exact_author_year_pdf'").select("claim_id")


def q_author_keys(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "ccp_registry").select("citation_author").filter("citation_author IS NOT NULL").distinct()
    c = F.col("citation_author")
    return a.select("citation_author", X.author_key(c).alias("primary_key"), X.surname_key(c).alias("surname_key"), X.first_author_key(c).alias("first_key"), X.first_author_key(c, compat=True).alias("first_key_compat"))


def q_guess_path(s: SparkSession, d: str) -> DataFrame:
    """<author with underscores>_<year>.pdf where there is such a file."""
    f = _files(s, d).select(F.lower("name").alias("guess"), "path").groupBy("guess").agg(F.min("path").alias("path"))
    c = _claims(s, d).select("claim_id", F.lower(F.concat(F.replace("citation_author", F.lit(" "), F.lit("_")), F.lit("_"), "citation_year", F.lit(".pdf"))).alias("guess"))
    return c.join(f, "guess", "left").select("claim_id", F.coalesce("path", F.lit("")).alias("path"))


# ---------------------------------------------------------------- canonical rows and reports


def q_canonical_fill(s: SparkSession, d: str) -> DataFrame:
    c = textops.fill_blank(_claims(s, d), "source_pdf_path", F.concat(F.lit("pilot_inputs/sources_pdf/"), F.replace("citation_author", F.lit(" "), F.lit("_")), F.lit("_"), X.year_digits(F.col("citation_year")), F.lit(".pdf")))
    return c.select("claim_id", F.translate("source_pdf_path", "\\", "/").alias("source_pdf_path"), X.basename(F.col("source_pdf_path")).alias("source_pdf"))


def q_bool_coerce(s: SparkSession, d: str) -> DataFrame:
    flag = lambda n, again: (F.lower(F.col(n).cast("string")).isin("true", "1", "yes") & F.col(n).isNotNull()) | F.coalesce(again, F.lit(False))
    c = F.col("claim_text")
    return _claims(s, d).select("claim_id", F.coalesce(flag("is_quote", X.is_quote(c)), F.lit(False)).alias("is_quote"), F.coalesce(flag("has_numbers", X.has_numbers(c)), F.lit(False)).alias("has_numbers"))


def q_bad_rate(s: SparkSession, d: str) -> DataFrame:
    return reports.bad_rate(_verdicts(s, d), ["review_id", "section"], F.col("verdict").isin("UNSUPPORTED_FAIL", "AMBIGUOUS_REVIEW")).select("review_id", "section", F.round("bad_rate", 6).alias("bad_rate"), "n")


def q_sampling_plan(s: SparkSession, d: str) -> DataFrame:
    v = _verdicts(s, d).filter("section IS NOT NULL").withColumn("priority", F.when(F.col("best") % 7 == 0, "High").otherwise("Low"))
    rates = reports.bad_rate(v, ["review_id", "section"], F.col("verdict").isin("UNSUPPORTED_FAIL", "AMBIGUOUS_REVIEW"))
    return reports.sampling_plan(v, rates, ["review_id", "section"], "claim_id", "priority")


def q_dashboard(s: SparkSession, d: str) -> DataFrame:
    levels = [("overall", []), ("review", ["review_id"]), ("section", ["review_id", "section"])]
    return reports.multi_level_counts(_verdicts(s, d), levels, "verdict")


def q_rewrite_update(s: SparkSession, d: str) -> DataFrame:
    """Failed verdicts get a proposal by key; of a claim's repeated rows only the last is changed."""
    base = table(s, d, "adjudication_inputs").select("review_id", "claim_id", "built_at", "stated_page", F.lit("").alias("proposed_rewrite"))
    changes = _verdicts(s, d).filter("verdict = 'UNSUPPORTED_FAIL'").select("review_id", "claim_id", F.concat(F.lit("rewrite "), "claim_id").alias("proposed_rewrite"))
    return reports.update_by_key(base, changes, ["review_id", "claim_id"], ["proposed_rewrite"], ["built_at"])


def q_value_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))


def q_dedupe_last(s: SparkSession, d: str) -> DataFrame:
    return _claims(s, d).select("claim_id", "review_id", "loaded_at")


def q_union_by_name(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "ccp_registry").select("review_id", "claim_id", "priority")
    b = table(s, d, "adjudication_inputs").select("claim_id", "review_id", "stated_page")
    return a.unionByName(b, allowMissingColumns=True)


def q_json_recover(s: SparkSession, d: str) -> DataFrame:
    """Each batch's JSON lines run together by a literal backslash and n, and taken apart again."""
    raw = table(s, d, "adjudication_raw").filter("layout = 'jsonl' AND raw_text <> ''")
    text = raw.groupBy("batch_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "raw_text"))), lambda x: x["raw_text"]), "\\n").alias("text"))
    got = jsonrepair.recover_files(text, "batch_file", "text")
    return got.select("batch_file", "ord", F.get_json_object("object", "$.claim_id").alias("claim_id"), F.col("bad").isNotNull().alias("is_bad"))


def q_props(s: SparkSession, d: str) -> DataFrame:
    """JSON text read by a schema and written again, NaN as null."""
    e = table(s, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return e.select("event_id", F.size("m").alias("n_keys"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"))


_LINES = r"""split AS (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r\x{000B}\x{000C}\x{0085}\x{2028}\x{2029}]') AS ls FROM documents WHERE text IS NOT NULL),
tidy AS (SELECT doc_id, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM split),
lines AS (SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INT) AS line_no, unnest(ls) AS line FROM tidy)"""


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SP}+|{_SP}+$', '', 'g')"


_SECTIONS = (
    _LINES
    + f""",
trimmed AS (SELECT doc_id, line_no, {_strip('line')} AS line FROM lines),
labelled AS (SELECT *, CASE WHEN line LIKE '#%' THEN lower({_strip("regexp_replace(line, '^#+', '')")})
  WHEN upper(line) = line AND lower(line) <> line AND len(string_split_regex(line, '{_SP}+')) <= 8 THEN lower(line)
  WHEN line LIKE '%:' AND len(string_split_regex(line, '{_SP}+')) <= 8 THEN lower({_strip("regexp_replace(line, ':$', '')")}) END AS label FROM trimmed WHERE line <> ''),
secs AS (SELECT doc_id, line_no, coalesce(last_value(label IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), 'unknown') AS section, line FROM labelled)"""
)


def _sentences(table_sql: str, key: str, col: str, compat: bool) -> str:
    t = _strip(f"coalesce({col}, '')")
    if not compat:
        t = f"regexp_replace({t}, '(\\bal\\.)({_SP}+\\()', '\\1' || chr(31) || '\\2', 'g')"
    gap = f"([.!?]){_SP}+([A-Z(“\"\\[])"
    parts = f"string_split(regexp_replace({t}, '{gap}', '\\1' || chr(30) || '\\2', 'g'), chr(30))"
    parts = f"list_filter(list_transform({parts}, lambda x: {_strip('replace(x, chr(31), chr(0)[:0])')}), lambda x: x <> '')"
    return f"SELECT {key}, CAST(generate_subscripts(ss, 1) - 1 AS INT) AS sent_no, unnest(ss) AS sentence FROM (SELECT {key}, {parts} AS ss FROM {table_sql})".replace("chr(0)[:0]", "''")


_PAIR = r"([A-Z][^,;()]+?)\s*,\s*(\d{4}[a-z]?)"
_CITED = r"(?i)\bas cited in\s+([A-Z][^,;()]+?)\s*,\s*(\d{4}[a-z]?)"
_NARRATIVE = citations.NARRATIVE.replace("'", "''")
_ENTRY = textops.REFERENCE_ENTRY.replace("'", "''")
_PAGE = r"(?i)\bpp?\.\s*(\d+(?:\s*[-–]\s*\d+)?)"
# The text up to the k-th match is found by its length without the matches up to there, marked with a character no text has.
_NARRATIVE_ROWS = f"""nm AS (SELECT KEYS, regexp_extract_all(COL, '{_NARRATIVE}', 0) AS m, regexp_extract_all(COL, '{_NARRATIVE}', 1) AS a, regexp_extract_all(COL, '{_NARRATIVE}', 2) AS y,
  string_split(regexp_replace(COL, '{_NARRATIVE}', chr(31), 'g'), chr(31)) AS g, COL AS full_text FROM ROWS),
nu AS (SELECT KEYS, full_text, m, g, unnest(m) AS mt, unnest(a) AS au, unnest(y) AS yr, generate_subscripts(m, 1) AS k FROM nm),
np AS (SELECT KEYS, mt, au, yr, k, CAST(list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS INT) AS span_start, full_text FROM nu),
nt AS (SELECT *, substr(full_text, span_start + length(mt) + 1) AS tail, substr(full_text, 1, span_start) AS head FROM np),
narr AS (SELECT KEYS, k, span_start, CASE WHEN h = '' THEN 'narrative' ELSE 'secondary_narrative' END AS citation_type, CASE WHEN h = '' THEN mt ELSE mt || ', ' || regexp_extract(tail, '{_CITED}', 0) END AS citation_text,
  CASE WHEN h = '' THEN trim(au) ELSE trim(h) END AS citation_author, CASE WHEN h = '' THEN yr ELSE regexp_extract(tail, '{_CITED}', 2) END AS citation_year,
  CASE WHEN h <> '' THEN trim(au) END AS primary_mentioned_author, CASE WHEN h <> '' THEN yr END AS primary_mentioned_year,
  coalesce(nullif(regexp_extract(tail, '{_PAGE}', 1), ''), nullif(regexp_extract(head, '{_PAGE}', 1), '')) AS stated_page FROM (SELECT *, regexp_extract(tail, '{_CITED}', 1) AS h FROM nt))"""


def _narratives(rows: str, keys: str, col: str) -> str:
    return _NARRATIVE_ROWS.replace("KEYS", keys).replace("COL", col).replace("FROM ROWS", f"FROM {rows}")


_BLOCKS = f"{_TEXTS}, blocks AS (SELECT claim_id, unnest(regexp_extract_all(claim_text, '\\(([^()]+)\\)', 1)) AS b FROM texts)"

_PAGES = r"""src AS (SELECT DISTINCT stem, regexp_replace(text, '\r\n?', chr(10), 'g') AS text FROM sources_text WHERE text <> ''),
pl AS (SELECT stem, generate_subscripts(ls, 1) AS k, unnest(ls) AS line FROM (SELECT stem, string_split(text, chr(10)) AS ls FROM src)),
pm AS (SELECT *, regexp_full_match(line, '<<<PAGE=\d+>>>') AS mark FROM pl),
po AS (SELECT *, sum(CAST(mark AS INT)) OVER (PARTITION BY stem ORDER BY k ROWS UNBOUNDED PRECEDING) AS ord, max(CAST(mark AS INT)) OVER (PARTITION BY stem) AS any_mark FROM pm),
pg AS (SELECT stem, greatest(ord, 1) - 1 AS page_ord, max(CASE WHEN mark THEN CAST(regexp_extract(line, '(\d+)', 1) AS INT) END) AS page_no,
  trim(string_agg(CASE WHEN NOT mark THEN line END, chr(10) ORDER BY k), ' ' || chr(10) || chr(9) || chr(13)) AS text FROM po WHERE any_mark = 1 GROUP BY stem, greatest(ord, 1) - 1),
pages AS (SELECT stem, page_no, page_ord, coalesce(text, '') AS text FROM pg QUALIFY row_number() OVER (PARTITION BY stem, page_no ORDER BY page_ord DESC) = 1)"""
_WORDS = rf"ws AS (SELECT stem, page_no, CASE WHEN text = '' THEN [] ELSE string_split_regex(text, '{_SP}+') END AS w FROM pages)"
_WINDOWS = _PAGES + ", " + _WORDS + """,
starts AS (SELECT stem, page_no, w, unnest(range(0, greatest(0, len(w) - 180) + 1, 90)) AS a FROM ws),
windows AS (SELECT stem, page_no, CAST(a / 90 AS INT) AS win_no, array_to_string(w[a + 1 : a + 180], ' ') AS text FROM starts)"""
_STEM = r"regexp_replace(trim(string_split(replace(source_pdf_path, chr(92), '/'), '/')[-1]), '(?i)(?:\.pdf)+$', '')"
_ASKED = _CLAIMS + rf""", low AS (SELECT lower(stem) AS stem, page_no, page_ord, translate(regexp_replace(text, '\s+', ' ', 'g'), '“”‘’', '""' || chr(39) || chr(39)) AS flat FROM pages),
lastin AS (SELECT * FROM adjudication_inputs QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY built_at DESC) = 1),
opening AS (SELECT claim_id, lower({_STEM}) AS stem, stated_page, generate_subscripts(evidence, 1) - 1 AS pos, unnest(evidence).text AS t FROM lastin WHERE trim(source_pdf_path) <> ''),
asked AS (SELECT claim_id, lower({_STEM}) AS stem, claim_text, stated_page, regexp_matches(claim_text, '["“”'']') AS is_quote FROM claims WHERE trim(source_pdf_path) <> ''
  UNION ALL SELECT claim_id || '#' || pos, stem, 'It says “' || substr(regexp_replace(t, '\s+', ' ', 'g'), 1, 30) || '” there.', stated_page, true FROM opening),
quotes AS (SELECT claim_id, stem, stated_page, is_quote, generate_subscripts(qs, 1) AS k, translate(unnest(qs), '“”‘’', '""' || chr(39) || chr(39)) AS q
  FROM (SELECT *, regexp_extract_all(claim_text, '["“](.+?)["”]', 1) AS qs FROM asked)),
hits AS (SELECT DISTINCT claim_id, q.stem, stated_page, is_quote, k, page_no, page_ord FROM quotes q JOIN low ON q.stem = low.stem WHERE contains(flat, q)),
said AS (SELECT claim_id, stem, TRY_CAST(nullif(regexp_extract(coalesce(stated_page, ''), '^(\d{{1,9}})', 1), '') AS INT) AS said FROM asked),
firsts AS (SELECT claim_id, stem, arg_min(page_no, page_ord) AS page FROM hits WHERE k = 1 GROUP BY ALL),
offsets AS (SELECT f.stem, CAST(floor(median(said - page)) AS INT) AS logical_minus_pdf_offset, CAST(count(*) AS INT) AS n_examples
  FROM firsts f JOIN said s ON s.claim_id = f.claim_id AND s.stem = f.stem WHERE said IS NOT NULL GROUP BY f.stem)"""
_FIRST_KEY = r"lower(string_split_regex(trim(string_split(string_split_regex(string_split(coalesce({0}, ''), '&')[1], '\band\b')[1], ',')[1]), '\s+')[1])"
_LETTERS = "strip_accents({0})"
_SURNAME = r"""lower(regexp_extract(string_split(trim(regexp_replace(string_split_regex(regexp_replace(replace(trim(regexp_replace(translate(strip_accents(coalesce({0}, '')), '–—‐', '---'), '\s+', ' ', 'g')), 'CLEARAA', 'CLEAR-AA'), '[’'']s\b', '', 'g'), '\s+(?:&|and)\s+')[1], '(?i)\bet\s+al\.?\b', '', 'g')), ',')[1], '([A-Za-z\-]+)', 1))"""
_YEAR4 = r"nullif(regexp_extract(coalesce({0}, ''), '((?:19|20)\d{{2}})', 1), '')"
_STRICT = f"""{_CLAIMS},
files AS (SELECT DISTINCT path, string_split(replace(path, chr(92), '/'), '/')[-1] AS name, regexp_replace(trim(string_split(replace(path, chr(92), '/'), '/')[-1]), '(?i)(?:\\.pdf)+$', '') AS st FROM file_inventory),
ix AS (SELECT {_SURNAME.format("string_split(st, '_')[1]")} AS author_key, {_YEAR4.format('st')} AS year_key, name FROM files),
best AS (SELECT author_key, year_key, arg_min(name, (length(name), name)) AS found FROM ix WHERE author_key <> '' AND year_key IS NOT NULL GROUP BY ALL),
c AS (SELECT claim_id, {_SURNAME.format('citation_author')} AS author_key, {_YEAR4.format('citation_year')} AS year_key, source_pdf_path AS old,
  nullif(trim(string_split(replace(coalesce(source_pdf_path, ''), chr(92), '/'), '/')[-1]), '') AS old_name FROM claims),
strict AS (SELECT claim_id, c.author_key, coalesce(c.year_key, '') AS year_key,
  CASE WHEN c.author_key = '' OR c.year_key IS NULL THEN coalesce(old, '') ELSE coalesce('pilot_inputs/sources_pdf/' || found, '') END AS path,
  CASE WHEN c.author_key = '' OR c.year_key IS NULL THEN '' WHEN found IS NULL THEN 'no_exact_author_year_pdf' WHEN old_name IS NOT NULL AND old_name <> found THEN 'corrected_from:' || old_name ELSE '' END AS mapping_note
  FROM c LEFT JOIN best ON c.author_key = best.author_key AND c.year_key = best.year_key)"""
_TOKENS = "list_distinct(list_filter(string_split_regex(coalesce({0}, ''), '" + _SP.replace("{", "{{").replace("}", "}}") + "+'), lambda t: t <> ''))"

SQL = {
    "q_lines": f"WITH {_LINES} SELECT * FROM lines",
    "q_sections": f"WITH {_SECTIONS} SELECT * FROM secs",
    "q_sentences": _sentences("documents", "doc_id", "text", False),
    "q_sentences_compat": _sentences("documents", "doc_id", "text", True),
    "q_claim_flags": f"""WITH {_TEXTS}, f AS (SELECT claim_id, regexp_matches(claim_text, '["“”'']') AS is_quote, regexp_matches(claim_text, '\\d') AS has_numbers,
      regexp_matches(claim_text, '{X.CAUSAL}') AS is_causal_or_normative FROM texts)
      SELECT *, CASE WHEN is_quote OR has_numbers OR is_causal_or_normative THEN 'High' ELSE 'Low' END AS priority FROM f""",
    "q_parenthetical": f"""WITH {_BLOCKS}, p AS (SELECT claim_id, b, regexp_extract_all(b, '{_PAIR}', 1) AS a, regexp_extract_all(b, '{_PAIR}', 2) AS y FROM blocks WHERE NOT regexp_matches(b, '{_CITED}'))
      SELECT claim_id, '(' || b || ')' AS citation_text, trim(unnest(a)) AS citation_author, unnest(y) AS citation_year, regexp_extract(b, '{_PAGE}', 1) AS stated_page FROM p""",
    "q_secondary": f"""WITH {_BLOCKS} SELECT claim_id, '(' || b || ')' AS citation_text, trim(regexp_extract(b, '{_CITED}', 1)) AS citation_author, regexp_extract(b, '{_CITED}', 2) AS citation_year
      FROM blocks WHERE regexp_matches(b, '{_CITED}')""",
    "q_narrative": f"WITH {_TEXTS}, {_narratives('texts', 'claim_id', 'claim_text')} SELECT claim_id, citation_text, citation_author, citation_year, citation_type, primary_mentioned_author, primary_mentioned_year, stated_page, span_start FROM narr",
    "q_multi_citation_split": f"""WITH t AS (SELECT DISTINCT claim_id, citation_text, {_strip("coalesce(citation_text, '')")} AS t FROM ccp_registry),
      u AS (SELECT claim_id, list_filter(list_transform(string_split(CASE WHEN regexp_full_match(t, '\\(.*\\)') THEN t[2:-2] ELSE t END, ';'), lambda x: {_strip('x')}), lambda x: x <> '') AS ps FROM t)
      SELECT claim_id, CAST(generate_subscripts(ps, 1) - 1 AS INT) AS part_no, unnest(ps) AS part FROM u""",
    "q_quotations": f"""WITH {_TEXTS}, q AS (SELECT claim_id, regexp_extract_all(claim_text, '["“](.+?)["”]', 1) AS qs FROM texts) SELECT claim_id, CAST(generate_subscripts(qs, 1) - 1 AS INT) AS quote_no, unnest(qs) AS quote FROM q""",
    "q_reference_entries": rf"""WITH r AS (SELECT DISTINCT review_id, raw_line FROM references_index WHERE raw_line IS NOT NULL)
      SELECT review_id, regexp_extract(raw_line, '{_ENTRY}', 1) AS first_author, regexp_extract(raw_line, '{_ENTRY}', 2) AS year, {_strip('raw_line')} AS raw_line
      FROM r WHERE regexp_extract(raw_line, '{_ENTRY}', 1) <> ''""",
    "q_in_reference_list": f"""WITH {_CLAIMS}, k AS (SELECT DISTINCT {_FIRST_KEY.format('first_author')} AS a, lower(year) AS y FROM references_index)
      SELECT claim_id, k.a IS NOT NULL AS in_reference_list FROM claims LEFT JOIN k ON k.a = {_FIRST_KEY.format('citation_author')} AND k.y = lower(citation_year)""",
    "q_in_reference_list_per_review": f"""WITH {_CLAIMS}, k AS (SELECT DISTINCT review_id AS r, {_FIRST_KEY.format('first_author')} AS a, lower(year) AS y FROM references_index)
      SELECT claim_id, k.a IS NOT NULL AS in_reference_list FROM claims LEFT JOIN k ON k.r = review_id AND k.a = {_FIRST_KEY.format('citation_author')} AND k.y = lower(citation_year)""",
    "q_pages": f"WITH {_PAGES} SELECT stem, page_no, CAST(page_ord AS INT) AS page_ord, text FROM pages",
    "q_windows": f"WITH {_WINDOWS} SELECT stem, page_no, win_no, md5(text) AS text_md5, CAST(length(text) AS INT) AS chars FROM windows",
    "q_windows_with_tail": f"""WITH {_PAGES}, {_WORDS}, st AS (SELECT stem, page_no, w, unnest(list_distinct(list_concat(range(0, greatest(0, len(w) - 180) + 1, 90), [greatest(0, len(w) - 180)]))) AS a FROM ws)
      SELECT stem, count(*) AS windows, CAST(sum(length(array_to_string(w[a + 1 : a + 180], ' '))) AS BIGINT) AS chars FROM st GROUP BY stem""",
    "q_quote_pages": f"WITH {_PAGES}, {_ASKED} SELECT DISTINCT claim_id, stem, page_no FROM hits",
    "q_quote_hits": f"""WITH {_PAGES}, {_ASKED}, n AS (SELECT claim_id, count(*) AS pages FROM (SELECT DISTINCT claim_id, stem, page_no FROM hits) GROUP BY claim_id)
      SELECT a.claim_id, stem, coalesce(pages, 0) AS pages FROM asked a LEFT JOIN n ON a.claim_id = n.claim_id WHERE regexp_matches(claim_text, '["“].+?["”]')""",
    "q_page_offsets": f"WITH {_PAGES}, {_ASKED} SELECT * FROM offsets",
    "q_stated_page_evidence": f"""WITH {_WINDOWS}, {_ASKED} SELECT s.claim_id, w.page_no, win_no, 100 AS score FROM said s JOIN offsets o ON s.stem = o.stem
      JOIN windows w ON lower(w.stem) = s.stem AND w.page_no = said - logical_minus_pdf_offset""",
    "q_exact_evidence": f"""WITH {_WINDOWS}, {_ASKED}, h AS (SELECT DISTINCT claim_id, stem, page_no FROM hits WHERE is_quote)
      SELECT claim_id, h.page_no, win_no, 100 AS score FROM h JOIN windows w ON h.stem = lower(w.stem) AND h.page_no = w.page_no""",
    "q_token_set_native": f"""WITH a AS (SELECT claim_id, claim_text, evidence FROM adjudication_inputs QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY built_at DESC) = 1),
      e AS (SELECT claim_id, CAST(generate_subscripts(evidence, 1) - 1 AS INT) AS pos, {_TOKENS.format('claim_text')} AS x, unnest(evidence).text AS t FROM a),
      p AS (SELECT claim_id, pos, x, {_TOKENS.format('t')} AS y FROM e),
      n AS (SELECT *, list_intersect(x, y) AS b, list_filter(x, lambda v: NOT list_contains(y, v)) AS l, list_filter(y, lambda v: NOT list_contains(x, v)) AS r FROM p),
      z AS (SELECT *, length(coalesce(array_to_string(b, ' '), '')) AS s, length(coalesce(array_to_string(l, ' '), '')) AS la, length(coalesce(array_to_string(r, ' '), '')) AS lb, CASE WHEN len(b) > 0 THEN 1 ELSE 0 END AS sep FROM n),
      q AS (SELECT *, CASE WHEN sep > 0 THEN greatest(100 * (1 - (sep + la) / (s + s + sep + la)), 100 * (1 - (sep + lb) / (s + s + sep + lb))) ELSE 0.0 END AS r1, 100 * (1 - abs(la - lb) / (s + sep + la + s + sep + lb)) AS top FROM z)
      SELECT claim_id, pos, round(CAST(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0 WHEN sep > 0 AND (len(l) = 0 OR len(r) = 0) THEN 100 ELSE r1 END AS DOUBLE), 4) AS native,
       round(CAST(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0 WHEN sep > 0 AND (len(l) = 0 OR len(r) = 0) THEN 100 ELSE greatest(r1, top) END AS DOUBLE), 4) AS bound FROM q""",
    "q_resolve_strict": f"WITH {_STRICT} SELECT * FROM strict",
    "q_unresolved": f"WITH {_STRICT} SELECT claim_id FROM strict WHERE mapping_note = 'no_exact_author_year_pdf'",
    "q_guess_path": rf"""WITH {_CLAIMS}, f AS (SELECT lower(string_split(replace(path, chr(92), '/'), '/')[-1]) AS guess, min(path) AS path FROM file_inventory GROUP BY 1)
      SELECT claim_id, coalesce(path, '') AS path FROM claims LEFT JOIN f ON f.guess = lower(replace(citation_author, ' ', '_') || '_' || citation_year || '.pdf')""",
    "q_canonical_fill": f"""WITH {_CLAIMS}, c AS (SELECT claim_id, CASE WHEN {_strip("coalesce(source_pdf_path, '')")} <> '' THEN source_pdf_path ELSE
      coalesce('pilot_inputs/sources_pdf/' || replace(citation_author, ' ', '_') || '_' || {_YEAR4.format('citation_year')} || '.pdf', '') END AS p FROM claims)
      SELECT claim_id, replace(p, chr(92), '/') AS source_pdf_path, string_split(replace(p, chr(92), '/'), '/')[-1] AS source_pdf FROM c""",
    "q_bool_coerce": f"""WITH {_CLAIMS} SELECT claim_id, coalesce(is_quote, false) OR coalesce(regexp_matches(claim_text, '["“”'']'), false) AS is_quote,
      coalesce(has_numbers, false) OR coalesce(regexp_matches(claim_text, '\\d'), false) AS has_numbers FROM claims""",
    "q_bad_rate": f"WITH {_VERDICTS} SELECT review_id, section, round(avg(CASE WHEN verdict IN ('UNSUPPORTED_FAIL', 'AMBIGUOUS_REVIEW') THEN 1.0 ELSE 0.0 END), 6) AS bad_rate, count(*) AS n FROM verdicts GROUP BY ALL",
    "q_sampling_plan": f"""WITH {_VERDICTS}, p AS (SELECT *, CASE WHEN best % 7 = 0 THEN 'High' ELSE 'Low' END AS priority FROM verdicts WHERE section IS NOT NULL),
      r AS (SELECT review_id, section, avg(CASE WHEN verdict IN ('UNSUPPORTED_FAIL', 'AMBIGUOUS_REVIEW') THEN 1.0 ELSE 0.0 END) AS rate FROM p GROUP BY ALL),
      k AS (SELECT *, row_number() OVER (PARTITION BY review_id, section, priority ORDER BY md5(claim_id || '42'), claim_id) AS rn, count(*) OVER (PARTITION BY review_id, section, priority) AS n FROM p)
      SELECT k.review_id, k.section, claim_id, priority, rate > 0.05 AS escalate_to_full_section FROM k JOIN r ON k.review_id = r.review_id AND k.section = r.section
      WHERE priority = 'High' OR rn <= greatest(10, floor(CAST(n AS DOUBLE) * CAST(0.3 AS DOUBLE)))""",
    "q_dashboard": f"""WITH {_VERDICTS} SELECT verdict, count(*) AS count, 'overall' AS level, NULL AS review_id, NULL AS section FROM verdicts GROUP BY verdict
      UNION ALL SELECT verdict, count(*), 'review', review_id, NULL FROM verdicts WHERE review_id IS NOT NULL GROUP BY verdict, review_id
      UNION ALL SELECT verdict, count(*), 'section', review_id, section FROM verdicts WHERE review_id IS NOT NULL AND section IS NOT NULL GROUP BY verdict, review_id, section""",
    "q_rewrite_update": f"""WITH {_VERDICTS}, b AS (SELECT review_id, claim_id, built_at, stated_page, max(built_at) OVER (PARTITION BY review_id, claim_id) AS last FROM adjudication_inputs)
      SELECT b.review_id, b.claim_id, built_at, stated_page, CASE WHEN v.claim_id IS NOT NULL AND built_at = last THEN 'rewrite ' || b.claim_id ELSE '' END AS proposed_rewrite
      FROM b LEFT JOIN (SELECT * FROM verdicts WHERE verdict = 'UNSUPPORTED_FAIL') v ON v.review_id = b.review_id AND v.claim_id = b.claim_id""",
    "q_value_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "q_dedupe_last": f"WITH {_CLAIMS} SELECT claim_id, review_id, loaded_at FROM claims",
    "q_union_by_name": "SELECT review_id, claim_id, priority, NULL AS stated_page FROM ccp_registry UNION ALL SELECT review_id, claim_id, NULL, stated_page FROM adjudication_inputs",
    "q_props": "SELECT event_id, CAST(len(json_keys(props)) AS INT) AS n_keys, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events",
}

_STOP_LIST = "['" + "', '".join(X.STOPWORDS) + "']"


def _tokens_sql(x: str) -> str:
    words = f"string_split_regex({_strip(f"regexp_replace(lower(coalesce({x}, '')), '[!-/:-@\\[-`{{-~]', ' ', 'g')")}, '{_SP}+')"
    return f"list_filter({words}, lambda t: length(t) > 1 AND NOT list_contains({_STOP_LIST}, t) AND strlen(t) = length(t))"


_DOC_SECTIONS = _SECTIONS + """,
dsec AS (SELECT doc_id AS review_id, min(line_no) AS sec_no, section AS title, string_agg(line, ' ' ORDER BY line_no) AS body FROM secs WHERE line NOT LIKE '#%' AND section <> 'unknown' GROUP BY doc_id, section),
sec AS (SELECT review_id, sec_no, CASE WHEN sec_no % 3 = 0 THEN 3 ELSE 2 END AS level, title, body FROM dsec)"""
_DOC_CLAIMS = (
    "ds AS (" + _sentences("(SELECT doc_id, regexp_replace(text, '(?m)^#.*$', '', 'g') AS text FROM documents)", "doc_id", "text", False) + "),"
    r" cl AS (SELECT doc_id AS review_id, doc_id || '#' || sent_no AS claim_id, sentence AS claim_text FROM ds WHERE regexp_matches(sentence, '\([^()]*\d{4}'))"
)
_TFIDF = f"""
st AS (SELECT review_id, sec_no, unnest({_tokens_sql('body')}) AS term FROM sec),
tf AS (SELECT review_id, sec_no, term, count(*) AS tf FROM st GROUP BY ALL),
nn AS (SELECT review_id, count(*) AS n FROM sec GROUP BY ALL),
idf AS (SELECT tf.review_id, term, ln((any_value(n) + 1) / (count(*) + 1)) + 1 AS idf FROM tf JOIN nn ON tf.review_id = nn.review_id GROUP BY tf.review_id, term),
wt AS (SELECT tf.review_id, sec_no, tf.term, tf * idf AS w FROM tf JOIN idf ON tf.review_id = idf.review_id AND tf.term = idf.term),
nrm AS (SELECT review_id, sec_no, sqrt(sum(w * w)) AS norm FROM wt GROUP BY ALL),
ct AS (SELECT review_id, claim_id, unnest({_tokens_sql('claim_text')}) AS term FROM cl),
cq AS (SELECT c.review_id, claim_id, c.term, tf * coalesce(idf, 1.0) AS q FROM (SELECT review_id, claim_id, term, count(*) AS tf FROM ct GROUP BY ALL) c LEFT JOIN idf ON c.review_id = idf.review_id AND c.term = idf.term),
cn AS (SELECT claim_id, sqrt(sum(q * q)) AS qn FROM cq GROUP BY ALL),
dt AS (SELECT cq.review_id, claim_id, sec_no, sum(q * w) AS dot FROM cq JOIN wt ON cq.review_id = wt.review_id AND cq.term = wt.term GROUP BY ALL),
pr AS (SELECT cl.claim_id, sec.sec_no, title, level, CASE WHEN regexp_matches(title, '{X.WEAK_HEADINGS}') THEN 0.60 ELSE 1.0 END * CASE level WHEN 4 THEN 1.15 WHEN 3 THEN 1.10 WHEN 1 THEN 0.90 ELSE 1.0 END AS prior,
  coalesce(dot / (norm * qn), 0) AS cosine, len(list_intersect({_tokens_sql('claim_text')}, {_tokens_sql('title')})) AS overlap
  FROM cl JOIN sec ON cl.review_id = sec.review_id LEFT JOIN dt ON dt.claim_id = cl.claim_id AND dt.sec_no = sec.sec_no AND dt.review_id = sec.review_id
  LEFT JOIN nrm ON nrm.review_id = sec.review_id AND nrm.sec_no = sec.sec_no LEFT JOIN cn ON cn.claim_id = cl.claim_id),
bt AS (SELECT claim_id, sec_no, title, level, round(cosine * CAST(prior AS DOUBLE), 9) AS score FROM pr QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY round(cosine * CAST(prior AS DOUBLE), 9) DESC, sec_no) = 1),
bo AS (SELECT claim_id, sec_no, title, level FROM pr QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY overlap * prior DESC, sec_no) = 1),
matched AS (SELECT bt.claim_id, CASE WHEN score > 0 THEN bt.sec_no ELSE bo.sec_no END AS sec_no, CASE WHEN score > 0 THEN bt.title ELSE bo.title END AS title,
  CASE WHEN score > 0 THEN bt.level ELSE bo.level END AS level, CAST(CASE WHEN score > 0 THEN round(score, 6) ELSE 0.0 END AS DOUBLE) AS score FROM bt JOIN bo ON bt.claim_id = bo.claim_id
 UNION ALL SELECT claim_id, NULL, 'unknown', NULL, 0.0 FROM cl WHERE review_id NOT IN (SELECT review_id FROM sec))"""
_YEAR_ONLY = r" regexp_extract(sentence, '(\d{4})[a-z]?\s*\)', 1) AS claim_text"
SQL |= {
    "q_tfidf_section": f"WITH {_DOC_SECTIONS}, {_DOC_CLAIMS}, {_TFIDF} SELECT * FROM matched",
    "q_section_fallback": f"""WITH {_DOC_SECTIONS.replace("title, body FROM dsec", "title, '' AS body FROM dsec")},
      {_DOC_CLAIMS.replace(" sentence AS claim_text", _YEAR_ONLY).replace("cl AS (", "cl AS (SELECT review_id, review_id || '#t' || sec_no AS claim_id, title AS claim_text FROM sec UNION ALL ")}, {_TFIDF} SELECT claim_id, sec_no, title, score FROM matched""",
    "q_file_inventory": rf"""WITH f AS (SELECT DISTINCT path, string_split(replace(path, chr(92), '/'), '/')[-1] AS name FROM file_inventory),
      g AS (SELECT path, name, regexp_replace(trim(lower(regexp_replace(regexp_replace(replace(regexp_replace(trim(name), '(?i)(?:\.pdf)+$', ''), '&', ' and '), '[!-/:-@\[-`{{-~]', ' ', 'g'), '[^A-Za-z0-9_ ]+', ' ', 'g'))), ' +', '_', 'g') AS stem_norm FROM f)
      SELECT path, name, stem_norm, nullif(regexp_extract(stem_norm, '(?i)(?:^|[^0-9])((?:19|20)\d{{2}}[a-z]?)(?:[^0-9a-z]|$)', 1), '') AS year FROM g""",
    "q_author_keys": rf"""WITH a AS (SELECT DISTINCT citation_author FROM ccp_registry WHERE citation_author IS NOT NULL)
      SELECT citation_author, regexp_replace(regexp_replace(regexp_replace(replace(lower(trim(string_split_regex(trim(regexp_replace(regexp_replace(replace(regexp_replace(citation_author, '(?i)\bet\.?\s*al\.?\b', '', 'g'), '&', ' and '),
        '[()\[\]{{}},.;:]', ' ', 'g'), '\s+', ' ', 'g')), '(?i)\band\b|[–—]')[1])), '-', '_'), '[’'']', '', 'g'), '\s+', '_', 'g'), '^_+|_+$', '', 'g') AS primary_key,
      {_SURNAME.format('citation_author')} AS surname_key, {_FIRST_KEY.format('citation_author')} AS first_key, {_FIRST_KEY.replace(chr(92) + 'band' + chr(92) + 'b', 'and').format('citation_author')} AS first_key_compat FROM a""",
    "q_reference_index": f"""WITH r AS (SELECT DISTINCT review_id, raw_line FROM references_index WHERE raw_line <> '')
      SELECT review_id, regexp_extract(raw_line, '{_ENTRY}', 1) AS first_author, regexp_extract(raw_line, '{_ENTRY}', 2) AS year, {_strip('raw_line')} AS raw_line FROM r WHERE regexp_extract(raw_line, '{_ENTRY}', 1) <> ''""",
}

QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("q_")}
