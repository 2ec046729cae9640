"""Queries of the model stages (prompts, verdict rows, rewrites), of path resolution by score, and of files written and read again."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.functions import scalars as X
from claimloom.operators import adjudicate, citations, jsonrepair, reports, resolve, sections, textops
from claimloom.plans.reference import _CITED, _CLAIMS, _PAGE, _PAIR, _TEXTS, _VERDICTS, _cited, _claims, _files, _narratives, _sentences, _strip, _verdicts
from claimloom.schemas import EVIDENCE
from claimloom.session import shared_folder, table
from claimloom.sources import files

# ---------------------------------------------------------------- model stages


def _inputs(s: SparkSession, d: str) -> DataFrame:
    """The last delivery of each claim's inputs."""
    return reports.last_of(table(s, d, "adjudication_inputs"), ["claim_id"], ["built_at"])


def q_prompts(s: SparkSession, d: str) -> DataFrame:
    p = _inputs(s, d).select("claim_id", adjudicate.judge_prompt().alias("p"))
    return p.select("claim_id", F.md5("p").alias("prompt_md5"), F.length("p").alias("chars"))


def q_verdict_rows(s: SparkSession, d: str) -> DataFrame:
    return adjudicate.verdict_rows(_inputs(s, d), adjudicate.excerpt_judge)


def _enriched(s: SparkSession, d: str) -> DataFrame:
    """Claims with a section title where the registry has a section, else the canonical name; the review stands for its question."""
    return _claims(s, d).select("review_id", "claim_id", "claim_text", F.col("review_id").alias("research_question"), F.col("section").alias("section_title"), F.lit("unknown").alias("section_canonical"))


def _failed(s: SparkSession, d: str) -> DataFrame:
    return adjudicate.rewrite_targets(_inputs(s, d).join(_verdicts(s, d).select("claim_id", "verdict"), "claim_id"))


def q_rewrite_rows(s: SparkSession, d: str) -> DataFrame:
    """Proposals for every failed claim."""
    return adjudicate.propose_rewrites(_failed(s, d), _enriched(s, d), table(s, d, "adjudication_inputs"), adjudicate.citing_rewriter)


def q_rewrite_targets(s: SparkSession, d: str) -> DataFrame:
    """The first fifty failed claims of the review with most claims (a limit is what the operator is for)."""
    v = _inputs(s, d).join(_verdicts(s, d).select("claim_id", "verdict"), "claim_id")
    top = v.groupBy("review_id").count().orderBy(F.desc("count"), "review_id").first()
    return adjudicate.rewrite_targets(v, top["review_id"] if top else None, 50).select("review_id", "claim_id")


def q_consolidated(s: SparkSession, d: str) -> DataFrame:
    """All verdict rows with the proposals filled in by key."""
    proposals = q_rewrite_rows(s, d)
    rows = _inputs(s, d).join(_verdicts(s, d).select("claim_id", "verdict"), "claim_id").select("review_id", "claim_id", "verdict", "built_at", *[F.lit("").alias(c) for c in adjudicate.REWRITE_COLUMNS])
    return adjudicate.with_rewrites(rows, proposals, ["built_at"]).drop("built_at")


def q_corrections(s: SparkSession, d: str) -> DataFrame:
    """What to do about each claim that did not pass: the proposed text where there is one, else an edit or removal."""
    v = q_consolidated(s, d).filter(F.col("verdict").isin("UNSUPPORTED_FAIL", "AMBIGUOUS_REVIEW"))
    section = _inputs(s, d).select("claim_id", "section")
    return v.join(section, "claim_id").select("review_id", "section", "claim_id", F.when(F.col("proposed_rewrite") != "", "replace").otherwise("edit_or_remove").alias("action_type"), F.col("proposed_rewrite").alias("proposed_text"), F.col("rewrite_notes").alias("notes"))


def q_map_defaults(s: SparkSession, d: str) -> DataFrame:
    """A field of JSON texts: as it stands, or a default where its name is missing; flags as one text, a list or not."""
    e = table(s, d, "events").select("event_id", "props", F.from_json("props", "map<string,string>").alias("m"))
    return e.select("event_id", X.default_if_missing(F.col("m"), "k", "none").alias("k"), X.default_if_missing(F.col("m"), "no such name", "none").alias("absent"), X.joined(F.to_json(F.array(F.lit("a"), F.col("event_id").cast("string")))).alias("flags"), X.joined(F.lit('"one"')).alias("flag"))


# ---------------------------------------------------------------- resolution


def q_resolve_weighted(s: SparkSession, d: str) -> DataFrame:
    return resolve.weighted(_claims(s, d), _files(s, d))


def q_resolve_weighted_compat(s: SparkSession, d: str) -> DataFrame:
    return resolve.weighted(_claims(s, d), _files(s, d), compat=True)


def q_enriched_paths(s: SparkSession, d: str) -> DataFrame:
    """Each claim's path, slashes turned; blank ones by the weighted resolver."""
    return resolve.fill_paths(_claims(s, d), _files(s, d))


def q_target_years(s: SparkSession, d: str) -> DataFrame:
    """The year a citation of several works gives the claim's author."""
    return _claims(s, d).select("claim_id", resolve.year_for_author(F.col("citation_author"), F.col("citation_text")).alias("target_year"))


def q_resolve_overlap(s: SparkSession, d: str) -> DataFrame:
    c = reports.last_of(table(s, d, "ccp_registry").select("claim_id", "citation_text", "loaded_at"), ["claim_id"], ["loaded_at"])
    return resolve.overlapping(c, _files(s, d))


def q_author_variants(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "ccp_registry").select("citation_author", "citation_text").filter("citation_author IS NOT NULL").distinct()
    return a.select("citation_author", "citation_text", F.array_join(F.array_sort(X.author_variants(F.col("citation_author"))), ",").alias("variants"), F.array_join(F.array_sort(X.mined_authors(F.col("citation_text"))), ",").alias("mined"))


# ---------------------------------------------------------------- citations


def q_claim_fanout(s: SparkSession, d: str) -> DataFrame:
    """One row for each sentence and citation, with a repeatable id."""
    rows = _cited(s, d)
    key = F.substr(F.sha2(F.concat_ws("|", "claim_id", "sent_no", "cit_no"), 256), F.lit(1), F.lit(16))
    return rows.select(key.alias("row_id"), "claim_id", "sent_no", "cit_no", "citation_type", "citation_author", "citation_year", "is_secondary", "stated_page")


def q_citation_types(s: SparkSession, d: str) -> DataFrame:
    return _cited(s, d).groupBy("citation_type").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- files


def q_csv_files(s: SparkSession, d: str) -> DataFrame:
    """Claims and a part of them once more, written as CSV in two goes with one column put last, and read again as text."""
    at = f"{shared_folder(s)}/csv"
    c = _claims(s, d).select("priority", *[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in ("claim_id", "claim_text", "citation_text", "is_quote")])
    files.write_csv(c, at, last=["priority"])
    files.write_csv(c.filter("is_quote = 'true'"), at, last=["priority"], mode="append")
    got = files.read_csv(s, at, "claim_id string, claim_text string, citation_text string, is_quote string, priority string")
    return got.select(*[F.coalesce(n, F.lit("")).alias(n) for n in got.columns])


def q_csv_inferred(s: SparkSession, d: str) -> DataFrame:
    """Events written as CSV, read with the types their values show."""
    at = f"{shared_folder(s)}/csv"
    files.write_csv(table(s, d, "events").select("event_id", "user_id", "event_type", "value"), at)
    got = files.read_csv_inferred(s, at)
    return got.select(F.col("event_id").cast("bigint").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id"), "event_type", F.col("value").cast("double").alias("value"))


def q_jsonl_files(s: SparkSession, d: str) -> DataFrame:
    """All deliveries of inputs as JSON lines in order of delivery, read keyed by claim, the last line winning, and strictly."""
    at = f"{shared_folder(s)}/jsonl"
    rows = table(s, d, "adjudication_inputs").select("claim_id", "stated_page", "evidence", "built_at")
    files.write_jsonl(rows.repartitionByRange("built_at").sortWithinPartitions("built_at").withColumn("built", F.unix_micros(F.col("built_at").cast("timestamp"))).drop("built_at"), at)
    schema = f"claim_id string, stated_page string, evidence {EVIDENCE}, built bigint"
    lines = files.read_jsonl(s, at, schema).groupBy("claim_id").agg(F.count("*").alias("lines"))
    return files.read_jsonl_keyed(s, at, schema, "claim_id").join(lines, "claim_id").select("claim_id", "stated_page", F.size("evidence").alias("n_evidence"), "built", "lines")


def q_best_read(s: SparkSession, d: str) -> DataFrame:
    """References to Parquet, CSV and a history; the best there is and the first CSV there is, and what a rewrite of the table keeps."""
    at = shared_folder(s)
    rows = table(s, d, "references_index").select("review_id", "first_author", "year").distinct().select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("review_id", "first_author", "year")])
    schema = "review_id string, first_author string, year string"
    files.write_all(rows, at, "1")
    best = files.read_best(s, f"{at}/parquet", f"{at}/csv", schema)
    first = files.read_best(s, None, [f"{at}/no-such-table", f"{at}/csv"], schema)
    old = files.rewrite_with_backup(best.filter("year <> ''"), f"{at}/parquet", "2")
    parts = [("csv", first), ("history", s.read.parquet(f"{at}/history/run_ts=1")), ("backup", s.read.parquet(old)), ("rewritten", s.read.parquet(f"{at}/parquet"))]
    counted = [f.groupBy("review_id").agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), F.coalesce("review_id", F.lit("")).alias("review_id"), "n") for name, f in parts]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


def _docx(s: SparkSession, d: str) -> DataFrame:
    """Each document as a word processor's file: its lines as paragraphs, # lines as headings of their level."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = []
            for lines in pdf["ls"]:
                heads = [(len(x) - len(x.lstrip("#")) if x.startswith("#") else None, x.lstrip("#").strip() if x.startswith("#") else x) for x in lines]
                made.append(files.docx_bytes(heads))
            yield pd.DataFrame({"path": [f"reviews/{i}.docx" for i in pdf["doc_id"]], "content": made})

    lines = table(s, d, "documents").select("doc_id", textops.line_array(F.col("text")).alias("ls"))
    return files.parse_docx(lines.mapInPandas(run, "path string, content binary"))


def q_docx_paragraphs(s: SparkSession, d: str) -> DataFrame:
    return _docx(s, d).select("review_id", "para_no", "level", F.md5(F.regexp_replace("text", r"\s+", " ")).alias("text_md5"))


def q_docx_sections(s: SparkSession, d: str) -> DataFrame:
    """Sections that claims can be matched with, and their review's question."""
    p = _docx(s, d)
    got = sections.usable(files.docx_sections(p)).join(files.research_questions(p), "review_id", "left")
    return got.select("review_id", F.col("sec_no").cast("int").alias("sec_no"), "level", "title", F.length("body").alias("body_chars"), F.coalesce("research_question", F.lit("")).alias("research_question"))


def q_json_lines(s: SparkSession, d: str) -> DataFrame:
    """Each delivered JSON line by itself: objects recovered and spans that are none."""
    raw = table(s, d, "adjudication_raw").filter("layout = 'jsonl'").select("raw_id", "raw_text")
    got = jsonrepair.recover_files(raw, "raw_id", "raw_text")
    good = F.col("object").isNotNull()
    return got.groupBy("raw_id").agg(F.count(F.when(good, 1)).alias("good"), F.min(F.when(good, F.get_json_object("object", "$.claim_id"))).alias("claim_id")).filter("good = 1 AND claim_id IS NOT NULL")


# ---------------------------------------------------------------- SQL

_EXCERPTS = "coalesce(array_to_string(list_transform({0}, lambda e: chr(10) || '[pp. ' || coalesce(e.page_range, '') || '] ' || coalesce(e.text, '') || chr(10)), ''), '')"
_INPUTS = "inputs AS (SELECT * FROM adjudication_inputs QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY built_at DESC) = 1)"
_TASK = adjudicate.JUDGE_TASK.replace("'", "''")
_ETAL = r"regexp_replace(coalesce({0}, ''), '(?i)\bet\.?\s*al\.?\b', '', 'g')"
_KEY = (
    r"regexp_replace(regexp_replace(regexp_replace(replace(lower(trim(string_split_regex(trim(regexp_replace(regexp_replace(replace(" + _ETAL + r", '&', ' and '), '[()\[\]{{}},.;:]', ' ', 'g'), '\s+', ' ', 'g')), '(?i)\band\b|[–—]')[1])), '-', '_'), '[’'']', '', 'g'), '\s+', '_', 'g'), '^_+|_+$', '', 'g')"
)
_NORM = r"regexp_replace(trim(lower(regexp_replace(regexp_replace(regexp_replace(replace({0}, '&', ' and '), '[!-/:-@\[-`{{-~]', ' ', 'g'), '[^A-Za-z0-9_ ]+', ' ', 'g'), ' +', ' ', 'g'))), ' ', '_', 'g')"
_YEAR_OF = r"nullif(lower(regexp_extract(coalesce({0}, ''), '(?i)(?:^|[^0-9])((?:19|20)\d{{2}}(?:[a-z](?:[^a-z]|$))?)(?:[^0-9]|$)', 1)), '')"


def _variants_sql(c: str) -> str:
    key = _KEY.format(c)
    rest = f"CASE WHEN regexp_matches(k, '^({'|'.join(X.PARTICLES)})_') THEN regexp_replace(k, '^[^_]+_', '') END"
    one = f"list_transform([{key}], lambda k: [k, string_split(k, '_')[-1], replace(k, '_', ''), replace(string_split(k, '_')[-1], '_', ''), {rest}, replace({rest}, '_', '')])[1]"
    return f"list_filter(list_distinct({one}), lambda v: v IS NOT NULL AND v <> '')"


def _mined_sql(c: str) -> str:
    head = rf"string_split_regex(regexp_replace(replace({_ETAL.format(c)}, '&', ' and '), '[()]', ' ', 'g'), '(?i)\b(?:19|20)\d{{2}}[a-z]?\b')[1]"
    chunks = rf"list_filter(list_transform(string_split_regex({head}, '(?i),|\band\b'), lambda x: regexp_replace({_NORM.format('x')}, '^_+|_+$', '', 'g')), lambda x: x <> '')"
    names = f"flatten(list_transform({chunks}, lambda x: [string_split(x, '_')[-1], x]))"
    return f"list_distinct(list_concat({names}, list_transform({names}, lambda x: replace(x, '_', ''))))"


_PARTS = f"list_filter(list_transform(string_split(CASE WHEN regexp_full_match({_strip('''coalesce(citation_text, '')''')}, '\\(.*\\)') THEN {_strip('''coalesce(citation_text, '')''')}[2:-2] ELSE {_strip('''coalesce(citation_text, '')''')} END, ';'), lambda x: {_strip('x')}), lambda x: x <> '')"
_FIRST_YEAR = r"nullif(lower(regexp_extract(regexp_replace(coalesce({0}, ''), '((?:19|20)\d{{2}})([A-Za-z]{{2,}})', '\1 \2', 'g'), '(?i)(?:^|[^0-9])((?:19|20)\d{{2}}[a-z]?)(?:[^0-9]|$)', 1)), '')"
_MINE = f"""tgt AS (SELECT claim_id, {_KEY.format('citation_author')} AS key, list_transform({_PARTS}, lambda p: {_NORM.format('p')}) AS parts FROM claims),
mine AS (SELECT claim_id, CASE WHEN key <> '' THEN list_filter(list_transform(list_filter(parts, lambda p: contains('_' || p || '_', '_' || key || '_') OR contains('_' || p || '_', '_' || replace(key, '_', '') || '_')),
  lambda p: {_FIRST_YEAR.format('p')}), lambda y: y IS NOT NULL)[1] END AS target_year FROM tgt)"""
_BASE = r"nullif(regexp_extract(coalesce({0}, ''), '(\d{{4}})', 1), '')"
_INVENTORY = rf"""fi AS (SELECT DISTINCT path, regexp_replace(trim(string_split(replace(path, chr(92), '/'), '/')[-1]), '(?i)(?:\.pdf)+$', '') AS st FROM file_inventory),
fs AS (SELECT path, st, {_NORM.format('st')} AS stem_norm FROM fi), ff AS (SELECT path, st, stem_norm, {_BASE.format(_FIRST_YEAR.format('stem_norm'))} AS have FROM fs)"""


def _weighted_sql(compat: bool) -> str:
    own = [f"lower(CASE WHEN {_strip(c)} <> '' THEN {c} END)" for c in ("citation_year", "primary_mentioned_year")]
    first = _FIRST_YEAR.format("citation_text")
    want = ", ".join(["target_year", *([first, *own] if compat else [*own, first])])
    return f"""{_CLAIMS}, {_MINE}, {_INVENTORY}, wc AS (SELECT c.claim_id, {_BASE.format(f'coalesce({want})')} AS want, {_KEY.format('citation_author')} AS key,
  list_filter(list_distinct(list_concat(list_concat({_variants_sql('citation_author')}, {_mined_sql('citation_text')}), {_variants_sql('primary_mentioned_author')})), lambda v: v <> '') AS vs FROM claims c JOIN mine ON mine.claim_id = c.claim_id),
sc AS (SELECT claim_id, path, CAST(CASE WHEN want = have THEN 10 ELSE 0 END + coalesce(list_sum(list_transform(vs, lambda v: CASE WHEN contains('_' || stem_norm || '_', '_' || v || '_') THEN 2 WHEN contains(stem_norm, v) THEN 1 ELSE 0 END * CASE WHEN v = key THEN 2 ELSE 1 END)), 0) AS INT) AS score
  FROM wc JOIN ff ON want IS NULL OR have IS NULL OR want = have),
weighted AS (SELECT claim_id, path, score FROM sc WHERE score >= 2 QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY score DESC, path) = 1)"""


_LEAD = r"regexp_replace(regexp_replace(regexp_replace(replace(" + _ETAL.replace("coalesce({0}, '')", "trim(coalesce({0}, ''))") + r", '-', '_'), '[^A-Za-z0-9_.]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g')"
_OVERLAP = f"""{_CLAIMS}, {_INVENTORY}, fo AS (SELECT path, lower({_LEAD.format('st')}) AS s FROM fi),
ld AS (SELECT claim_id, regexp_replace({_LEAD.format("string_split(citation_text, ',')[1]")}, '^[(_]+', '') AS lead, nullif(regexp_extract(coalesce(citation_text, ''), '((?:19|20)\\d{{2}})', 1), '') AS yr FROM claims),
cd AS (SELECT claim_id, CAST(generate_subscripts(cs, 1) - 1 AS INT) AS cand_no, unnest(cs) AS cand FROM (SELECT claim_id, CASE WHEN yr IS NULL THEN [lower(lead)] ELSE [lower(lead || '_' || yr), lower(lead)] END AS cs FROM ld)),
ex AS (SELECT claim_id, path FROM cd JOIN fo ON cand = s QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY cand_no, path) = 1),
cw AS (SELECT claim_id, cand_no, list_filter(list_distinct(string_split(cand, '_')), lambda t: t <> '') AS ts FROM cd), fw AS (SELECT path, list_filter(list_distinct(string_split(s, '_')), lambda t: t <> '') AS ts FROM fo),
ov AS (SELECT claim_id, path, CAST(len(list_intersect(cw.ts, fw.ts)) AS INT) AS shared, cand_no FROM cw, fw WHERE len(list_intersect(cw.ts, fw.ts)) > 0 QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY shared DESC, cand_no, path) = 1)"""
_SENT = "sent AS (" + _sentences("texts", "claim_id", "claim_text", False) + "), cs AS (SELECT * FROM sent WHERE contains(sentence, '('))"
_FANOUT = f"""{_TEXTS}, {_SENT}, blk AS (SELECT claim_id, sent_no, generate_subscripts(bs, 1) AS bn, unnest(bs) AS b FROM (SELECT claim_id, sent_no, regexp_extract_all(sentence, '\\(([^()]+)\\)', 1) AS bs FROM cs)),
par AS (SELECT claim_id, sent_no, bn, b, 0 AS pn, 'secondary_parenthetical' AS citation_type, trim(regexp_extract(b, '{_CITED}', 1)) AS citation_author, regexp_extract(b, '{_CITED}', 2) AS citation_year FROM blk WHERE regexp_extract(b, '{_CITED}', 1) <> ''
  UNION ALL SELECT claim_id, sent_no, bn, b, generate_subscripts(a, 1), 'parenthetical', trim(unnest(a)), unnest(y) FROM
  (SELECT *, regexp_extract_all(b, '{_PAIR}', 1) AS a, regexp_extract_all(b, '{_PAIR}', 2) AS y FROM blk WHERE regexp_extract(b, '{_CITED}', 1) = '')),
{_narratives('cs', 'claim_id, sent_no', 'sentence')},
alls AS (SELECT claim_id, sent_no, 1 AS kind, bn AS o1, pn AS o2, '(' || b || ')' AS ct, citation_type, citation_author, citation_year, NULL AS pa, NULL AS py, nullif(regexp_extract(b, '{_PAGE}', 1), '') AS stated_page, bn - 1 AS place FROM par
  UNION ALL SELECT claim_id, sent_no, 2, k, 0, citation_text, citation_type, citation_author, citation_year, primary_mentioned_author, primary_mentioned_year, stated_page, span_start FROM narr),
uniq AS (SELECT * FROM alls QUALIFY row_number() OVER (PARTITION BY claim_id, sent_no, ct, citation_type, citation_author, citation_year, pa, py, stated_page, place ORDER BY kind, o1, o2) = 1),
fan AS (SELECT *, CAST(row_number() OVER (PARTITION BY claim_id, sent_no ORDER BY kind, o1, o2) - 1 AS INT) AS cit_no FROM uniq)"""
_PROPOSAL = f"""{_VERDICTS}, {_INPUTS}, {_CLAIMS}, pr AS (SELECT i.review_id, i.claim_id, coalesce(nullif(c.claim_text, ''), i.claim_text, '') AS ct, i.evidence[1].page_range AS pg, len(coalesce(i.evidence, [])) AS n,
  coalesce(i.source_pdf_path, '') AS source_pdf_path, CASE WHEN c.claim_id IS NULL THEN '' ELSE coalesce(nullif(c.section, ''), 'unknown') END AS section_title, coalesce(c.review_id, '') AS research_question
  FROM verdicts v JOIN inputs i ON i.claim_id = v.claim_id LEFT JOIN claims c ON c.claim_id = i.claim_id AND c.review_id = i.review_id WHERE verdict = 'UNSUPPORTED_FAIL'),
proposals AS (SELECT review_id, claim_id, CASE WHEN n > 0 THEN trim(ct || ' (pp. ' || coalesce(pg, '') || ')') ELSE '' END AS proposed_rewrite, CASE WHEN n > 0 THEN trim('pp. ' || coalesce(pg, '')) ELSE '' END AS page_anchor,
  source_pdf_path, section_title, research_question, CASE WHEN n > 0 THEN 'first excerpt' ELSE 'LLM error: no excerpt' END AS notes, CASE WHEN n > 0 THEN 'weak_evidence' ELSE 'llm_error' END AS risk_flags FROM pr),
merged AS (SELECT v.review_id, v.claim_id, v.section, verdict, coalesce(p.proposed_rewrite, '') AS proposed_rewrite, coalesce(p.page_anchor, '') AS page_anchor, coalesce(p.notes, '') AS rewrite_notes, coalesce(p.risk_flags, '') AS rewrite_flags
  FROM verdicts v LEFT JOIN proposals p ON p.claim_id = v.claim_id AND p.review_id = v.review_id)"""
_DOCX = rf"""split AS (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r\x{{000B}}\x{{000C}}\x{{0085}}\x{{2028}}\x{{2029}}]') AS ls FROM documents WHERE text IS NOT NULL),
tidy AS (SELECT doc_id, CASE WHEN ls[-1] = '' THEN ls[:-2] ELSE ls END AS ls FROM split),
para AS (SELECT CAST(doc_id AS VARCHAR) AS review_id, CAST(generate_subscripts(ls, 1) - 1 AS INT) AS para_no, unnest(ls) AS line FROM tidy),
px AS (SELECT review_id, para_no, CASE WHEN line LIKE '#%' THEN CAST(length(regexp_extract(line, '^(#+)', 1)) AS INT) END AS level, regexp_replace(CASE WHEN line LIKE '#%' THEN {_strip("regexp_replace(line, '^#+', '')")} ELSE line END, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g') AS text FROM para)"""

SQL = {
    "q_prompts": f"""WITH {_INPUTS}, p AS (SELECT claim_id, 'CLAIM: ' || chr(10) || coalesce(claim_text, '') || chr(10) || chr(10) || 'CITATION CONTEXT:' || chr(10) || '- Citation text: ' || coalesce(citation_text, '') || chr(10)
      || '- Type: ' || coalesce(citation_type, '') || CASE WHEN is_secondary THEN ' (secondary)' ELSE '' END || chr(10)
      || CASE WHEN primary_mentioned_author <> '' THEN '- Primary source mentioned: ' || primary_mentioned_author || ' (' || coalesce(primary_mentioned_year, '') || ')' ELSE '' END || chr(10)
      || CASE WHEN stated_page <> '' THEN '- Stated page (may be wrong): ' || stated_page ELSE '' END || chr(10) || chr(10)
      || 'CITED SOURCE:' || chr(10) || '- ' || coalesce(citation_author, '') || ' (' || coalesce(citation_year, '') || ')' || chr(10) || '- ' || coalesce(source_pdf_path, '') || chr(10) || chr(10)
      || 'SOURCE EXCERPTS:' || chr(10) || {_EXCERPTS.format('evidence')} || chr(10) || 'TASK:' || chr(10) || '{_TASK}' AS p FROM inputs)
      SELECT claim_id, md5(p) AS prompt_md5, CAST(length(p) AS INT) AS chars FROM p""",
    "q_verdict_rows": f"""WITH {_INPUTS}, j AS (SELECT *, len(coalesce(evidence, [])) AS n, {_EXCERPTS.format('evidence')} AS ex FROM inputs)
      SELECT coalesce(review_id, '') AS review_id, coalesce(section, '') AS section, claim_id, coalesce(claim_text, '') AS claim_text, coalesce(citation_author, '') AS citation_author, coalesce(citation_year, '') AS citation_year,
      coalesce(source_pdf_path, '') AS source_pdf_path, CASE WHEN claim_text <> '' AND contains(ex, claim_text) THEN 'EXACT_QUOTE_PASS' WHEN n >= 3 THEN 'FAITHFUL_PARAPHRASE_PASS' WHEN n > 0 THEN 'AMBIGUOUS_REVIEW' ELSE 'UNSUPPORTED_FAIL' END AS verdict,
      n || ' excerpts' AS rationale, CAST(n AS VARCHAR) AS evidence_span, CASE WHEN n > 0 THEN 'none' ELSE 'cite or remove' END AS required_fix, CASE WHEN n > 0 THEN '' ELSE 'insufficient_evidence;pdf_missing' END AS risk_flags,
      '' AS proposed_rewrite, '' AS page_anchor, '' AS rewrite_notes, '' AS rewrite_flags FROM j""",
    "q_rewrite_rows": f"WITH {_PROPOSAL} SELECT * FROM proposals",
    "q_rewrite_targets": f"""WITH {_VERDICTS}, top AS (SELECT review_id FROM verdicts GROUP BY review_id ORDER BY count(*) DESC, review_id LIMIT 1)
      SELECT review_id, claim_id FROM verdicts WHERE verdict = 'UNSUPPORTED_FAIL' AND review_id IN (SELECT review_id FROM top) ORDER BY claim_id LIMIT 50""",
    "q_consolidated": f"WITH {_PROPOSAL} SELECT review_id, claim_id, verdict, proposed_rewrite, page_anchor, rewrite_notes, rewrite_flags FROM merged",
    "q_corrections": f"""WITH {_PROPOSAL} SELECT review_id, section, claim_id, CASE WHEN proposed_rewrite <> '' THEN 'replace' ELSE 'edit_or_remove' END AS action_type, proposed_rewrite AS proposed_text, rewrite_notes AS notes
      FROM merged WHERE verdict IN ('UNSUPPORTED_FAIL', 'AMBIGUOUS_REVIEW')""",
    "q_map_defaults": "SELECT event_id, CASE WHEN list_contains(json_keys(props), 'k') THEN props ->> '$.k' ELSE 'none' END AS k, 'none' AS absent, 'a;' || event_id AS flags, 'one' AS flag FROM events",
    "q_resolve_weighted": f"WITH {_weighted_sql(False)} SELECT * FROM weighted",
    "q_resolve_weighted_compat": f"WITH {_weighted_sql(True)} SELECT * FROM weighted",
    "q_enriched_paths": f"""WITH {_weighted_sql(False)} SELECT c.claim_id, CASE WHEN {_strip("coalesce(source_pdf_path, '')")} <> '' THEN replace({_strip('source_pdf_path')}, chr(92), '/') ELSE coalesce(replace(path, chr(92), '/'), '') END AS source_pdf_path
      FROM claims c LEFT JOIN weighted w ON w.claim_id = c.claim_id""",
    "q_target_years": f"WITH {_CLAIMS}, {_MINE} SELECT * FROM mine",
    "q_resolve_overlap": f"""WITH {_OVERLAP} SELECT coalesce(ex.claim_id, ov.claim_id) AS claim_id, coalesce(ex.path, ov.path) AS path, CASE WHEN ex.path IS NULL THEN shared END AS shared FROM ex FULL JOIN ov ON ex.claim_id = ov.claim_id""",
    "q_author_variants": f"""WITH a AS (SELECT DISTINCT citation_author, citation_text FROM ccp_registry WHERE citation_author IS NOT NULL)
      SELECT citation_author, citation_text, coalesce(array_to_string(list_sort({_variants_sql('citation_author')}), ','), '') AS variants, coalesce(array_to_string(list_sort({_mined_sql('citation_text')}), ','), '') AS mined FROM a""",
    "q_claim_fanout": f"""WITH {_FANOUT} SELECT substr(sha256(claim_id || '|' || sent_no || '|' || cit_no), 1, 16) AS row_id, claim_id, sent_no, cit_no, citation_type, citation_author, citation_year,
      starts_with(citation_type, 'secondary') AS is_secondary, stated_page FROM fan""",
    "q_citation_types": f"WITH {_FANOUT} SELECT citation_type, count(*) AS n FROM fan GROUP BY citation_type",
    "q_csv_files": f"""WITH {_CLAIMS}, c AS (SELECT claim_id, coalesce(claim_text, '') AS claim_text, coalesce(citation_text, '') AS citation_text, coalesce(CAST(is_quote AS VARCHAR), '') AS is_quote, coalesce(priority, '') AS priority FROM claims)
      SELECT * FROM c UNION ALL SELECT * FROM c WHERE is_quote = 'true'""",
    "q_csv_inferred": "SELECT event_id, user_id, event_type, value FROM events",
    "q_jsonl_files": f"""WITH {_INPUTS}, n AS (SELECT claim_id, count(*) AS lines FROM adjudication_inputs GROUP BY claim_id)
      SELECT i.claim_id, stated_page, CAST(len(evidence) AS INT) AS n_evidence, epoch_us(built_at) AS built, lines FROM inputs i JOIN n ON n.claim_id = i.claim_id""",
    "q_best_read": """WITH r AS (SELECT DISTINCT coalesce(review_id, '') AS review_id, coalesce(first_author, '') AS first_author, coalesce(year, '') AS year FROM (SELECT DISTINCT review_id, first_author, year FROM references_index)),
      n AS (SELECT review_id, coalesce(year, '') <> '' AS dated FROM (SELECT DISTINCT review_id, first_author, year FROM references_index))
      SELECT part, coalesce(review_id, '') AS review_id, count(*) AS n FROM n, (SELECT unnest(['csv', 'history', 'backup']) AS part) GROUP BY ALL UNION ALL SELECT 'rewritten', coalesce(review_id, ''), count(*) FROM n WHERE dated GROUP BY ALL""",
    "q_docx_paragraphs": rf"WITH {_DOCX} SELECT review_id, para_no, level, md5(regexp_replace(text, '\s+', ' ', 'g')) AS text_md5 FROM px",
    "q_docx_sections": rf"""WITH {_DOCX}, t AS (SELECT review_id, para_no, level, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM px), u AS (SELECT *, level BETWEEN 1 AND 4 AS head FROM t WHERE t <> ''),
      v AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY review_id ORDER BY para_no ROWS UNBOUNDED PRECEDING) AS sec_no FROM u),
      w AS (SELECT review_id, CAST(sec_no AS INT) AS sec_no, max(CASE WHEN head THEN level END) AS level, max(CASE WHEN head THEN t END) AS title, coalesce(string_agg(CASE WHEN NOT coalesce(head, false) THEN t END, ' ' ORDER BY para_no), '') AS body FROM v WHERE sec_no > 0 GROUP BY ALL),
      q AS (SELECT review_id, arg_min(t, para_no) AS rq FROM u WHERE level = 1 GROUP BY review_id)
      SELECT w.review_id, sec_no, level, title, CAST(length(body) AS INT) AS body_chars, coalesce(rq, '') AS research_question FROM w LEFT JOIN q ON q.review_id = w.review_id WHERE level BETWEEN 2 AND 4 OR (level = 1 AND body <> '')""",
}

QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("q_")}
