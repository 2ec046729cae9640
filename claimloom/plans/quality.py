"""Queries p3 to p5 (rows that fail to parse, packed fields, orphan references) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimloom.operators import orphans, packed, rejects
from claimloom.session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    parsed = rejects.parse_lines(table(spark, d, "adjudication_raw"))
    return rejects.rejects(parsed).select("raw_id", "reason").distinct()


def p3_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The lines that load, with the number and the length of their evidence items."""
    rows = rejects.loaded(rejects.parse_lines(table(spark, d, "adjudication_raw")))
    return rows.selectExpr(
        "raw_id", "review_id", "section", "claim_id", "claim_text", "citation_text", "stated_page", "source_pdf_path",
        "size(evidence) AS n_evidence", "aggregate(evidence, 0L, (a, e) -> a + length(e.text)) AS evidence_chars",
    )


def p3_reasons(spark: SparkSession, d: str) -> DataFrame:
    parsed = rejects.parse_lines(table(spark, d, "adjudication_raw"))
    return rejects.rejects(parsed).groupBy("reason").count().withColumnRenamed("count", "n_lines")


def _packed(spark: SparkSession, d: str) -> DataFrame:
    # a redelivered claim repeats its field: one row for each claim and field before anything is split
    claims = table(spark, d, "ccp_registry").select("claim_id", "citation_text").distinct()
    return packed.unpack_field(claims, "citation_text", ["claim_id"])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).filter("n_values >= 2").select("claim_id", "pos", "cite_value").distinct()


def p4_value_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many claims cite how many works in one field."""
    one = _packed(spark, d).select("claim_id", "n_values").distinct()
    return one.groupBy("n_values").count().withColumnRenamed("count", "n_claims")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(table(spark, d, "ccp_registry"), table(spark, d, "file_inventory"), table(spark, d, "references_index"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per referred table, month and reason."""
    return orphans.orphan_report(p5_found(spark, d))


_YEAR = r"(?:1[5-9]|20)\d\d[A-Za-z]?"
_PAGE = r"(?:\s*,\s*pp?\.?\s*\d+(?:[-–]\d+)?)?"
_P4 = rf"""
WITH f AS (SELECT DISTINCT claim_id, trim(citation_text) AS t FROM ccp_registry WHERE citation_text IS NOT NULL),
g AS (SELECT claim_id, CASE WHEN regexp_full_match(t, '\((?:[^()]|\([^()]*\))*\)') OR regexp_full_match(t, '\[(?:[^\[\]]|\[[^\[\]]*\])*\]')
  THEN substr(t, 2, length(t) - 2) ELSE t END AS t FROM f),
v AS (SELECT claim_id, regexp_extract_all(t, '("(?:[^"]|"")*"|“[^”]*”|[^0-9"“”]*\b{_YEAR}{_PAGE}(?:, as cited in [^0-9]*\b{_YEAR}{_PAGE})?)') AS vs FROM g),
n AS (SELECT claim_id, vs, unnest(vs) AS x, generate_subscripts(vs, 1) AS pos FROM v WHERE len(vs) >= 2),
s AS (SELECT claim_id, len(vs) AS n_values, pos, trim(regexp_replace(regexp_replace(x, '^(?:\s|[;；|/·,&–—]|and\b)+', ''), '\s+', ' ', 'g')) AS x FROM n)
"""
_P4_VALUE = """CASE WHEN x LIKE '"%"' THEN replace(substr(x, 2, length(x) - 2), '""', '"') WHEN x LIKE '“%”' THEN substr(x, 2, length(x) - 2) ELSE x END"""

_P5 = r"""
WITH r AS (SELECT claim_id, extracted_at AS seen_at, lower(trim(replace(coalesce(source_pdf_path, ''), chr(92), '/'))) AS path, in_reference_list AS listed,
   coalesce(review_id, '') AS rv, lower(trim(coalesce(citation_author, ''))) AS au, lower(coalesce(citation_year, '')) AS yr FROM ccp_registry),
fi AS (SELECT lower(trim(replace(path, chr(92), '/'))) AS path, registered_at AS s, deleted_at AS e FROM file_inventory),
ri AS (SELECT coalesce(review_id, '') AS rv, lower(trim(coalesce(first_author, ''))) AS au, lower(coalesce(year, '')) AS yr, indexed_at AS s, withdrawn_at AS e FROM references_index),
a AS (SELECT claim_id, 'file_inventory' AS ref_table, seen_at, count(fi.path) AS n,
   coalesce(bool_or(fi.path IS NOT NULL AND (s IS NULL OR s <= seen_at) AND (e IS NULL OR e > seen_at)), false) AS live, coalesce(bool_or(s > seen_at), false) AS late
   FROM r LEFT JOIN fi ON r.path = fi.path WHERE r.path <> '' GROUP BY ALL),
b AS (SELECT claim_id, 'references_index' AS ref_table, seen_at, count(ri.rv) AS n,
   coalesce(bool_or(ri.rv IS NOT NULL AND (s IS NULL OR s <= seen_at) AND (e IS NULL OR e > seen_at)), false) AS live, coalesce(bool_or(s > seen_at), false) AS late
   FROM r LEFT JOIN ri ON r.rv = ri.rv AND r.au = ri.au AND r.yr = ri.yr WHERE r.listed GROUP BY claim_id, seen_at, r.rv, r.au, r.yr),
found AS (SELECT DISTINCT claim_id, ref_table, CASE WHEN n = 0 THEN 'missing' WHEN late THEN 'late' ELSE 'deleted' END AS reason, strftime(seen_at, '%Y-%m') AS ref_month
   FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE NOT live)
"""

QUERIES = {
    "p3_found": p3_found,
    "p3_loaded": p3_loaded,
    "p3_reasons": p3_reasons,
    "p4_found": p4_found,
    "p4_value_counts": p4_value_counts,
    "p5_found": p5_found,
    "p5_report": p5_report,
}
SQL = {
    "p4_found": _P4 + f"SELECT DISTINCT claim_id, CAST(pos AS INT) AS pos, {_P4_VALUE} AS cite_value FROM s",
    "p4_value_counts": _P4.replace(" WHERE len(vs) >= 2", " WHERE len(vs) >= 1") + "SELECT CAST(n_values AS INT) AS n_values, count(DISTINCT claim_id) AS n_claims FROM s GROUP BY n_values",
    "p5_found": _P5 + "SELECT * FROM found",
    "p5_report": _P5 + "SELECT ref_table, ref_month, reason, count(*) AS orphans FROM found GROUP BY ALL",
}
