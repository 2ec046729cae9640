"""Explicit schemas and the guards that hold tables to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVIDENCE = "array<struct<page_range:string,text:string,score:int>>"
REGISTRY = (
    "review_id string, section string, claim_id string, claim_text string, is_quote boolean, has_numbers boolean, is_causal_or_normative boolean, citation_text string, citation_type string, "
    "citation_author string, citation_year string, is_secondary boolean, primary_mentioned_author string, primary_mentioned_year string, stated_page string, in_reference_list boolean, "
    "source_pdf_path string, priority string"
)
REFERENCES = "review_id string, first_author string, year string, raw_line string"
INPUTS = (
    "review_id string, section string, claim_id string, claim_text string, citation_text string, citation_type string, is_secondary boolean, primary_mentioned_author string, primary_mentioned_year string, "
    f"stated_page string, citation_author string, citation_year string, source_pdf_path string, evidence {EVIDENCE}"
)
# Names a canonical table must have.
CANONICAL = ["review_id", "section", "claim_id", "claim_text", "is_quote", "has_numbers", "is_causal_or_normative", "citation_text", "source_pdf"]
FLAGS = ["is_quote", "has_numbers", "is_causal_or_normative"]


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The table itself, or a ValueError that lists the missing names."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def cast_where_possible(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """try_cast per value; a value that does not fit becomes null (not: the whole column stays as it was)."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in types.items() if c in df.columns})


def with_required(df: DataFrame, names: list[str] = CANONICAL) -> DataFrame:
    """Absent flags become false, other absent columns the empty string."""
    return df.withColumns({n: F.lit(False) if n in FLAGS else F.lit("") for n in names if n not in df.columns})
