"""A pluggable row-wise model: render a prompt, score it in Arrow batches, check the answer against its schema, shape the rows.

A row that fails, or whose answer breaks the schema, becomes an error row and the rest goes on. A model is any Python callable from a
prompt to a JSON text; a call over a network belongs in one."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.config import DEFAULTS
from claimloom.functions.scalars import or_else
from claimloom.operators.reports import last_of, update_by_key

Judge = Callable[[str], str]

# The verdicts, the keys of an answer (those of `text` must not be empty) and the columns of a verdict row.
VERDICTS = ["EXACT_QUOTE_PASS", "FAITHFUL_PARAPHRASE_PASS", "AMBIGUOUS_REVIEW", "UNSUPPORTED_FAIL"]
VERDICT_ANSWER = {"required": ["verdict", "rationale", "evidence_span", "required_fix", "risk_flags"], "text": ["rationale", "evidence_span"], "closed": True}
REWRITE_ANSWER = {"required": ["proposed_rewrite", "page_anchor"], "text": ["proposed_rewrite", "page_anchor"], "closed": False}
BASE_COLUMNS = ["review_id", "section", "claim_id", "claim_text", "citation_author", "citation_year", "source_pdf_path", "verdict", "rationale", "evidence_span", "required_fix", "risk_flags"]
REWRITE_COLUMNS = ["proposed_rewrite", "page_anchor", "rewrite_notes", "rewrite_flags"]

JUDGE_TASK = "Say whether the excerpts support the claim: one verdict of " + ", ".join(VERDICTS) + ". Answer with one JSON object of the keys " + ", ".join(VERDICT_ANSWER["required"]) + " and nothing else."
REWRITE_TASK = "Write the claim anew so that the excerpts support it, with a citation in brackets and its pages. Answer with one JSON object of the keys proposed_rewrite, page_anchor, notes, risk_flags."


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _line(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\n"))


def excerpts(evidence: Column) -> Column:
    """Each excerpt with its pages on a line of its own."""
    rows = F.transform(F.coalesce(evidence, F.array()), lambda e: F.concat(F.lit("\n[pp. "), F.coalesce(e["page_range"], F.lit("")), F.lit("] "), F.coalesce(e["text"], F.lit("")), F.lit("\n")))
    return F.array_join(rows, "")


def judge_prompt(task: str = JUDGE_TASK) -> Column:
    """The prompt of a row of adjudication inputs: claim, context of its citation, source, excerpts, task. Optional lines stay empty."""
    none = F.lit("")
    secondary = F.when(F.coalesce("is_secondary", F.lit(False)), " (secondary)").otherwise("")
    primary = F.when(_text("primary_mentioned_author") != "", F.concat(F.lit("- Primary source mentioned: "), _text("primary_mentioned_author"), F.lit(" ("), _text("primary_mentioned_year"), F.lit(")"))).otherwise(none)
    page = F.when(_text("stated_page") != "", F.concat(F.lit("- Stated page (may be wrong): "), _text("stated_page"))).otherwise(none)
    return F.concat(
        _line("CLAIM: "), _line(_text("claim_text")), _line(""),
        _line("CITATION CONTEXT:"), _line("- Citation text: ", _text("citation_text")), _line("- Type: ", _text("citation_type"), secondary), _line(primary), _line(page), _line(""),
        _line("CITED SOURCE:"), _line("- ", _text("citation_author"), " (", _text("citation_year"), ")"), _line("- ", _text("source_pdf_path")), _line(""),
        _line("SOURCE EXCERPTS:"), excerpts(F.col("evidence")), _line(""), _line("TASK:"), F.lit(task),
    )


def rewrite_prompt(task: str = REWRITE_TASK, most: int = DEFAULTS.max_excerpts) -> Column:
    """The prompt of a failed claim: research question, section, claim, source, at most `most` excerpts, task."""
    return F.concat(
        _line("RESEARCH QUESTION (H1):"), _line(_text("research_question")), _line(""), _line("SECTION FOCUS (H2/H3/H4 title):"), _line(_text("section_title")), _line(""),
        _line("ORIGINAL CLAIM (UNSUPPORTED):"), _line(_text("claim_text")), _line(""),
        _line("CITED SOURCE:"), _line("- ", _text("citation_author"), " (", _text("citation_year"), ")"), _line("- ", _text("source_pdf_path")), _line(""),
        _line("RELEVANT EXCERPTS (with page ranges):"), excerpts(F.slice(F.coalesce("evidence", F.array()), 1, most)), _line(""), _line("Instructions:"), F.lit(task),
    )


def broken(answer: object, schema: dict) -> str | None:
    """What of the schema an answer breaks, or None."""
    if not isinstance(answer, dict):
        return "no object"
    missing = [k for k in schema["required"] if k not in answer]
    if missing:
        return f"missing {', '.join(missing)}"
    if schema["closed"] and set(answer) - set(schema["required"]):
        return f"unknown {', '.join(sorted(set(answer) - set(schema['required'])))}"
    flags = answer.get("risk_flags", [])
    if not isinstance(flags, list) or not all(isinstance(f, str) for f in flags):
        return "risk_flags is no list of texts"
    wrong = [k for k, v in answer.items() if k != "risk_flags" and not isinstance(v, str)] + [k for k in schema["text"] if answer[k] == ""]
    if wrong:
        return f"no text in {', '.join(wrong)}"
    if "verdict" in schema["required"] and answer["verdict"] not in VERDICTS:
        return "unknown verdict"
    return None


def answers(df: DataFrame, prompt: Column, model: Judge, schema: dict, failed: Callable[[str], dict]) -> DataFrame:
    """df and _answer, a map of the answer's texts, risk_flags as one text. An exception or a broken answer gives failed(reason)."""

    def one(p: str) -> dict[str, str]:
        try:
            answer = json.loads(model(p))
            reason = broken(answer, schema)
        except Exception as e:  # noqa: BLE001
            answer, reason = None, str(e) or type(e).__name__
        answer = failed(f"LLM error: {reason}") if reason is not None else answer
        return {k: ";".join(v) if isinstance(v, list) else v for k, v in answer.items()}

    @F.pandas_udf("map<string,string>")
    def run(prompts: pd.Series) -> pd.Series:
        return prompts.map(one)

    return df.withColumn("_answer", run(prompt))


def verdict_rows(inputs: DataFrame, model: Judge, prompt: Column | None = None) -> DataFrame:
    """The 16 columns of an adjudicated claim, those of a rewrite empty. A failed row is UNSUPPORTED_FAIL with the flag llm_error."""
    failed = lambda reason: {"verdict": "UNSUPPORTED_FAIL", "rationale": reason, "evidence_span": "", "required_fix": "", "risk_flags": ["llm_error"]}
    got = answers(inputs, judge_prompt() if prompt is None else prompt, model, VERDICT_ANSWER, failed)
    base = [_text(c).alias(c) for c in BASE_COLUMNS if c in inputs.columns]
    rest = [F.coalesce(F.col("_answer")[c], F.lit("")).alias(c) for c in BASE_COLUMNS if c not in inputs.columns]
    return got.select(*base, *rest, *[F.lit("").alias(c) for c in REWRITE_COLUMNS])


def rewrite_targets(verdicts: DataFrame, only_review: str | None = None, limit: int | None = None) -> DataFrame:
    """The failed rows, of one review if named, and the first `limit` by review and claim if given."""
    rows = verdicts.filter("verdict = 'UNSUPPORTED_FAIL'")
    rows = rows.filter(F.col("review_id") == only_review) if only_review else rows
    return rows.orderBy("review_id", "claim_id").limit(limit) if limit else rows


def propose_rewrites(targets: DataFrame, enriched: DataFrame, inputs: DataFrame, model: Judge) -> DataFrame:
    """targets(review_id, claim_id, ...), enriched(review_id, claim_id, claim_text, research_question, section_title, section_canonical),
    inputs(claim_id, ..., built_at) -> the nine columns of a proposal. Of several rows of a key the last counts; what neither table has
    is empty."""
    e = enriched.select("review_id", "claim_id", "research_question", or_else(F.col("section_title"), F.col("section_canonical")).alias("section_title"), F.col("claim_text").alias("_claim")).dropDuplicates(["review_id", "claim_id"])
    i = last_of(inputs.select("claim_id", F.col("citation_author").alias("_author"), F.col("citation_year").alias("_year"), F.col("source_pdf_path").alias("_path"), "evidence", "built_at"), ["claim_id"], ["built_at"]).withColumn("_known", F.lit(True))
    t = targets.select("review_id", "claim_id", "claim_text", "citation_author", "citation_year", "source_pdf_path").join(e, ["review_id", "claim_id"], "left").join(i, "claim_id", "left")
    of = lambda a, b: F.when(F.col("_known"), F.col(a)).otherwise(F.col(b)).alias(b)
    t = t.select("review_id", "claim_id", "research_question", "section_title", or_else(F.col("_claim"), F.col("claim_text")).alias("claim_text"), of("_author", "citation_author"), of("_year", "citation_year"), of("_path", "source_pdf_path"), "evidence")
    failed = lambda reason: {"proposed_rewrite": "", "page_anchor": "", "notes": reason, "risk_flags": ["llm_error"]}
    got = answers(t, rewrite_prompt(), model, REWRITE_ANSWER, failed)
    said = lambda c: F.coalesce(F.col("_answer")[c], F.lit(""))
    return got.select(
        "review_id", "claim_id", F.trim(said("proposed_rewrite")).alias("proposed_rewrite"), F.trim(said("page_anchor")).alias("page_anchor"), _text("source_pdf_path").alias("source_pdf_path"),
        _text("section_title").alias("section_title"), _text("research_question").alias("research_question"), said("notes").alias("notes"), said("risk_flags").alias("risk_flags"),
    )


def with_rewrites(verdicts: DataFrame, proposals: DataFrame, order: list[str]) -> DataFrame:
    """The verdict rows with their proposals filled in, by review and claim; of rows with one key only the last by `order` is changed."""
    p = proposals.select("review_id", "claim_id", "proposed_rewrite", "page_anchor", F.col("notes").alias("rewrite_notes"), F.col("risk_flags").alias("rewrite_flags"))
    return update_by_key(verdicts, p, ["review_id", "claim_id"], REWRITE_COLUMNS, order)


def excerpt_judge(prompt: str) -> str:
    """A deterministic model without a network, for tests: by the number of excerpts, or the claim among them."""
    claim = prompt.removeprefix("CLAIM: \n").partition("\n\nCITATION CONTEXT:\n")[0]
    found = prompt.partition("\nSOURCE EXCERPTS:\n")[2].rpartition("\nTASK:\n")[0]
    n = len(re.findall(r"^\[pp\. ", found, re.M))
    verdict = VERDICTS[0] if claim and claim in found else VERDICTS[1] if n >= 3 else VERDICTS[2] if n else VERDICTS[3]
    return json.dumps({"verdict": verdict, "rationale": f"{n} excerpts", "evidence_span": f"{n}", "required_fix": "none" if n else "cite or remove", "risk_flags": [] if n else ["insufficient_evidence", "pdf_missing"]})


def citing_rewriter(prompt: str) -> str:
    """A deterministic rewriter, for tests: the claim and the pages of its first excerpt; without an excerpt it fails."""
    claim = prompt.partition("\nORIGINAL CLAIM (UNSUPPORTED):\n")[2].partition("\n\nCITED SOURCE:\n")[0]
    pages = re.search(r"^\[pp\. (.*?)\]", prompt.partition("\nRELEVANT EXCERPTS (with page ranges):\n")[2], re.M)
    if not pages:
        raise ValueError("no excerpt")
    return json.dumps({"proposed_rewrite": f" {claim} (pp. {pages[1]})", "page_anchor": f"pp. {pages[1]} ", "notes": "first excerpt", "risk_flags": ["weak_evidence"]})
