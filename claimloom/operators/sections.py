"""Which section of its review a claim belongs to: TF-IDF cosine with priors, else overlap with the title, else the first section."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.scalars import heading_penalty, level_boost, tokens
from claimloom.session import cut


def usable(sections: DataFrame) -> DataFrame:
    """Levels 2 to 4, and level 1 with a body."""
    return sections.filter((F.col("level").between(2, 4)) | ((F.col("level") == 1) & (F.coalesce("body", F.lit("")) != "")))


def match_sections(claims: DataFrame, sections: DataFrame, doc: str = "review_id") -> DataFrame:
    """claims(doc, claim_id, claim_text), sections(doc, sec_no, level, title, body) -> claim_id, sec_no, title, level, score.

    idf = ln((N + 1) / (df + 1)) + 1 over the review's sections, 1 for terms no section has. Cosine needs no term shares, counts do.
    Claims meet sections on the terms they share, first of the body, then, if there is none, of the title; claims of a review without
    sections have the section "unknown". No claim is paired with all sections of its review."""
    # both inputs are read several times: what they are made of is not done again
    claims = cut(claims.select(doc, "claim_id", "claim_text"))
    s = cut(sections.select(doc, "sec_no", "level", "title", "body", (heading_penalty(F.col("title")) * level_boost(F.col("level"))).alias("prior")))
    heads = s.drop("body")
    terms = s.select(doc, "sec_no", F.explode(tokens(F.col("body"))).alias("term")).groupBy(doc, "sec_no", "term").agg(F.count("*").alias("tf"))
    n = heads.groupBy(doc).agg(F.count("*").alias("n"), F.min(F.struct("sec_no", "title", "level")).alias("first"))
    by_term = terms.groupBy(doc, "term").agg(F.collect_list(F.struct("sec_no", "tf")).alias("places")).join(n.select(doc, "n"), doc)  # a review's sections with one term
    by_term = cut(by_term.select(doc, "term", (F.log((F.col("n") + 1) / (F.size("places") + 1)) + 1).alias("idf"), "places"))
    weights = by_term.select(doc, "term", "idf", F.explode("places").alias("p")).select(doc, "term", F.col("p.sec_no").alias("sec_no"), (F.col("p.tf") * F.col("idf")).alias("w"))
    norms = weights.groupBy(doc, "sec_no").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    asked = claims.select(doc, "claim_id", F.explode(tokens(F.col("claim_text"))).alias("term")).groupBy(doc, "claim_id", "term").agg(F.count("*").alias("tf"))
    asked = cut(asked.join(by_term, [doc, "term"], "left").select(doc, "claim_id", (F.col("tf") * F.coalesce("idf", F.lit(1.0))).alias("q"), "idf", "places"))
    q_norms = asked.groupBy(doc, "claim_id").agg(F.sqrt(F.sum(F.col("q") * F.col("q"))).alias("q_norm"))
    dots = asked.select(doc, "claim_id", "q", "idf", F.explode("places").alias("p")).groupBy(doc, "claim_id", F.col("p.sec_no").alias("sec_no")).agg(F.sum(F.col("q") * F.col("p.tf") * F.col("idf")).alias("dot"))
    scored = dots.join(norms.join(heads, [doc, "sec_no"]), [doc, "sec_no"]).join(q_norms, [doc, "claim_id"])
    cosine = F.round(F.coalesce(F.col("dot") / (F.col("norm") * F.col("q_norm")), F.lit(0.0)) * F.col("prior"), 9)
    by_text = scored.select(doc, "claim_id", "sec_no", "title", "level", cosine.alias("score")).filter("score > 0").groupBy(doc, "claim_id")
    by_text = cut(by_text.agg(F.max_by(F.struct("sec_no", "title", "level", "score"), F.struct("score", -F.col("sec_no"))).alias("p")))  # one row a claim, read twice
    rest = claims.select(doc, "claim_id", "claim_text").join(by_text.select(doc, "claim_id"), [doc, "claim_id"], "left_anti")
    words = rest.select(doc, "claim_id", F.explode(F.array_distinct(tokens(F.col("claim_text")))).alias("term"))
    title_words = heads.select(doc, "sec_no", "title", "level", "prior", F.explode(F.array_distinct(tokens(F.col("title")))).alias("term"))
    by_title = words.join(title_words, [doc, "term"]).groupBy(doc, "claim_id", "sec_no", "title", "level").agg((F.count("*") * F.first("prior")).alias("overlap"))
    by_title = by_title.groupBy(doc, "claim_id").agg(F.max_by(F.struct("sec_no", "title", "level"), F.struct("overlap", -F.col("sec_no"))).alias("p"))
    found = rest.drop("claim_text").join(by_title, [doc, "claim_id"], "left").join(n.select(doc, "first"), doc, "left").select("claim_id", F.coalesce("p", "first").alias("p"))
    found = found.select("claim_id", "p.sec_no", F.coalesce("p.title", F.lit("unknown")).alias("title"), "p.level", F.lit(0.0).alias("score"))
    return by_text.select("claim_id", "p.sec_no", "p.title", "p.level", F.round("p.score", 6).alias("score")).unionByName(found)
