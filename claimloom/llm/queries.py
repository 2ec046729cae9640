"""Queries of the operators for training data, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import chunks, leakage, names, packing, residue, scans, sentences
from claimloom.operators import packed
from claimloom.session import table


def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    """Each spelling with the entity it names."""
    return names.link_names(table(spark, d, "ccp_registry"), "citation_author")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variant_pairs(p1_entities(spark, d))


def p1_cited(spark: SparkSession, d: str) -> DataFrame:
    """Spellings in citation_text too: the author part of each cited value, with its entity and the claims that cite it."""
    claims = table(spark, d, "ccp_registry").select("claim_id", "citation_author", "citation_text").distinct()
    values = packed.unpack_field(claims.select("claim_id", "citation_text").distinct(), "citation_text", ["claim_id"])
    in_text = values.select("claim_id", F.trim(F.regexp_extract("cite_value", r"^(.*?)[,(\s]*\(?\b(?:1[5-9]|20)\d\d", 1)).alias("name"))
    spelled = claims.select("claim_id", F.col("citation_author").alias("name")).unionByName(in_text).filter("trim(name) <> ''").distinct()
    linked = names.link_names(spelled.select("name"))
    return spelled.groupBy("name").agg(F.count("*").alias("claims")).join(linked, "name")


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Every piece of every evidence text longer than the limit; repeats of a row count once."""
    return chunks.split_texts(chunks.long_evidence(table(spark, d, "adjudication_inputs")), ["claim_id", "ev_pos"], "ev_text").distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = chunks.split_texts(chunks.long_evidence(table(spark, d, "adjudication_inputs")), ["claim_id", "ev_pos"], "ev_text")
    return pieces.filter("n_pieces > 1").select("claim_id", "ev_pos").distinct()


def _claims(spark: SparkSession, d: str) -> DataFrame:
    """Each claim and its text once, however often it was delivered."""
    return table(spark, d, "ccp_registry").select("claim_id", "claim_text").filter("trim(claim_text) <> ''").distinct()


def p2_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Each long text from its pieces: characters and a hash of what they hold without their overlaps, and the pieces that break a bound."""
    p = p2_pieces(spark, d).withColumn("own", F.expr("substr(piece, content_start - start_char + 1)"))
    bad = (F.length("piece") > chunks.LIMIT) | (F.col("content_start") - F.col("start_char") > chunks.OVERLAP)
    whole = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("piece_no", "own"))), lambda x: x["own"]), "")  # the pieces of one text
    return p.groupBy("claim_id", "ev_pos", "n_pieces").agg(whole.alias("t"), F.count(F.when(bad, 1)).alias("n_bad")).select("claim_id", "ev_pos", F.length("t").alias("chars"), F.md5("t").alias("text_md5"), "n_bad")


def p6_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences.split_sentences(_claims(spark, d), "claim_id", "claim_text")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_sentences(spark, d).select("claim_id", "sent_no", "start_char", "end_char").distinct()


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noisy_lines(table(spark, d, "sources_text"))


def p7_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The repaired paragraphs."""
    return scans.repaired_paragraphs(table(spark, d, "sources_text"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    """Each piece of each document with the container it went to."""
    return packing.pack(table(spark, d, "documents"), "doc_id", "text").drop("segments")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), "doc_id", "text").filter("n_pieces > 1").select("doc_id").distinct()


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers by tenth of the capacity used, with their tokens."""
    packed = packing.pack(table(spark, d, "documents"), "doc_id", "text")
    full = packed.groupBy("container").agg(F.sum("tokens").alias("tokens"))
    return full.groupBy(F.floor(F.col("tokens") * 10 / packing.CAPACITY).cast("int").alias("tenth")).agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every document once, with all its tokens, wherever they went."""
    p = packing.pack(table(spark, d, "documents"), "doc_id", "text")
    return p.groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), (F.count("*") == F.max("n_pieces")).alias("whole"))


def p8_limits(spark: SparkSession, d: str) -> DataFrame:
    """All tokens packed, and containers beyond one of the three limits."""
    c = packing.pack(table(spark, d, "documents"), "doc_id", "text").groupBy("container").agg(F.sum("tokens").alias("tokens"), F.sum("segments").alias("segments"), F.sum("loss").alias("loss"), F.max("loss").alias("one"))
    over = (F.col("tokens") > packing.CAPACITY) | (F.col("segments") > packing.SEGMENTS) | (F.col("loss") > F.greatest(F.lit(packing.LOSS), F.col("one")))
    return c.agg(F.sum("tokens").alias("tokens"), F.count(F.when(over, 1)).alias("over"))


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Each document and leaked item, with the longest verified run and its replaced words."""
    return leakage.find_leaks(table(spark, d, "documents"), table(spark, d, "heldout_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_leaks(spark, d).select("doc_id", "item_id").distinct()


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """How many documents hold each leaked item."""
    return p9_leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("run_words").alias("longest_run"))


def p10_residue(spark: SparkSession, d: str) -> DataFrame:
    """Documents to exclude, with the words of each kind of evidence in their residual."""
    return residue.find_residue(table(spark, d, "documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_residue(spark, d).select("doc_id").distinct()


QUERIES = {
    "p1_found": p1_found,
    "p1_entities": p1_entities,
    "p1_cited": p1_cited,
    "p2_found": p2_found,
    "p2_pieces": p2_pieces,
    "p2_round_trip": p2_round_trip,
    "p6_found": p6_found,
    "p6_sentences": p6_sentences,
    "p7_found": p7_found,
    "p7_paragraphs": p7_paragraphs,
    "p8_found": p8_found,
    "p8_packed": p8_packed,
    "p8_fill": p8_fill,
    "p8_documents": p8_documents,
    "p8_limits": p8_limits,
    "p9_found": p9_found,
    "p9_leaks": p9_leaks,
    "p9_items": p9_items,
    "p10_found": p10_found,
    "p10_residue": p10_residue,
}
SQL: dict[str, str] = {
    "p2_found": """SELECT DISTINCT claim_id, CAST(k - 1 AS INT) AS ev_pos FROM
      (SELECT claim_id, unnest(evidence) AS e, generate_subscripts(evidence, 1) AS k FROM adjudication_inputs) WHERE length(e.text) > 1200""",
    "p2_round_trip": """SELECT claim_id, CAST(k - 1 AS INT) AS ev_pos, CAST(length(e.text) AS INT) AS chars, md5(e.text) AS text_md5, CAST(0 AS BIGINT) AS n_bad FROM
      (SELECT DISTINCT claim_id, e, k FROM (SELECT claim_id, unnest(evidence) AS e, generate_subscripts(evidence, 1) AS k FROM adjudication_inputs)) WHERE length(e.text) > 1200""",
    "p8_documents": "SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS tokens, true AS whole FROM (SELECT DISTINCT doc_id, text FROM documents)",
    "p8_limits": "SELECT CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS over FROM (SELECT DISTINCT doc_id, text FROM documents)",
    "p8_found": "SELECT doc_id FROM documents WHERE strlen(coalesce(text, '')) + 1 > 4096",
}
