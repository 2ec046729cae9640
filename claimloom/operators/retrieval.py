"""Evidence for claims from windows of their source: exact quotation, stated page, then fuzzy top-k, in tiers capped at k.

The tiers are independent of one another: slice(concat(t1, t2 without t1, t3), 1, k) is the tiered result. For the fuzzy tier each
window's ratio is bounded from both sides by built-in expressions, which mostly meet; only windows whose bounds leave a gap and whose
upper one reaches the k-th best lower bound of the claim go through the Python scorer, which loses no window of the top k. Pairs are
moved as ids and bounds; texts join those that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.config import DEFAULTS
from claimloom.functions.lcs import LENGTH_BITS, bounds_of_common, code_chars, token_codes, token_set_ratio_udf
from claimloom.functions.scalars import leading_page, page_label
from claimloom.operators.textops import quote_pages
from claimloom.session import cut

EVIDENCE = ["claim_id", "page_no", "win_no", "text", "score", "tier"]


def fuzzy_top_k(claims: DataFrame, windows: DataFrame, source_key: str, k: int = DEFAULTS.top_k) -> DataFrame:
    """claim_id, source_key, page_no, win_no, _text (a hash), score, rank: the k best windows of each claim's source by the ratio itself, of
    which score is the whole part; ties by page and window."""
    place = [source_key, "page_no", "win_no", "_text"]
    windows = windows.withColumn("_text", F.xxhash64("text"))  # two deliveries of a source may differ on the same page

    def coded(df: DataFrame, keys: list[str], text: str, to: str) -> DataFrame:
        t = df.select(*keys, token_codes(F.col(text)).alias(to))
        return t.withColumns({f"{to}_n": F.size(to), f"{to}_c": code_chars(F.col(to)), f"{to}_long": F.exists(to, lambda v: v.bitwiseAND(F.lit(LENGTH_BITS)) == LENGTH_BITS)})

    pairs = coded(claims, ["claim_id", source_key], "claim_text", "q").join(coded(windows, place, "text", "w"), source_key)
    pairs = pairs.select("claim_id", *place, "q_n", "q_c", "w_n", "w_c", (F.col("q_long") | F.col("w_long")).alias("long"), F.array_intersect("q", "w").alias("both"))
    low, high = bounds_of_common(*[F.col(c) for c in ("both", "q_n", "w_n", "q_c", "w_c")])
    # a token too long for its code leaves the ratio open
    pairs = pairs.select("claim_id", *place, F.when(F.col("long"), 0.0).otherwise(low).alias("low"), F.when(F.col("long"), 100.0).otherwise(high).alias("high"))
    per_claim = Window.partitionBy("claim_id")
    pairs = pairs.withColumn("nth", F.row_number().over(per_claim.orderBy(F.desc("low"))))
    floor = F.max(F.when(F.col("nth") == k, F.col("low"))).over(per_claim)  # the k-th best lower bound; null where there are fewer windows
    kept = cut(pairs.withColumn("floor", floor).filter("floor IS NULL OR high >= floor").drop("nth", "floor"))
    known = kept.filter("high <= low").select("claim_id", *place, F.col("low").alias("ratio"))
    # the short texts of claims ride to their windows, and are scored there
    open_ = kept.filter("high > low").join(claims.select("claim_id", F.col("claim_text").alias("q")), "claim_id").join(windows.select(*place, "text"), place)
    scored = known.unionByName(open_.select("claim_id", *place, token_set_ratio_udf("q", "text").alias("ratio")))
    top = scored.withColumn("rank", F.row_number().over(per_claim.orderBy(F.desc("ratio"), "page_no", "win_no"))).filter(F.col("rank") <= k)
    return top.select("claim_id", *place, F.floor("ratio").cast("int").alias("score"), "rank")


def exact_tier(claims: DataFrame, page_rows: DataFrame, windows: DataFrame, source_key: str) -> DataFrame:
    """Windows of pages that hold a quotation of a claim marked as a quote: score 100."""
    hits = quote_pages(claims.filter("is_quote"), page_rows, "claim_id", source_key, "claim_text").select("claim_id", source_key, "page_no").distinct()
    return hits.join(windows, [source_key, "page_no"]).select("claim_id", "page_no", "win_no", "text", F.lit(100).alias("score"), F.lit(1).alias("tier"))


def stated_tier(claims: DataFrame, offsets: DataFrame, windows: DataFrame, source_key: str) -> DataFrame:
    """Windows of the page a claim states, put right by the source's page offset: score 100."""
    c = claims.select("claim_id", source_key, leading_page(F.col("stated_page")).alias("said")).filter("said IS NOT NULL").join(offsets, source_key)
    c = c.select("claim_id", source_key, (F.col("said") - F.col("logical_minus_pdf_offset")).alias("page_no"))
    return c.join(windows, [source_key, "page_no"]).select("claim_id", "page_no", "win_no", "text", F.lit(100).alias("score"), F.lit(2).alias("tier"))


def evidence(claims: DataFrame, page_rows: DataFrame, windows: DataFrame, offsets: DataFrame, source_key: str, k: int = DEFAULTS.top_k, compat: bool = False) -> DataFrame:
    """claim_id, evidence: at most k items in tier order. compat: the fuzzy tier may repeat windows of the other tiers."""
    t1 = exact_tier(claims, page_rows, windows, source_key)
    t2 = stated_tier(claims, offsets, windows, source_key).join(t1.select("claim_id", "page_no", "win_no"), ["claim_id", "page_no", "win_no"], "left_anti")
    near = fuzzy_top_k(claims, windows, source_key, k).join(windows.select(source_key, "page_no", "win_no", "text").withColumn("_text", F.xxhash64("text")), [source_key, "page_no", "win_no", "_text"])
    t3 = near.select("claim_id", "page_no", "win_no", "text", "score", F.lit(3).alias("tier"), F.col("rank").alias("near"))
    if not compat:
        t3 = t3.join(t1.select("claim_id", "page_no", "win_no").union(t2.select("claim_id", "page_no", "win_no")), ["claim_id", "page_no", "win_no"], "left_anti")
    rows = t1.unionByName(t2).withColumn("near", F.lit(0)).unionByName(t3)
    order = Window.partitionBy("claim_id").orderBy("tier", "near", "page_no", "win_no")
    top = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    item = F.struct("rank", page_label(F.col("page_no"), F.col("page_no")).alias("page_range"), "text", "score")
    got = top.groupBy("claim_id").agg(F.array_sort(F.collect_list(item)).alias("items"))  # at most k a claim
    return got.select("claim_id", F.transform("items", lambda x: F.struct(x["page_range"].alias("page_range"), x["text"].alias("text"), x["score"].alias("score"))).alias("evidence"))
