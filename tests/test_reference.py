"""The claim pipeline's operators on hand-made cases, with the quirks in both modes, and properties."""

import io
import json
import random
import re
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.config import read_settings
from claimloom.functions import scalars as X
from claimloom.functions.lcs import lcs_length, token_set_bounds, token_set_ratio, token_sets
from claimloom.operators import adjudicate, citations, jsonrepair, reports, resolve, retrieval, sections, textops
from claimloom.operators.graph import connected_components
from claimloom.sources import files


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col(F.col("x")).alias("y")).first().y


def test_lines_and_sections(spark):
    df = spark.createDataFrame([(1, "# Methods\na\r\nFINDINGS\nb\n\nScope:\nc\n"), (2, ""), (3, None), (4, "x y")], "doc_id int, t string")
    assert [(r.doc_id, r.line_no, r.line) for r in textops.lines(df, "doc_id", "t").filter("doc_id > 1").collect()] == [(4, 0, "x"), (4, 1, "y")]
    got = [(r.section, r.line) for r in textops.sections(df, "doc_id", "t").filter("doc_id = 1").orderBy("line_no").collect()]
    assert got == [("methods", "# Methods"), ("methods", "a"), ("findings", "FINDINGS"), ("findings", "b"), ("scope", "Scope:"), ("scope", "c")]


def test_sentence_modes(spark):
    t = "Smith et al. (2020) argue X. Then Y."
    assert one(spark, lambda c: textops.sentence_array(c, True), t) == ["Smith et al.", "(2020) argue X.", "Then Y."]
    assert one(spark, textops.sentence_array, t) == ["Smith et al. (2020) argue X.", "Then Y."]
    assert one(spark, textops.sentence_array, "A. B.") == ["A.", "B."] and one(spark, textops.sentence_array, None) == []


def test_flags(spark):
    assert one(spark, X.is_quote, "It doesn't (Smith, 2020).") is True and one(spark, X.is_quote, "no ’ mark") is False
    assert one(spark, X.is_causal_or_normative, "This LEADS to that") is True and one(spark, X.is_causal_or_normative, "mustard") is False


def test_citations(spark):
    got = one(spark, citations.parenthetical, "(see Smith, 2020; Jones & Lee, 2019a, p. 4)")
    assert [(c.citation_author, c.citation_year, c.stated_page) for c in got] == [("Smith", "2020", "4"), ("Jones & Lee", "2019a", "4")]
    got = one(spark, citations.parenthetical, "(Old, 1990, as cited in New, 2001)")
    assert [(c.citation_author, c.citation_year, c.citation_type, c.is_secondary) for c in got] == [("New", "2001", "secondary_parenthetical", True)]
    got = one(spark, citations.narrative, "Smith (2020) and Lee et al. (2019) say so (p. 7), as cited in Host, 2022.")
    assert [(c.citation_author, c.primary_mentioned_author, c.citation_type) for c in got] == [("Host", "Smith", "secondary_narrative"), ("Host", "Lee et al.", "secondary_narrative")]
    got = one(spark, citations.narrative, "On p. 3, Smith (2020) shows it.")
    assert [(c.citation_text, c.stated_page, c.span_start) for c in got] == [("Smith (2020)", "3", 9)]
    assert one(spark, citations.citation_array, None) == []


def test_references(spark):
    df = spark.createDataFrame([("r", "Intro (2000)\nReferences \nSmith, J. (2001). T.\nnot one\nLee-Roy, K. (2002a). U.", 1)], "review_id string, t string, line_no int")
    got = textops.reference_entries(textops.reference_lines(df, "review_id", "t"), "review_id", "line").orderBy("year").collect()
    assert [(r.first_author, r.year) for r in got] == [("Smith", "2001"), ("Lee-Roy", "2002a")]


def test_pages(spark):
    df = spark.createDataFrame([("a", "intro\n<<<PAGE=1>>>\na\n<<<PAGE=2>>>\nb"), ("b", "none"), ("c", "<<<PAGE=1>>>\nx\n<<<PAGE=1>>>\ny\n<<<PAGE=2>>>"), ("d", None)], "stem string, t string")
    got = sorted((r.stem, r.page_no, r.text) for r in textops.pages(df, "stem", "t").collect())
    assert got == [("a", 1, "intro\na"), ("a", 2, "b"), ("c", 1, "y"), ("c", 2, "")]


@pytest.mark.parametrize(("n", "want"), [(0, 1), (5, 1), (180, 1), (200, 1), (269, 1), (270, 2), (400, 3)])
def test_window_counts(spark, n, want):
    df = spark.createDataFrame([("s", 1, " ".join(f"w{k}" for k in range(n)))], "stem string, page_no int, text string")
    got = textops.windows(df, "stem").collect()
    assert len(got) == want == max(0, n - 180) // 90 + 1
    tail = textops.windows(df, "stem", keep_tail=True).collect()
    assert {w for r in tail for w in r.text.split()} == {f"w{k}" for k in range(n)}


def test_scalars(spark):
    assert one(spark, X.first_year, "adeyemi_2022") == "2022" and one(spark, lambda c: X.first_year(c, True), "adeyemi_2022") is None
    assert one(spark, X.first_author_key, "Brandt") == "brandt" and one(spark, lambda c: X.first_author_key(c, True), "Brandt") == "br"
    assert one(spark, X.author_key, "O’Neil-Roy et al. & Fish") == "oneil_roy" and one(spark, X.surname_key, "Müller’s, K. & Lee") == "muller"
    assert set(one(spark, X.author_variants, "van Dam")) == {"van_dam", "dam", "vandam"}
    assert one(spark, X.norm_stem, "Johnston-Goodstar & Co_2012") == "johnston_goodstar_and_co_2012"
    assert one(spark, X.tokens, "The  Big, big DATA a x") == ["big", "big", "data"]
    assert one(spark, textops.citation_parts, "(A, 2000; B, 2001;)") == ["A, 2000", "B, 2001"]
    assert one(spark, X.leading_page, "14-15") == 14 and one(spark, X.leading_page, "x") is None and one(spark, X.leading_page, None) is None
    assert one(spark, X.candidate_names, "(Smith et al., 2020)")[0].lower().startswith("smith")


@settings(max_examples=150, deadline=None)
@given(st.text("ab cd", max_size=14), st.text("ab cd", max_size=14))
def test_token_set_ratio(a, b):
    n, m = len(a), len(b)
    t = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    assert lcs_length(a, b) == t[n][m]
    r = token_set_ratio(a, b)
    assert 0 <= r <= 100 and abs(r - token_set_ratio(b, a)) < 1e-9


def test_token_set_cases(spark):
    assert [token_set_ratio(*p) for p in [("a b", "b a"), ("", "a"), ("a", "a b"), ("ab", "ac")]] == [100, 0, 100, 50]
    pairs = [("a b c", "a d"), ("x", "y"), ("one two", "two one"), ("", "q"), ("long words here", "words there longer")]
    df = spark.createDataFrame(pairs, "a string, b string")
    low, high = token_set_bounds(token_sets(F.col("a")), token_sets(F.col("b")))
    for r in df.select("a", "b", low.alias("low"), high.alias("high")).collect():
        assert r.low - 1e-9 <= token_set_ratio(r.a, r.b) <= r.high + 1e-9


def test_evidence_tiers(spark):
    pages = spark.createDataFrame([("s", 1, 0, "alpha beta gamma"), ("s", 2, 1, "the quick brown fox"), ("s", 3, 2, "other words")], "stem string, page_no int, page_ord int, text string")
    claims = spark.createDataFrame([("c", "s", "says “quick brown” alpha", "3", True), ("d", "s", "alpha beta", None, False)], "claim_id string, stem string, claim_text string, stated_page string, is_quote boolean")
    off = spark.createDataFrame([("s", 0)], "stem string, logical_minus_pdf_offset int")
    w = textops.windows(pages, "stem")
    got = {r.claim_id: [(e.page_range, e.score) for e in r.evidence] for r in retrieval.evidence(claims, pages, w, off, "stem").collect()}
    assert got["c"][:2] == [("2", 100), ("3", 100)] and got["c"][2][0] == "1" and got["d"][0] == ("1", 100)
    literal = {r.claim_id: len(r.evidence) for r in retrieval.evidence(claims, pages, w, off, "stem", compat=True).collect()}
    assert literal == {"c": 5, "d": 3}


def test_top_k_by_the_ratio_itself(spark):
    pages = spark.createDataFrame([("s", 1, 0, "a" * 111), ("s", 2, 1, "a" * 112), ("s", 3, 2, "other words")], "stem string, page_no int, page_ord int, text string")
    claims = spark.createDataFrame([("c", "s", "a" * 200, "3", False)], "claim_id string, stem string, claim_text string, stated_page string, is_quote boolean")
    assert [int(token_set_ratio("a" * 200, "a" * n)) for n in (111, 112)] == [71, 71]
    w = textops.windows(pages, "stem")
    assert [(r.page_no, r.score) for r in retrieval.fuzzy_top_k(claims, w, "stem", 1).collect()] == [(2, 71)]
    off = spark.createDataFrame([("s", 0)], "stem string, logical_minus_pdf_offset int")
    assert [(e.page_range, e.score) for e in retrieval.evidence(claims, pages, w, off, "stem", 2).first().evidence] == [("3", 100), ("2", 71)]


def test_offsets(spark):
    pages = spark.createDataFrame([("s", k, k - 1, f"text number {k} alpha{k}") for k in range(1, 5)], "stem string, page_no int, page_ord int, text string")
    claims = spark.createDataFrame([("a", "s", "“alpha3”", "0"), ("b", "s", "“alpha4”", "2-3"), ("c", "s", "“zzz”", "9"), ("d", "s", "no", "1")], "claim_id string, stem string, claim_text string, stated_page string")
    r = textops.page_offsets(claims, pages, "stem", "claim_text", "stated_page").first()
    assert (r.logical_minus_pdf_offset, r.n_examples) == (-3, 2)


def test_sections(spark):
    secs = spark.createDataFrame([("r", 0, 2, "Methods", "surveys interviews sampling"), ("r", 1, 2, "Water", "pumps wells pipes"), ("r", 2, 2, "Roads", "gravel")], "review_id string, sec_no int, level int, title string, body string")
    claims = spark.createDataFrame([("r", "a", "Pumps and wells fail"), ("r", "b", "roads"), ("r", "c", "nothing known")], "review_id string, claim_id string, claim_text string")
    got = {r.claim_id: (r.title, r.score > 0) for r in sections.match_sections(claims, secs).collect()}
    assert got == {"a": ("Water", True), "b": ("Roads", False), "c": ("Methods", False)}


def test_resolution(spark):
    inv = resolve.inventory(spark.createDataFrame([(f"p/{n}.pdf",) for n in ["Mbele_2018", "Mbele_2019", "Lee_2000", "Lee_2000_v2", "Müller_2001"]], "path string"))
    c = spark.createDataFrame([("a", "Mbele", "2019", "(Mbele, 2019)", None, ""), ("b", "Lee et al.", "2000b", "(Lee et al., 2000b)", None, "p/Lee_1999.pdf"), ("c", "Nobody", "1990", "(Nobody, 1990)", None, ""), ("d", None, None, None, None, None), ("e", "Muller", "2001", "(Muller, 2001)", None, "")], "claim_id string, citation_author string, citation_year string, citation_text string, primary_mentioned_author string, source_pdf_path string").withColumn("primary_mentioned_year", F.lit(None).cast("string"))
    w = {r.claim_id: r.path for r in resolve.weighted(c, inv).collect()}
    assert w["a"] == "p/Mbele_2019.pdf" and "c" not in w
    s = {r.claim_id: (r.path, r.mapping_note) for r in resolve.strict(c, inv).collect()}
    assert s["b"] == ("pilot_inputs/sources_pdf/Lee_2000.pdf", "corrected_from:Lee_1999.pdf") and s["c"] == ("", "no_exact_author_year_pdf") and s["d"] == ("", "") and s["e"][0].endswith("Müller_2001.pdf")
    o = {r.claim_id: r.path for r in resolve.overlapping(c, inv).collect()}
    assert o["a"] == "p/Mbele_2019.pdf"
    assert resolve.strict(c, inv, {("mbele", "2019"): "Mbele_2018.pdf"}).filter("mapping_note = 'override'").count() == 1


def test_weighted_without_a_common_word(spark):
    inv = resolve.inventory(spark.createDataFrame([(f"p/{n}.pdf",) for n in ["Twendembele_2018", "Abc_2018", "Zed_2018", "Vandam_Lee", "Oneword_1999"]], "path string"))
    rows = [("inside", "Mbele", "2018"), ("year", "Nobody", "2018"), ("undated", "Neword", None), ("word", "Lee", "2001"), ("over", "Dam Le", "2001"), ("none", "Nobody", "2002"), ("other", "Lee", "1999")]
    c = spark.createDataFrame([(k, a, y, f"({a}, {y})" if y else a) for k, a, y in rows], "claim_id string, citation_author string, citation_year string, citation_text string")
    c = c.withColumns({"primary_mentioned_author": F.lit(None).cast("string"), "primary_mentioned_year": F.lit(None).cast("string")})
    got = {r.claim_id: (r.path, r.score) for r in resolve.weighted(c, inv).collect()}
    assert got == {
        "inside": ("p/Twendembele_2018.pdf", 12), "year": ("p/Abc_2018.pdf", 10), "undated": ("p/Oneword_1999.pdf", 2), "word": ("p/Vandam_Lee.pdf", 4),
        "over": ("p/Vandam_Lee.pdf", 3), "other": ("p/Oneword_1999.pdf", 10),
    }


def test_overlap_against_all_pairs(spark):
    rnd, some = random.Random(5), "ash bay cod dew elm fen gum hay ivy jet 2001 2002".split()
    names = ["_".join(rnd.sample(some, rnd.randint(1, 9))) for _ in range(150)] + ["ash_" * 3 + "2001", "_".join(some)]
    inv = resolve.inventory(spark.createDataFrame([(f"{'pq'[k % 2]}/{n}.PDF",) for k, n in enumerate(names)] + [("p/.pdf",)], "path string"))
    said = [" ".join(rnd.sample([*some, "nowhere", "Oak-ash"], rnd.randint(1, 11))) for _ in range(300)] + ["Nobody, 1999", "", " ".join([*some, "x"]), "Ash bay, 2001", names[3]]
    rows = [(f"c{k}", x) for k, x in enumerate(said)] + [("none", None), (None, names[0])]
    got = resolve.overlapping(spark.createDataFrame(rows, "claim_id string, citation_text string"), inv)
    files = [(r.path, r.path.split("/")[1][:-4].lower()) for r in inv.collect()]
    words, want = lambda x: {*x.lower().split("_")} - {""}, []
    for i, text in rows:
        lead, year = (text or "").split(",")[0].strip().replace("-", "_").replace(" ", "_").lower(), re.search(r"(?:19|20)\d\d", text or "")
        cands = [f"{lead}_{year[0]}", lead] if year else [lead]
        exact = next((min(p for p, s in files if s.strip("_") == x) for x in cands if any(s.strip("_") == x for _, s in files)), None)
        best = min(((-len(words(x) & words(s)), k, p) for k, x in enumerate(cands) for p, s in files if words(x) & words(s)), default=None)
        want += [(i, exact, None)] * (exact is not None) + ([(i, best[2], -best[0])] if best and (exact is None or i is None) else [])
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "int"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_overlap_with_a_file_without_a_path(spark):
    inv = resolve.inventory(spark.createDataFrame([(None,), ("p/.pdf",), ("p/Lee_2001.pdf",)], "path string"))
    c = spark.createDataFrame([("a", None), ("b", "(2001)")], "claim_id string, citation_text string")
    assert {tuple(r) for r in resolve.overlapping(c, inv).collect()} == {("a", "p/.pdf", None), ("b", "p/Lee_2001.pdf", 1)}


def test_overlap_of_a_frequent_word_is_not_met_file_by_file(spark):
    inv = resolve.inventory(spark.range(1500).select(F.format_string("p/Name%s_2019.pdf", "id").alias("path")))
    c = spark.range(1500).select(F.col("id").cast("string").alias("claim_id"), F.format_string("(Other%s, 2019)", "id").alias("citation_text"))
    jvm, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()

    def written() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, jvm.new_array(jvm.jvm.double, 0), jvm.jvm.java.util.ArrayList())
        return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))

    before, limit = written(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as in larger tables
    try:
        rows = resolve.overlapping(c, inv).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {(r.path, r.shared) for r in rows} == {("p/Name0_2019.pdf", 1)} and len(rows) == 1500
    assert written() - before < 60_000


def test_reports(spark):
    v = spark.createDataFrame([("r", "s", "A", "1"), ("r", None, "A", "2"), (None, "s", "B", "3")], "review_id string, section string, verdict string, claim_id string")
    got = sorted((r.level, r.verdict, r["count"]) for r in reports.multi_level_counts(v, [("overall", []), ("review", ["review_id"]), ("section", ["review_id", "section"])], "verdict").collect())
    assert got == [("overall", "A", 2), ("overall", "B", 1), ("review", "A", 2), ("section", "A", 1)]
    low = spark.createDataFrame([("r", f"c{k}", "Low" if k < 100 else "High") for k in range(103)] + [("q", "x", "Low")], "g string, id string, priority string")
    plan = reports.sampling_plan(low, low.groupBy("g").agg(F.lit(0.1).alias("bad_rate")), ["g"], "id", "priority")
    assert plan.filter("g = 'r' AND priority = 'Low'").count() == 30 and plan.filter("priority = 'High'").count() == 3 and plan.filter("g = 'q'").count() == 1


def test_update_only_last(spark):
    base = spark.createDataFrame([("k", 1, ""), ("k", 2, ""), ("m", 1, "")], "id string, at int, x string")
    got = sorted(tuple(r) for r in reports.update_by_key(base, spark.createDataFrame([("k", "new")], "id string, x string"), ["id"], ["x"], ["at"]).collect())
    assert got == [("k", 1, ""), ("k", 2, "new"), ("m", 1, "")]
    assert [tuple(r) for r in reports.last_of(base, ["id"], ["at"]).orderBy("id").collect()] == [("k", 2, ""), ("m", 1, "")]


INPUTS = f"review_id string, section string, claim_id string, claim_text string, citation_text string, citation_type string, is_secondary boolean, primary_mentioned_author string, primary_mentioned_year string, stated_page string, citation_author string, citation_year string, source_pdf_path string, evidence {schemas.EVIDENCE}, built_at int"


def _inputs(spark):
    e = [("4", "pumps failed here", 80), ("5-6", "x", 3)]
    rows = [("r", "s", "a", "pumps failed", "(A, 2000)", "parenthetical", True, "Old", "1990", "4", "A", "2000", "p/A_2000.pdf", e, 1), ("r", None, "b", "boom", None, None, None, None, None, None, None, None, None, None, 1), ("q", "t", "c", "none such", None, None, False, "", "", "", "C", "2001", None, e[1:], 1)]
    return spark.createDataFrame(rows, INPUTS)


def test_prompts(spark):
    got = {r.claim_id: r.p for r in _inputs(spark).select("claim_id", adjudicate.judge_prompt("Do it.").alias("p")).collect()}
    assert got["a"] == (
        "CLAIM: \npumps failed\n\nCITATION CONTEXT:\n- Citation text: (A, 2000)\n- Type: parenthetical (secondary)\n- Primary source mentioned: Old (1990)\n- Stated page (may be wrong): 4\n\n"
        "CITED SOURCE:\n- A (2000)\n- p/A_2000.pdf\n\nSOURCE EXCERPTS:\n\n[pp. 4] pumps failed here\n\n[pp. 5-6] x\n\nTASK:\nDo it."
    )
    assert got["b"].startswith("CLAIM: \nboom\n\nCITATION CONTEXT:\n- Citation text: \n- Type: \n\n\n\nCITED SOURCE:\n-  ()\n- \n\nSOURCE EXCERPTS:\n\nTASK:")


def test_verdict_rows(spark):
    def model(p):
        if "boom" in p:
            raise RuntimeError("no line")
        return adjudicate.excerpt_judge(p)

    rows = adjudicate.verdict_rows(_inputs(spark), model)
    assert rows.columns == adjudicate.BASE_COLUMNS + adjudicate.REWRITE_COLUMNS
    got = {r.claim_id: r for r in rows.collect()}
    assert got["a"].verdict == "EXACT_QUOTE_PASS" and got["c"].verdict == "AMBIGUOUS_REVIEW" and got["c"].source_pdf_path == ""
    assert (got["b"].verdict, got["b"].rationale, got["b"].risk_flags, got["b"].section) == ("UNSUPPORTED_FAIL", "LLM error: no line", "llm_error", "")
    bad = adjudicate.verdict_rows(_inputs(spark), lambda p: '{"verdict": "MAYBE"}').select("rationale").distinct().collect()
    assert len(bad) == 1 and bad[0].rationale.startswith("LLM error: missing")


@pytest.mark.parametrize(("change", "reason"), [({}, None), ({"verdict": "MAYBE"}, "unknown verdict"), ({"rationale": ""}, "no text in rationale"), ({"risk_flags": "x"}, "risk_flags is no list of texts"), ({"more": "x"}, "unknown more"), ({"required_fix": 1}, "no text in required_fix"), ({"required_fix": ""}, None)])
def test_answers_against_the_schema(change, reason):
    good = {"verdict": "AMBIGUOUS_REVIEW", "rationale": "r", "evidence_span": "4", "required_fix": "none", "risk_flags": ["a"]}
    assert adjudicate.broken(good | change, adjudicate.VERDICT_ANSWER) == reason
    assert adjudicate.broken([], adjudicate.VERDICT_ANSWER) == "no object" and adjudicate.broken({"proposed_rewrite": "x", "page_anchor": "p. 1", "more": "y"}, adjudicate.REWRITE_ANSWER) is None


def test_rewrites(spark):
    inputs = _inputs(spark)
    v = adjudicate.verdict_rows(inputs, lambda p: json.dumps({"verdict": "UNSUPPORTED_FAIL", "rationale": "r", "evidence_span": "s", "required_fix": "", "risk_flags": []}))
    assert [r.claim_id for r in adjudicate.rewrite_targets(v, "r").orderBy("claim_id").collect()] == ["a", "b"] and [r.claim_id for r in adjudicate.rewrite_targets(v, limit=1).collect()] == ["c"]
    e = spark.createDataFrame([("r", "a", "", "RQ", "", "canon"), ("r", "b", "own claim", "RQ", "Title", "canon")], "review_id string, claim_id string, claim_text string, research_question string, section_title string, section_canonical string")
    p = adjudicate.propose_rewrites(v, e, inputs, adjudicate.citing_rewriter)
    got = {r.claim_id: r for r in p.collect()}
    assert (got["a"].proposed_rewrite, got["a"].page_anchor, got["a"].section_title, got["a"].risk_flags) == ("pumps failed (pp. 4)", "pp. 4", "canon", "weak_evidence")
    assert (got["b"].proposed_rewrite, got["b"].notes, got["b"].section_title) == ("", "LLM error: no excerpt", "Title") and got["c"].research_question == ""
    done = {r.claim_id: (r.proposed_rewrite, r.rewrite_flags) for r in adjudicate.with_rewrites(v.withColumn("at", F.lit(1)), p, ["at"]).collect()}
    assert done == {"a": ("pumps failed (pp. 4)", "weak_evidence"), "b": ("", "llm_error"), "c": ("none such (pp. 5-6)", "weak_evidence")}


def test_settings():
    got = read_settings("paths:\n  pdf_dir: x/pdf  # here\nretrieval:\n  chunk_words: 90\n  top_k: 3\nother:\n  model: m\n")
    assert (got.sources_dir, got.chunk_words, got.top_k, got.chunk_stride) == ("x/pdf", 90, 3, 90)
    with pytest.raises(ValueError):
        read_settings("retrieval:\n  top_k: many\n")


def test_small_scalars(spark):
    assert one(spark, X.joined, '["a", "b"]') == "a;b" and one(spark, X.joined, '"a"') == "a" and one(spark, X.joined, None) == "" and one(spark, X.joined, "3") == "3"
    df = spark.sql("SELECT map('a', 'x', 'b', CAST(NULL AS STRING)) AS m")
    assert [df.select(X.default_if_missing(F.col("m"), k, "d").alias("y")).first().y for k in "abc"] == ["x", None, "d"]
    assert one(spark, X.plain_letters, "Ǻç ﬁn Ｓｍíth ẞ e\u0301") == "Ac fin Smith ẞ e"


def test_resolution_by_the_authors_own_year(spark):
    inv = resolve.inventory(spark.createDataFrame([("p/Alpha_2022.pdf",), ("p/Beta_2018.pdf",)], "path string"))
    rows = [("beta", "Beta", "2018", "(Alpha, 2022; Beta, 2018)", ""), ("late", "Beta", "2018", "(Gamma, 2022)", " "), ("kept", "Beta", "2018", "(Beta, 2018)", "a\\b.pdf")]
    c = spark.createDataFrame(rows, "claim_id string, citation_author string, citation_year string, citation_text string, source_pdf_path string")
    c = c.withColumns({"primary_mentioned_author": F.lit(None).cast("string"), "primary_mentioned_year": F.lit(None).cast("string")})
    paths = lambda compat: {r.claim_id: r.source_pdf_path for r in resolve.fill_paths(c, inv, compat).collect()}
    assert paths(False) == {"beta": "p/Beta_2018.pdf", "late": "p/Beta_2018.pdf", "kept": "a/b.pdf"} and paths(True)["late"] == "p/Alpha_2022.pdf"


def test_sections_of_reviews_without_any(spark):
    secs = spark.createDataFrame([("r", 0, 1, "Top", ""), ("r", 1, 2, "Water", "pumps")], "review_id string, sec_no int, level int, title string, body string")
    claims = spark.createDataFrame([("r", "a", "Pumps"), ("x", "b", "Pumps"), ("r", "c", None)], "review_id string, claim_id string, claim_text string")
    got = {r.claim_id: (r.title, r.sec_no) for r in sections.match_sections(claims, sections.usable(secs)).collect()}
    assert got == {"a": ("Water", 1), "b": ("unknown", None), "c": ("Water", 1)}
    assert sections.match_sections(claims.limit(0), secs).count() == 0 and sections.match_sections(claims, secs.limit(0)).filter("title = 'unknown'").count() == 3


def test_keyed_lines_and_backup(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"k": "a", "v": 1}\n{"k": "b", "v": 2}\n\n{"k": "a", "v": 3}\n{"v": 9}\n')
    assert {(r.k, r.v) for r in files.read_jsonl_keyed(spark, str(tmp_path / "in.jsonl"), "k string, v int", "k").collect()} == {("a", 3), ("b", 2)}
    at = str(tmp_path / "t")
    spark.range(3).write.parquet(at)
    old = files.rewrite_with_backup(spark.read.parquet(at).filter("id > 0"), at, "1")
    assert spark.read.parquet(at).count() == 2 and spark.read.parquet(old).count() == 3
    files.write_csv(spark.createDataFrame([(1, " x ", 2.5)], "a int, b string, c double"), str(tmp_path / "c"))
    got = files.read_csv_inferred(spark, str(tmp_path / "c"))
    assert dict(got.dtypes) == {"a": "int", "b": "string", "c": "double"} and got.first().b == " x "
    p = spark.createDataFrame([("r", 0, None, "H", 2, "x"), ("r", 1, None, " First  one ", 1, "x"), ("r", 2, None, "Second", 1, "x")], "review_id string, para_no int, style string, text string, level int, more string")
    assert [tuple(r) for r in files.research_questions(p).collect()] == [("r", "First one")]


def test_json_recovery():
    good = lambda t: [g for g, _ in jsonrepair.recover(t)]
    assert good('{"a": 1}\\n{"a": "x\\"}{", "b": NaN}') == ['{"a": 1}', '{"a": "x\\"}{", "b": null}']
    assert good('{"items": [{"a": 1}, {"a": 2}]}') == ['{"a": 1}', '{"a": 2}'] and good('[{"a": 1}]') == ['{"a": 1}']
    assert jsonrepair.recover('x {"a": 1,} y {bad} z') == [('{"a": 1}', None), (None, "{bad}")] and jsonrepair.recover(None) == []


@pytest.mark.parametrize("nl", ["\n", "\r\n", "\\n"])
def test_json_recovery_of_cut_lines(nl):
    lines = ['{"a": "x\\\\n{y"}', '{"a": 2, "e": [{"p": 1}, {"p":', '{"a": 3, "t": "un', '{"a": 4}', "{'a': '5'}", '\ufeff{"a": 6,}', 'x {"a": 7}', '[{"a": 8}, {"a": 9}]', '{"a": 10, "e": [', '{"a": 11}', '{"a": 12, "t": "end']
    got = jsonrepair.recover(nl.join(lines))
    assert [json.loads(g)["a"] for g, _ in got if g] == [json.loads(lines[0])["a"], 4, 6, 7, 8, 9, 11]
    assert [b for _, b in got if b] == [lines[k] for k in (1, 2, 4, 8, 10)]


def test_json_recovery_over_lines():
    good = lambda t: [json.loads(g) for g, _ in jsonrepair.recover(t) if g]
    assert good('{"a": [\n{"x": 1},\n{"y": 2},\n]}\n{"b": 1}') == [{"a": [{"x": 1}, {"y": 2}]}, {"b": 1}]
    assert good('[{"a": 1},\n{"b": 2\n,{"c": 3},\n{"d": 4}]') == [{"a": 1}, {"c": 3}, {"d": 4}]
    assert jsonrepair.recover('{\n  "k": bad,\n  "e": [\n    {"x": 1}\n  ]\n}\n{"b": 1}')[1:] == [('{"b": 1}', None)]


def test_schema_guards(spark):
    df = spark.createDataFrame([("2019a", "7")], "y string, n string")
    with pytest.raises(ValueError, match="claim_id"):
        schemas.require_columns(df, ["y", "claim_id"])
    assert tuple(schemas.cast_where_possible(df, {"y": "int", "n": "int"}).first()) == (None, 7)
    assert schemas.with_required(df).first().is_quote is False


def test_files(spark, tmp_path):
    d = tmp_path / "reviews"
    d.mkdir()
    (d / "a.md").write_bytes("ok \xff é".encode("latin-1"))
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="{s}"/></w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>' for s, t in [("Heading1", "Top"), ("Normal", "one"), ("Heading2", "Sub"), ("Normal", "two"), ("Heading5", "deep")])
    with zipfile.ZipFile(d / "b.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    (d / "c.docx").write_bytes(b"broken")
    got = {r.review_id: (r.text, r.error is None) for r in files.read_reviews(spark, str(d)).collect()}
    assert got["a"] == ("ok  ", True) and got["b"] == ("Top\none\nSub\ntwo\ndeep", True) and got["c"][1] is False
    secs = files.docx_sections(files.read_docx_paragraphs(spark, str(d))).orderBy("sec_no").collect()
    assert [(s.level, s.title, s.body) for s in secs] == [(1, "Top", "one"), (2, "Sub", "two deep")]
    df = spark.createDataFrame([("x", 'a "q", b\nc'), ("y", None)], "k string, t string")
    files.write_csv(df, str(tmp_path / "csv"), last=["k"])
    back = files.read_csv(spark, str(tmp_path / "csv"), "k string, t string, more int")
    assert sorted((r.k, r.t, r.more) for r in back.collect()) == [("x", 'a "q", b\nc', None), ("y", None, None)]
    files.write_jsonl(df, str(tmp_path / "j"))
    assert files.read_jsonl(spark, str(tmp_path / "j"), "k string, t string").count() == 2
    files.write_all(df, str(tmp_path / "all"), "20240101_000000")
    assert files.read_best(spark, str(tmp_path / "all/parquet"), "none", "k string").count() == 2
    assert files.read_best(spark, str(tmp_path / "none"), str(tmp_path / "csv"), "k string").count() == 2
    with pytest.raises(FileNotFoundError):
        files.read_best(spark, str(tmp_path / "no"), str(tmp_path / "no2"), "k string")
    (tmp_path / "txt").mkdir()
    (tmp_path / "txt" / "Twende Mbele_2018.txt").write_text("<<<PAGE=1>>>\nhi")
    assert files.read_source_texts(spark, str(tmp_path / "txt")).first().stem == "Twende Mbele_2018"


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(30, 31), (31, 30), (40, 40), (None, 5)]
    e = spark.createDataFrame(edges, "a int, b int")
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([(k,) for k in [0, 20, 31, 40, 50]], "node int"), e).collect()}
    assert got[20] == 0 and got[31] == 30 and got[40] == 40 and got[50] == 50
    assert connected_components(spark.createDataFrame([(1,)], "node int"), e.limit(0)).count() == 1


def test_pdf_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one\x0ctwo ")
    (tmp_path / "b.pdf").write_bytes(b"broken")

    def pages_of(content):
        if content == b"broken":
            raise ValueError("no pages")
        return content.decode().split("\x0c")

    failed = files.convert_pdfs(spark, str(tmp_path), str(tmp_path / "out"), pages_of)
    assert [tuple(r) for r in failed.collect()] == [("b", "ValueError: no pages")]
    texts = spark.read.parquet(str(tmp_path / "out"))
    assert [tuple(r) for r in texts.collect()] == [("a", "<<<PAGE=1>>>\none\n<<<PAGE=2>>>\ntwo")]
    assert [(r.page_no, r.text) for r in textops.pages(texts, "stem", "text").orderBy("page_no").collect()] == [(1, "one"), (2, "two")]
    assert files.read_pdf_texts(spark, str(tmp_path)).filter("error IS NULL").count() == 0


def test_chains_in_the_literal_form(spark):
    t = "Smith (2020) says so, as cited in Host, 2022."
    assert [c.citation_text for c in one(spark, citations.narrative, t)] == ["Smith (2020), as cited in Host, 2022"]
    assert [c.citation_text for c in one(spark, lambda c: citations.narrative(c, True), t)] == ["Smith (2020), as cited in as cited in Host, 2022"]
