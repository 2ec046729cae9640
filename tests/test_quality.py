"""Reject rows, packed fields, orphan references: fixtures, brute force, properties."""

import csv
import io
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.operators import orphans, packed, rejects

EV = '[{"page_range": "3-4", "text": "x, \\"y\\"", "score": 7}]'
GOOD = ["r", "s", "0123456789abcdef", "a, b", 'say "hi"', "", "p.pdf", EV]


def line(fields: list[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(fields)
    return out.getvalue()


def test_csv_reasons():
    cases = {
        line(GOOD): None,
        "﻿" + line(GOOD) + "\r": None,
        line(GOOD).replace("r,s", 'r,"s'): "syntax",
        line(GOOD).replace("r,s", 'r"x,s'): "syntax",
        line(GOOD).replace("r,s", '"r"x,s'): "syntax",
        line(GOOD)[:-1]: "syntax",
        line(GOOD[:7]): "count",
        line([*GOOD, "x"]): "count",
        "": "count",
        line([*GOOD[:2], "0123456789ABCDEF", *GOOD[3:]]): "value",
        line([*GOOD[:7], "not json"]): "value",
        line([*GOOD[:7], "null"]): "value",
        line([*GOOD[:3], "two\nlines", *GOOD[4:]]): None,
    }
    got = rejects.parse_batch(["csv"] * len(cases), list(cases))
    assert [r for r, _, _ in got] == list(cases.values())
    assert got[0][2]["citation_text"] == 'say "hi"' and got[0][2]["evidence"][0]["score"] == 7


def test_jsonl_reasons():
    row = dict.fromkeys(rejects.JSON_FIELDS, "") | {"claim_id": "0123456789abcdef", "is_secondary": False, "evidence": json.loads(EV)}
    text = json.dumps(row)
    item = row["evidence"][0]
    cases = [
        (text, None), (text[:-1], "syntax"), (text.replace('"', "'"), "syntax"), (text + text, "syntax"), ("", "syntax"), ("[1]", "count"), (json.dumps(row | {"more": 1}), "count"),
        (text[:-1] + ', "claim_id": "0123456789abcdef"}', "count"), (json.dumps(row | {"evidence": [item | {"score": 7.5}]}), "value"), (json.dumps(row | {"evidence": [item | {"score": float("nan")}]}), "value"),
        (json.dumps(row | {"evidence": [item | {"score": True}]}), "value"), (json.dumps(row | {"evidence": [item | {"text": "  "}]}), "value"), (json.dumps(row | {"evidence": []}), None), (json.dumps(row | {"claim_id": None}), "value"),
    ]
    assert [r for r, _, _ in rejects.parse_batch(["jsonl"] * len(cases), [t for t, _ in cases])] == [r for _, r in cases]
    assert [r for r, _, _ in rejects.parse_batch([None, "xml"], [None, "x"])] == ["syntax", "syntax"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00\r"), max_size=8), min_size=1, max_size=5), min_size=1, max_size=6))
def test_csv_round_trip(rows):
    lines = [",".join('"' + f.replace('"', '""') + '"' for f in r) for r in rows]
    assert rejects.index_csv(lines) == rows


def test_parse_lines_frame(spark):
    df = spark.createDataFrame([(1, "csv", line(GOOD), "x"), (2, "csv", None, "y"), (3, None, "q", "z"), (1, "csv", line(GOOD), "x")], "raw_id long, layout string, raw_text string, reason string")
    parsed = rejects.parse_lines(df)
    assert sorted((r.raw_id, r.reason) for r in rejects.rejects(parsed).collect()) == [(2, "count"), (3, "syntax")]
    good = rejects.loaded(parsed).collect()
    assert len(good) == 2 and good[0].evidence[0].page_range == "3-4" and good[0].citation_type is None
    assert rejects.parse_lines(df.limit(0)).count() == 0


def values(spark, text):
    df = spark.createDataFrame([("c", text, 1)], "claim_id string, t string, pos int")
    return [r.cite_value for r in packed.unpack_field(df, "t", ["claim_id"]).orderBy("pos").collect()]


def test_packed_values(spark):
    cases = {
        "(A B, 2000; C & D, 2001a, p. 3 | E 1999)": ["A B, 2000", "C & D, 2001a, p. 3", "E 1999"],
        '("A; Team, 2000" and B, 2001)': ["A; Team, 2000", "B, 2001"],
        '("A (""X"" series), 2000b", “B / C, 1999”, D, E. F., 2003, pp. 12–14, G, 2004)': ['A ("X" series), 2000b', "B / C, 1999", "D, E. F., 2003, pp. 12–14", "G, 2004"],
        "(A, 2000, as cited in B & C, 2010)": ["A, 2000, as cited in B & C, 2010"],
        "[A, 2000\tB, 2001\nC, 2002；D, 2003 · E,  2004 – F, 2005 / G, 2006]": ["A, 2000", "B, 2001", "C, 2002", "D, 2003", "E, 2004", "F, 2005", "G, 2006"],
        "Name [ABC] (2001)": ["Name [ABC] (2001)"],
        "(Name [ABC], 2001; B, 2000)": ["Name [ABC], 2001", "B, 2000"],
        'A "b, 2000; C, 2001': ['A "b, 2000', "C, 2001"],
        "": [],
        "  ": [],
        None: [],
        "(" + "; ".join(f"N{k}, 2000" for k in range(3000)) + ")": [f"N{k}, 2000" for k in range(3000)],
    }
    for text, want in cases.items():
        assert values(spark, text) == want, text


def test_orphans_against_brute_force(spark):
    import random

    rng = random.Random(5)
    t = lambda k: f"2024-{k:02d}-01 00:00:00"
    keys = [f"k{k}" for k in range(40)]
    parents = [(rng.choice(keys), rng.choice([None, *range(1, 12)]), rng.choice([None, None, *range(1, 12)])) for _ in range(45)]
    parents += parents[:5]
    refs = [(rng.choice([*keys, "zz", "a"]), rng.choice(range(1, 13))) for _ in range(300)] + [("k1", 3)] * 200  # one hot key
    r = spark.createDataFrame(refs, "key string, m int").select("key", F.expr("make_timestamp(2024, m, 1, 0, 0, 0)").alias("at"))
    p = spark.createDataFrame(parents, "key string, s int, e int").selectExpr("key", "make_timestamp(2024, s, 1, 0, 0, 0) AS start", "make_timestamp(2024, e, 1, 0, 0, 0) AS end")
    got = {(x.key, x["at"].month): x.reason for x in orphans.find_orphans(r, p).collect()}
    want = {}
    for key, at in set(refs):
        own = [(s, e) for k, s, e in parents if k == key]
        if any((s is None or s <= at) and (e is None or e > at) for s, e in own):
            continue
        want[(key, at)] = "missing" if not own else "late" if any(s is not None and s > at for s, _ in own) else "deleted"
    assert got == want
    assert t(1) and orphans.find_orphans(r, p.limit(0)).filter("reason <> 'missing'").count() == 0
    assert orphans.find_orphans(r.limit(0), p).count() == 0


def test_runs(spark):
    ids = spark.createDataFrame([(n,) for n in [0, 1, 2, 5, 6, 9, 10, 11]], "n long")
    runs = orphans.contiguous_runs(ids, block=8)
    assert sorted((r.run_start, r.run_end) for r in runs.collect()) == [(0, 2), (5, 6), (9, 11)]
    refs = spark.createDataFrame([(n,) for n in range(14)], "n long")
    assert sorted(r.n for r in orphans.beyond_runs(refs, runs, block=8).collect()) == [3, 4, 7, 8, 12, 13]
    one = orphans.contiguous_runs(ids, block=2)
    assert sorted(r.n for r in orphans.beyond_runs(refs, one, block=2).collect()) == [3, 4, 7, 8, 12, 13]


def test_orphan_references_nulls(spark):
    reg = spark.createDataFrame([("c1", None, None, "", True, None, "x"), ("c2", "r", "A ", "2001B", True, "p\\Q.pdf", "y"), ("c3", "r", "a", "2001b", None, " P/q.PDF ", "z")], "claim_id string, review_id string, citation_author string, citation_year string, in_reference_list boolean, source_pdf_path string, key string")
    reg = reg.withColumn("extracted_at", F.to_timestamp(F.lit("2024-05-01")))
    inv = spark.createDataFrame([("p/q.pdf",)], "path string").selectExpr("path", "timestamp'2024-01-01' AS registered_at", "CAST(NULL AS TIMESTAMP) AS deleted_at", "1 AS key")
    idx = spark.createDataFrame([("r", "a", "2001b")], "review_id string, first_author string, year string").selectExpr("*", "timestamp'2024-06-01' AS indexed_at", "CAST(NULL AS TIMESTAMP) AS withdrawn_at")
    got = sorted(tuple(r) for r in orphans.orphan_references(reg, inv, idx).collect())
    assert got == [("c1", "references_index", "missing", "2024-05"), ("c2", "references_index", "late", "2024-05")]


def test_ends_of_values(spark):
    """Values without a year, and a caller's own end of a value."""
    df = spark.createDataFrame([("a", "(Smith, n.d.; Jones & Lee, in press)"), ("b", "red; green / blue"), ("c", '"x; y"; z')], "k string, t string")
    values = lambda rows, k: [r.cite_value for r in rows.filter(f"k = '{k}'").orderBy("pos").collect()]
    assert values(packed.unpack_field(df, "t", ["k"]), "a") == ["Smith, n.d.", "Jones & Lee, in press"] and values(packed.unpack_field(df, "t", ["k"]), "b") == ["red; green / blue"]
    own = packed.unpack_field(df, "t", ["k"], complete="", separator="[;/]")
    assert values(own, "b") == ["red", "green", "blue"] and values(own, "c") == ["x; y", "z"]
