"""Operators for training data: fixtures, brute force, round trips, held-out accuracy."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimloom.llm import chunks, leakage, names, packing, residue, scans, sentences

# ---------------------------------------------------------------- names


def test_name_forms():
    p = lambda n: names.parse_name(n)[1:7]
    assert p("Dr. R. N. Smith")[2:] == ("smith", None, "r", "n") and p("Smith, R. N.")[2:] == ("smith", None, "r", "n") and p("Smith RN")[2:] == ("smith", None, "r", "n")
    assert p("Bob  Smith")[2:4] == ("smith", "robert") and p("Smith Robert")[2:4] == ("smith", "robert") and p("SMITH et al.")[2:4] == ("smith", None)
    assert p("Smíth & Jones")[2:4] == ("smith", None) and p("Trust of Delta Island Basin")[1] == p("The Delta Island Basin Trust")[1] == p("trust, delta island basin")[1]
    assert p("Delta Isl. Basin Trust")[0] == "short" and p("D.I.B.T.")[0] == "acronym" and names.parse_name("  ") is None and names.parse_name(None) is None


def test_distances():
    for other in ("abdce", "abde", "axcde", "xbcde", "abcdef"):
        assert names.alike("abcde", other) and names.codes_with_a_slip(["abcde"]) & names.codes_with_a_slip([other])
    assert not names.alike("abcde", "xbcdy") and not names.alike("abcde", "edcba")
    assert not names.codes_with_a_slip(["solvani"]) & names.codes_with_a_slip(["darmati"]) and names.codes_with_a_slip(["van", "berk"]) == names.codes_with_a_slip(["berg", "fan"])
    assert names.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-3) and names.jaro_winkler("", "a") == 0.0
    assert names.abbreviates("hbr", "harbour") and not names.abbreviates("hbx", "harbour")


@given(st.lists(st.sampled_from("abcdefghilmnoprstuvz"), min_size=5, max_size=12, unique=True).map("".join), st.integers(0, 11), st.sampled_from("abdegilmnorstu"), st.sampled_from(["change", "drop", "add", "swap"]))
def test_a_slip_leaves_a_common_block_and_is_alike(word, k, letter, how):
    k %= len(word) - 1
    other = {"change": word[:k] + letter + word[k + 1 :], "drop": word[:k] + word[k + 1 :], "add": word[:k] + letter + word[k:], "swap": word[:k] + word[k + 1] + word[k] + word[k + 2 :]}[how]
    assert names.alike(word, other) or letter in word
    if "ph" not in word + other:
        assert names.codes_with_a_slip([word]) & names.codes_with_a_slip([other])
    assert word[0] == other[0] or word[-1] == other[-1]


def test_persons_of_three_words(spark):
    p = lambda n: names.parse_name(n)[1:6]
    assert p("Maria del Carmen Lopez")[0] == "person" and p("Maria del Carmen Lopez")[2] == "lopez" and p("Anna van der Berg")[2:4] == ("berg", "anna")
    assert p("van der Berg, A.")[2] == "berg" and p("John P. Garcia Marquez")[0] == "person" and p("Wang, L.")[2] == "wang"
    got = {r.name: r.entity for r in names.link_names(spark.createDataFrame([("Li Wang",), ("Wang, L.",), ("Wang, Li",), ("Wnag, Li",), ("Anna van der Berg",), ("A. van der Berg",)], "name string")).collect()}
    assert got["Wnag, Li"] == got["Wang, Li"] and got["Anna van der Berg"] == got["A. van der Berg"]


def test_link_names(spark):
    groups = [
        ["Robert Kamidero", "Bob Kamidero", "R. Kamidero", "Kamidero, R.", "Kamidero", "KAMIDERO ", "Kamidreo", "Dr. R. Kamidero", "Kamidero et al."],
        ["E. Solvani", "Elizabeth Solvani", "Solvani Liz"],
        ["N. Solvani", "Nicholas T. Solvani"],
        ["Delta Island Ironwood Basin Trust", "The Delta Island Ironwood Basin Trust", "DELTA ISLAND IRONWOOD BASIN TRUST", "Delta Islad Ironwood Basin Trust", "Delta Isl. Ironwood Basin Trust", "D.I.I.B.T.", "DIIBT", "Trust of Delta Island Ironwood Basin", "Delta Island Ironwood & Partners Basin Trust"],
        ["Delta Inland Ironwood Basin Forum"],
        ["Solvani"],
    ]
    rows = [(n, k) for k, g in enumerate(groups) for n in g] + [(None, 9), ("", 9), ("Kamidero", 9)]
    df = spark.createDataFrame(rows, "name string, entity int")
    got = {r.name: r.entity for r in names.link_names(df).collect()}
    assert set(got) == {n for g in groups for n in g}
    by = {}
    for n, e in got.items():
        by.setdefault(e, set()).add(n)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, groups))
    pairs = names.variant_pairs(names.link_names(df)).collect()
    assert len(pairs) == sum(len(g) * (len(g) - 1) // 2 for g in groups) and all(a < b for a, b in pairs)


def test_slips_in_two_forms_and_in_short_surnames(spark):
    groups = [
        ["Isabella Vinulumi", "I. Vinulumi", "Vinulumi, I. T.", "Vinulumi", "Isabella Vniulumi", "Vniulumi", "Izzy T. Vinulumi"],
        ["Robert Smith", "R. Smith", "R. N. Smith", "Smith, Bob N.", "Bob Smth"],
        ["Robert Karo", "R. Karo", "R. N. Karo"], ["Nicholas Kano"], ["R. Kavo"],
        ["Thomas Dolavi", "T. Dolavi", "T. N. Dolavi", "Dolavi"], ["Peter Dolawi", "Susan Dolawi"],
    ]
    got = {r.name: r.entity for r in names.link_names(spark.createDataFrame([(n,) for g in groups for n in g], "name string")).collect()}
    family = lambda n: got[n].split("|")[1]
    assert family("Isabella Vniulumi") == family("Vniulumi") == family("Vinulumi") and got["Isabella Vniulumi"] == got["Isabella Vinulumi"]
    assert got["Bob Smth"] == got["Robert Smith"]
    assert len({family(n) for n in ("Robert Karo", "Nicholas Kano", "R. Kavo")}) == 3 and family("Peter Dolawi") != family("Dolavi")


def test_link_names_empty(spark):
    assert names.link_names(spark.createDataFrame([], "name string")).count() == 0
    assert names.link_names(spark.createDataFrame([(None,), (" ",)], "name string")).count() == 0


# ---------------------------------------------------------------- chunks


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab. \n,中。กé"), max_size=900), st.integers(0, 20))
def test_chunk_round_trip(text, overlap):
    pieces = chunks.chunk(text, 80, overlap, 25)
    assert "".join(text[b:e] for _, b, e in pieces) == text
    assert all(e - a <= 80 and 0 <= b - a <= overlap for a, b, e in pieces)
    assert all(e > b for _, b, e in pieces)


def test_chunk_edges():
    assert chunks.chunk(None) == [] and chunks.chunk("") == [] and chunks.chunk("x" * 1200) == [(0, 0, 1200)]
    long = "x" * 400_000
    assert "".join(long[b:e] for _, b, e in chunks.chunk(long)) == long
    with pytest.raises(ValueError):
        chunks.chunk("x" * 2000, 100, 100, 10)


def test_chunk_ends_and_edits():
    rng = random.Random(3)
    sentence = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(rng.randint(4, 14))).capitalize() + ". "
    text = "".join(sentence() for _ in range(400))
    pieces = chunks.chunk(text)
    assert all(text[:e].rstrip().endswith(".") for _, _, e in pieces)
    edited = text[:5000] + "Some new words stand here. " + text[5000:]
    old = {text[b:e] for _, b, e in pieces}
    assert len(old - {edited[b:e] for _, b, e in chunks.chunk(edited)}) <= 4


def test_long_evidence(spark):
    ev = "array<struct<page_range:string,text:string,score:int>>"
    rows = [("a", [("1", "x" * 1201, 1), ("1", None, 1), ("2", "y" * 1200, 2)], 0), ("b", None, 0), ("c", [], 0), ("a", [("1", "x" * 1201, 1)], 1)]
    df = spark.createDataFrame(rows, f"claim_id string, evidence {ev}, piece int")
    assert sorted(tuple(r)[:2] for r in chunks.long_evidence(df).collect()) == [("a", 0), ("a", 0)]
    out = chunks.split_texts(chunks.long_evidence(df), ["claim_id", "ev_pos"], "ev_text")
    assert out.distinct().count() == 2 and out.filter("n_pieces > 1").select("claim_id", "ev_pos").distinct().count() == 1


# ---------------------------------------------------------------- sentences

CLAIMS = [
    ("Dr. F. A. Zan noted it. The cost rose by 3.5 percent (Foo, 2010, p. 4). It fell in the U.S. According to Prof. Wu and Ms. Pora, it rose.", ["Dr. F. A. Zan noted it.", "The cost rose by 3.5 percent (Foo, 2010, p. 4).", "It fell in the U.S.", "According to Prof. Wu and Ms. Pora, it rose."]),
    ("“Ask the clerk! She knows,” the nurse said, and all went well. When staff asked \"Who reads this?\" in meetings, they left.", ["“Ask the clerk! She knows,” the nurse said, and all went well.", "When staff asked \"Who reads this?\" in meetings, they left."]),
    ("一位官员说：“没有人来过。什么都没变。”但地方审计组指出。数据质量很好？", ["一位官员说：“没有人来过。什么都没变。”但地方审计组指出。", "数据质量很好？"]),
    ("สำนักงานแผนรายงานว่าเพิ่มขึ้น 27 จุด สำนักงานแผนพบว่ายังคง (Diguzafi, 2009)", ["สำนักงานแผนรายงานว่าเพิ่มขึ้น 27 จุด", "สำนักงานแผนพบว่ายังคง (Diguzafi, 2009)"]),
    ("डॉ. सोनिल ने बताया। रिपोर्ट आई।", ["डॉ. सोनिल ने बताया।", "रिपोर्ट आई।"]),
    ("See Fig. 4 and vol. 5, No. 11 of it.\nA line\nbreak is none … and so on.", ["See Fig. 4 and vol. 5, No. 11 of it.", "A line\nbreak is none … and so on."]),
    ("  The report states: “All was well.” Then it ended.  ", ["The report states: “All was well.”", "Then it ended."]),
]


@pytest.fixture(scope="module")
def model(spark):
    import pathlib

    data = pathlib.Path("/root/testdata/sf0.01/ccp_registry.parquet")
    if not data.exists():
        pytest.skip("no test data")
    return sentences.train(spark.read.parquet(str(data)).select("claim_text").distinct(), "claim_text", 3000)


def test_sentences(spark, model):
    for text, want in CLAIMS:
        assert [text[a:b] for a, b in sentences.boundaries(text, model)] == want
    df = spark.createDataFrame([("a", CLAIMS[0][0], "x"), ("b", None, "y"), ("c", " ", "z"), ("d", "x" * 100_000, "w")], "claim_id string, t string, sentence string")
    got = sentences.split_sentences(df, "claim_id", "t", model).collect()
    assert sorted({r.claim_id for r in got}) == ["a", "d"] and [r.sent_no for r in got if r.claim_id == "a"] == [1, 2, 3, 4]


def test_sentence_accuracy_held_out(spark, model):
    """Reliable candidates of texts the model was not trained on."""
    texts = [r.claim_text for r in spark.read.parquet("/root/testdata/sf0.001/ccp_registry.parquet").select("claim_text").filter("claim_text <> ''").distinct().collect()]
    right = total = 0
    for t in texts:
        for c in sentences.candidates(t):
            y = sentences.reliable(t, c, model.counts)
            if y is not None:
                total += 1
                right += bool(y) == bool(sum(model.weights[k] for k in sentences.features(t, c, model.counts)) > 0)
    assert total > 200 and right / total >= 0.99


def test_sentences_empty(spark):
    assert sentences.split_sentences(spark.createDataFrame([], "i string, t string"), "i", "t").count() == 0


# ---------------------------------------------------------------- scans


def test_undo_and_furniture():
    assert scans.explain("review", "revicw") == [(4, "c")] and scans.explain("eat", "cat") == [(0, "c")] and scans.explain("cat", "eat") is None and scans.undone("simpliﬁed") == "simplified"
    long = "commemoration and administration of environmental information"
    assert len(scans.explain(long, long.replace("m", "rn").replace("e", "c").replace("t", "f"))) == sum(map(long.count, "met")) and scans.explain("", "") == []
    assert scans.certain_misread("guidɑnce") and scans.certain_misread("re9ular") and not scans.certain_misread("2019a") and not scans.certain_misread("1,250") and not scans.certain_misread("4th")
    text = "<<<PAGE=1>>>\nNotes on water\nLee\n\nBody one\n12\nends here.\nPage 1 of 2\n<<<PAGE=2>>>\nNotcs on water | 30\nBody two.\n- 2 -"
    kinds = scans.line_kinds(text.split("\n"))
    assert [k for k, x in enumerate(kinds, 1) if x == "furniture"] == [6, 8, 10, 12]
    assert scans.line_kinds([""]) == ["blank"]


def test_noisy_lines_and_repair(spark):
    clean = "the review of funding was shared with the regional council and the peri-urban reporting calendar was simplified for all members".split()
    rng = random.Random(1)
    rows = []
    for k in range(30):
        lines = [" ".join(rng.sample(clean, 8)) for _ in range(12)]
        rows.append((f"s{k}", "<<<PAGE=1>>>\nA long title of it\nLee\n\n" + "\n".join(lines)))
    noisy = "<<<PAGE=1>>>\nA title here\nLee\n\nthe revicw of funding was sh¬\nared with the regional coun-\n<<<PAGE=2>>>\nA title here | 2\ncil and the peri-\nurban reporting\n7\ncalendar was simpliﬁed"
    df = spark.createDataFrame([*rows, ("n", noisy), ("n", noisy), ("e", ""), ("z", None)], "stem string, text string").selectExpr("*", "1 AS kind")
    got = {(r.line_no, r.kind) for r in scans.noisy_lines(df).filter("stem = 'n'").collect()}
    assert got == {(5, "misread"), (5, "hyphen"), (6, "hyphen"), (8, "furniture"), (11, "furniture"), (12, "misread")}
    text = [r.text for r in scans.repaired_paragraphs(df).filter("stem = 'n'").orderBy("para_no").collect()]
    assert text[-1] == "the review of funding was shared with the regional council and the peri-urban reporting calendar was simplified"


def test_scans_empty(spark):
    assert scans.noisy_lines(spark.createDataFrame([], "stem string, text string")).count() == 0


# ---------------------------------------------------------------- packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=120))
def test_fill(sizes):
    s = np.array([[n, 1, n // 2] for n in sizes], np.int64).reshape(-1, 3)
    out = packing.fill(s, np.array([100, 7, 40]))
    for b in set(out.tolist()):
        assert (s[out == b].sum(0) <= [100, 7, 40]).all() or (s[out == b][:, 2] > 40).any()
    assert len(out) == len(s)


def test_cut_bytes():
    for text in ["a" * 4096, "é" * 3000, "word " * 2000, "中" * 1400]:
        parts = packing.cut_bytes(text, 4096)
        assert sum(parts) == len(text.encode()) and all(0 < n <= 4096 for n in parts) and parts[-1] + 1 <= 4096
        raw, at = text.encode(), 0
        for n in parts:
            raw[at : at + n].decode()
            at += n


def test_pack(spark):
    rng = random.Random(2)
    rows = [(k, "x" * rng.randint(0, 3000), "c") for k in range(400)] + [(1000, "y " * 6000, "c"), (1001, None, "c")]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, container string")
    got = packing.pack(df, "doc_id", "text").collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows} and len(got) == len({(r.doc_id, r.piece_no) for r in got})
    fill = {}
    for r in got:
        fill.setdefault(r.container, []).append(r.tokens)
    assert max(map(sum, fill.values())) <= 4096 and sum(map(sum, fill.values())) / (4096 * len(fill)) > 0.97
    assert {r.doc_id for r in got if r.n_pieces > 1} == {1000}
    assert packing.pack(df.limit(0), "doc_id", "text").count() == 0


# ---------------------------------------------------------------- leakage


def test_words():
    assert leakage.words_of("The​ <b>quick</b>\xa0Fox&amp;_dog_­!") == ["the", "quick", "fox", "dog"] and leakage.words_of(None) == []


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(300)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [text(rng.randint(20, 60)) for _ in range(25)] + [text(3)]
    docs = []
    for k in range(160):
        body = text(rng.randint(30, 400))
        it = rng.choice(items)
        n = rng.choice([8, 12, 15, 20, len(it)])
        a = rng.randint(0, max(0, len(it) - n))
        run = [w if rng.random() > 0.07 or n < 14 else rng.choice(["also", "other"]) for w in it[a : a + n]]
        at = rng.randint(0, len(body))
        docs.append(body[:at] + run + body[at:] if k % 2 else body)
    brute = {(d, i) for d, x in enumerate(docs) for i, y in enumerate(items) if leakage.longest_run(x, y)[0]}
    df = spark.createDataFrame([(k, " ".join(x).upper() if k % 3 else ", ".join(x), 1) for k, x in enumerate(docs)] + [(900, None, 1), (901, "", 1)], "doc_id long, text string, key int")
    it = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(99, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.find_leaks(df, it).collect()}
    assert got <= brute and len(got & brute) >= 0.97 * len(brute) and len(brute) > 20
    assert leakage.find_leaks(df.limit(0), it).count() == 0 and leakage.find_leaks(df, it.limit(0)).count() == 0


def test_longest_run():
    item = [f"a{k}" for k in range(40)]
    assert leakage.longest_run(["x", *item[5:19], "y"], item) == (0, 0)
    assert leakage.longest_run(["x", *item[5:20], "y"], item) == (15, 0)
    swapped = item[5:25]
    swapped[9] = "z"
    assert leakage.longest_run(swapped, item) == (20, 1)


# ---------------------------------------------------------------- residue

RESIDUE = [
    ("Please enable JavaScript to view this report.", "notice"), ("HTTP 503", "notice"), ("页面不存在，请返回首页重试。", "notice"), ("Seite nicht gefunden.", "notice"), ("Between {{YEAR}} and %%Country%%, it rose.", "placeholder"),
    ("Dear [First Name], dated DD/MM/YYYY.", "placeholder"), ("Lorem ipsum dolor sit amet consectetur.", "filler"), ("asdf asdf test test 123 blah blah", "filler"),
    ("Several officers complained that the dashboard asked them to enable JavaScript, so they kept paper records.", None), ("Auditors noted that 44 visits to the portal ended in a 404 error during the pilot.", None),
    ("In the older template a placeholder in double braces, such as {{district}}, marked the place of each value.", None), ("Trainers showed how lorem ipsum text in a draft misled readers, and the draft was withdrawn.", None),
    ("La misión de campo recomienda revisar los registros.", None), ("« Rien n’a changé », a dit un agent.", None),
]


@pytest.mark.parametrize(("text", "kind"), RESIDUE)
def test_residue_sentences(text, kind):
    assert residue.kind_of_sentence(text) == kind


def test_find_residue(spark):
    prose = "The study of water found better targeting because supervision was irregular and managers took part. " * 4
    banner = "Please enable JavaScript to view this report."
    own = lambda k: prose.replace("water", "".join(chr(97 + int(c)) for c in str(k + 1000)))  # noqa: E731  # no line of its own recurs
    rows = [(k, f"{banner}\n{own(k)}", "h1") for k in range(30)] + [(100, banner, "h1"), (101, f"Home | Site\n{banner}", None), (102, prose + "\nLorem ipsum dolor sit amet aliqua elit.", "h2"), (103, "", "h1"), (104, None, None), (105, prose, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'q' AS line", "1 AS prose")
    assert {r.doc_id for r in residue.find_residue(df).collect()} == {100, 101, 102}
    assert residue.find_residue(df.limit(0)).count() == 0


def _one_match(items) -> list[str]:
    """Texts, one for each alternative of a parsed pattern (a repeat as often as it must be, at least once where it may be absent)."""
    from re import _constants as c

    texts = [""]
    for op, arg in items:
        if op is c.LITERAL:
            more = [chr(arg)]
        elif op is c.BRANCH:
            more = [t for part in arg[1] for t in _one_match(part)]
        elif op is c.SUBPATTERN:
            more = _one_match(arg[3])
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT):
            more = [t * max(arg[0], 1) for t in _one_match(arg[2])] + ([""] if arg[0] == 0 else [])
        elif op is c.IN:
            kind, value = arg[0]
            classes = {c.CATEGORY_DIGIT: "4", c.CATEGORY_WORD: "a"}
            more = [chr(value) if kind is c.LITERAL else chr(value[0]) if kind is c.RANGE else classes.get(value, " ")]
        else:
            more = [""]
        texts = [a + b for a in texts for b in dict.fromkeys(more)][:1000]
    return texts


@pytest.mark.parametrize("name", ["NOTICE", "FIELD_TEXT", "PLACEHOLDER"])
def test_residue_filter_keeps_every_alternative(name, monkeypatch):
    """With and without the literals that texts are filtered by, every alternative of every pattern is classed alike."""
    from re import _parser

    pattern = getattr(residue, name)
    texts = [t for t in _one_match(_parser.parse(pattern.pattern, pattern.flags)) if pattern.search(t)]
    assert len(texts) > 25
    forms = [f(t) for t in texts for f in (str, str.upper, lambda x: x.replace(" ", "\xa0"), lambda x: f'"{x}"', lambda x: x.replace("i", "ı").replace("s", "ſ"))] if name != "PLACEHOLDER" else texts
    got = [residue.classify_lines(t) for t in forms]
    monkeypatch.setattr(residue, "NOTICE_KEYS", None)
    monkeypatch.setattr(residue, "FIELD_KEYS", None)
    monkeypatch.setattr(residue, "PLACE_KEYS", __import__("re").compile(""))
    full = [residue.classify_lines(t) for t in forms]
    assert got == full and sum(map(bool, full)) > len(texts) // 2


@pytest.mark.parametrize("text", ["text hier eingeben", 'Please enable "scripts" to view', "enable (script)", "enable/scripts", "allow\xa0scripts"])
def test_residue_filter_known_losses(text):
    assert residue.classify_lines(text)


def test_short_items_are_found_exactly(spark):
    items = [(1, "alpha"), (2, "one two three four five"), (3, "k1 k2 k3 k4 k5 k6 k7 k8 k9 k10"), (4, "..."), (5, "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10 a11 a12 a13 a14")]
    docs = [(10, "x alpha y"), (11, "one two three four six"), (12, "say: One, two three FOUR five!"), (13, "z k1 k2 k3 k4 k5 zz k7 k8 k9 k10 z"), (14, "k1 k2 zz k4 k5 zz k7 k8 k9 k10"), (15, "a1 a2 a3 a4 a5 zz a7 a8 a9 a10 a11 a12 a13 a14"), (16, "alph a")]
    got = leakage.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(10, 1), (12, 2), (13, 3), (15, 5)}


def test_items_in_rounds(spark):
    rng = random.Random(9)
    items = [(k, " ".join(f"w{rng.randint(0, 9000)}" for _ in range(30))) for k in range(60)]
    docs = [(k, f"so {t} it is") for k, t in items]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    pairs = leakage.candidates(d, i, max_bits=1 << 17)
    assert {(r.doc_id, r.item_id) for r in pairs.collect()} >= {(k, k) for k, _ in items}


def test_recall_of_runs_with_two_words_replaced():
    """The hardest case, a run of just 15 words with two of them replaced anywhere but at its ends, in the middle of other text."""
    rng = random.Random(11)
    found = n = 0
    for _ in range(400):
        item = [f"i{rng.randint(0, 10**6)}" for _ in range(40)]
        run = item[12:27]
        for k in rng.sample(range(1, 14), 2):
            run[k] = "zz"
        doc = [f"d{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 60))] + run + [f"e{rng.randint(0, 10**6)}" for _ in range(40)]
        if leakage.longest_run(doc, item)[0]:
            n += 1
            a = leakage.keys_of([" ".join(item)], leakage.LEAST - leakage.SHINGLE + 1, 1, True)[1]
            b = leakage.keys_of([" ".join(doc)], leakage.BLOCK - leakage.SHINGLE + 1, leakage.STRIDE, False)[1]
            found += bool(np.isin(a, b).any())
    print("recall of hardest runs", found, n)
    assert n > 300 and found >= 0.9 * n


def test_counts_do_not_change_with_the_corpus(spark):
    """Twice the texts, and many times as many rare words, leave shares and lower-case words as they are."""
    base = ["Dr. Ama met Prof. Bo. They talked. The dr. left. Then they ate at no. 4."] * 40 + ["The end came. They saw it."] * 40
    texts = lambda rows: spark.createDataFrame([(t,) for t in rows], "t string")
    small = sentences.count_tokens(texts(base), "t")
    large = sentences.count_tokens(texts(base * 2), "t")
    assert small.stops == large.stops and small.low == large.low and small.stops["Dr"][0] == 1.0 and {"they", "left"} <= small.low and "ama" not in small.low
    rare = [" ".join(f"x{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + j)}{'abcdefghij'[k // 676]}." for j in range(20)) for k in range(3000)]
    wide = sentences.count_tokens(texts(base + rare), "t", token_share=1e-4)
    assert {k: wide.stops[k] for k in ("Dr", "Prof", "no")} == {k: small.stops[k] for k in ("Dr", "Prof", "no")} and wide.low == small.low and len(wide.stops) <= 1e4


def test_many_open_brackets_take_linear_time():
    text = '([{“„ a. ' * 20_000 + ") ] } ” " * 5_000 + '" b. ' * 20_000
    spans, closers = sentences.spans_of_brackets(text)
    assert spans and len(sentences.candidates(text)) < len(text)
    assert sentences.spans_of_brackets('a (b "c) d" e)')[0] == [(2, 7)] and sentences.outermost([(5, 9), (0, 3), (6, 7), (8, 12)]) == ([0, 5], [3, 12])


def test_each_limit_binds():
    """Of three limits each is the one that decides for some items."""
    plain, headed, small = [[1000, 1, 1000]] * 40, [[1000, 1, 500]] * 40, [[20, 1, 10]] * 400
    fill = lambda rows, limits: packing.fill(np.array(rows), np.array(limits)).max() + 1
    assert fill(plain + headed, [4096, 99, 4096]) == 20 and 20 <= fill(plain + headed, [4096, 99, 3100]) <= 24 and fill(plain, [4096, 99, 3100]) == 14
    assert fill(small, [4096, 32, 4096]) == 13 and fill(small, [4096, 999, 4096]) == 2
    boxes = packing.fill(np.array(plain + headed), np.array([4096, 99, 3100]))
    assert np.bincount(boxes, np.array(plain + headed)[:, 2]).max() <= 3100


def test_pack_keeps_the_loss_limit(spark):
    rows = [(k, "# " + "h" * 200 + "\n" + "x" * 700 if k % 2 else "x" * 900) for k in range(200)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", loss=3500).groupBy("container").sum("loss", "tokens").collect()
    assert max(r["sum(loss)"] for r in got) <= 3500 and max(r["sum(tokens)"] for r in got) <= 4096
