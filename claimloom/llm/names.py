"""Variant spellings of person and organisation names: block, compare, cluster.

1. Distinct strings are parsed: first-named party only, titles and "et al." off, accents and case folded; a person's surname, given
   name (through a nickname table) and initials in any order; an organisation's word set, or an acronym.
2. Blocks: phonetic codes of the sorted tokens, of a surname or of an organisation. A slip in a letter changes its code in one place at
   most, so besides the code itself each code with one sound left out is a key (in one token at a time), and two spellings one slip
   apart always share one. Blocks of surnames are split by the first letter and again by the last, of which a slip leaves one; those
   of organisations hold only names that agree in all tokens but one: no block grows with a frequent word.
3. Pairs in a block are compared with Jaro-Winkler, against what one changed letter leaves of it at their length. A misspelling is rare:
   a surname is taken for one of another only if it stands in one form and the other in no fewer, or, also with more forms or up to
   four letters, if the other stands in twice as many and has its initials and given names (a short one shares a given name); a word
   only if one name has it, or if the other is in twice as many.
4. Accepted pairs are clustered by connected components, surnames into families and organisations into entities. In a family, given
   names and initials part the persons; a form without any joins them only if there is but one. Abbreviated names and acronyms join the
   organisation with their initials if there is but one.

Defined results: null and blank names are left out; strings that differ in case or blanks only are variants; repeated rows count once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.graph import connected_components
from claimloom.session import cut

# Usual short forms of given names.
NICKNAMES = {
    "alexander": "alex sandy", "andrew": "drew andy", "anthony": "tony", "barbara": "barb babs", "benjamin": "ben benny", "charles": "chuck charlie", "christopher": "chris kit", "daniel": "dan danny",
    "deborah": "debbie deb", "donald": "don donny", "edward": "ted eddie ed ned", "elizabeth": "liz beth betty eliza lizzie", "frances": "fran frannie", "francis": "frank", "gabriela": "gaby gabi", "gabriel": "gabe",
    "gerald": "gerry", "gregory": "greg", "henry": "hank harry", "isabella": "izzy bella", "jacob": "jake", "james": "jim jimmy", "jennifer": "jen jenny", "jessica": "jess", "john": "jack johnny", "joseph": "joe joey",
    "josephine": "jo josie", "katherine": "kate kathy katie", "kenneth": "ken kenny", "lawrence": "larry", "leonard": "len lenny", "margaret": "peggy maggie meg", "matthew": "matt", "michael": "mike mick mickey",
    "nicholas": "nick nicky", "otto": "ottie", "patricia": "trish pat patty", "peter": "pete", "philip": "phil", "raymond": "ray", "rebecca": "becky", "richard": "rick dick", "robert": "bob rob bobby", "ronald": "ron",
    "samuel": "sam sammy", "stephen": "steve", "susan": "sue susie", "theodore": "theo", "thomas": "tom tommy", "timothy": "tim", "victoria": "vicky vicki tori", "vincent": "vince", "walter": "walt", "william": "bill will billy",
    "yolanda": "yoli",
}
GIVEN = {n: full for full, short in NICKNAMES.items() for n in (full, *short.split())}
TITLES = {"dr", "prof", "professor", "mr", "mrs", "ms", "sir", "sr", "sra", "dra"}
# Fixed value: a surname in several forms is a misspelling only of one in at least so many times as many.
RARER = 2
ONE_LETTER = 0.79
SMALL = {"the", "of", "and", "for", "a"}
# Usual contractions in names of organisations that keep a vowel and may stand without a full stop.
CONTRACTIONS = set("admin agcy assn assoc corp dept dist fdn govt inst intl natl pship univ".split())
# Words inside a surname.
PARTICLES = {"de", "del", "della", "da", "dos", "di", "du", "la", "le", "van", "von", "der", "den", "ter", "bin", "ibn", "al", "el"}
_CLASSES = str.maketrans("bpcgjkqsxzdtlmnrfvwaeiou", "112222222233455677700000")

PARSED = "name string, kind string, form string, surname string, given string, fi string, middle string, words array<string>, initials string"


def fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def phonetic(token: str) -> str:
    """One sound class for each letter, in place; ph is f, h and y are not heard; letters of other scripts stand for themselves."""
    return re.sub("[hy]", "", token.replace("ph", "f")).translate(_CLASSES)


def codes_with_a_slip(tokens: list[str]) -> set[str]:
    """The phonetic codes of the sorted tokens, whole and with one sound left out of one token."""
    codes = [phonetic(t) for t in tokens]
    out = {" ".join(sorted(codes))}
    for k, c in enumerate(codes):
        out |= {" ".join(sorted([*codes[:k], c[:j] + c[j + 1 :], *codes[k + 1 :]])) for j in range(len(c))}
    return out


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    first = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                first.append(c)
                break
    if not first:
        return 0.0
    second = [c for c, u in zip(b, used) if u]
    m, t = len(first), sum(x != y for x, y in zip(first, second)) / 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Jaro's measure takes the first letter that fits, so it is read from both ends, and the better counts."""
    best = max(jaro(a, b), jaro(a[::-1], b[::-1]))
    prefix = next((k for k, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return best + 0.1 * prefix * (1 - best)


def alike(a: str, b: str) -> bool:
    """Jaro-Winkler of one changed letter, even the first (1 - 0.67 / length), but not of two, even far behind (1 - 0.8 / length)."""
    return jaro_winkler(a, b) >= 1 - ONE_LETTER / max(len(a), len(b), 1)


def abbreviates(short: str, full: str) -> bool:
    """Is short made of the first and other letters of full, in order?"""
    if short == full:
        return True
    if not short or short[0] != full[0] or len(short) >= len(full):
        return False
    it = iter(full)
    return all(c in it for c in short)


def given_name(token: str) -> str | None:
    if token in GIVEN:
        return GIVEN[token]
    if len(token) >= 5:
        near = [full for full in NICKNAMES if alike(token, full)]
        return near[0] if len(near) == 1 else None
    return None


def person_like(name: str, words: list[str]) -> bool:
    """Is a name of three words and more a person's: by a particle or a known given name in front?"""
    plain = [w.strip(".").lower() for w in words]
    inside = plain[1:-1] if "," not in name else plain
    return any(w in PARTICLES and words[plain.index(w)].islower() for w in inside) or plain[0] in GIVEN


def parse_name(name: str | None) -> tuple | None:
    """A row of PARSED, or None for a blank name."""
    raw = re.sub(r"\s+", " ", fold(name or "")).strip()
    raw = re.sub(r",?\s*\bet\s+al\b\.?.*$", "", raw, flags=re.I).strip(" ,;")
    if not raw:
        return None
    inner = re.sub(r"\s*[(\[]([A-Z.]{2,12})[)\]]\s*$", "", raw)
    words = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?\.?", inner)
    letters = re.sub(r"[^A-Za-z]", "", inner)
    if re.fullmatch(r"(?:[A-Z]\.){2,8}|[A-Z]{2,6}", inner):
        return name, "acronym", letters.lower(), letters.lower(), None, None, None, None, letters.lower()
    partners = re.sub(r"\s*&\s*partners\b", "", inner, flags=re.I)
    real = [w for w in re.findall(r"[^\W\d_]+\.?", partners) if w.lower() not in SMALL and w.lower().strip(".") not in TITLES]
    long_words = [w for w in real if len(w.strip(".")) > 1]
    if len(long_words) >= 3 and not re.search(r"&|\band\b", partners) and not person_like(inner, real):
        flat = re.sub(r"^the ", "", partners, flags=re.I)
        m = re.match(r"^(\w+\.?) of (.+)$", flat, re.I) or re.match(r"^(\w+\.?), (.+)$", flat)
        flat = f"{m.group(2)} {m.group(1)}" if m else flat
        tokens = [w.lower() for w in re.findall(r"[^\W\d_]+\.?", flat) if w.lower() not in SMALL]
        plain = [t.strip(".") for t in tokens]
        short = any(t.endswith(".") or not re.search(r"[aeiou]", t.strip(".")) or t in CONTRACTIONS for t in tokens)
        return name, "short" if short else "org", " ".join(plain if short else sorted(plain)), None, None, None, None, plain, "".join(t[0] for t in plain)
    first = re.split(r"\s*(?:&|\band\b)\s*", inner)[0].strip(" ,")
    tokens = [w for w in re.findall(r"[^\W\d_]+(?:['-][^\W\d_]+)*\.?", first) if w.lower().strip(".") not in TITLES or (w.isupper() and not first.startswith(w))]
    if not tokens:
        return None
    comma = "," in first
    initials, long = [], []
    for k, t in enumerate(tokens):
        bare = t.strip(".")
        tail = k > 0 and bare.isupper() and len(bare) <= 3 and not first.isupper()
        if len(bare) == 1 or tail:
            initials += list(bare.lower())
        else:
            long.append(bare.lower())
    long = [w for w in long if w not in PARTICLES] or long
    if not long:
        return name, "acronym", letters.lower(), letters.lower(), None, None, None, None, letters.lower()
    given, surname = None, long[-1]
    if len(long) >= 2:
        g0, g1 = given_name(long[0]), given_name(long[-1])
        if comma or (g1 and not g0):
            surname, given = long[0], g1 or long[-1]
        else:
            surname, given = long[-1], g0 or long[0]
        if len(long) > 2:  # a second given name is an initial; a second surname is not told from one
            initials = [long[1][0], *initials]
    fi = given[0] if given else (initials[0] if initials else None)
    middle = (initials[0] if initials else None) if given else (initials[1] if len(initials) > 1 else None)
    form = " ".join(["".join(x or "-") for x in (surname, given, fi, middle)])
    return name, "person", form, surname, given, fi, middle, None, None


def parse_names(names: DataFrame) -> DataFrame:
    """names(name) -> PARSED."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([r for n in pdf["name"] if (r := parse_name(n))], columns=[c.split()[0] for c in PARSED.split(", ")])

    return names.select("name").filter("name IS NOT NULL").distinct().mapInPandas(run, PARSED)


@F.pandas_udf(T.BooleanType())
def similar(a: pd.Series, b: pd.Series) -> pd.Series:
    """All words alike, one by one."""
    return pd.Series([len(x := p.split()) == len(y := q.split()) and all(map(alike, x, y)) for p, q in zip(a, b)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def surname_keys(s: pd.Series) -> pd.Series:
    """Block keys of a surname, split by its first and by its last letter."""
    return s.map(lambda t: sorted(f"{side}:{c}" for c in codes_with_a_slip(re.split("[-' ]", t)) for side in ("^" + t[0], "$" + t[-1])))


_LEFT_OUT = T.StructType([T.StructField(n, T.StringType()) for n in ("key", "out", "rest")])


@F.pandas_udf(T.ArrayType(_LEFT_OUT))
def leave_one_out(words: pd.Series) -> pd.Series:
    """For each word: keys of the codes of the other words with those of the word itself, the word, and the others in the order of their codes."""

    def keys(ws: list[str]) -> list[dict[str, str]]:
        ws = sorted(ws)
        out = []
        for k, w in enumerate(ws):
            rest = sorted(ws[:k] + ws[k + 1 :], key=lambda x: (phonetic(x), x))
            code = " ".join(map(phonetic, rest))
            out += [{"key": f"{code}|{c}", "out": w, "rest": " ".join(rest)} for c in sorted(codes_with_a_slip([w]))]
        return out

    return words.map(lambda w: keys(list(w)))


@F.pandas_udf(T.BooleanType())
def short_for(short: pd.Series, full: pd.Series) -> pd.Series:
    return pd.Series([len(a) == len(b) and all(abbreviates(x, y) or alike(x, y) for x, y in zip(a, b)) for a, b in zip(short, full)])


def agreement(persons: DataFrame, slips: DataFrame) -> DataFrame:
    """slip, base, agree, same_given: are all initials of the slip initials of the base, with no other given name where the base has one,
    and do both share a given name? Slips without an initial give no row."""
    said = persons.filter("fi IS NOT NULL").select("surname", "fi", "given").distinct()
    by_fi = said.groupBy(F.col("surname").alias("base"), "fi").agg(F.count("given").alias("n_given"))
    by_given = said.filter("given IS NOT NULL").select(F.col("surname").alias("base"), "fi", "given", F.lit(True).alias("same"))
    rows = slips.select("slip", "base").join(said.withColumnRenamed("surname", "slip"), "slip").join(by_fi, ["base", "fi"], "left").join(by_given, ["base", "fi", "given"], "left")
    same = F.coalesce("same", F.lit(False))
    fits = F.col("n_given").isNotNull() & (F.col("given").isNull() | (F.col("n_given") == 0) | same)
    return rows.groupBy("slip", "base").agg(F.bool_and(fits).alias("agree"), F.bool_or(same).alias("same_given"))


def surname_slips(persons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The surnames with their numbers, and a -> b of accepted misspellings."""
    stats = cut(persons.groupBy("surname").agg(F.countDistinct("form").alias("forms"), F.countDistinct("fi").alias("n_fi"), F.min("fi").alias("one_fi")))
    keys = stats.filter(F.length("surname") >= 2).select("surname", F.explode(surname_keys("surname")).alias("key")).select("surname", F.xxhash64("key").alias("key"))
    pairs = keys.alias("x").join(keys.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.surname") < F.col("y.surname"))).select(F.col("x.surname").alias("a"), F.col("y.surname").alias("b")).distinct()
    initials = persons.filter("fi IS NOT NULL").select("surname", "fi").distinct()
    sided = pairs.filter(similar("a", "b")).join(stats.select(F.col("surname").alias("a"), F.col("forms").alias("fa"), F.col("n_fi").alias("na"), F.col("one_fi").alias("ia")), "a")
    sided = sided.join(stats.select(F.col("surname").alias("b"), F.col("forms").alias("fb"), F.col("n_fi").alias("nb"), F.col("one_fi").alias("ib")), "b")
    # the rarer is the misspelling
    flip = (F.col("fa") < F.col("fb")) | ((F.col("fa") == F.col("fb")) & (F.col("a") > F.col("b")))
    pick = lambda x, y: F.when(flip, F.col(x)).otherwise(F.col(y))
    slips = cut(sided.select(pick("a", "b").alias("slip"), pick("b", "a").alias("base"), pick("fa", "fb").alias("slip_forms"), pick("fb", "fa").alias("base_forms"), pick("na", "nb").alias("slip_n"), pick("ia", "ib").alias("slip_fi"), pick("nb", "na").alias("base_n")))
    slips = slips.join(agreement(persons, slips), ["slip", "base"], "left").join(initials.select(F.col("surname").alias("base"), F.col("fi").alias("slip_fi"), F.lit(True).alias("known")), ["base", "slip_fi"], "left")
    # one form of a long surname need not contradict; several forms, or a short surname, must be far rarer and agree, a short one in a given name
    short = F.least(F.length("slip"), F.length("base")) <= 4
    single = (F.col("slip_forms") == 1) & ~short & ((F.col("slip_n") == 0) | (F.col("base_n") == 0) | F.col("known"))
    agreed = (F.col("slip_forms") * RARER <= F.col("base_forms")) & F.col("agree") & (~short | F.col("same_given"))
    best = slips.filter(single | agreed).groupBy("slip").agg(F.max_by("base", F.struct("known", "base_forms", "base")).alias("base"))
    return stats, best.select(F.col("slip").alias("a"), F.col("base").alias("b"))


def person_entities(persons: DataFrame, families: DataFrame) -> DataFrame:
    """families(surname, family) -> name, entity."""
    p = cut(persons.join(families, "surname").select("name", "family", "given", "fi", "middle"))
    by_fi = p.filter("fi IS NOT NULL").groupBy("family", "fi").agg(F.countDistinct("given").alias("n_given"), F.max("given").alias("one_given"), F.countDistinct("middle").alias("n_mid"))
    by_family = by_fi.groupBy("family").agg(F.count("*").alias("n_fi"), F.max("fi").alias("only_fi"), F.max("n_given").alias("max_given"), F.max("one_given").alias("only_given"), F.max("n_mid").alias("max_mid"))
    q = p.join(by_fi, ["family", "fi"], "left").join(by_family, "family", "left")
    one = (F.col("n_fi") == 1) & (F.col("max_given") <= 1)
    given = F.when(F.col("given").isNotNull(), F.col("given")).when(F.col("n_given") == 1, F.col("one_given")).when(F.col("n_given") == 0, F.lit("-")).otherwise(F.concat(F.lit("?"), F.coalesce("middle", F.lit("-"))))
    who = F.when(F.col("fi").isNotNull(), F.concat_ws("|", "fi", given)).when(one, F.concat_ws("|", "only_fi", F.coalesce("only_given", F.lit("-")))).otherwise(F.lit("bare"))
    return q.select("name", F.concat_ws("|", "family", who).alias("entity"))


def organisation_slips(orgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The forms of organisations, and a -> b of those that differ in a misspelt word."""
    forms = cut(orgs.groupBy("form").agg(F.first("words").alias("words")))
    rare = forms.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    out = forms.select("form", F.explode(leave_one_out("words")).alias("k")).select("form", F.xxhash64("k.key").alias("key"), F.col("k.out").alias("word"), F.col("k.rest").alias("rest")).join(rare, "word")
    least, most = F.least("x.df", "y.df"), F.greatest("x.df", "y.df")
    pairs = out.alias("x").join(out.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.form") < F.col("y.form")) & ((least == 1) | (least * RARER <= most)))
    pairs = pairs.select(F.col("x.form").alias("a"), F.col("y.form").alias("b"), F.concat_ws(" ", "x.word", "x.rest").alias("p"), F.concat_ws(" ", "y.word", "y.rest").alias("q")).distinct()
    return forms, pairs.filter(similar("p", "q")).select("a", "b").distinct()


def organisation_entities(orgs: DataFrame, shorts: DataFrame, acronyms: DataFrame, comp: DataFrame) -> DataFrame:
    """comp(form, entity) -> name, entity. An acronym or abbreviation that fits no or several organisations is an entity of its own."""
    full = cut(orgs.groupBy("form", "initials").agg(F.first("words").alias("full")).join(comp, "form").groupBy("entity", "initials").agg(F.collect_set("full").alias("fulls")))
    named = orgs.join(comp, "form").select("name", "entity")
    # distinct word lists meet, not names; word by word an abbreviation begins with the first letter of what it stands for
    asked = shorts.select("form", "words", "initials").distinct()
    short = asked.join(full.select("initials", "entity", F.explode("fulls").alias("full")), "initials").filter(short_for("words", "full")).groupBy("form").agg(F.countDistinct("entity").alias("n"), F.min("entity").alias("entity"))
    short = shorts.join(short.filter("n = 1").select("form", "entity"), "form", "left").select("name", F.coalesce("entity", F.concat(F.lit("s|"), "form")).alias("entity"))
    lone = full.groupBy("initials").agg(F.countDistinct("entity").alias("n"), F.min("entity").alias("entity")).filter("n = 1").select("initials", "entity")
    acro = acronyms.join(lone, "initials", "left").select("name", F.coalesce("entity", F.concat(F.lit("a|"), "form")).alias("entity"))
    return named.unionByName(short).unionByName(acro)


def link_names(names: DataFrame, name_col: str = "name") -> DataFrame:
    """name, entity: one row for each distinct string that is not blank."""
    parsed = cut(parse_names(names.select(F.col(name_col).alias("name"))))
    orgs = parsed.filter("kind = 'org'")
    initials = orgs.select("initials").distinct()
    # capitals that are no organisation's initials are a surname in capitals
    acronyms = parsed.filter("kind = 'acronym'").join(initials, "initials", "left_semi")
    loud = parsed.filter("kind = 'acronym'").join(initials, "initials", "left_anti")
    persons = parsed.filter("kind = 'person'").unionByName(loud)
    stats, slips = surname_slips(persons)
    forms, misspelt = organisation_slips(orgs)
    # one graph for both, so that the rounds of the components are gone through once
    own = lambda c, kind: F.concat(F.lit(kind), F.col(c))
    nodes = stats.select(own("surname", "p|").alias("node")).unionByName(forms.select(own("form", "o|").alias("node")))
    edges = slips.select(own("a", "p|").alias("a"), own("b", "p|").alias("b")).unionByName(misspelt.select(own("a", "o|").alias("a"), own("b", "o|").alias("b")))
    comp = cut(connected_components(nodes, edges))
    part = lambda kind, key, value: comp.filter(F.startswith("node", F.lit(kind))).select(F.substr("node", F.lit(3)).alias(key), F.col("component").alias(value))
    return person_entities(persons, part("p|", "surname", "family")).unionByName(organisation_entities(orgs, parsed.filter("kind = 'short'"), acronyms, part("o|", "form", "entity")))


def variant_pairs(linked: DataFrame) -> DataFrame:
    """name_a < name_b by code point for the variants of each entity."""
    a, b = linked.select(F.col("name").alias("name_a"), "entity"), linked.select(F.col("name").alias("name_b"), "entity")
    return a.join(b, "entity").filter(F.col("name_a") < F.col("name_b")).select("name_a", "name_b")
