"""Template residue and error-page text: find documents that are, or hold in place of content, placeholders, filler or notices.

1. Every line of every document, normalised (case, digits, white space), is counted by host (the document's source): one hash for each
   distinct line of a document, summed with map-side combine on (host, hash), so a host with a third of all rows is no hot key.
2. Each sentence is classed: unfilled placeholder, filler, notice (error page, script or browser notice) or other. A sentence that
   speaks about such things (a mention: placeholders named as such, filler words in a running sentence, an error told in the past) is
   other. Documents without evidence are dropped here, before anything is joined.
3. Lines that recur in at least RECUR_SHARE of a host's documents are boilerplate and subtracted from the residual. A document is
   excluded when its residual has placeholder or filler evidence, or when a notice stands where content belongs, that is with fewer
   than PROSE_WORDS words of other running text. A recurrent evidence line counts only where there is no such text.

Defined results: null and empty texts are no cases; a null host is a host of its own; repeated texts are each judged; whole texts are
read, whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from re import _constants as sre
from re import _parser as sre_parser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECUR_DOCS, RECUR_SHARE, PROSE_WORDS = 5, 0.002, 40

NAME = r"[A-Za-z][\w.]*(?: [A-Za-z][\w.]*){0,4}"
PLACEHOLDER = re.compile(
    rf"\{{\{{ ?{NAME} ?\}}\}}|\$\{{ ?{NAME} ?\}}|<%=? ?{NAME} ?%>|\[\[ ?{NAME} ?\]\]|«[A-Za-z][\w.]*(?: [A-Za-z][\w.]*){{0,3}}»|%%{NAME}%%|(?<!\w)__{NAME}__(?!\w)|(?<![\w&])#{NAME}#(?!\w)|(?<![\w$}}{{])\{{{NAME}\}}(?!\}})"
    rf"|<{NAME} (?:to be (?:added|completed|confirmed|inserted)|here)>|<(?:insert|add|enter|your) {NAME}>|\[(?:INSERT|ADD|ENTER|TO BE)\b[^\]\n]{{0,60}}\]"
    r"|\[(?:First|Last|Full|Your|Insert|Enter|Add) ?[A-Z]?[a-z]*(?: [A-Za-z]+)?\]|\[(?:Name|District|Date|Country|Year|Title|Author|Organi[sz]ation|Company|Address|Email|Phone|Project|Programme|Client)\]"
    r"|\bDD[/.-]MM[/.-](?:YY){1,2}\b|\bMM[/.-]DD[/.-]YYYY\b|\bYYYY[/.-]MM[/.-]DD\b|\bX{4,}\b|\b(?:19|20)XX\b|\[object Object\]|\bundefined undefined\b|\bnull \(NaN\)",
)
FIELD_TEXT = re.compile(
    r"click (?:or tap )?here to (?:enter|add)|choose an item\b|your text (?:goes )?here|type your text|add a (?:sub)?title|replace this (?:paragraph|text) with|(?:^|[:.]\s*)TBD\b|\bsummary to follow\b"
    r"|insert (?:text|title|name) here|(?:^|\W)(?:à compléter|por completar|a preencher|hier text einfügen|texto de ejemplo|text hier eingeben|此处输入文字|请在此输入|ここにテキストを入力)",
    re.I,
)
MENTION = re.compile(r"\b(?:placeholders?|double braces|merge fields?|template (?:used|had|field)|older template|such as|lorem ipsum text|marqueur|platzhalter|marcadores?)\b|[\"“][^\"”]*$", re.I)

# The vocabulary of the usual filler texts.
LATIN_FILLER = set(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea "
    "commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
#: those of them that are no short words of living languages; a filler sentence holds at least one
LONG_FILLER = {w for w in LATIN_FILLER if len(w) >= 5} | {"amet", "elit", "enim", "quis", "nisi", "duis", "aute", "esse", "sint", "sunt", "anim"}
KEY_FILLER = set("asdf asdfasdf qwerty blah foo bar baz test testing text dummy sample xxx yyy zzz 123 abc".split())

NOTICE = re.compile(
    r"(?:enable|activate|turn on|switch on|allow)\b[^.\n]{0,25}\b(?:javascript|cookies|scripts?)\b|\b(?:requires?|needs?) javascript|scripts? (?:are|is) (?:blocked|disabled)|javascript is (?:disabled|required|not)|your browser (?:is not supported|does not)"
    r"|checking your browser|verify (?:that )?you are (?:a )?human|(?:session|link) has expired|sign in again|too many requests|service (?:is )?(?:temporarily )?unavailable|temporarily unavailable|under(?:going)? maintenance"
    r"|^(?:http(?:/[\d.]+)?|error|status)[ :]*[45]\d\d\b|^[45]\d\d\b[ -:–—]*(?:not found|forbidden|error|bad request|bad gateway|service unavailable|internal server|unauthorized|gateway|gone\b)|\bpage (?:not found|(?:you requested )?(?:could not be|cannot be|was not) found)|internal server error|bad gateway"
    r"|access (?:is )?denied|^forbidden\b|fatal error:|uncaught exception|traceback \(most recent|^warning: |connection refused|could not load|something went wrong|^(?:keyerror|typeerror|valueerror|nullpointer)|has been logged"
    r"|(?:activer|activez)[^.\n]{0,20}javascript|page (?:introuvable|non trouvée)|erreur \d{3}|página no (?:encontrada|existe)|(?:habilite|active|activar|active el)[^.\n]{0,20}javascript|página não (?:encontrada|existe)|(?:ative|habilite) o javascript"
    r"|seite (?:nicht gefunden|wurde nicht)|javascript (?:aktivieren|einschalten)|aktivieren sie (?:bitte )?javascript|页面不存在|页面未找到|找不到(?:页面|网页)|请(?:启用|开启)|返回首页重试|访问被拒绝|スクリプトを有効|ページが見つかりません|javascriptを有効|服务不可用"
    r"|الصفحة غير موجودة|(?:تفعيل|فعّل|تمكين) (?:جافا|javascript)|पृष्ठ नहीं मिला|जावास्क्रिप्ट|ไม่พบหน้า|เปิดใช้งาน (?:javascript|จาวา)|ገጹ አልተገኘም",
    re.I,
)
# A sentence with more words than LEAD_WORDS, or with one of these, before the notice tells of it.
LEAD_WORDS = 6
TOLD = re.compile(r"\b(?:that|noted|complained|asked|reported|said|showed|explained|ended in|because|when|during|were|was)\b", re.I)


def literals_of(pattern: re.Pattern) -> list[str] | None:
    """Lower-case texts of which every match of the pattern holds at least one, read off the parsed pattern; None if there are none."""

    def least(x: set[str]) -> tuple[int, int]:
        return min(map(len, x)), -len(x)

    def of(items: Iterable) -> set[str] | None:
        found: list[set[str]] = []
        run = ""
        for op, arg in [*items, (None, None)]:
            if op is sre.LITERAL:
                run += chr(arg).lower()
                continue
            if run:
                found.append({run})
                run = ""
            inner = None
            if op is sre.BRANCH:
                parts = [of(x) for x in arg[1]]
                inner = None if None in parts else set().union(*parts)
            elif op is sre.SUBPATTERN:
                inner = of(arg[3])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and arg[0] > 0:
                inner = of(arg[2])
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
                inner = {chr(c).lower() for _, c in arg}
            if inner:
                found.append(inner)
        return max(found, key=least) if found else None

    keys = of(sre_parser.parse(pattern.pattern, pattern.flags))
    if keys is None:
        return None
    return sorted(k for k in keys if not any(k != other and other in k for other in keys))


NOTICE_KEYS, FIELD_KEYS = literals_of(NOTICE), literals_of(FIELD_TEXT)
PLACE_KEYS = re.compile(r"[{<\[«]|#[A-Za-z]|%%|__|MM|XX|undefined|null \(")
WORD = re.compile(r"\w+")


def told(lead: str) -> bool:
    """Does what stands before a notice in its sentence make it a report on one?"""
    return bool(TOLD.search(lead)) or len(WORD.findall(lead)) > LEAD_WORDS


def may_hold(low: str, keys: list[str] | None) -> bool:
    return keys is None or any(map(low.__contains__, keys))


def folded(text: str) -> str:
    """Lower case, as patterns without regard to case see it: they take four letters beyond ASCII for i, s and k."""
    if not text.isascii():
        text = text.replace("İ", "i").replace("ı", "i").replace("ſ", "s").replace("\u212a", "k")
    return text.lower()


def kind_of_sentence(s: str, words: list[str] | None = None, field: bool = True, notice: bool = True) -> str | None:
    """placeholder, filler, notice or None. field, notice: may the sentence hold such a text, as far as its whole text tells?"""
    words = [w.lower() for w in WORD.findall(s)] if words is None else words
    low = folded(s) if field or notice else ""
    field, notice = field and may_hold(low, FIELD_KEYS), notice and may_hold(low, NOTICE_KEYS)
    if not words:
        return None
    if PLACE_KEYS.search(s) and (m := PLACEHOLDER.search(s)) and not MENTION.search(s[: m.start()]):
        return "placeholder"
    if field and len(words) <= 25 and (m := FIELD_TEXT.search(s)) and not MENTION.search(s[: m.start()]) and not (len(words) > 12 and told(s[: m.start()])):
        return "placeholder"
    if len(words) >= 3 and not LONG_FILLER.isdisjoint(words) and sum(w in LATIN_FILLER for w in words) >= 0.7 * len(words) and ("lorem" in words or len(words) >= 5):
        return "filler"
    if len(words) >= 5 and not KEY_FILLER.isdisjoint(words) and sum(w in KEY_FILLER for w in words) >= 0.8 * len(words):
        return "filler"
    if notice and (m := NOTICE.search(s.strip())) and not told(s.strip()[: m.start()]):
        return "notice"
    return None


def sentences_of(line: str) -> Iterator[str]:
    """Cut at end marks that white space or the line's end follows; dots inside a token (a placeholder's name) do not cut."""
    yield from (x for x in re.split(r"(?<=[.!?。！？।።…])(?:(?<=[。！？])|(?=\s))", line) if x.strip())


def classify_lines(text: str) -> list[tuple[str, int, int, int, int]]:
    """(line, words of placeholders, of filler, of notices, of other running text) for each line with a word; [] for a text without
    evidence. Only lines that hold a literal which any match must have are cut into sentences first; the literals come from the patterns
    themselves, so nothing is lost. Filler is looked for wherever the text has enough words of it."""
    low = folded(text)
    field, notice = may_hold(low, FIELD_KEYS), may_hold(low, NOTICE_KEYS)
    words = WORD.findall(low)
    filler = not LONG_FILLER.isdisjoint(words) or (not KEY_FILLER.isdisjoint(words) and sum(w in KEY_FILLER for w in words) >= 4)
    place = bool(PLACE_KEYS.search(text))
    if not (field or notice or filler or place):
        return []
    lines = text.split("\n")

    def suspect(line: str) -> bool:
        low = folded(line) if field or notice else ""
        return filler or (place and bool(PLACE_KEYS.search(line))) or (field and may_hold(low, FIELD_KEYS)) or (notice and may_hold(low, NOTICE_KEYS))

    if not any(suspect(x) and any(kind_of_sentence(s, None, field, notice) for s in sentences_of(x)) for x in lines):
        return []
    out = []
    for line in lines:
        n = {"placeholder": 0, "filler": 0, "notice": 0, None: 0}
        for s in sentences_of(line):
            words = [w.lower() for w in WORD.findall(s)]
            n[kind_of_sentence(s, words, field, notice)] += len(words) if s.isascii() or not re.search(r"[぀-鿿]", s) else len(s) // 2
        if any(n.values()):
            other = n[None] if n[None] >= 8 else 0  # headings, navigation and the like are no running text
            out.append((line, n["placeholder"], n["filler"], n["notice"], other))
    return out


def line_key(c: Column) -> Column:
    return F.xxhash64(F.lower(F.regexp_replace(F.regexp_replace(F.trim(c), r"\b[0-9a-fA-F]{6,}\b|\d+", "0"), r"\s+", " ")))


def host_lines(documents: DataFrame, text_col: str, host_col: str, recur_docs: int = RECUR_DOCS) -> DataFrame:
    """host, key, docs: in how many documents of the host a normalised line stands."""
    lines = documents.select(F.coalesce(F.col(host_col), F.lit("\u0001")).alias("host"), F.array_distinct(F.transform(F.split(F.col(text_col), "\n"), line_key)).alias("keys"))
    return lines.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("docs")).filter(F.col("docs") >= recur_docs)


def find_residue(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", recur_docs: int = RECUR_DOCS, recur_share: float = RECUR_SHARE, prose_words: int = PROSE_WORDS
) -> DataFrame:
    """doc_id, placeholder, filler, notice, prose: words of each kind in the residual, for the documents to exclude.

    recur_docs, recur_share: a line in so many documents of a host, and in such a share of them, is boilerplate. prose_words: with so
    many words of other running text, notices and boilerplate are no case."""
    host = F.coalesce(F.col(host_col), F.lit("\u0001"))
    cols = documents.select(F.col(id_col).cast("long").alias("doc_id"), host.alias("host"), F.col(text_col).alias("t")).filter("t <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, h, t in zip(pdf["doc_id"], pdf["host"], pdf["t"]):
                lines = classify_lines(t)
                if any(p or f or n for _, p, f, n, _ in lines):
                    rows += [(i, h, *x) for x in lines]
            yield pd.DataFrame(rows, columns=["doc_id", "host", "line", "placeholder", "filler", "notice", "prose"])

    found = cols.mapInPandas(run, "doc_id long, host string, line string, placeholder int, filler int, notice int, prose int")
    totals = documents.groupBy(host.alias("host")).agg(F.count("*").alias("total"))
    recurrent = host_lines(documents, text_col, host_col, recur_docs).join(totals, "host").filter(F.col("docs") >= recur_share * F.col("total")).select("host", "key", F.lit(True).alias("recurs"))
    lines = found.withColumn("key", line_key(F.col("line"))).join(recurrent, ["host", "key"], "left").withColumn("own", F.col("recurs").isNull())
    own = lambda c: F.sum(F.when(F.col("own"), F.col(c)).otherwise(0))
    docs = lines.groupBy("doc_id").agg(
        own("placeholder").alias("placeholder"), own("filler").alias("filler"), F.sum("notice").alias("notice"), own("prose").alias("prose"),
        F.sum(F.expr("placeholder + filler + notice")).alias("evidence"),
    )
    return docs.filter((F.col("placeholder") > 0) | (F.col("filler") > 0) | ((F.col("evidence") > 0) & (F.col("prose") < prose_words))).drop("evidence")
