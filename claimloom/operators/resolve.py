"""Which file a citation means: three algorithms, each an equi-join on tokens or pieces instead of a nested loop over all files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.config import DEFAULTS
from claimloom.functions.scalars import author_key, author_variants, basename, blank_to_null, candidate_names, first_year, mined_authors, norm_lead, norm_stem, stem, strip, surname_key, year_digits
from claimloom.operators.textops import citation_parts
from claimloom.session import cut


def inventory(files: DataFrame, path: str = "path") -> DataFrame:
    """path, name, stem_norm, year of each distinct file."""
    s = stem(F.col(path))
    return files.select(path).distinct().select(F.col(path).alias("path"), basename(F.col(path)).alias("name"), norm_stem(s).alias("stem_norm"), first_year(norm_stem(s)).alias("year"))


def year_base(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d{4})", 1), F.lit(""))


def year_for_author(author: Column, citation: Column) -> Column:
    """The year of the first part of a citation of several works that names the author; null where no part does."""
    key = F.coalesce(author_key(author), F.lit(""))
    padded = lambda x: F.concat(F.lit("_"), x, F.lit("_"))
    parts = F.transform(citation_parts(citation), norm_stem)
    mine = F.filter(parts, lambda p: F.contains(padded(p), padded(key)) | F.contains(padded(p), padded(F.replace(key, F.lit("_"), F.lit("")))))
    years = F.filter(F.transform(mine, lambda p: first_year(p)), lambda y: y.isNotNull())
    return F.when(key != "", F.try_element_at(years, F.lit(1)))


def contained(variants: DataFrame, stems: DataFrame) -> DataFrame:
    """variants(v), stems(stem_norm, ...) -> v, as_word and the stems' columns for each v inside a stem. They meet on the first four
    letters of v, or all of a shorter one, which a stem that holds v has at some place."""
    at = F.sequence(F.lit(1), F.greatest(F.length("stem_norm"), F.lit(1)))
    pieces = F.array_distinct(F.flatten(F.transform(at, lambda p: F.array(*[F.substr("stem_norm", p, F.lit(n)) for n in range(1, 5)]))))
    met = variants.withColumn("piece", F.substr("v", F.lit(1), F.lit(4))).join(stems.withColumn("piece", F.explode(pieces)), "piece").drop("piece")
    as_word = F.contains(F.concat(F.lit("_"), "stem_norm", F.lit("_")), F.concat(F.lit("_"), "v", F.lit("_")))
    return met.filter(F.contains("stem_norm", F.col("v"))).withColumn("as_word", as_word)


def weighted(claims: DataFrame, files: DataFrame, compat: bool = False) -> DataFrame:
    """claim_id -> path, score. The year is that of the part of the citation that names the author, else the claim's own, the primary
    source's, the first in the text; compat: the first in the text comes before the claim's own. Year equal +10, unequal out; primary key as a word +4, inside one +2; other variants as words +2 each,
    inside one +1; best, at least 2, ties by path. A file scores by the variants its stem holds and by its year: claims meet files on
    variant and year, and the first file of their year, which stands for all that have nothing but the year."""
    mine, own, any_year = year_for_author(F.col("citation_author"), F.col("citation_text")), [F.lower(blank_to_null(F.col(c))) for c in ("citation_year", "primary_mentioned_year")], first_year(F.col("citation_text"))
    want = F.coalesce(mine, *([any_year, *own] if compat else [*own, any_year]))
    variants = F.array_distinct(F.concat(author_variants(F.col("citation_author")), mined_authors(F.col("citation_text")), author_variants(F.col("primary_mentioned_author"))))
    c = cut(claims.select("claim_id", year_base(want).alias("want"), author_key(F.col("citation_author")).alias("primary"), variants.alias("variants")))
    f = files.select("path", "stem_norm", year_base(F.col("year")).alias("have"))
    # a claim's year meets files of that year and of none (?); a claim of no year meets all (*)
    asked = c.select("claim_id", "want", "primary", F.explode("variants").alias("v")).filter("v <> ''")
    asked = asked.withColumn("on_year", F.explode(F.when(F.col("want").isNull(), F.array(F.lit("*"))).otherwise(F.array("want", F.lit("?")))))
    hits = contained(asked.select("v").distinct(), f).withColumn("on_year", F.explode(F.array(F.coalesce("have", F.lit("?")), F.lit("*"))))
    points = F.when(F.col("v") == F.col("primary"), F.when(F.col("as_word"), 4).otherwise(2)).otherwise(F.when(F.col("as_word"), 2).otherwise(1))
    year = F.when(F.col("on_year") == F.col("want"), 10).otherwise(0)
    named = asked.join(hits, ["v", "on_year"]).groupBy("claim_id", "path").agg((F.sum(points) + F.max(year)).cast("int").alias("score"))
    first = f.groupBy(F.col("have").alias("want")).agg(F.min("path").alias("path"))
    scored = named.filter("score >= 2").unionByName(c.join(first, "want").select("claim_id", "path", F.lit(10).alias("score")))
    return scored.groupBy("claim_id").agg(F.min_by(F.struct("path", "score"), F.struct((-F.col("score")).alias("s"), "path")).alias("b")).select("claim_id", "b.path", "b.score")


def fill_paths(claims: DataFrame, files: DataFrame, compat: bool = False) -> DataFrame:
    """claim_id, source_pdf_path: a path that stands is kept with its slashes turned; only a blank one is resolved, "" if nothing fits."""
    blank = blank_to_null(F.col("source_pdf_path")).isNull()
    got = weighted(claims.filter(blank), files, compat).select("claim_id", F.translate("path", "\\", "/").alias("found"))
    kept = F.when(~blank, F.translate(strip(F.col("source_pdf_path")), "\\", "/"))
    return claims.join(got, "claim_id", "left").select("claim_id", F.coalesce(kept, "found", F.lit("")).alias("source_pdf_path"))


def ranked(names: DataFrame, words: DataFrame) -> DataFrame:
    """names(name, ...), words(t, n) -> also ws: the name's known words, rarest first, joined; names without one are left out."""
    t = names.withColumn("t", F.explode(F.array_distinct(F.split("name", "_"))))
    return t.join(words, "t").groupBy(*names.columns).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "t"))), lambda x: x["t"]), "_").alias("ws"))


def choices(sets: DataFrame, most: int) -> DataFrame:
    """sets(ws, ...) -> also key, size: each choice of one to `most` of the words, in their order. Rows are made one by one, so a long
    name takes no memory."""
    got = sets.withColumns({"each": F.split("ws", "_"), "key": F.lit(""), "size": F.lit(0), "at": F.lit(0)})
    for _ in range(most):
        # the next word is one behind the last; the last one's own place means that no more follow
        got = got.withColumn("next", F.explode(F.sequence("at", F.size("each"))))
        more, word = F.col("next") > F.col("at"), F.get("each", F.col("next") - 1)
        key = F.when(~more, F.col("key")).when(F.col("size") == 0, word).otherwise(F.concat("key", F.lit("_"), word))
        got = got.select(*sets.columns, "each", key.alias("key"), (F.col("size") + more.cast("int")).alias("size"), F.when(more, F.col("next")).otherwise(F.size("each")).alias("at"))
    return got.filter("size > 0").drop("each", "at")


def most_shared(names: DataFrame, files: DataFrame, most: int = 3) -> DataFrame:
    """names(name), files(name, path), each distinct -> name, path, shared: the file that shares most words with a name, ties by path.
    Both sides meet on choices of up to `most` words. Of the files with a choice only the first by path counts, as long as no more words
    are shared, so a frequent word is one row. More are shared only by pairs that meet on `most` words before the file's last one."""
    words = files.select(F.explode(F.array_distinct(F.split("name", "_"))).alias("t")).filter("t <> ''").groupBy("t").agg(F.count("*").alias("n"))
    f = ranked(files, words).select("ws", "path")
    first = choices(f, most).groupBy("key").agg(F.min("path").alias("path"), F.max("size").alias("size")).withColumn("theirs", F.lit(None).cast("string"))
    long = f.filter(F.size(F.split("ws", "_")) > most).select(F.regexp_replace("ws", "_[^_]*$", "").alias("ws"), "path", F.col("ws").alias("theirs"))
    met = first.unionByName(choices(long, most).filter(F.col("size") == most).select("key", "path", "size", "theirs"))
    asked = ranked(names, words)
    shared = F.when(F.col("theirs").isNull(), F.col("size")).otherwise(F.size(F.array_intersect(F.split("ws", "_"), F.split("theirs", "_"))))
    hits = choices(asked.select("ws").distinct(), most).select("ws", "key").join(met, "key").select("ws", (-shared).alias("s"), "path")
    best = hits.groupBy("ws").agg(F.min(F.struct("s", "path")).alias("b"))
    return asked.join(best, "ws").select("name", "b.path", (-F.col("b.s")).alias("shared"))


def overlapping(claims: DataFrame, files: DataFrame) -> DataFrame:
    """claim_id -> path, shared: an exact stem first, else the file that shares most tokens with a candidate name; ties by path. The first
    candidate has all words of the second, which so has a say in exact stems only. A claim without an id has a row for either."""
    cands = F.transform(candidate_names(F.col("citation_text")), lambda x: F.lower(x))
    c = claims.select("claim_id", cands.alias("cands")).select("claim_id", F.element_at("cands", 1).alias("name"), F.element_at("cands", -1).alias("lead"))
    stems = files.select(F.lower(norm_lead(stem(F.col("path")))).alias("name"), "path").groupBy("name").agg(F.min("path").alias("path"))
    by_words = most_shared(c.select("name").distinct(), stems).select("name", F.col("path").alias("op"), "shared")
    exact = [stems.select(F.col("name").alias(k), F.struct("path").alias(f"by_{k}")) for k in ("name", "lead")]
    both = c.join(by_words, "name", "left").join(exact[0], "name", "left").join(exact[1], "lead", "left").withColumn("e", F.coalesce("by_name", "by_lead"))
    row = lambda path, shared: F.struct(path.alias("path"), shared.cast("int").alias("shared"))
    is_exact, is_shared, e, op, shared = F.col("e").isNotNull(), F.col("shared").isNotNull(), F.col("e.path"), F.col("op"), F.col("shared")
    one = F.when(is_exact | is_shared, F.array(row(F.coalesce(e, op), F.when(e.isNull(), shared))))
    two = F.array_compact(F.array(F.when(is_exact, row(e, F.lit(None))), F.when(is_shared, row(op, shared))))
    return both.select("claim_id", F.inline(F.when(F.col("claim_id").isNull(), two).otherwise(one)))


def strict(claims: DataFrame, files: DataFrame, overrides: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """claim_id, author_key, year_key, path, mapping_note by exact (surname, year). overrides: (surname, year) -> file name, if there."""
    parts = F.split(stem(F.col("path")), "_")
    index = files.select("name", surname_key(F.element_at(parts, 1)).alias("author_key"), year_digits(stem(F.col("path"))).alias("year_key")).filter("author_key <> '' AND year_key IS NOT NULL")
    index = index.groupBy("author_key", "year_key").agg(F.min_by("name", F.struct(F.length("name"), "name")).alias("found"))
    c = claims.select("claim_id", surname_key(F.col("citation_author")).alias("author_key"), year_digits(F.col("citation_year")).alias("year_key"), F.col("source_pdf_path").alias("old"))
    joined = c.join(index, ["author_key", "year_key"], "left")
    if overrides:
        spark = claims.sparkSession
        o = spark.createDataFrame([(a, y, n) for (a, y), n in overrides.items()], "author_key string, year_key string, name string").join(files.select("name"), "name", "left_semi")
        joined = joined.join(o.withColumnRenamed("name", "forced"), ["author_key", "year_key"], "left")
    else:
        joined = joined.withColumn("forced", F.lit(None).cast("string"))
    old_name = F.nullif(F.trim(basename(F.coalesce("old", F.lit("")))), F.lit(""))
    no_key = (F.col("author_key") == "") | F.col("year_key").isNull()
    got = F.coalesce("forced", "found")
    note = (
        F.when(no_key, "").when(F.col("forced").isNotNull(), "override").when(got.isNull(), "no_exact_author_year_pdf")
        .when(old_name.isNotNull() & (old_name != got), F.concat(F.lit("corrected_from:"), old_name)).otherwise("")
    )
    path = F.when(no_key, F.coalesce("old", F.lit(""))).otherwise(F.coalesce(F.concat(F.lit(f"{DEFAULTS.sources_dir}/"), got), F.lit("")))
    return joined.select("claim_id", "author_key", F.coalesce("year_key", F.lit("")).alias("year_key"), path.alias("path"), note.alias("mapping_note"))
