"""References to records that do not exist: orphan references per referred table and month.

Keys are text, so the distinct keys of both sides and of all referred tables are first given dense integers in sort order: range
partitioning, then a running number inside each partition and the offset of the partitions before it (one count for each partition).
From there on references and lifetimes carry the integer. Parent integers are compressed into contiguous runs. Each distinct reference
key is matched as-of to the last run start at or before it, and lies beyond that run's end if no parent has it: `missing`. As-of
matching is a window over blocks of consecutive integers; runs are cut at block borders, so no window spans more than a block. Keys
that exist meet the lifetimes of their records: none live at the time of reference means `late` (a record starts later) or else
`deleted`. Records live at a time are starts up to it less ends up to it: a running sum within each hour of a key, on top of what the
key's earlier hours leave, so one key that holds a third of all rows is split by its hours.

References are reduced to distinct (key, time) before that. Defined results: null and empty values are the same "no value"; a null
start means live from ever, a null end means live for ever; a null reference time sees every record as live and gives a null month;
exact repeats count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.session import cut

BLOCK = 1 << 16
HOUR = 3_600_000_000  # in microseconds


def normal_path(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.translate(F.coalesce(c, F.lit("")), "\\", "/"), r"^\s+|\s+$", ""))


def normal_name(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", ""))


def dense_integers(keys: DataFrame) -> DataFrame:
    """key -> n, dense from 0 in the order of key. keys has one distinct column `key`."""
    ranged = cut(keys.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("part").agg(F.count("*").alias("rows"))  # one row for each partition
    offsets = counts.withColumn("off", F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).select("part", "off")
    numbered = ranged.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("key")))
    return numbered.join(F.broadcast(offsets), "part").select("key", (F.col("off") + F.col("k") - 1).alias("n"))


def contiguous_runs(ids: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs (block, run_start, run_end) of the distinct integers n, cut at block borders."""
    b = ids.select("n", F.floor(F.col("n") / block).alias("block"))
    w = Window.partitionBy("block").orderBy("n")
    grouped = b.withColumn("run", F.col("n") - F.row_number().over(w)).groupBy("block", "run")
    return grouped.agg(F.min("n").alias("run_start"), F.max("n").alias("run_end")).drop("run")


def beyond_runs(refs: DataFrame, runs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Those integers n of refs that lie in no run: as-of match to the preceding run start, then the end decides."""
    r = refs.select(F.floor(F.col("n") / block).alias("block"), F.col("n").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("run_end"))
    s = runs.select("block", F.col("run_start").alias("at"), F.lit(0).alias("kind"), "run_end")
    w = Window.partitionBy("block").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = s.unionByName(r).withColumn("end", F.last("run_end", ignorenulls=True).over(w))
    return seen.filter("kind = 1 AND (end IS NULL OR at > end)").select(F.col("at").alias("n"))


def live_counts(events: DataFrame) -> DataFrame:
    """events(n, t, kind, step, ...) with live: the sum of step over the key's events up to each, kind 0 before 1 at one time, null first."""
    e = events.withColumn("hour", F.coalesce(F.floor(F.unix_micros("t") / HOUR), F.lit(-(1 << 60))))
    whole = e.groupBy("n", "hour").agg(F.sum("step").alias("step"))
    before = Window.partitionBy("n").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select("n", "hour", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("carried"))
    inside = Window.partitionBy("n", "hour").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return e.withColumn("inside", F.sum("step").over(inside)).join(carried, ["n", "hour"]).withColumn("live", F.col("inside") + F.col("carried")).drop("hour", "inside", "carried")


def find_orphans(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """refs(key, at), parents(key, start, end) -> key, at, reason for the references without a live record."""
    return orphans_of(refs.select("key", "at", F.col("key").alias("_key")), parents).select(F.col("_key").alias("key"), "at", "reason").distinct()


def orphans_of(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """refs(key, at, ...), parents(key, start, end) -> the references without a live record, with reason in place of key."""
    sides = refs.select("key", F.lit(1).alias("w"), F.lit(0).alias("h")).unionByName(parents.select("key", F.lit(0).alias("w"), F.lit(1).alias("h")))
    sides = cut(sides.groupBy("key").agg(F.max("w").alias("w"), F.max("h").alias("h")))
    numbered = cut(dense_integers(sides.select("key")).join(sides, "key"))
    gone = beyond_runs(numbered.filter("w = 1").select("n"), contiguous_runs(numbered.filter("h = 1").select("n")))
    asked = cut(refs.join(numbered.select("key", "n"), "key").drop("key"))
    lives = cut(parents.distinct().join(numbered.filter("w = 1").select("key", "n"), "key").drop("key"))
    missing = asked.join(gone, "n", "left_semi").withColumn("reason", F.lit("missing"))
    # records live at a time
    latest = lives.groupBy("n").agg(F.max("start").alias("latest"))
    wanted = asked.filter("at IS NOT NULL").select("n", "at").distinct().join(latest, "n").select("n", F.col("at").alias("t"), F.lit(1).alias("kind"), F.lit(0).alias("step"), "latest")
    none = F.lit(None).cast("timestamp").alias("latest")
    sound = lives.filter("start IS NULL OR end IS NULL OR start < end")  # others are never live
    starts = sound.select("n", F.col("start").alias("t"), F.lit(0).alias("kind"), F.lit(1).alias("step"), none)
    ends = sound.filter("end IS NOT NULL").select("n", F.col("end").alias("t"), F.lit(0).alias("kind"), F.lit(-1).alias("step"), none)
    seen = live_counts(wanted.unionByName(starts).unionByName(ends)).filter("kind = 1 AND live = 0")
    dead = seen.select("n", F.col("t").alias("at"), F.when(F.col("latest") > F.col("t"), F.lit("late")).otherwise(F.lit("deleted")).alias("reason"))
    return missing.unionByName(asked.join(dead, ["n", "at"])).drop("n")


def orphan_references(registry: DataFrame, inventory: DataFrame, references: DataFrame) -> DataFrame:
    """claim_id, ref_table, reason, ref_month for the registry's orphan references; one row for each claim, table, reason and month."""
    sep = F.lit("\u0001")
    tables = ["file_inventory", "references_index"]  # their place in the list begins a key
    path = normal_path(F.col("source_pdf_path"))
    entry = F.concat(F.coalesce("review_id", F.lit("")), sep, normal_name(F.col("citation_author")), sep, F.lower(F.coalesce("citation_year", F.lit(""))))
    own = F.concat(F.coalesce("review_id", F.lit("")), sep, normal_name(F.col("first_author")), sep, F.lower(F.coalesce("year", F.lit(""))))
    keys = F.array(F.when(path != "", F.concat(F.lit("0"), path)), F.when(F.col("in_reference_list"), F.concat(F.lit("1"), entry)))
    refs = registry.select("claim_id", F.col("extracted_at").cast("timestamp").alias("at"), F.explode(F.array_compact(keys)).alias("key"))
    files = inventory.select(F.concat(F.lit("0"), normal_path(F.col("path"))).alias("key"), F.col("registered_at").cast("timestamp").alias("start"), F.col("deleted_at").cast("timestamp").alias("end"))
    cites = references.select(F.concat(F.lit("1"), own).alias("key"), F.col("indexed_at").cast("timestamp").alias("start"), F.col("withdrawn_at").cast("timestamp").alias("end"))
    names = F.array(*[F.lit(t) for t in tables])
    found = orphans_of(refs.withColumn("t", F.substr("key", F.lit(1), F.lit(1)).cast("tinyint")), files.unionByName(cites))
    return found.select("claim_id", names[F.col("t").cast("int")].alias("ref_table"), "reason", F.date_format("at", "yyyy-MM").alias("ref_month")).distinct()


def orphan_report(orphans: DataFrame) -> DataFrame:
    return orphans.groupBy("ref_table", "ref_month", "reason").agg(F.count("*").alias("orphans"))
