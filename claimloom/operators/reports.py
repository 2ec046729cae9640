"""Counts over several levels, group rates, stratified sampling, key-wise de-duplication and updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.config import DEFAULTS


def multi_level_counts(df: DataFrame, levels: list[tuple[str, list[str]]], value: str) -> DataFrame:
    """Counts of value alone and within growing key lists, one pass by grouping sets; null keys of a level are dropped.

    levels: (name, keys) from the coarsest on, e.g. [("overall", []), ("review", ["review_id"]), ...]."""
    keys = levels[-1][1]
    sets = ", ".join(f"({', '.join([*ks, value])})" for _, ks in levels)
    grouping = [f"grouping({k}) AS g_{k}" for k in keys]
    out = df.sparkSession.sql(f"SELECT {value}, {', '.join(keys)}, {', '.join(grouping)}, count(*) AS count FROM {{rows}} GROUP BY GROUPING SETS ({sets})", rows=df.select(value, *keys))
    level = F.lit(levels[0][0])
    for name, ks in levels[1:]:
        level = F.when(F.col(f"g_{ks[-1]}") == 0, F.lit(name)).otherwise(level)
    for k in keys:
        out = out.filter((F.col(f"g_{k}") == 1) | F.col(k).isNotNull())
    return out.filter(F.col(value).isNotNull()).select(value, "count", level.alias("level"), *keys)


def bad_rate(df: DataFrame, keys: list[str], bad: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(bad.cast("int")).alias("bad_rate"), F.count("*").alias("n"))


def sampling_plan(df: DataFrame, rates: DataFrame, keys: list[str], key_id: str, priority: str, share: float = DEFAULTS.low_share, least: int = DEFAULTS.low_least, above: float = DEFAULTS.escalate_above, salt: str = DEFAULTS.sample_salt) -> DataFrame:
    """All High rows and min(n, max(least, int(share * n))) Low rows of each group, in the order of a salted hash: repeatable anywhere.

    The number of Low rows comes from a group count joined back, the rank from a window limited to the rows a group can give."""
    low = df.filter(F.col(priority) == "Low")
    size = low.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_take", F.greatest(F.lit(least), F.floor(F.col("_n") * F.lit(float(share)))).cast("int"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.md5(F.concat(F.col(key_id), F.lit(salt))), key_id))
    sampled = low.withColumn("_r", rank).join(size, keys).filter("_r <= _take").select(*keys, key_id, priority)
    rows = df.filter(F.col(priority) == "High").select(*keys, key_id, priority).unionByName(sampled)
    plan = rows.join(rates.select(*keys, "bad_rate"), keys, "left")
    return plan.select(*keys, key_id, priority, (F.coalesce("bad_rate", F.lit(0.0)) > above).alias("escalate_to_full_section"))


def last_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; a hot key costs one aggregation row a partition, no window."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(df.columns)


def update_by_key(base: DataFrame, changes: DataFrame, keys: list[str], cols: list[str], order: list[str]) -> DataFrame:
    """base with cols replaced where changes have the key; of several base rows of a key only the last is updated."""
    last = base.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_last"))
    b = base.join(last, keys, "left")
    new = changes.select(*keys, *[F.col(c).alias(f"_{c}") for c in cols], F.lit(True).alias("_hit")).dropDuplicates(keys)
    j = b.join(new, keys, "left")
    use = F.coalesce("_hit", F.lit(False)) & F.struct(*order).eqNullSafe(F.col("_last"))
    return j.select(*[F.when(use, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns])
