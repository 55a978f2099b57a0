"""The correction cache as a table: text_hash, text, changes, confidence, model, created_at, hits, last_accessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import text_hash

MOST, DAYS = 10_000, 30


def live(cache: DataFrame, now: Column, days: int | None = DAYS) -> DataFrame:
    """Entries not older than ``days``; None keeps all."""
    return cache if days is None else cache.where(F.col("created_at") >= now - F.make_interval(days=F.lit(days)))


def looked_up(texts: DataFrame, cache: DataFrame, column: str = "text") -> DataFrame:
    """texts with text_hash, hit and cached (a struct of the entry); one key, so repeated texts share an entry."""
    entries = cache.select(F.col("text_hash").alias("__h"), F.struct(*[c for c in cache.columns if c != "text_hash"]).alias("cached"))
    joined = texts.withColumn("text_hash", text_hash(F.col(column))).join(entries, F.col("text_hash") == F.col("__h"), "left")
    return joined.withColumn("hit", F.col("__h").isNotNull()).drop("__h")


def missing(texts: DataFrame, cache: DataFrame, column: str = "text") -> DataFrame:
    """texts without an entry."""
    return texts.withColumn("text_hash", text_hash(F.col(column))).join(cache.select("text_hash"), "text_hash", "left_anti")


def written(cache: DataFrame, new: DataFrame, most: int = MOST) -> DataFrame:
    """The cache with new entries, the later of a key kept, and evicted to ``most``: the fewest hits go first, of equals the oldest, then by hash."""
    rank = F.row_number().over(Window.partitionBy("text_hash").orderBy(F.desc("__new"), F.desc("created_at")))
    both = cache.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    once = both.withColumn("__k", rank).where("__k = 1").drop("__k", "__new")
    kept = once.orderBy(F.desc("hits"), F.desc("created_at"), F.desc("text_hash")).limit(most)
    return kept


def touched(cache: DataFrame, looked: DataFrame, now: Column) -> DataFrame:
    """The cache after lookups: hits counted, time of the last one noted."""
    hits = looked.where("hit").groupBy("text_hash").agg(F.count("*").alias("__n"))
    joined = cache.join(hits, "text_hash", "left")
    return joined.withColumn("hits", F.col("hits") + F.coalesce("__n", F.lit(0))).withColumn("last_accessed", F.when(F.col("__n").isNotNull(), now).otherwise(F.col("last_accessed"))).drop("__n")


def figures(looked: DataFrame) -> DataFrame:
    """(hits, misses, hit_rate)."""
    return looked.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), F.coalesce(F.round(F.try_divide(F.count_if("hit") * 100.0, F.count("*")), 2), F.lit(0.0)).alias("hit_rate"))


def run_figures(looked: DataFrame, before: DataFrame, new: DataFrame, most: int = MOST) -> DataFrame:
    """One row of a run: hits, misses, hit_rate, writes (entries given), evictions (what ``written`` lets go), entries after it and how many there may be."""
    keys = before.select("text_hash").unionByName(new.select("text_hash")).agg(F.countDistinct("text_hash").alias("keys"))
    wrote = new.agg(F.count("*").alias("writes"))
    row = figures(looked).crossJoin(wrote).crossJoin(keys)  # of one row each
    return row.withColumn("evictions", F.greatest(F.col("keys") - most, F.lit(0))).withColumn("entries", F.least(F.col("keys"), F.lit(most))).withColumn("max_entries", F.lit(most)).drop("keys")


def contains(texts: DataFrame, cache: DataFrame, column: str = "text") -> DataFrame:
    return looked_up(texts, cache, column).drop("cached")


def cleared(cache: DataFrame) -> DataFrame:
    return cache.limit(0)
