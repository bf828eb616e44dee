"""Keyed tables: merges, replacements, work lists and status counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFRESHABLE = ("name", "website", "review_count")


def merge_businesses(old: DataFrame, new: DataFrame, now: Column, refresh: bool = False) -> DataFrame:
    """Upsert sightings (``place_id, name, website, review_count, state_code, trade_bucket, relevance, found_via, seq``).

    New keys are inserted from their first sighting (and, with ``refresh``, the
    refreshable fields of their last); known keys unite provenance and touch the
    refresh time. ``action`` tells inserted, updated and kept rows apart.
    """
    fixed = ("state_code", "trade_bucket", "relevance")
    first = [F.min_by(c, "seq").alias(c) for c in fixed]
    chosen = [(F.max_by if refresh else F.min_by)(c, "seq").alias(c) for c in REFRESHABLE]
    sightings = new.groupBy("place_id").agg(*first, *chosen, F.array_sort(F.array_distinct(F.flatten(F.collect_list("found_via")))).alias("found_via"), F.count("*").alias("sightings"))
    o, n = old.alias("o"), sightings.alias("n")
    both = o.join(n, "place_id", "full")
    known, seen = F.col("o.first_seen").isNotNull(), F.col("n.sightings").isNotNull()
    pick = lambda c: F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)
    fresh = lambda c: (F.when(known & (~seen if refresh else F.lit(True)), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))).alias(c)
    none = F.array().cast("array<string>")
    via = F.array_sort(F.array_union(F.coalesce("o.found_via", none), F.coalesce("n.found_via", none)))
    return both.select(
        "place_id",
        *(pick(c) for c in fixed),
        *(fresh(c) for c in REFRESHABLE),
        via.alias("found_via"),
        F.when(known, F.col("o.first_seen")).otherwise(now).alias("first_seen"),
        F.when(seen, now).otherwise(F.col("o.last_refreshed")).alias("last_refreshed"),
        F.when(~known, "inserted").when(seen, "updated").otherwise("kept").alias("action"),
        F.coalesce("n.sightings", F.lit(0)).cast("bigint").alias("sightings"),
    )


def merge_counters(merged: DataFrame) -> DataFrame:
    """Inserted rows, and sightings beyond the inserting ones."""
    ins = F.count_if(F.col("action") == "inserted")
    return merged.agg(ins.alias("inserted"), (F.sum("sightings") - ins).alias("updated"))


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(new, keys, "left_anti").unionByName(new)


def upsert_pins(old: DataFrame, new: DataFrame) -> DataFrame:
    """New pins in, known pins take the new rank; everything else of a known pin stays."""
    on = ["place_id", "row", "col", "keyword"]
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    return o.join(n, on, "full").select(*on, F.coalesce("o.scan_id", "n.scan_id").alias("scan_id"), F.when(F.col("n._new"), F.col("n.rank")).otherwise(F.col("o.rank")).alias("rank"))


def commit_cells(results: DataFrame) -> DataFrame:
    """Only complete cells are marked as swept; a partial sweep keeps its businesses but not the mark."""
    return results.where("complete").select("cell_id", "bucket", "found", "saturated")


def pending(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(done.select(*keys), keys, "left_anti")


def restrict(df: DataFrame, cohort: DataFrame, key: str = "place_id") -> DataFrame:
    return df.join(cohort, key, "left_semi")


def store_status(biz: DataFrame) -> DataFrame:
    return biz.agg(F.count("*").alias("businesses"), F.count_if(F.col("no_website") == 1).alias("no_website"), F.countDistinct(F.nullif("state_code", F.lit(""))).alias("states"))


def top_k(df: DataFrame, n: int, order: list) -> DataFrame:
    return df.orderBy(*order).limit(n)


def open_run(runs: DataFrame, region: str, budget: float, mode: str, now: Column) -> DataFrame:
    """The ledger with one more row, which has spent nothing yet."""
    number = (runs.agg(F.max("run_id")).first()[0] or 0) + 1
    row = runs.sparkSession.range(1).select(F.lit(number).cast("bigint").alias("run_id"), F.lit(region).alias("region"), F.lit(budget).alias("budget"), F.lit(mode).alias("mode"), now.alias("started_ts"), F.lit(None).cast("timestamp").alias("ended_ts"), F.lit(0).cast("bigint").alias("requests"), F.lit(0.0).alias("cost"))
    return runs.unionByName(row)


def finish_run(runs: DataFrame, results: DataFrame) -> DataFrame:
    """The ledger with end, requests and cost of the runs in ``results`` (``run_id, ended_ts, requests, cost``)."""
    r, n = runs.alias("r"), results.alias("n")
    later = lambda c: F.coalesce(f"n.{c}", f"r.{c}").alias(c)
    return r.join(n, "run_id", "left").select("run_id", "region", "budget", "mode", "started_ts", later("ended_ts"), later("requests"), F.round(F.coalesce("n.cost", "r.cost"), 2).alias("cost"))
