"""Listing profiles: fields of responses, neglect score, snapshots and their differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from localpulse import config as K
from localpulse.functions import columns as C
from localpulse.operators.grid import earliest, latest

INFO = (
    "place_id string, is_claimed boolean, rating struct<value:double,votes_count:int>, category string, additional_categories array<string>, "
    "description string, total_photos int, work_time string, attributes string, rating_distribution map<string,int>, snippet string, unavailable_attributes string"
)


def extract_profile(responses: DataFrame) -> DataFrame:
    """Profile fields of listing responses (``INFO``); absent stays NULL, but description and hours, which count as missing."""
    return responses.select(
        "place_id",
        F.col("is_claimed").cast("int").alias("is_claimed"),
        F.col("rating.value").alias("rating_value"),
        F.col("rating.votes_count").alias("rating_votes"),
        "category",
        F.when(F.col("additional_categories").isNotNull(), F.size("additional_categories")).alias("additional_categories_count"),
        F.when(F.coalesce(F.nullif(F.trim("description"), F.lit("")), F.trim("snippet"), F.lit("")) != "", 1).otherwise(0).alias("has_description"),
        "total_photos",
        F.when(F.coalesce("work_time", F.lit("")) != "", 1).otherwise(0).alias("has_hours"),
        C.leaf_count(F.col("attributes")).alias("attr_available_count"),
        C.leaf_count(F.col("unavailable_attributes")).alias("attr_unavailable_count"),
        C.negative_count(F.col("rating_distribution")).alias("neg_reviews"),
    )


def extract_posts(posts: DataFrame, now: Column) -> DataFrame:
    """Post count, last post and whole days since (``place_id, timestamp``)."""
    last = F.max(C.parse_ts(F.col("timestamp")))
    out = posts.groupBy("place_id").agg(F.count("*").alias("post_count"), last.alias("last_post_ts"))
    return out.withColumn("days_since_post", C.days_since(F.col("last_post_ts"), now))


def signal_conditions() -> dict[str, Column]:
    """When each neglect signal fires; NULL never does."""
    days = F.coalesce(F.col("days_since_post") > K.STALE_DAYS, F.lit(False))
    return {
        "unclaimed": F.col("is_claimed") == 0,
        "stale_posts": (F.col("post_count") == 0) | (F.col("post_count").isNotNull() & days),
        "thin_reviews": F.col("rating_votes") < 10,
        "few_photos": F.col("total_photos") < 10,
        "no_secondary_categories": F.col("additional_categories_count") == 0,
        "no_hours": F.col("has_hours") == 0,
        "sparse_attributes": F.col("attr_available_count") < 3,
        "no_description": F.col("has_description") == 0,
    }


FIELDS = ("is_claimed", "post_count", "days_since_post", "rating_votes", "total_photos", "additional_categories_count", "has_hours", "attr_available_count", "has_description")


def with_neglect(df: DataFrame, weights: dict[str, int] = K.NEGLECT_WEIGHTS) -> DataFrame:
    """``neglect_score`` and the map ``signals`` of fired signals with weight. Fields that ``df`` lacks are unknown."""
    full = df.withColumns({f: F.lit(None).cast("int") for f in FIELDS if f not in df.columns})
    fired = {k: F.coalesce(c, F.lit(False)) for k, c in signal_conditions().items() if weights.get(k, 0) > 0}
    score = F.least(F.lit(100), reduce(lambda a, b: a + b, (F.when(c, weights[k]).otherwise(0) for k, c in fired.items()), F.lit(0)))
    signals = F.map_filter(F.create_map(*(x for k, c in fired.items() for x in (F.lit(k), c))), lambda _, v: v)
    out = full.withColumns({"neglect_score": score.cast("double"), "signals": signals})
    return out.drop(*(f for f in FIELDS if f not in df.columns))


def audit_rows(df: DataFrame) -> DataFrame:
    """Status of an audit, and no score for one that failed."""
    status = F.when(F.col("failed"), "error").when(F.col("found"), "complete").otherwise("no_data")
    return df.withColumn("status", status).withColumn("neglect_score", F.when(F.col("status") == "complete", F.col("neglect_score")))


def rescore(audits: DataFrame, weights: dict[str, int]) -> DataFrame:
    """Snapshots with the score under ``weights`` and whether it moved; running it again moves nothing."""
    new = with_neglect(audits.withColumnsRenamed({"neglect_score": "old_score"}).drop("signals"), weights)
    return new.withColumn("moved", ~F.col("old_score").eqNullSafe(F.col("neglect_score")))


def latest_audits(audits: DataFrame) -> DataFrame:
    return latest(audits.where("status = 'complete'"), ["place_id"], ["id"])


def baseline_audits(audits: DataFrame) -> DataFrame:
    return earliest(audits.where("status = 'complete' AND audit_type IN ('baseline', 'prospect')"), ["place_id"], ["audited_ts", "id"])


def diff_profiles(audits: DataFrame) -> DataFrame:
    """Baseline against the latest other snapshot: count changes, gained fields, resolved signals; claim status is not shown."""
    base = with_neglect(baseline_audits(audits)).alias("b")
    cur = with_neglect(latest(audits.where("status = 'complete'"), ["place_id"], ["audited_ts", "id"])).alias("c")
    hidden = F.array(F.lit("unclaimed"))
    resolved = F.array_sort(F.array_except(F.array_except(F.map_keys("b.signals"), F.map_keys("c.signals")), hidden))
    pairs = base.join(cur, "place_id").where("b.id <> c.id")
    return pairs.select(
        "place_id",
        F.col("b.id").alias("base_id"),
        F.col("c.id").alias("cur_id"),
        (F.col("c.rating_votes") - F.col("b.rating_votes")).alias("votes_delta"),
        (F.col("c.total_photos") - F.col("b.total_photos")).alias("photos_delta"),
        ((F.col("b.has_hours") == 0) & (F.col("c.has_hours") == 1)).alias("hours_added"),
        (F.col("b.neglect_score") - F.col("c.neglect_score")).alias("neglect_improvement"),
        F.array_join(resolved, ",").alias("resolved"),
    )


def recently_audited(audits: DataFrame, since: Column) -> DataFrame:
    return audits.where((F.col("audited_ts") >= since) & F.col("status").isin("complete", "no_data")).select("place_id").distinct()


def compare_sources(stored: DataFrame, live: DataFrame) -> DataFrame:
    """Both sources' rating, votes and hours side by side with what agrees."""
    s, v = stored.alias("s"), live.alias("v")
    gap = F.abs(F.col("s.votes") - F.col("v.votes"))
    sure = lambda c: F.coalesce(c, F.lit(False))
    return s.join(v, "place_id").select(
        "place_id",
        sure(F.abs(F.col("s.rating") - F.col("v.rating")) <= 0.11).alias("rating_ok"),
        sure(gap <= F.greatest(F.lit(2.0), F.col("v.votes") * 0.05)).alias("votes_ok"),
        F.col("s.has_hours").eqNullSafe(F.col("v.has_hours")).alias("hours_ok"),
        sure(gap > F.greatest(F.lit(5.0), F.col("v.votes") * 0.2)).alias("votes_far"),
    )


def reliability(compared: DataFrame) -> DataFrame:
    n = F.nullif(F.count("*"), F.lit(0))
    return compared.agg(F.count("*").alias("n"), *((F.count_if(F.col(c)) / n).alias(f"{c}_share") for c in ("rating_ok", "votes_ok", "hours_ok", "votes_far")))


def stratified(audits: DataFrame, n_unclaimed: int, n_claimed: int) -> DataFrame:
    """Unclaimed places by reviews, claimed ones with at least five reviews by id; both samples in one table."""
    open_ = audits.where("is_claimed = 0").orderBy(F.desc_nulls_last("rating_votes"), "place_id").limit(n_unclaimed)
    held = audits.where("is_claimed = 1 AND rating_votes >= 5").orderBy("place_id").limit(n_claimed)
    return open_.select("place_id", F.lit("unclaimed").alias("stratum")).unionByName(held.select("place_id", F.lit("claimed").alias("stratum")))
