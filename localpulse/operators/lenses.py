"""Ranked views of the store: opportunity, budget and profile lenses, and their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.functions import columns as C
from localpulse.operators.ordering import ranked


def lead_view(biz: DataFrame, enrichment: DataFrame, contacts: DataFrame) -> DataFrame:
    return biz.join(enrichment, "place_id", "left").join(contacts, "place_id", "left")


def profile_view(biz: DataFrame, latest_audits: DataFrame, contacts: DataFrame) -> DataFrame:
    return biz.join(latest_audits, "place_id").join(contacts, "place_id", "left")


def _tier() -> Column:
    return F.when(F.col("relevance") == "match", 0).when(F.col("relevance") == "maybe", 1).otherwise(9)


def opportunity_order() -> list[Column]:
    """Tier, bucket, weakest live site, most reviews, name, key."""
    return [_tier(), C.opp_bucket(F.col("no_website"), F.col("site_status")), F.desc(F.coalesce("readiness_score", F.lit(-1))), F.desc(F.coalesce("review_count", F.lit(0))), F.coalesce("name", F.lit("")), F.col("place_id")]


def with_budget(leads: DataFrame, min_reviews: int = 20) -> DataFrame:
    signal = C.paid_signal(F.col("google_ads"), F.col("mgmt_status"), F.col("marketing_tags"))
    gap = C.has_gap(F.col("no_website"), F.col("site_status"), F.col("readiness_score"))
    tier = C.budget_tier(signal, F.col("review_count"), gap, min_reviews)
    why = F.when(F.col("no_website") == 1, "no site").when((F.coalesce("site_status", F.lit("")) != "") & (F.col("site_status") != "live"), "dead/blocked site").otherwise("weak site")
    reason = F.when(tier == 1, signal).when(tier == 2, F.concat(F.lit("busy: "), F.coalesce("review_count", F.lit(0)).cast("string"), F.lit(" reviews, "), why)).otherwise("")
    label = F.when(tier == 1, "PROVEN BUDGET").when(tier == 2, "QUALIFIED DEMAND").otherwise("long tail")
    return leads.withColumns({"budget_tier": tier, "budget_label": label, "budget_reason": reason})


def budget_order() -> list[Column]:
    """Tier 1 weakest site first, the others busiest first."""
    score, reviews = F.coalesce("readiness_score", F.lit(-1)), F.coalesce("review_count", F.lit(0))
    first = F.col("budget_tier") == 1
    return [F.col("budget_tier"), F.desc(F.when(first, score).otherwise(reviews)), F.desc(F.when(first, reviews).otherwise(score)), F.coalesce("name", F.lit("")), F.col("place_id")]


def profile_order() -> list[Column]:
    return [_tier(), F.desc_nulls_last("neglect_score"), F.desc(F.coalesce("review_count", F.lit(0))), F.coalesce("name", F.lit("")), F.col("place_id")]


def pitch_order() -> list[Column]:
    return [F.desc(F.coalesce("rating", F.lit(0))), F.desc(F.coalesce("complaint_count", F.lit(0))), F.asc(F.coalesce("rating_votes", F.lit(0))), F.col("place_id")]


def shortlist_order() -> list[Column]:
    """Weakest site first, then the busiest."""
    return [F.desc(F.coalesce("readiness_score", F.lit(-1))), F.desc(F.coalesce("review_count", F.lit(0))), F.col("place_id")]


def state_totals(leads: DataFrame) -> DataFrame:
    return leads.groupBy("state_code").agg(F.count("*").alias("leads"), F.count_if(F.col("no_website") == 1).alias("no_site")).orderBy(F.desc("leads"), "state_code")


def shortlist(biz: DataFrame, enrichment: DataFrame, measured: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Leads with a live, scored site that are not yet measured; explicit ``keys`` (``place_id``) take that filter's place. Rank them by ``shortlist_order``."""
    joined = biz.join(enrichment, "place_id", "left").join(measured.select("place_id"), "place_id", "left_anti")
    if keys is not None:
        return joined.join(keys.select("place_id"), "place_id", "left_semi")
    return joined.where((F.coalesce("website", F.lit("")) != "") & (F.col("no_website") == 0) & F.col("readiness_score").isNotNull())


def to_record(leads: DataFrame) -> DataFrame:
    """Lead rows (with ``with_budget``) as display records of the opportunity and budget lenses."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    tier = F.when(F.col("relevance") == "match", "CONFIRMED").when(F.col("relevance") == "maybe", "REVIEW").otherwise("?")
    return leads.select(
        "place_id",
        F.col("budget_label").alias("qualified"),
        F.col("budget_reason").alias("budget_signal"),
        tier.alias("tier"),
        "name",
        F.coalesce("review_count", F.lit(0)).alias("reviews"),
        F.when(F.col("no_website") == 1, "NO").otherwise("yes").alias("has_website"),
        F.coalesce(F.nullif("site_status", F.lit("")), F.when(F.col("no_website") == 1, "none").otherwise("")).alias("site_status"),
        C.readiness_cell(F.col("no_website"), F.col("site_status"), F.col("readiness_score")).alias("readiness"),
        text("mgmt_status").alias("management"),
        C.tags_str(F.col("marketing_tags")).alias("marketing_tags"),
        text("phone").alias("phone"),
        text("website").alias("website"),
        F.coalesce(F.nullif("state_code", F.lit("")), F.lit("Unknown")).alias("state"),
    )


def to_profile_record(rows: DataFrame) -> DataFrame:
    """Audited leads as display records of the profile lens."""
    shown = lambda c, none="": F.coalesce(F.col(c).cast("string"), F.lit(none))
    tier = F.when(F.col("relevance") == "match", "CONFIRMED").when(F.col("relevance") == "maybe", "REVIEW").otherwise("?")
    return rows.select(
        "place_id",
        tier.alias("tier"),
        "name",
        F.coalesce(F.bround("neglect_score").cast("int").cast("string"), F.lit("")).alias("neglect"),
        F.when(F.col("is_claimed").isNull(), "?").when(F.col("is_claimed") != 0, "yes").otherwise("NO").alias("claimed"),
        C.signal_label(F.col("signals")).alias("top_gaps"),
        shown("rating_votes").alias("votes"),
        shown("total_photos").alias("photos"),
        shown("phone").alias("phone"),
        F.coalesce(F.nullif("state_code", F.lit("")), F.lit("Unknown")).alias("state"),
    )


def prospect_table(companies: DataFrame, audits: DataFrame, contacts: DataFrame) -> DataFrame:
    """Companies with their site's audit (by host) and contacts (by name), and whether any usable site is left."""
    keyed = companies.withColumn("host", C.host_of(F.col("website")))
    out = keyed.join(audits, "host", "left").join(contacts, "name", "left")
    status = C.site_status(F.col("host"), F.col("no_website"), F.col("http_status").isNotNull(), F.col("http_status"), F.col("title"), F.col("word_count"))
    out = out.withColumn("site_status", status)
    return out.withColumns({"no_usable": F.col("site_status").isin("none", "dead", "social_only", "directory", "parked", "unreachable"), "score": F.when(F.col("site_status") == "live", F.col("score"))})


def prospect_groups(prospects: DataFrame) -> DataFrame:
    """Group and rank: no usable site by reviews, local by score and reviews, chains by reviews; ties by key."""
    group = F.when(F.col("no_usable"), "build").when(F.col("tier") == "local", "local").when(F.col("tier") == "chain", "chain")
    reviews = F.coalesce("review_count", F.lit(0))
    score = F.when(group == "local", F.coalesce("score", F.lit(-1))).otherwise(0)
    out = prospects.withColumns({"group": group, "_s": score, "_r": reviews}).where("group IS NOT NULL")
    return ranked(out, [F.desc("_s"), F.desc("_r"), F.asc("place_id")], "rank", by=["group"]).drop("_s", "_r")


def flat_prospects(prospects: DataFrame) -> DataFrame:
    """Grouped prospects as text cells: null is '', contacts that are missing 'not found'."""
    found = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("not found"))
    cell = F.when(F.col("no_usable"), "NO SITE").when(F.col("score").isNull(), "n/a (site error)").otherwise(F.col("score").cast("string"))
    yes = lambda c: F.when(F.col(c).isNull(), "").when(F.col(c), "yes").otherwise("no")
    return prospects.select("place_id", "group", "rank", "name", cell.alias("score"), found("phone").alias("phone"), yes("https").alias("https"), F.coalesce(F.col("word_count").cast("string"), F.lit("")).alias("words"))
