"""Reviews: negatives, rollups, batches, model replies and the pitch list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Complaint types that a reply may name: fixed values.
COMPLAINTS = ("no_callback", "unresponsive", "no_show", "no_followthrough")
REPLY = "array<struct<place_id:string,name:string,complaint_count:int,complaint_types:array<string>,evidence:array<string>>>"


def negatives(reviews: DataFrame, most: int = 2) -> DataFrame:
    return reviews.where((F.col("rating") <= most) & (F.coalesce(F.trim("text"), F.lit("")) != ""))


def review_rollup(reviews: DataFrame) -> DataFrame:
    bad = (F.col("rating") <= 2) & (F.coalesce(F.trim("text"), F.lit("")) != "")
    return reviews.groupBy("place_id").agg(F.count("*").alias("n_reviews"), F.count_if(bad).alias("n_negative"))


def assign_batches(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Batches of ``n`` rows in order; places come from a range partition, not from one window over all rows."""
    from localpulse.operators.budget import running_total

    one = running_total(df.withColumn("_one", F.lit(1).cast("bigint")), "_one", order)
    return one.withColumn("batch", F.expr(f"cast((running - 1) div {n} as bigint)")).drop("running", "_one")


def batch_payload(businesses: DataFrame) -> DataFrame:
    """The JSON line of each business (``place_id, name, negative_reviews``) and its size in characters."""
    line = F.to_json(F.struct("place_id", "name", "negative_reviews"))
    return businesses.withColumn("payload", line).withColumn("chars", F.length("payload"))


def reply_array(reply: Column) -> Column:
    """The JSON array between the first ``[`` and the last ``]`` of a model's reply; NULL if it does not parse."""
    return F.from_json(F.regexp_extract(reply, r"(?s)\[.*\]", 0), REPLY)


def normalise_flags(flags: Column) -> Column:
    """Known complaint types only, two quotes of 160 characters at most, a count under 1 becomes the number of quotes (at least 1); entries without a key go."""
    none = F.array().cast("array<string>")

    def clean(x: Column) -> Column:
        types = F.filter(F.coalesce(x["complaint_types"], none), lambda t: t.isin(*COMPLAINTS))
        quotes = F.slice(F.transform(F.coalesce(x["evidence"], none), lambda q: F.substring(q, 1, 160)), 1, 2)
        count = F.when(x["complaint_count"] >= 1, x["complaint_count"]).otherwise(F.greatest(F.size(quotes), F.lit(1)))
        return F.struct(x["place_id"].alias("place_id"), x["name"].alias("name"), count.alias("complaint_count"), types.alias("complaint_types"), quotes.alias("evidence"))

    return F.transform(F.filter(flags, lambda x: F.coalesce(x["place_id"], F.lit("")) != ""), clean)


def latest_flags(replies: DataFrame) -> DataFrame:
    """One flag row per business from reply texts (``file, reply``); the later file wins."""
    rows = replies.select("file", F.explode(normalise_flags(reply_array(F.col("reply")))).alias("f")).select("file", "f.*")
    w = Window.partitionBy("place_id").orderBy(F.desc("file"))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "file")


def pitch_rows(flags: DataFrame, biz: DataFrame, audits: DataFrame, contacts: DataFrame, review_cap: int, complaint_floor: int) -> DataFrame:
    """Flagged businesses with their latest audit (``rating``, ``rating_votes``) and contacts, under a cap on votes (0: none) and over a complaint floor."""
    out = flags.join(biz, "place_id").join(audits, "place_id").join(contacts, "place_id", "left")
    out = out.where(F.coalesce("complaint_count", F.lit(1)) >= complaint_floor)
    return out.where(F.coalesce("rating_votes", F.lit(0)) <= review_cap) if review_cap else out
