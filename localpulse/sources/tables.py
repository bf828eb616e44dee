"""Readers and writers for the file shapes of the market's data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from localpulse.operators.ordering import ranked

RESPONSES = (
    "places array<struct<id:string,displayName:struct<text:string>,formattedAddress:string,location:struct<latitude:double,longitude:double>,nationalPhoneNumber:string,"
    "internationalPhoneNumber:string,primaryTypeDisplayName:struct<text:string>,types:array<string>,googleMapsUri:string,rating:double,userRatingCount:int,websiteUri:string>>"
)
COMPANY = "place_id string, name string, website string, review_count int, found_via array<string>, state_code string"


def read_gazetteer(spark: SparkSession, path: str, min_pop: int = 1000) -> DataFrame:
    """Populated places of a tab-separated dump (19 fields); blank population counts as 0, broken rows are dropped."""
    raw = spark.read.text(path).select(F.split("value", "\t").alias("f")).where(F.size("f") >= 15)
    pop = F.when(F.trim(F.col("f")[14]) == "", "0").otherwise(F.col("f")[14])
    rows = raw.select(
        F.col("f")[1].alias("name"),
        F.col("f")[4].try_cast("double").alias("lat"),
        F.col("f")[5].try_cast("double").alias("lng"),
        F.col("f")[6].alias("feature_class"),
        F.col("f")[8].alias("country"),
        F.col("f")[10].alias("admin1"),
        pop.try_cast("bigint").alias("population"),
    )
    return rows.where(F.col("country").isin("US", "CA") & (F.col("feature_class") == "P") & (F.col("population") >= min_pop) & F.col("lat").isNotNull() & F.col("lng").isNotNull()).drop("feature_class")


def with_admin1(places: DataFrame, admin1: DataFrame, codes: DataFrame) -> DataFrame:
    """State name and two-letter code by two small lookups; '' where there is none."""
    named = places.join(F.broadcast(admin1), F.concat_ws(".", "country", "admin1") == F.col("key"), "left").drop("key")
    coded = named.join(F.broadcast(codes), "state_name", "left")
    return coded.withColumns({"state_name": F.coalesce("state_name", F.lit("")), "state_code": F.coalesce("state_code", F.lit(""))})


def write_seed(df: DataFrame, path: str) -> None:
    df.orderBy(F.desc("population"), "name").write.option("header", True).csv(path)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The seed table; rows whose numbers do not parse are skipped."""
    raw = spark.read.option("header", True).csv(path)
    rows = raw.withColumns({"lat": F.col("lat").try_cast("double"), "lng": F.col("lng").try_cast("double"), "population": F.col("population").try_cast("bigint")})
    return rows.where("lat IS NOT NULL AND lng IS NOT NULL AND population IS NOT NULL")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSES).json(path)


def flatten_places(responses: DataFrame) -> DataFrame:
    """Business rows of listing responses; places without an id are dropped."""
    p = responses.select(F.explode("places").alias("p")).select("p.*").where(F.coalesce("id", F.lit("")) != "")
    site = F.coalesce("websiteUri", F.lit(""))
    return p.select(
        F.col("id").alias("place_id"),
        F.col("displayName.text").alias("name"),
        F.col("formattedAddress").alias("address"),
        F.col("location.latitude").alias("lat"),
        F.col("location.longitude").alias("lng"),
        F.coalesce("nationalPhoneNumber", "internationalPhoneNumber").alias("phone"),
        F.col("primaryTypeDisplayName.text").alias("primary_type"),
        F.col("types"),
        F.col("rating"),
        F.col("userRatingCount").alias("review_count"),
        site.alias("website"),
        F.when(site == "", 1).otherwise(0).alias("no_website"),
    )


def to_discover(biz: DataFrame) -> DataFrame:
    """The fixed export fields; an empty website is null."""
    return biz.select("place_id", "name", F.nullif("website", F.lit("")).alias("website"), F.col("review_count").cast("int").alias("review_count"), F.coalesce("found_via", F.array().cast("array<string>")).alias("found_via"), "state_code")


def read_discover(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPANY).json(path)


def area_label(biz: DataFrame) -> DataFrame:
    return biz.agg(F.array_join(F.array_sort(F.collect_set("state_name")), ", ").alias("label"))


def read_cohort(spark: SparkSession, path: str) -> DataFrame:
    """Distinct keys of a file that separates them by newlines, commas or spaces."""
    keys = spark.read.text(path).select(F.explode(F.split("value", r"[,\s]+")).alias("place_id"))
    return keys.where("place_id <> ''").distinct()


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.schema("place_id string, reviews array<struct<rating:int,text:string>>").json(path)
    return files.select("place_id", F.explode("reviews").alias("r")).select("place_id", "r.*")


def read_audits(spark: SparkSession, path: str) -> DataFrame:
    """One row for each page of the page-audit files by host; pages with an error are dropped."""
    page = "struct<status:int,title:string,word_count:int,error:string>"
    files = spark.read.schema(f"host string, pages map<string,{page}>").json(path)
    rows = files.select("host", F.posexplode(F.map_entries("pages")).alias("position", "p")).select("host", "position", F.col("p.key").alias("url"), "p.value.*")
    return rows.where("error IS NULL").drop("error")


def flatten_pagespeed(responses: DataFrame) -> DataFrame:
    """Scores out of 100 and field metrics of performance responses."""
    return responses.select("url", (F.col("lighthouse.score") * 100).alias("score"), F.transform_values("field", lambda _, v: v.cast("double")).alias("field"))


def unwrap_tasks(responses: DataFrame) -> DataFrame:
    """Items of provider responses: both codes must be 20000; 40102 is an empty result; anything else an error row."""
    ok = (F.col("status_code") == 20000) & (F.col("task_code") == 20000)
    empty = F.col("task_code") == 40102
    status = F.when(ok, "ok").when(empty, "empty").otherwise("error")
    rows = responses.withColumn("status", status).withColumn("items", F.when(F.col("status") == "ok", F.col("items")))
    return rows.select("task_id", "status", F.explode_outer("items").alias("item"))


def flatten_backlinks(responses: DataFrame) -> DataFrame:
    return responses.select("target", F.col("summary.rank").alias("rank"), F.col("summary.backlinks").alias("backlinks"), F.col("summary.referring_domains").alias("referring_domains"))


def append_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_ranked(df: DataFrame, path: str, order: list[Column], by: str = "state_code", name: str = "rank") -> None:
    """CSV parts in the order of group and rank: reading them by number gives the whole ranked list.

    Ranks count from 1 within ``by``; ``order`` is a lens's order.
    """
    out = ranked(df, order, name, by=[by])
    out.repartitionByRange(F.asc(by), F.asc(name)).sortWithinPartitions(by, name).write.option("header", True).csv(path)


def write_by(df: DataFrame, column: str, path: str) -> None:
    df.write.partitionBy(column).parquet(path)
