"""Competitor benchmark: host rollup, rubric, leaderboard, gaps and coverage notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from localpulse.operators.budget import running_total

#: Crawlers that fetch pages to cite them: fixed values.
CITATION_BOTS = ("OAI-SearchBot", "PerplexityBot", "Bingbot")


def rollup_pages(pages: DataFrame) -> DataFrame:
    """Per host: pages, mean words, what all pages and what any page has, and the home page's own facts."""
    every = lambda c, low, high=10**9: F.bool_and(F.coalesce(F.col(c), F.lit(0)).between(low, high))
    some = lambda c: F.bool_or(F.coalesce(F.col(c), F.lit(False)))
    return pages.groupBy("host").agg(
        F.count("*").alias("pages_n"),
        F.bround(F.avg("word_count")).alias("avg_words"),
        every("title_length", 10, 65).alias("all_titled"),
        every("meta_description_length", 50, 170).alias("all_desc"),
        every("h1_count", 1).alias("all_h1"),
        every("h2_count", 2).alias("multi_h2"),
        some("has_phone").alias("has_phone"),
        some("local_business").alias("local_business"),
        some("faq").alias("faq"),
        some("organization").alias("organization"),
        F.bool_or(F.coalesce("rating", F.lit(False)) | F.coalesce("review", F.lit(False))).alias("rated"),
        F.bool_or(F.size("types") > 0).alias("any_jsonld"),
        F.min_by(F.coalesce("canonical", F.lit("")) != "", "page_id").alias("canonical"),
        F.min_by("viewport", "page_id").alias("viewport"),
        F.min_by("https", "page_id").alias("https"),
    )


def rubric(bench: DataFrame) -> DataFrame:
    """Technical, content, local and agentic points, at most five each, and their total of twenty. NULL facts give no point."""
    def on(c):
        return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(False)).cast("int")

    def add(*parts):
        return reduce(lambda a, b: a + b, parts)

    technical = add(on("sitemap"), on("citation_ok"), on("all_titled"), on("all_desc"), on(F.col("canonical") & F.col("https") & F.col("viewport")))
    content = add(on(F.col("avg_words") >= 400), on(F.col("avg_words") >= 800), on(F.col("all_h1") & F.col("multi_h2")), on("faq"), on(F.col("pages_n") >= 3))
    local = F.least(F.lit(5), add(on("local_business") * 2, on("has_phone"), on("rated"), on("organization")))
    agentic = add(on("any_jsonld"), on("faq"), on("citation_ok"), on("llms"), on("ai_mentioned"))
    out = bench.withColumns({"technical": technical, "content": content, "local": local, "agentic": agentic})
    return out.withColumn("total", F.col("technical") + F.col("content") + F.col("local") + F.col("agentic"))


def leaderboard(scored: DataFrame) -> DataFrame:
    placed = running_total(scored.withColumn("_one", F.lit(1).cast("bigint")), "_one", [F.desc("total"), F.col("entity")])
    return placed.withColumn("place", F.col("running").cast("int")).drop("_one", "running")


def benchmark_table(entities: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Every source's columns next to each entity; a source without a row leaves NULL, and ``has_<source>`` says so."""
    out = entities
    for name, df in sources.items():
        out = out.join(df.withColumn(f"has_{name}", F.lit(True)), "entity", "left").withColumn(f"has_{name}", F.coalesce(f"has_{name}", F.lit(False)))
    return out


def market_gaps(bench: DataFrame, flags: list[str]) -> DataFrame:
    """Signals that every audited entity lacks."""
    absent = bench.agg(*(F.bool_and(~F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags))
    return absent.unpivot([], flags, "signal", "absent").where("absent").select("signal")


def coverage_notes(inputs: dict[str, DataFrame]) -> DataFrame:
    """Which inputs hold nothing and so were not measured."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("input"), "n", F.when(F.col("n") == 0, "not measured").otherwise("measured").alias("note")) for name, df in inputs.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def measure(leads: DataFrame, serp: DataFrame, links: DataFrame, answers: DataFrame) -> DataFrame:
    """Rank, backlinks, and whether any answer mentions or cites each lead."""
    hits = answers.groupBy("place_id").agg(F.bool_or("mentioned").alias("mentioned"), F.bool_or("cited").alias("cited"))
    ranks = serp.groupBy("place_id").agg(F.min(F.nullif("rank", F.lit(0))).alias("rank"))
    return leads.join(ranks, "place_id", "left").join(links, "place_id", "left").join(hits, "place_id", "left")
