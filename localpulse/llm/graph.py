"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, release_since, scratch_count


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its least node) for every node of ``edges`` (``a``, ``b``, comparable, not null).

    Each step joins edges with one row per node, so a node with very many edges is
    only a skewed key, which the join splits; the edge list never grows.
    """
    mark = scratch_count()
    state = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "edges")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        state = materialize(small.distinct(), "edges")
        sign = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        # The state is stored: the tables it was made from are not read again.
        release_since(edges.sparkSession, mark, but=1)
        if (sign.n, sign.h) == before:
            break
        before = (sign.n, sign.h)
    found = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
