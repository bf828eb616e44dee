"""Ranks in a total order without a window over many rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.sources.scratch import materialize


ROWS = 250_000  # rows of a task that sorts them


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` shuffled by ``keys`` into tasks of about ``ROWS`` rows, so that what a task sorts does not grow with the table."""
    return df.repartition(max(1, ceil(df.count() / ROWS)), *keys)


def ranked(df: DataFrame, order: list[Column], name: str = "place", by: list[str] | None = None, start: int = 1) -> DataFrame:
    """``df`` with ranks from ``start`` in ``order``, within the columns ``by`` (or over all rows), whatever the groups' sizes.

    Rows are dealt by ranges of group and order, so a large group spans many tasks; each
    task numbers its rows by group, and the rows that earlier tasks hold of the group are
    added. What is counted is one number for a task and group. ``order`` should break ties.
    The ordered rows are stored, so that both passes see one layout.
    """
    by = by or []
    sort = [*(F.asc(c) for c in by), *order]
    dealt = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = dealt.withColumns({"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()})
    stored = materialize(dealt, "ranked")
    counts = stored.groupBy(*by, "_part").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task and group
    counts = counts.select(*by, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    on = F.col("_part") == F.col("_p")
    for c in by:
        on &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    counts = counts.select(F.col("_part").alias("_p"), "_first", "_before", *(F.col(c).alias(f"_by_{c}") for c in by))
    out = stored.join(counts, on)
    return out.select(*df.columns, (F.col("_before") + F.col("_seq") - F.col("_first") + start).cast("int").alias(name))
