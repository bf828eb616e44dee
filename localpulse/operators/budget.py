"""Budget prefixes and unit costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.sources.scratch import materialize


def running_total(df: DataFrame, cost: str, order: list[str | Column]) -> DataFrame:
    """``df`` in global order with ``running``, the cost up to and with each row.

    Two phases: rows are range-partitioned by ``order`` and summed within their
    partition; the partitions' sums (one row each) give the offsets. No window
    over all rows, so no single task sees them all.
    """
    asc = [F.col(c) if isinstance(c, str) else c for c in order]
    part = materialize(df.repartitionByRange(*asc).sortWithinPartitions(*asc).withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumn("_part", F.shiftright("_at", 33))
    sums = [(r["_part"], r["s"]) for r in part.groupBy("_part").agg(F.sum(cost).alias("s")).orderBy("_part").collect()]
    offsets, total = [], 0
    for p, s in sums:
        offsets.append((p, total))
        total += s or 0
    kind = part.schema[cost].dataType.simpleString()
    base = df.sparkSession.createDataFrame(offsets, f"_part bigint, _base {'bigint' if kind in ('int', 'bigint') else kind}")
    w = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return part.join(F.broadcast(base), "_part").withColumn("running", F.sum(cost).over(w) + F.col("_base")).drop("_at", "_part", "_base")


def budget_prefix(df: DataFrame, cost: str, order: list, cap) -> DataFrame:
    """Rows in order while the running cost fits the cap. Costs are not negative, so this is where spending would stop."""
    return running_total(df, cost, order).where(F.col("running") <= cap)


def guarded_prefix(df: DataFrame, estimate: str, actual: str, failed: Column, order: list, cap) -> DataFrame:
    """Rows charged max(actual, estimate), failures the estimate; a row runs only if its estimate still fits."""
    charged = F.when(failed, F.col(estimate)).otherwise(F.greatest(actual, estimate))
    out = running_total(df.withColumn("charged", charged), "charged", order)
    return out.where(F.col("running") - F.col("charged") + F.col(estimate) <= cap)


def grid_cost(scans: DataFrame, rate: float) -> DataFrame:
    return scans.withColumn("usd", F.col("n_pins") * F.col("n_keywords") * rate)


def review_cost(targets: DataFrame, setup: float, rate: float) -> DataFrame:
    """Setup fee plus a fee for every ten reviews begun."""
    return targets.withColumn("usd", setup + F.ceil(F.col("depth") / 10) * rate)
