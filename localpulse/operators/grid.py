"""Map-rank grids: positions and ranks, share of local voice, scans and their differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse import config as K
from localpulse.functions import columns as C
from localpulse.operators.ordering import dealt

PIN = ["place_id", "row", "col", "keyword"]


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (all descending). Spark limits each task to one row per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def earliest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def business_position(item_id: Column, partition: list[str], order: list[str]) -> Column:
    """Place among rows that carry an id; ads carry none."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.when(item_id.isNotNull(), F.sum(F.when(item_id.isNotNull(), 1).otherwise(0)).over(w))


def extract_rank(items: DataFrame, keys: list[str], order: list[str], item_id: str = "item_id") -> DataFrame:
    """Rank of every business in every result list: its first row's absolute rank, else group rank, else position; 0 counts as missing."""
    placed = dealt(items, keys).withColumn("position", business_position(F.col(item_id), keys, order)).where(F.col(item_id).isNotNull())
    rank = F.coalesce(F.nullif("rank_absolute", F.lit(0)), F.nullif("rank_group", F.lit(0)), F.col("position").cast("int"))
    return placed.groupBy(*keys, item_id).agg(F.min_by(rank, "position").alias("rank"))


def solv(points: DataFrame, keys: list[str], max_rank: int = 20) -> DataFrame:
    """Share of local voice and its companions for each key. One hash aggregation."""
    rank = F.col("rank")
    n = F.count("*")
    return points.groupBy(*keys).agg(
        (F.sum(C.visibility(rank, max_rank)) * 100.0 / n).alias("solv"),
        F.avg("rank").alias("avg_rank"),
        (F.count_if(rank <= 3) / n).alias("top3_share"),
        (F.count("rank") / n).alias("found_share"),
    )


def solv_by_keyword(base: DataFrame, cur: DataFrame, keys: list[str], max_rank: int = 20) -> DataFrame:
    """Share of local voice of each keyword in both scans; a keyword of one scan only scores 0 in the other.

    The change has nine decimals, so that the order of summing makes no change of its own.
    """
    on = [*keys, "keyword"]
    b = solv(base, on, max_rank).select(*on, F.col("solv").alias("base_solv"))
    c = solv(cur, on, max_rank).select(*on, F.col("solv").alias("cur_solv"))
    both = b.join(c, on, "full").withColumns({x: F.coalesce(x, F.lit(0.0)) for x in ("base_solv", "cur_solv")})
    return both.withColumn("change", F.round(F.col("cur_solv") - F.col("base_solv"), 9))


def pin_mean(points: DataFrame) -> DataFrame:
    return points.groupBy("place_id", "row", "col").agg(F.avg("rank").alias("mean_rank"))


def diff_pins(base: DataFrame, cur: DataFrame) -> DataFrame:
    """Pins of both scans with status and improvement (positive is better); a NULL rank is a value."""
    b = base.select(*PIN, F.col("rank").alias("base_rank"))
    c = cur.select(*PIN, F.col("rank").alias("cur_rank"))
    return b.join(c, PIN).withColumns({"status": C.pin_status(F.col("base_rank"), F.col("cur_rank")), "improvement": F.col("base_rank") - F.col("cur_rank")})


def diff_counts(diff: DataFrame, keys: list[str]) -> DataFrame:
    names = ("improved", "declined", "unchanged", "gained", "lost", "still_absent")
    out = diff.groupBy(*keys).agg(*(F.count_if(F.col("status") == s).alias(s) for s in names))
    return out.withColumn("net_improved", F.col("improved") + F.col("gained") - F.col("declined") - F.col("lost"))


def top_movers(diff: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest gains and drops of each place; ties by pin, then keyword."""
    moved = diff.where("improvement <> 0").withColumn("direction", F.when(F.col("improvement") > 0, "gain").otherwise("drop"))
    w = Window.partitionBy("place_id", "direction").orderBy(F.desc(F.abs("improvement")), "row", "col", "keyword")
    return moved.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def shared_pins(base: DataFrame, cur: DataFrame) -> DataFrame:
    return base.select(*PIN).intersect(cur.select(*PIN))


def all_keywords(base: DataFrame, cur: DataFrame) -> DataFrame:
    return base.select("place_id", "keyword").union(cur.select("place_id", "keyword")).distinct()


def heatmap_cells(points: DataFrame, keyword: str | None = None) -> DataFrame:
    """One value and tier for each pin: of one keyword, or the mean of all."""
    if keyword is None:
        cells = pin_mean(points).withColumnRenamed("mean_rank", "value")
    else:
        cells = points.where(F.col("keyword") == keyword).select("place_id", "row", "col", F.col("rank").cast("double").alias("value"))
    label = F.coalesce(F.bround("value").cast("int").cast("string"), F.lit("-"))
    return cells.withColumns({"tier": C.rank_tier(F.col("value")), "label": label})


def grid_section(scans: DataFrame) -> DataFrame:
    """What a place's report shows: before and after with two scans, a single map with one."""
    return scans.groupBy("place_id").agg(F.count("*").alias("n_scans"), F.min("scan_id").alias("first_scan"), F.max("scan_id").alias("last_scan")).withColumn(
        "section", F.when(F.col("n_scans") >= 2, "before_after").otherwise("single")
    )


def geometry_warning(base: DataFrame, cur: DataFrame, fields: list[str]) -> DataFrame:
    """Places whose grid moved between two scans; NULLs compare as values."""
    moved = None
    for f in fields:
        part = ~F.col(f"b.{f}").eqNullSafe(F.col(f"c.{f}"))
        moved = part if moved is None else moved | part
    return base.alias("b").join(cur.alias("c"), "place_id").select("place_id", moved.alias("geometry_changed"))


def pin_grid(centers: DataFrame, rows: int, cols: int, spacing_km: float) -> DataFrame:
    """Pins around each centre (``place_id, lat, lng``); (0, 0) is the north-west corner; 6 decimals."""
    if rows < 1 or cols < 1 or spacing_km <= 0:
        raise ValueError("a grid needs rows, columns and spacing above 0")
    dlat = F.lit(spacing_km / K.KM_PER_DEGREE_LAT)
    dlng = F.lit(spacing_km) / (F.lit(K.KM_PER_DEGREE_LNG) * F.cos(F.radians("lat")))
    grid = centers.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    north, east = F.lit((rows - 1) / 2.0) - F.col("row"), F.col("col") - F.lit((cols - 1) / 2.0)
    return grid.select("place_id", "row", "col", F.round(F.col("lat") + north * dlat, 6).alias("lat"), F.round(F.col("lng") + east * dlng, 6).alias("lng"))
