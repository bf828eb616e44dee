"""Cells: planning, density order, overlap pruning, subdivision, query plans and sweep cost."""

from __future__ import annotations

from functools import reduce
from math import pi

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from localpulse import config as K
from localpulse.functions import columns as C
from localpulse.operators.ordering import ranked
from localpulse.operators.pairs import tiled_join
from localpulse.sources.scratch import materialize


def filter_region(df: DataFrame, region: str) -> DataFrame:
    """``all``, a comma list of state codes or names, or ``bbox:south,west,north,east`` with inclusive bounds."""
    text = region.strip()
    if text.lower() in ("", "all"):
        return df
    if text.lower().startswith("bbox:"):
        parts = text[5:].split(",")
        if len(parts) != 4:
            raise ValueError("bbox: needs four numbers: south, west, north, east")
        south, west, north, east = map(float, parts)
        return df.where(F.col("lat").between(south, north) & F.col("lng").between(west, east))
    wanted = [p.strip().lower() for p in text.split(",") if p.strip()]
    return df.where(F.lower("state_code").isin(*wanted) | F.lower("state_name").isin(*wanted))


def filter_states(df: DataFrame, codes: str) -> DataFrame:
    wanted = [c.strip().lower() for c in codes.split(",") if c.strip()]
    return df if not wanted or wanted == ["all"] else df.where(F.lower("state_code").isin(*wanted))


def plan_cells(places: DataFrame) -> DataFrame:
    """Cells with radius and expansion, densest first."""
    p = F.col("population")
    return places.withColumns({"radius_m": C.radius_for(p), "expected_cells": C.expected_subdivision(p), "high_cells": C.high_subdivision(p)}).orderBy(F.desc("population"), "cell_id")


def _reached(small: DataFrame, large: DataFrame) -> DataFrame:
    """``small, large``: a large cell comes before a small one in density order and reaches its centre.

    An equi-join on half-degree buckets, the larger side exploded into the nine neighbours. Crowded buckets are cut into tiles.
    """
    y, x = C.geo_bucket(F.col("lat"), F.col("lng"))
    keyed = lambda cells: cells.select("cell_id", "lat", "lng", "radius_m", "population", y.alias("by"), x.alias("bx"))
    near = F.array(*(F.struct(F.lit(i).alias("dy"), F.lit(j).alias("dx")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    around = keyed(large).withColumn("d", F.explode(near)).withColumns({"by": F.col("by") + F.col("d.dy"), "bx": F.col("bx") + F.col("d.dx")}).drop("d")
    ahead = (F.col("b.population") > F.col("a.population")) | ((F.col("b.population") == F.col("a.population")) & (F.col("b.cell_id") < F.col("a.cell_id")))
    reach = F.greatest("a.radius_m", "b.radius_m")
    # A distance is never under that of the latitudes, which is tested first because it costs little; a metre is left for rounding.
    level = F.abs(F.col("a.lat") - F.col("b.lat")) * (K.EARTH_METRES * pi / 180) <= reach + 1
    close = C.haversine_m(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")) <= reach
    return tiled_join(keyed(small), around, ["by", "bx"], ahead & level & close).select(F.col("a.cell_id").alias("small"), F.col("b.cell_id").alias("large"))


def cover_edges(cells: DataFrame) -> DataFrame:
    """``small, large``: the large cell comes first in density order and reaches the small one's centre."""
    return _reached(cells, cells)


def prune_overlapping(cells: DataFrame, tile: float = 16.0, first: int = 2048) -> DataFrame:
    """Keep a cell unless a kept cell ahead of it covers it: the greedy result.

    Cells are taken in batches by density order, the ``first`` densest to begin with, then about twice
    as many each time; all later cells that a batch's kept ones cover are dropped at once. Covers are
    looked up within a batch and between its kept cells and the rest only, never between all cells.
    A batch crowded into few buckets is halved, down to ``first`` cells, so that its covers stay within
    about ``first`` squared times nine.
    """
    columns = ("cell_id", "lat", "lng", "radius_m", "population")
    rest = ranked(cells.select(*columns), [F.desc("population"), F.asc("cell_id")])
    rest = materialize(rest, "open-cells")
    kept, size = [cells.select("cell_id").limit(0)], first
    while True:
        n, low = rest.agg(F.count("*"), F.min("place")).first()
        if n == 0:
            break
        size = max(size, low - 1)
        while size > first and _crowd(rest.where(F.col("place") < low + size)) > first * first:
            size = max(first, size // 2)
        batch = rest.where(F.col("place") < low + size)
        chosen = materialize(batch.join(_greedy(batch, tile), "cell_id", "left_semi"), "kept")
        kept.append(chosen.select("cell_id"))
        later = rest.where(F.col("place") >= low + size)
        rest = materialize(later.join(_reached(later, chosen).select(F.col("small").alias("cell_id")).distinct(), "cell_id", "left_anti"), "open-cells")
        size *= 2
    return cells.join(reduce(DataFrame.unionByName, kept), "cell_id", "left_semi")


def _crowd(cells: DataFrame) -> float:
    """Pairs of cells in one bucket, summed over the buckets."""
    y, x = C.geo_bucket(F.col("lat"), F.col("lng"))
    return cells.groupBy(y, x).agg(F.count("*").cast("double").alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0.0


def _greedy(cells: DataFrame, tile: float) -> DataFrame:
    """``cell_id`` of the cells that the greedy pruning keeps, by the covers among them.

    Cells are tiled by ``tile`` degrees. In a round every tile decides, in order of density,
    what follows from the cells decided before and from its own: a chain of covers takes a
    round for each tile border that it crosses, not one for each cell. Between rounds only
    undecided cells and the covers of theirs that are undecided remain; each round's tiles
    are shifted by half a tile, so that chains along a border are not cut twice.
    A tile is one task's work: undecided cells within it, a key and its open covers each.
    """
    edges = materialize(cover_edges(cells), "covers")
    order = F.struct((-F.col("population").cast("double")).alias("p"), F.col("cell_id").alias("c"))
    open_ = cells.select("cell_id", "lat", "lng", order.alias("place"))
    covers = edges.groupBy(F.col("small").alias("cell_id")).agg(F.collect_list("large").alias("by"))  # the cells within reach of one
    open_ = materialize(open_.join(covers, "cell_id", "left").withColumn("by", F.coalesce("by", F.array().cast(covers.schema["by"].dataType))), "open-cells")
    decided, turn = [], 0
    kind = cells.schema["cell_id"].dataType.simpleString()

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["p", "c"], kind="stable")
        inside = set(rows["cell_id"])
        kept: dict = {}
        for cell, by in zip(rows["cell_id"], rows["by"], strict=True):
            states = [kept.get(other) if other in inside else None for other in by]
            kept[cell] = False if True in states else None if None in states else True
        return pd.DataFrame({"cell_id": list(kept), "kept": pd.array([kept[c] for c in kept], "boolean")})

    while True:
        shift = tile / 2 * (turn % 2)
        at = [F.floor((F.col(c) + shift) / tile).alias(n) for c, n in (("lat", "y"), ("lng", "x"))]
        found = open_.select(*at, "cell_id", "by", "place.*").groupBy("y", "x").applyInPandas(decide, f"cell_id {kind}, kept boolean")
        found = materialize(found.where("kept IS NOT NULL"), "decided")
        decided.append(found.where("kept").select("cell_id"))
        # Dropped cells cover nothing any more; a kept one drops those that it covers.
        rest = open_.join(found.select("cell_id"), "cell_id", "left_anti")
        links = rest.select(F.col("cell_id").alias("small"), F.explode_outer("by").alias("large")).join(found.select(F.col("cell_id").alias("large"), "kept"), "large", "left")
        left = links.groupBy(F.col("small").alias("cell_id")).agg(F.bool_or(F.coalesce("kept", F.lit(False))).alias("gone"), F.collect_list(F.when(F.col("kept").isNull(), F.col("large"))).alias("by")).where("NOT gone").drop("gone")
        open_ = materialize(rest.drop("by").join(left, "cell_id"), "open-cells")
        turn += 1
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, decided)


def subdivide(cells: DataFrame, n: int = 4) -> DataFrame:
    """``n`` children of each cell, at half its radius to the corners, with six tenths of the radius."""
    corners = ((1, 1), (1, -1), (-1, 1), (-1, -1))[:n]
    dlat, dlng = C.degrees_of(F.col("radius_m") * 0.5, F.col("lat"))
    kids = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(corners)))
    out = cells.withColumns({"_dlat": dlat, "_dlng": dlng}).withColumn("_k", F.explode(kids))
    return out.withColumns(
        {
            "cell_id": F.concat("cell_id", F.lit("/q"), F.col("_k.i")),
            "lat": F.col("lat") + F.col("_k.a") * F.col("_dlat"),
            "lng": F.col("lng") + F.col("_k.b") * F.col("_dlng"),
            "radius_m": F.greatest(F.lit(2000), F.floor(F.col("radius_m") * 0.6).cast("int")),
        }
    ).drop("_dlat", "_dlng", "_k")


def query_plan(cells: DataFrame, buckets: DataFrame, core: str) -> DataFrame:
    """Cells x buckets (``bucket, phrase``); small towns get the core bucket only, or all if there is no core."""
    has_core = buckets.where(F.col("bucket") == core).limit(1).count() > 0
    wanted = (F.col("population") >= K.SMALL_TOWN) | (F.col("bucket") == core) if has_core else F.lit(True)
    return cells.join(F.broadcast(buckets), wanted)  # a config table of a few phrases


def cell_results(pages: DataFrame) -> DataFrame:
    """Found listings (occurrences) and saturation of each cell and bucket; a page token left or 60 results saturate."""
    return pages.groupBy("cell_id", "bucket").agg(F.sum("n_results").alias("found"), F.bool_or(F.col("more") | (F.col("n_results") >= 60)).alias("saturated"))


def sweep_estimate(cells: DataFrame, queries: int, rate: float) -> DataFrame:
    """Requests and cost in the low, expected and worst case; requests are floor(v + 0.999)."""
    p = F.col("population")
    total = cells.agg(F.count("*").alias("low"), F.sum(C.expected_subdivision(p)).alias("expected"), F.sum(C.high_subdivision(p)).alias("high"))
    up = lambda c, f: F.floor(F.coalesce(F.col(c), F.lit(0)) * float(queries * f) + 0.999).cast("bigint")
    req = total.select(up("low", K.PAGES[0]).alias("low_requests"), up("expected", K.PAGES[1]).alias("expected_requests"), up("high", K.PAGES[2]).alias("high_requests"))
    return req.withColumns({c.replace("requests", "usd"): F.col(c) * rate / 1000 for c in req.columns})


def rank_within(df: DataFrame, key: str, order: list) -> DataFrame:
    return ranked(df, order, "place", by=[key])
