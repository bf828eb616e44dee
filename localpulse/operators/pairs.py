"""Pairs within groups: an equi-join whose large groups are cut into tiles."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from localpulse.sources.scratch import materialize

SIDE = 1_000  # rows of either side in a tile
PER_TASK = 16_000_000  # pairs that one task compares, on average
SENT = 1_000_000  # rows that one task sends to tiles, or gets for its own, on average


def tiled_join(a: DataFrame, b: DataFrame, keys: list[str], condition: Column) -> DataFrame:
    """Inner join of ``a`` and ``b`` on ``keys`` and ``condition``, which names the sides' columns ``a.…`` and ``b.…``.

    Both sides of a group are cut by a hash of the row into pieces of about ``SIDE`` rows, each piece meets
    each of the other side, and tasks are as many as the pairs to compare ask for: a task's work does not
    grow with a group. A row is sent once for each piece that it meets, so the rows sent grow with the pairs
    too; they are dealt over as many tasks as that asks for before they are multiplied. Rows should differ:
    copies of a whole row stay in one piece.
    """
    size = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    groups = materialize(size(a, "_na").join(size(b, "_nb"), keys), "tiles")
    counted = groups.withColumns({"_pa": F.ceil(F.col("_na") / SIDE), "_pb": F.ceil(F.col("_nb") / SIDE)})
    total = lambda x, y: F.coalesce(F.sum(F.col(x).cast("double") * F.col(y)), F.lit(0.0))
    compared, sent_a, sent_b = counted.agg(total("_na", "_nb"), total("_na", "_pb"), total("_nb", "_pa")).first()
    tasks = max(1, ceil(compared / PER_TASK), ceil((sent_a + sent_b) / SENT))
    pieces = counted.select(*keys, "_pa", "_pb")
    on = [*keys, "_i", "_j"]

    def cut(df: DataFrame, own: str, n_own: str, other: str, n_other: str, sent: float) -> DataFrame:
        held = df.join(pieces, keys).withColumn(own, F.pmod(F.xxhash64(*df.columns), n_own))
        if sent > SENT:
            held = held.repartition(ceil(sent / SENT), *df.columns)
        held = held.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n_other) - 1))).drop("_pa", "_pb")
        return held.repartition(tasks, *on) if tasks > 1 else held

    left, right = cut(a, "_i", "_pa", "_j", "_pb", sent_a).alias("a"), cut(b, "_j", "_pb", "_i", "_pa", sent_b).alias("b")
    same = F.lit(True)
    for c in on:
        same &= F.col(f"a.{c}") == F.col(f"b.{c}")
    # Without the hint a small side would be sent whole to each task of the other, which may be one.
    return left.join(right.hint("merge"), same & condition)
