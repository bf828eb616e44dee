"""Sharding along a Hilbert curve over metadata.

Each dimension is quantised to ``BITS`` bits, the point's index on the Hilbert
curve is its sort key, and the sorted run is cut into shards whose row counts are
at most one apart. Near points of the metadata space stand together, so that the
shards' value ranges (``manifest``) prune files for predicates on any dimension.

Categories are quantised by a hash, so that equality prunes; numbers by equal
steps between their least and greatest value, on a logarithmic scale if asked.
Ranks come from a range partition plus a count per partition, never from one
global window.

Defined cases: a null value is the lowest cell of its dimension; ties on the
curve are ordered by text checksum, size and id; repeated rows keep a slot each;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from localpulse.llm.core import materialize

BITS = 5


@dataclass(frozen=True)
class Dimension:
    """A metadata column: ``kind`` is ``category``, ``number`` or ``log``."""

    column: str
    kind: str


#: Dimensions of a document, and what orders rows of one curve cell.
DIMENSIONS = [Dimension("lang", "category"), Dimension("source", "category"), Dimension("size", "log"), Dimension("doc_id", "number")]
TIES = ["text_crc32", "size", "doc_id"]


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows of ``cells``), after Skilling's transform, for all rows at once."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def cells(df: DataFrame, dims: list[Dimension], bits: int = BITS) -> list[Column]:
    """Quantised cell of each dimension."""
    top = (1 << bits) - 1
    scaled = {d.column: F.log2(F.greatest(F.col(d.column).cast("double"), F.lit(0.0)) + 1) if d.kind == "log" else F.col(d.column).cast("double") for d in dims if d.kind != "category"}
    bounds = df.agg(*(f(c).alias(f"{n}:{name}") for name, c in scaled.items() for n, f in (("lo", F.min), ("hi", F.max)))).first() if scaled else {}
    out = []
    for d in dims:
        if d.kind == "category":
            cell = F.pmod(F.xxhash64(F.col(d.column).cast("string")), F.lit(top)) + 1
        else:
            low, high = bounds[f"lo:{d.column}"] or 0.0, bounds[f"hi:{d.column}"] or 0.0
            cell = F.least(F.floor((scaled[d.column] - low) / ((high - low) or 1.0) * top) + 1, F.lit(top))
        out.append(F.when(F.col(d.column).isNull(), 0).otherwise(cell).cast("int"))
    return out


def curve_order(df: DataFrame, dims: list[Dimension], shards: int, ties: list[str], bits: int = BITS) -> DataFrame:
    """Stored rows of ``df`` with ``shard`` and ``slot`` (both from 0), in curve order cut into equal runs."""

    @F.pandas_udf("bigint")
    def on_curve(points: pd.DataFrame) -> pd.Series:
        return pd.Series(curve_index(points.to_numpy(), bits))

    keyed = df.select("*", on_curve(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(cells(df, dims, bits))))).alias("_curve"))
    run = keyed.repartitionByRange("_curve", *ties).sortWithinPartitions("_curve", *ties)
    # The id gives the partition and the place in it; the stored copy fixes both.
    run = materialize(run.withColumn("_at", F.monotonically_increasing_id()), "curve")
    part = F.shiftright("_at", 33)
    counts = run.groupBy(part.alias("p")).count().orderBy("p").collect()  # one row for each partition
    total, before = 0, []
    for r in counts:
        before.append((r.p, total))
        total += r["count"]
    base = F.broadcast(df.sparkSession.createDataFrame(before, "_part bigint, _base bigint"))
    rank = F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)
    ranked = run.join(base, part == F.col("_part")).withColumn("_rank", rank)
    shard = F.expr(f"cast(_rank * {shards}L div {max(total, 1)}L as int)")
    # The first rank of shard s is ceil(s * total / shards).
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return ranked.withColumn("shard", shard).withColumn("slot", F.col("_rank") - first).drop("_at", "_part", "_base", "_rank")


def _measured(docs: DataFrame, doc_id: str, text: str, dims: list[Dimension], *more: Column) -> DataFrame:
    """Id, size, checksum and dimensions of every document, and ``more``."""
    size = (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("bigint")
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    keep = [F.col(d.column) for d in dims if d.column not in ("doc_id", "size")]
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), size.alias("size"), crc.alias("text_crc32"), *keep, *more)


def shard_documents(docs: DataFrame, shards: int = 8, *, doc_id: str = "doc_id", text: str = "text", dims: list[Dimension] | None = None) -> DataFrame:
    """Shard and slot of every document; sizes and checksums are taken from the text, the text itself is not moved."""
    dims = dims or DIMENSIONS
    return curve_order(_measured(docs, doc_id, text, dims), dims, shards, TIES)


def write_shards(docs: DataFrame, path: str, shards: int = 8, *, doc_id: str = "doc_id", text: str = "text", dims: list[Dimension] | None = None) -> None:
    """Store the documents as one folder of Parquet files per shard (``hilbert_shard``), each in the order of ``hilbert_slot``.

    Whole rows move along the curve, so rows with equal or null ids stay what they
    are. Input columns named like the two new ones are replaced.
    """
    dims = dims or DIMENSIONS
    placed = curve_order(_measured(docs, doc_id, text, dims, F.struct("*").alias("_row")), dims, shards, TIES)
    keep = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ("hilbert_shard", "hilbert_slot")]
    df = placed.select(*keep, F.col("shard").alias("hilbert_shard"), F.col("slot").alias("hilbert_slot"))
    order = ["hilbert_shard", "hilbert_slot"]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("hilbert_shard").parquet(path)


def manifest(placed: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, bytes and value ranges of each shard, for pruning."""
    ranges = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), *ranges)
