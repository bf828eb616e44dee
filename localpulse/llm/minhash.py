"""Near-duplicates by MinHash with tensored banding.

``SIDE`` small hashes of ``ROWS`` minhashes each form a first collection, as many a second
one. A table is a pair of one small hash of either collection, so SIDE * SIDE tables of
2 * ROWS minhashes each come from 2 * SIDE * ROWS minhashes: about the square root of
what as many tables of their own would take. Two sets of similarity s share a table
when some small hash of each collection agrees, so they miss each other with a chance of
about 2 (1 - s^ROWS)^SIDE: 1.2 in a million for s = 0.8, the least linked, and the defaults.

Order of work:
1. one pass over the texts: set size, set hash, small hashes, and two exact bounds of
   how many shingles two sets share (group counts and parities, as in ``rtree``);
2. equal sets become one class, of which one representative moves on;
3. a small hash that one class alone has can form no shared table; of those left, all
   pairs of a class are its table keys. Keys under which the same classes meet are one bucket;
4. every class is checked against the partner under most keys, of those that lead
   the buckets; buckets that then hold several components are searched for pairs that
   the bounds leave, and these are checked too, on whole sets.

Buckets are counted by aggregation, so a frequent key is never gathered; a bucket of
more members than a task takes is searched in chunks, and one in a single component not
at all. There is no cap on buckets or partners.

Defined cases: a null or empty text has an empty set and is linked
with nothing; a text with fewer words than a shingle is one shingle; rows are told apart
by their texts, so rows that share an id, or have none, are linked like any others;
a component's id is its least one that is not null; of a component the row of the least
id, then of the least text hash, is kept, and all rows that are equal to it in id and
text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from localpulse.llm import rtree
from localpulse.llm.core import materialize, mix64, release_since, scratch_count, trimmed
from localpulse.llm.rtree import Rule

#: Small hashes of a collection, and minhashes of a small hash.
SIDE = 20
ROWS = 3
#: Parities a shingle: with eight, few pairs that the bounds leave are below the threshold by more than a hundredth.
FINE = 8


def factors(side: int, rows: int) -> np.ndarray:
    """Odd multipliers of the minhash functions, fixed for all runs."""
    rng = np.random.Generator(np.random.PCG64(13))
    return rng.integers(1, 2**63, (2 * side, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def small_hashes(h: np.ndarray, n: np.ndarray, side: int, rows: int) -> np.ndarray:
    """The small hashes of the sets of ``n`` shingle hashes each that follow one another in ``h``: first the one collection's, then the other's."""
    full = np.flatnonzero(n > 0)
    out = np.zeros((len(n), 2 * side), np.uint64)
    heads = (np.cumsum(n) - n)[full]
    if not len(full):
        return out
    for k, row in enumerate(factors(side, rows).tolist()):
        own = np.full(len(full), k + 1, np.uint64)
        for factor in row:
            own = mix64(own * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((h * np.uint64(factor)) >> np.uint64(32), heads))
        out[full, k] = own
    return out


def _small_keys(side: int, rows: int):
    def keys(h: np.ndarray, row: np.ndarray, n: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
        full = n > 0
        return small_hashes(h, n, side, rows)[full].ravel(), np.repeat(np.flatnonzero(full), 2 * side)

    return keys


def exploded_small(reps: DataFrame, side: int) -> DataFrame:
    """``node, second, key``: every small hash of each representative (``node, blocks``), and whether it is of the second collection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, where = rtree.binary_rows(batch.column(1))
            keys = data[where[0] : where[-1]].view(np.int64)
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), 2 * side)
            second = np.arange(len(keys)) % (2 * side) >= side
            for a in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 16)]) for x in (node, second, keys)], ["node", "second", "key"])

    return reps.select("node", "blocks").mapInArrow(trimmed(run), "node bigint, second boolean, key bigint")


def shared_keys(reps: DataFrame, side: int) -> DataFrame:
    """``node, rank, first, second``: the small hashes of each representative that others have too, by collection.

    A node's rank counts the others that its small hashes meet, so originals rank before their copies.
    """
    small = exploded_small(reps, side)
    met = small.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    of = lambda which: F.collect_list(F.when(which, F.col("key")))
    return small.join(met, "key").groupBy("node").agg(F.sum("size").alias("rank"), of(~F.col("second")).alias("first"), of(F.col("second")).alias("second"))


def _groups(docs: DataFrame, rule: Rule, side: int, rows: int, doc_id: str, text: str) -> DataFrame:
    docs = rtree._input(docs, doc_id, text)
    mark = scratch_count()
    sketch = materialize(rtree.sketches(docs, rule, _small_keys(side, rows)).withColumn("row", F.monotonically_increasing_id()), "sketches")
    classes, reps = rtree.classes_of(sketch)
    held = materialize(shared_keys(reps, side).where("size(first) > 0 AND size(second) > 0"), "small-hashes")
    points = materialize(reps.select("node", "n", "point", "parity").join(held.select("node", "rank"), "node"), "points")
    pairs = held.select("node", "rank", F.explode("first").alias("x"), "second").select("node", "rank", "x", F.explode("second").alias("y"))
    keys = materialize(pairs.select("node", "rank", F.xxhash64("x", "y").alias("key")), "table-keys")
    same = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"same{i}") for i in (0, 1)]
    buckets = keys.groupBy("key").agg(F.count("*").alias("size"), *same, F.max(F.struct("rank", (-F.col("node")).alias("node"))).alias("hub")).where("size > 1")
    buckets = materialize(buckets.groupBy("size", "same0", "same1").agg(F.min("key").alias("key"), (-F.first("hub.node")).alias("hub"), F.count("*").alias("times")), "buckets")
    placed = materialize(keys.select("node", "key").join(buckets.select("key", "size", "hub", "times"), "key"), "members")
    tried = placed.where("node <> hub").groupBy("hub", "node").agg(F.sum("times").alias("shared"))
    tried = tried.groupBy(F.col("node").alias("b")).agg(F.max_by("hub", F.struct("shared", -F.col("hub"))).alias("a"))
    tried = materialize(tried.select("a", "b"), "pairs")
    names = rtree.named(classes, rtree.linked(placed.select("key", "node", "size"), points, tried, docs, classes, rule))
    release_since(docs.sparkSession, mark + 1, but=1)  # all but the sketches and the names
    return rtree.grouped(sketch, names)


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, side: int = SIDE, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row: set size, least id reachable by links of similar sets, and whether the row stays."""
    out = _groups(docs, Rule(words, percent, FINE), side, rows, doc_id, text)
    empty = F.col("n") == 0
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("least.doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.when(empty, True).otherwise(stays).alias("kept"))
