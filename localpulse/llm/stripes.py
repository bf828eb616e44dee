"""How far the sources of a language diverge in their terms, exactly, from in-mapper stripes.

A task folds the documents it reads, whole, into stripes: for each language and term
the number of documents and a table from source to occurrences. It spills its stripes
when they outgrow ``STRIPE_BYTES``, so a term leaves a task a few times, not once a
document. Spilled stripes are merged by language, term and source, with partial sums
ahead of the shuffle. A language keeps the terms of ``min_docs`` documents or more.

The share of a term in a group (or language) of N occurrences over V kept terms is
p = 1 + floor(1e9 (count + 2) / (N + 2 V)), and two shares lie f = floor((p - q)^2 / (p + q))
apart. The merged stripes give both parts of the audit:

- ``term``: for a group the kept terms that it uses more than its language does;
- ``pair``: for two sources the sum of f over all kept terms. A task holds one matrix
  of a block of sources by another; stripes of several blocks go to every pair of
  blocks that they fill. Terms of which two blocks have no occurrence are not
  visited: each adds the f of two shares of count 0.

Work grows with the occurrences of distinct (term, source) and with the pairs of
sources that the result lists; no task holds a whole language.

Defined cases: null text, language and source are empty strings; a group without
terms has N = 0 and all its pairs; a language without kept terms has V = 0, pairs of
value 0 and no ``term`` rows; a source alone in its language has no pairs; equal
values are ranked by item in UTF-8 order; repeated rows are documents of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, release_since, scratch_count, trimmed

#: Bytes of stripes that a task holds, about, before it spills them.
STRIPE_BYTES = 128 << 20
#: Sources of a block.
BLOCK = 64
#: Runs of ASCII letters (lowered before) and of bytes of other characters.
_TERM = re.compile(rb"[a-z\x80-\xff]+")

CELL = "lang string, term string, source string, n bigint, n_docs bigint"


def stripes(docs: DataFrame, *, stripe_bytes: int = STRIPE_BYTES) -> DataFrame:
    """What every task spills of its stripes, an entry a row (columns ``CELL``), for ``docs`` (``lang, source, text``, not null).

    A stripe holds occurrences and documents by source; a document has one source, so the
    document frequency of a term is the sum of its stripe's documents.
    """
    names = [c.split()[0] for c in CELL.split(", ")]
    one_doc = 1 << 48  # documents stand above the occurrences in one number

    def spilled(held: dict[str, dict]) -> Iterator[pa.RecordBatch]:
        for lang, table in held.items():
            terms = list(table)
            for a in range(0, len(terms), 20_000):
                part = terms[a : a + 20_000]
                entries = [table[t] for t in part]
                term = np.repeat(np.arange(len(part)), [len(e) for e in entries])
                both = np.array([v for e in entries for v in e.values()], np.int64)
                columns = [pa.array([lang]).take(pa.array(np.zeros(len(term), np.int32))), pa.array(part, pa.binary()).cast(pa.string()).take(pa.array(term)), pa.array([x for e in entries for x in e], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(both & (one_doc - 1)), pa.array(both >> 48)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict] = {}
        size = 0
        for batch in batches:
            lang, source = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, text in enumerate(batch.column(2).cast(pa.binary())):
                by, table = source[row], held.setdefault(lang[row], {})
                for term, n in Counter(_TERM.findall(text.as_py().lower())).items():
                    stripe = table.get(term)
                    if stripe is None:
                        table[term] = {by: one_doc + n}
                        size += 400 + len(term)
                    else:
                        stripe[by] = stripe.get(by, 0) + one_doc + n
                if size > stripe_bytes:
                    yield from spilled(held)
                    held, size = {}, 0
        yield from spilled(held)

    return docs.mapInArrow(trimmed(run), CELL)


def _share(count: str, total: str, terms: str) -> Column:
    """The share p of a count, from names of columns; exact for any count below 10^18."""
    return F.expr(f"1 + (cast({count} + 2 as decimal(19,0)) * 1000000000BD) div cast({total} + 2 * {terms} as decimal(19,0))")


def _apart(p: str, q: str) -> Column:
    """How far two shares lie apart, from names of columns; shares are below 2^31."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(rows: DataFrame) -> DataFrame:
    """``lang, lo, hi, value, n_terms``: each task's sums over its stripes, for all two sources of the stripes' blocks.

    ``rows``: ``lang, i, j, stripe`` (structs of place in the two blocks, and share) and ``none`` (places, numbers of the
    sources in their language, and their shares of count 0), in the order of language and blocks.
    """
    schema = "lang string, lo bigint, hi bigint, value bigint, n_terms bigint"
    names = [c.split()[0] for c in schema.split(", ")]

    def unpacked(column: pa.Array, *fields: str) -> tuple[np.ndarray, ...]:
        lists = column if isinstance(column, pa.ListArray) else column.combine_chunks()
        n = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        return np.repeat(np.arange(len(n)), n), *(flat.field(f).to_numpy(zero_copy_only=False) for f in fields)

    def summed(key: tuple, none: tuple, row: np.ndarray, place: np.ndarray, share: np.ndarray, rows: int, total: np.ndarray) -> None:
        _, empty = none
        for a in range(0, rows, 4096):
            own = (row >= a) & (row < a + 4096)
            p = np.repeat(empty[None, :], min(4096, rows - a), 0)
            p[row[own] - a, place[own]] = share[own]
            left = p[:, :BLOCK]
            right = p if key[1] == key[2] else p[:, BLOCK:]
            for x in range(left.shape[1]):
                d = right - left[:, x, None]
                total[x] += (d * d // (right + left[:, x, None])).sum(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, none, total, seen = None, None, None, 0

        def done() -> Iterator[pa.RecordBatch]:
            if key is None:
                return
            number, _ = none
            first = number[:BLOCK]
            second = number if key[1] == key[2] else number[BLOCK:]
            x, y = np.meshgrid(np.arange(len(first)), np.arange(len(second)), indexing="ij")
            ok = (first[x] >= 0) & (second[y] >= 0) & (first[x] < second[y])
            n = int(ok.sum())
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * n), pa.array(first[x[ok]]), pa.array(second[y[ok]]), pa.array(total[ok]), pa.array(np.full(n, seen))], names)

        for batch in batches:
            lang, i, j = (batch.column(c).to_pylist() for c in range(3))
            keys = list(zip(lang, i, j, strict=True))
            heads = [0, *(r for r in range(1, len(keys)) if keys[r] != keys[r - 1]), len(keys)]
            for a, b in zip(heads, heads[1:]):
                if a == b:
                    continue
                if keys[a] != key:
                    yield from done()
                    key, seen = keys[a], 0
                    _, place, number, share = unpacked(batch.column(4).slice(a, 1), "place", "number", "share")
                    size = BLOCK if key[1] == key[2] else 2 * BLOCK
                    none = np.full(size, -1, np.int64), np.ones(size, np.int64)
                    none[0][place], none[1][place] = number, share
                    total = np.zeros((BLOCK, BLOCK), np.int64)
                summed(key, none, *unpacked(batch.column(3).slice(a, b - a), "place", "share"), b - a, total)
                seen += b - a
        yield from done()

    return rows.select("lang", "i", "j", "stripe", "none").mapInArrow(trimmed(run), schema)


def divergences(docs: DataFrame, *, min_docs: int = 10, top: int = 10, lang: str = "lang", source: str = "source", text: str = "text", stripe_bytes: int = STRIPE_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of ``docs``: all other sources, and its ``top`` own terms."""
    mark = scratch_count()
    read = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(read(lang, "lang"), read(source, "source"), read(text, "text"))
    # One shuffle, by term: its merged stripe stands together, and says whether the term is kept.
    merged = stripes(rows, stripe_bytes=stripe_bytes).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    kept = merged.withColumn("df", F.sum("n_docs").over(Window.partitionBy("lang", "term"))).where(F.col("df") >= min_docs)
    cells = materialize(kept.select("lang", "term", "source", "n"), "cells")
    terms = materialize(cells.groupBy("lang", "term").agg(F.sum("n").alias("n")), "terms")
    langs = terms.groupBy("lang").agg(F.sum("n").alias("all_n"), F.count("*").alias("v"))
    groups = rows.select("lang", "source").distinct()
    groups = groups.join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "all_n"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint") - 1
    groups = groups.withColumn("number", number).withColumn("zero", F.lit(0).cast("bigint"))
    groups = groups.withColumn("none", F.when(F.col("v") > 0, _share("zero", "total", "v"))).withColumns({"block": F.floor(F.col("number") / BLOCK), "slot": F.col("number") % BLOCK}).drop("zero")
    groups = materialize(groups, "groups")
    shares = cells.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "v"))

    # Own terms of a group, against the language.
    of_lang = terms.withColumnRenamed("n", "lang_n")
    own = shares.join(of_lang, ["lang", "term"]).withColumn("q", _share("lang_n", "all_n", "v")).where("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    own = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart("p", "q").alias("value"))
    own = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # Sums over terms for all two sources, a pair of blocks at a time.
    blocks = groups.groupBy("lang").agg(F.max("block").alias("last"))
    spread = shares.select("lang", "term", "block", "slot", "p").join(blocks, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
    second = F.col("block") > F.col("other")
    place = F.when(second, F.col("slot") + BLOCK).otherwise(F.col("slot"))
    ends = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    stripe = spread.select("lang", "term", *ends, F.struct(place.alias("place"), F.col("p").alias("share")).alias("c")).groupBy("lang", "i", "j", "term").agg(F.collect_list("c").alias("stripe"))
    empty = groups.where("v > 0").join(blocks, "lang").withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), "last")))
    empty = empty.select("lang", *ends, F.struct(place.alias("place"), "number", F.col("none").alias("share")).alias("c")).groupBy("lang", "i", "j").agg(F.collect_list("c").alias("none"))
    sums = _pair_sums(stripe.join(empty, ["lang", "i", "j"]).sortWithinPartitions("lang", "i", "j")).groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value"), F.sum("n_terms").alias("n_terms"))
    sums = materialize(sums, "pair-sums")
    a = groups.select("lang", "source", "v", F.col("number").alias("x"), F.col("none").alias("p"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("y"), F.col("none").alias("q"))
    pairs = a.join(b, "lang").where("x <> y").withColumns({"lo": F.least("x", "y"), "hi": F.greatest("x", "y")}).join(sums, ["lang", "lo", "hi"], "left").na.fill(0, ["value", "n_terms"])
    value = F.when(F.col("v") > 0, F.col("value") + (F.col("v") - F.col("n_terms")) * _apart("p", "q")).otherwise(0).cast("bigint")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    out = materialize(pairs.unionByName(own), "divergences")
    release_since(docs.sparkSession, mark, but=1)
    return out
