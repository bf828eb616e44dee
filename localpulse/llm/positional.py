"""Benchmark decontamination with a positional inverted index.

``build_index`` cuts the documents into segments and stores each segment's
postings: its distinct terms (64-bit hashes of the lower-cased words), and for
each term the sorted positions where it stands. ``search`` takes phrases: in each
segment it starts from the phrase's rarest term, shifts its positions by the
term's place in the phrase, and intersects with the next rarest list until the
candidates are exact. With ``slop`` it also reports phrases whose terms all stand
within so many words of their place (proximity matches).

Terms are compared by 64-bit hashes, so a false match needs collisions in every
place of a phrase.

Defined cases: a null or empty text has no words; phrases without a word never
match; a null item id is matched but not listed; repeated documents are reported
as often as they occur; empty tables give empty results; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from localpulse.llm.core import ALNUM, LOWER, materialize, release_since, row_key, run_hashes, scratch_count, text_buffer, trimmed, without, word_runs
from localpulse.llm.tokens import slices

WINDOW = 10
SEGMENT_BYTES = 2 << 20
#: Words of phrases that are sent to the tasks at once; more phrases are searched in blocks of about so many.
QUERY_WORDS = 2_000_000

INDEX = "part int, segment int, doc_ids binary, doc_starts binary, terms binary, term_starts binary, postings binary"
HITS = "part int, segment int, doc int, exact array<struct<start:int,stop:int>>, near array<struct<start:int,stop:int>>, items array<string>"


def hashed_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all rows, and where each row's words start among them (one more entry than rows)."""
    starts, ends = word_runs(buf, offs, ALNUM)
    return run_hashes(buf, starts, ends, LOWER), np.searchsorted(starts, offs)


def build_index(docs: DataFrame, *, doc_id: str | Column = "doc_id", text: str | Column = "text") -> DataFrame:
    """Store the postings of all documents; returns the stored index (columns ``INDEX``)."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    rows = docs.select(col(doc_id).cast("bigint").alias("doc_id"), col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment = TaskContext.get().partitionId(), 0
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            keys = batch.column(0).fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            for i, j in slices(offs, SEGMENT_BYTES):
                words, at = hashed_words(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                order = np.argsort(words, kind="stable").astype(np.uint32)
                sorted_ = words[order]
                head = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(words) else np.zeros(0, np.int64)
                out = [keys[i:j].astype(np.int64), at.astype(np.uint32), sorted_[head], np.append(head, len(words)).astype(np.uint32), order]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([segment], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in out)], ["part", "segment", "doc_ids", "doc_starts", "terms", "term_starts", "postings"])
                segment += 1

    return materialize(rows.mapInArrow(trimmed(run), INDEX), "postings")


class Phrases:
    """The distinct windows of a set of items, as numbers of their distinct terms."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        buf, offs = text_buffer(pa.array([t for _, t in items], pa.large_string()))
        words, at = hashed_words(buf, offs)
        self.terms, code = np.unique(words, return_inverse=True)
        owners: dict[tuple[int, ...], set[str]] = {}
        for (item, _), a, b in zip(items, at[:-1].tolist(), at[1:].tolist(), strict=True):
            own = code[a:b].tolist()
            for i in range(max(1, len(own) - window + 1) if own else 0):
                found = owners.setdefault(tuple(own[i : i + window]), set())
                if item is not None:
                    found.add(item)
        self.items = [sorted(x) for x in owners.values()]
        self.size = np.array([len(x) for x in owners], np.int64)
        self.words = np.full((len(owners), window), len(self.terms), np.int64)
        for row, x in zip(self.words, owners, strict=True):
            row[: len(x)] = x


def matches(terms: np.ndarray, term_starts: np.ndarray, postings: np.ndarray, phrases: Phrases, slop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each phrase with matches: its number, exact start positions, and near ones."""
    if not len(terms) or not len(phrases.size):
        return
    at = np.minimum(np.searchsorted(terms, phrases.terms), len(terms) - 1)
    there = terms[at] == phrases.terms
    first = np.append(np.where(there, term_starts[at], 0), 0).astype(np.int64)
    count = np.append(np.where(there, term_starts[at + 1].astype(np.int64) - term_starts[at], 0), np.iinfo(np.int64).max)
    lists = count[phrases.words]
    for w in np.flatnonzero(lists.min(1) > 0).tolist():
        n = int(phrases.size[w])
        order = np.argsort(lists[w, :n], kind="stable").tolist()
        words = phrases.words[w]
        positions = lambda k: postings[first[words[k]] : first[words[k]] + count[words[k]]].astype(np.int64)  # noqa: E731, B023
        start = positions(order[0]) - order[0]
        exact = near = start
        for k in order[1:]:
            if not len(near):
                break
            other = positions(k)
            if len(exact):
                slot = np.minimum(np.searchsorted(other, exact + k), len(other) - 1)
                exact = exact[other[slot] == exact + k]
            if slop:
                near = near[np.searchsorted(other, near + k - slop, "left") < np.searchsorted(other, near + k + slop, "right")]
            else:
                near = exact
        near = np.setdiff1d(near, exact) if slop else near[:0]
        if len(exact) or len(near):
            yield w, exact, near


def merged(start: np.ndarray, stop: np.ndarray) -> list[dict[str, int]]:
    """Disjoint spans that cover the same positions."""
    order = np.lexsort((stop, start))
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(start)) - 1
    return [{"start": s, "stop": e} for s, e in zip(start[heads].tolist(), reach[tails].tolist(), strict=True)]


def search(index: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, slop: int = 0, item_id: str | Column = "item_id", text: str | Column = "text") -> DataFrame:
    """Documents in which windows of the items stand (columns ``HITS``): covered spans in words, and the items."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    spark = index.sparkSession
    items = benchmark.select(col(item_id).cast("string").alias("item_id"), col(text).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    blocks = 1 + size // (4 * QUERY_WORDS)
    found = []
    for b in range(blocks):
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        sent = spark.sparkContext.broadcast(Phrases([(r.item_id, r.text) for r in block.collect()], window))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            phrases = sent.value
            for batch in batches:
                for row in range(batch.num_rows):
                    part, segment = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                    read = lambda c, kind: np.frombuffer(batch.column(c)[row].as_buffer(), kind)  # noqa: E731, B023
                    doc_starts = read(2, np.uint32).astype(np.int64)
                    where: list[tuple[np.ndarray, ...]] = []
                    for w, *kinds in matches(read(3, np.uint64), read(4, np.uint32), read(5, np.uint32), phrases, slop):
                        for kind, start in enumerate(kinds):
                            n = int(phrases.size[w])
                            doc = np.searchsorted(doc_starts, start, "right") - 1
                            ok = (start >= 0) & (doc >= 0)
                            ok[ok] = start[ok] + n <= doc_starts[doc[ok] + 1]
                            start, doc = start[ok], doc[ok]
                            where.append((doc, start - doc_starts[doc], start - doc_starts[doc] + n, np.full(len(doc), kind), np.full(len(doc), w)))
                    if not where:
                        continue
                    doc, start, stop, kind, w = (np.concatenate(x) for x in zip(*where, strict=True))
                    out: list[dict] = []
                    for d in np.unique(doc).tolist():
                        own, sides = doc == d, []
                        for k in (0, 1):
                            m = own & (kind == k)
                            sides.append(merged(start[m], stop[m]) if m.any() else [])
                        own &= kind == 0
                        out.append({"part": part, "segment": segment, "doc": d, "exact": sides[0], "near": sides[1], "items": sorted({x for v in np.unique(w[own]).tolist() for x in phrases.items[v]})})
                    if out:
                        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
                        yield pa.RecordBatch.from_pylist(out, pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("doc", pa.int32()), ("exact", span), ("near", span), ("items", pa.list_(pa.string()))]))

        found.append(index.select("part", "segment", "doc_starts", "terms", "term_starts", "postings").mapInArrow(trimmed(run), HITS))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def indexed_documents(index: DataFrame) -> DataFrame:
    """Every document of an index: ``part, segment, doc, doc_id, n_words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, ids, starts in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                ids = np.frombuffer(ids, np.int64)
                n = np.diff(np.frombuffer(starts, np.uint32).astype(np.int64))
                k = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, part, np.int32)), pa.array(np.full(k, segment, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(ids, mask=ids == -(2**63)), pa.array(n)], ["part", "segment", "doc", "doc_id", "n_words"])

    return index.select("part", "segment", "doc_ids", "doc_starts").mapInArrow(trimmed(run), "part int, segment int, doc int, doc_id bigint, n_words bigint")


def contamination(index: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row per indexed document: words, hit words, items with occurring windows."""
    spans = F.array_sort(F.flatten(F.collect_list("exact")))
    hits = search(index, benchmark, window=window).groupBy("part", "segment", "doc").agg(spans.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    covered = F.expr("aggregate(spans, named_struct('reach', 0, 'n', 0L), (a, s) -> named_struct('reach', greatest(a.reach, s.stop), 'n', a.n + greatest(0, s.stop - greatest(a.reach, s.start))), a -> a.n)")
    hits = hits.select("part", "segment", "doc", covered.alias("n_hit"), "items")
    return indexed_documents(index).join(hits, ["part", "segment", "doc"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows in whose text a window of the benchmark stands; rows are told apart by id and text, so null and repeated ids decide nothing."""
    mark = scratch_count()
    rows = docs.select(row_key(doc_id, text).alias("doc_id"), F.col(text).alias("text"))
    found = contamination(build_index(rows), benchmark, window=window)
    bad = materialize(found.where("contaminated").select("doc_id"), "contaminated")
    release_since(docs.sparkSession, mark, but=1)
    return without(docs, bad, doc_id, text)
