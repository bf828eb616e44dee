"""Packing by deficit round-robin over source queues.

Each source is a queue of its documents' ids, in packets of ``packet`` ids. A round fills
one window of ``length`` ids: every queue's deficit counter grows by its quantum (its
target share of the window), and the queue sends packets while the counter covers
them; what is left over stays in the counter for the next window. A queue that has run
dry leaves its share to the others, whose quanta grow so that they fill the window.

No counter has to be stepped. Let a queue with target share s have been given s * t ids
by time t, or all its n ids once it is dry. All queues together have then been given
T(t) = sum of min(n, s * t), so window w ends at the time t with T(t) = (w + 1) * length,
and the whole packets that fit into s * t are those that its queue has sent by then. T is
a line between the times at which queues run dry, so it is kept as a curve of at most
``KNOTS`` such times (all of them up to that many sources, quantiles beyond). Deficits
thus cross windows and partitions, and the stream's order is a sort by window, source
and place, whatever the number of sources. In every window each live source is within a
packet of its target, but for the few ids by which the packets shift the window's edge.

A document is cut where its source's share of a window ends, and at window edges.

Defined cases: a null text is one id (the end id); a null source is a source of
its own; repeated rows are packed as often as they occur; an empty table gives
no piece. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, release_since, scratch_count, text_buffer, trimmed
from localpulse.llm.tokens import encoder, slices

WINDOW = 2048
PACKET = 16
#: Times of queues running dry that the curve keeps.
KNOTS = 1024
#: Rows of the offsets table (writer task x source) up to which it is broadcast; it is joined by shuffle beyond.
BROADCAST_ROWS = 200_000

TOKENS = "part int, source string, doc_id bigint, at bigint, n_tokens bigint, ids binary"
PACKETS = "late boolean, round bigint, source string, place bigint, doc_id bigint, start bigint, doc_tokens bigint, ids binary"
STREAM = "part int, at bigint, source string, doc_id bigint, start bigint, doc_tokens bigint, ids binary"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string"


def _bounds(column: pa.Array, width: int) -> tuple[pa.Buffer, np.ndarray]:
    """Data of a binary column, and where its rows start in elements of ``width`` bytes (one more entry than rows)."""
    _, where, data = column.buffers()
    return data, np.frombuffer(where, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64) // width


def _binaries(data: pa.Buffer, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), data])


def encode(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str | Column, text: str | Column, source: str | Column) -> DataFrame:
    """Stored ids of each document with its place in its source's queue within the writing task."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    rows = docs.select(col(doc_id).cast("bigint").alias("doc_id"), col(source).cast("string").alias("source"), col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen: dict[str | None, int] = {}
        for batch in batches:
            buf, offs = text_buffer(batch.column(2))
            names = batch.column(1).to_pylist()
            for i, j in slices(offs, 1 << 20):
                ids, n = enc.encode_with_end(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], end_id)
                at = []
                for name, k in zip(names[i:j], n.tolist(), strict=True):
                    at.append(seen.get(name, 0))
                    seen[name] = at[-1] + k
                ends = np.concatenate([[0], np.cumsum(n)]) * ids.itemsize
                flat = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(j - i, part, np.int32)), batch.column(1).slice(i, j - i).cast(pa.string()), batch.column(0).slice(i, j - i), pa.array(at, pa.int64()), pa.array(n), flat], ["part", "source", "doc_id", "at", "n_tokens", "ids"])

    return materialize(rows.mapInArrow(trimmed(run), TOKENS), "tokens", compression="zstd")


def queues(per_part: DataFrame, weights: dict[str | None, float] | None, temper: float) -> tuple[DataFrame, dict[bool, tuple[np.ndarray, np.ndarray]]]:
    """``own`` (source), ``share`` and ``late`` of every source of ``per_part`` (``source, n``), and the curves of ``late``: times, and ids given to all queues by then."""
    sources = per_part.groupBy("source").agg(F.sum("n").alias("n")).withColumn("share", F.pow(F.col("n").cast("double"), F.lit(temper)))
    late = F.lit(False)
    if weights is not None:
        named = per_part.sparkSession.createDataFrame([(q, float(w)) for q, w in weights.items()], "named string, target double")
        sources = sources.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("named")), "left")  # as many rows as the caller named
        late = F.col("target").isNull()
        sources = sources.withColumn("share", F.coalesce("target", "share"))
    sources = materialize(sources.select(F.col("source").alias("own"), "n", "share", late.alias("late"), (F.col("n") / F.col("share")).alias("dry")), "queues")
    ranks = [k / KNOTS for k in range(1, KNOTS + 1)]
    times = sources.groupBy(F.col("late").alias("of")).agg(F.array_sort(F.array_distinct(F.array_append(F.percentile_approx("dry", ranks, 10 * KNOTS), F.max("dry")))).alias("times"))
    timed = sources.join(F.broadcast(times), F.col("late") == F.col("of"))  # two rows
    knot = F.size(F.filter("times", lambda t: t < F.col("dry")))
    sums = timed.groupBy("late", F.get("times", knot).alias("time")).agg(F.sum("n").alias("n"), F.sum("share").alias("share")).orderBy("late", "time")
    curves, base = {}, 0
    rows = sums.collect()  # at most KNOTS + 1 rows for each of the two curves
    for key in (False, True):
        own = [r for r in rows if r.late == key]
        time, n, share = (np.array([r[c] for r in own], np.float64) for c in ("time", "n", "share"))
        given = np.cumsum(n) + time * (share.sum() - np.cumsum(share))
        if own:
            given[-1] = n.sum()
        curves[key] = np.append(0.0, time), base + np.append(0.0, given)
        base += int(n.sum())
    return sources.select("own", "share", "late"), curves


def packets(placed: DataFrame, dtype: type, packet: int, length: int, curves: dict[bool, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """What each window takes (columns ``PACKETS``) of documents ``doc_id, source, late, share, at, n_tokens, ids``."""
    close = 1e-6  # of a packet or window, for sums that are whole numbers but for rounding

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            late, share, at, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4, 5))

            def window_of(place: np.ndarray) -> np.ndarray:
                """Windows in which the packets that hold these places of their queues are sent."""
                time = (place // packet + 1) * packet / share
                given = np.where(late, *(np.interp(time, *curves[k]) for k in (True, False)))
                return np.maximum(np.ceil(given / length - close).astype(np.int64) - 1, 0)

            first = window_of(at)
            per = window_of(at + n - 1) - first + 1
            row = np.repeat(np.arange(len(n)), per)
            ends = np.cumsum(per)
            window = np.arange(len(row)) - np.repeat(ends - per - first, per)
            time = np.where(late[row], *(np.interp((window + 1.0) * length, *curves[k][::-1]) for k in (True, False)))
            to = np.clip(np.floor(share[row] * time / packet + close).astype(np.int64) * packet, at[row], (at + n)[row]) - at[row]
            to[ends - 1] = n
            start = np.append(0, to[:-1])
            start[ends - per] = 0
            some = to > start
            row, window, start = row[some], window[some], start[some]
            data, where = _bounds(batch.column(6), dtype().itemsize)
            ids = _binaries(data, np.append(where[row] + start, where[-1]) * dtype().itemsize)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(2).take(take), pa.array(window), batch.column(1).take(take).cast(pa.string()), pa.array(at[row] + start), batch.column(0).take(take), pa.array(start), pa.array(n[row]), ids], ["late", "round", "source", "place", "doc_id", "start", "doc_tokens", "ids"])

    return placed.select("doc_id", "source", "late", "share", "at", "n_tokens", "ids").mapInArrow(trimmed(run), PACKETS)


def stream(sent: DataFrame, dtype: type) -> DataFrame:
    """Stored packets in the order in which they are sent (columns ``STREAM``); neighbours that continue a document are one row.

    ``at``: ids before the row in its partition; ``part`` numbers the partitions in order.
    """
    order = ["late", "round", "source", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, where = _bounds(batch.column(7), dtype().itemsize)
            size = np.diff(where)
            place, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            # A packet that is not a document's first continues the one before it if it is the next of the same queue.
            names = batch.column(2).cast(pa.string()).fill_null("\x00").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            go_on = (names[1:] == names[:-1]) & (place[1:] == place[:-1] + size[:-1]) & (start[1:] == start[:-1] + size[:-1]) & (start[1:] > 0)
            head = np.flatnonzero(np.append(True, ~go_on))
            bounds = np.append(where[head], where[-1])
            at = total + bounds[:-1] - bounds[0]
            total += int(bounds[-1] - bounds[0])
            take = pa.array(head)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(head), part, np.int32)), pa.array(at), *(batch.column(i).take(take) for i in (2, 4, 5, 6)), _binaries(data, bounds * dtype().itemsize)], ["part", "at", "source", "doc_id", "start", "doc_tokens", "ids"])

    sorted_ = sent.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(sorted_.mapInArrow(trimmed(run), STREAM), "stream", compression="zstd")


def pack(docs: DataFrame, tokenizer: str, *, end_id: int = 1, length: int = WINDOW, packet: int = PACKET, weights: dict[str | None, float] | None = None, temper: float = 1.0, doc_id: str | Column = "doc_id", text: str | Column = "text", source: str | Column = "source") -> DataFrame:
    """One row for each piece of a document in a window (columns ``PIECES``).

    ``weights``: target share of each source, in any unit; sources that are not named
    follow when the named ones are used up. Without, a source's target share goes with
    its number of ids to the power ``temper``: 1 for the corpus's own proportions (all
    queues end together), less to raise small sources.
    """
    dtype = encoder(tokenizer).dtype
    mark = scratch_count()
    stored = encode(docs, tokenizer, end_id, doc_id, text, source)
    per_part = materialize(stored.groupBy("source", "part").agg(F.sum("n_tokens").alias("n")), "queue-parts")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    shares, curves = queues(per_part, weights, temper)
    offsets = offsets.join(shares, F.col("source").eqNullSafe(F.col("own")))
    offsets = materialize(offsets.select(F.col("source").alias("of"), F.col("part").alias("in"), "base", "share", "late"), "queue-offsets")
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = stored.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))).withColumn("at", F.col("base") + F.col("at"))
    sent = stream(packets(placed, dtype, packet, length, curves), dtype)
    release_since(docs.sparkSession, mark, but=1)
    # One row for each partition of the stream: as many as its writer had tasks, whatever the corpus holds.
    width, base, total = dtype().itemsize, {}, 0
    for r in sent.groupBy("part").agg(F.sum(F.octet_length("ids")).alias("n")).orderBy("part").collect():
        base[r.part] = total // width
        total += r.n
    bases = docs.sparkSession.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, start, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 4, 5))
            data, where = _bounds(batch.column(6), width)
            at = at + np.array([bases.value[p] for p in batch.column(0).to_pylist()], np.int64)
            size = np.diff(where)
            first = at // length
            per = (at + size - 1) // length - first + 1
            row = np.repeat(np.arange(len(at)), per)
            window = np.repeat(first, per) + np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
            lo, hi = np.maximum(window * length, at[row]), np.minimum((window + 1) * length, (at + size)[row])
            ids = np.frombuffer(data, dtype)[where[0] : where[-1]].astype("<u4")
            from_ = where[row] - where[0] + lo - at[row]
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * i : 4 * j]) for i, j in zip(from_.tolist(), (from_ + hi - lo).tolist(), strict=True)]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(3).take(take), pa.array(start[row] + lo - at[row]), pa.array(hi - lo), pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(window), pa.array(lo - window * length), batch.column(2).take(take).cast(pa.string())], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"])

    return sent.mapInArrow(trimmed(run), PIECES)
