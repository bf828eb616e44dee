"""Token-id files compressed by a pair grammar (Re-Pair), decodable document by document.

Texts are range-partitioned by document id, encoded, and cut into shards of
about ``SHARD_TOKENS`` ids that end at a document's end. In each shard the most
frequent pairs of neighbouring symbols become nonterminals, round after round,
until no pair occurs ``MIN_COUNT`` times or the symbol space is used up. Symbols
have 16 bits where the vocabulary leaves a quarter of those free, else 32 bits with
``WIDE_RULES`` nonterminals. A shard is one row: rules, expansion lengths, the symbol stream, and where each
document's symbols start. No rule crosses a document's end, so a document, or a
range of its ids, decodes without the rest of its shard.

Defined cases: a null or empty text is one id (the end id); documents with equal
ids are ordered by a hash of the text, then by text; a null document id sorts first; an empty table gives no
shard. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, text_buffer, trimmed
from localpulse.llm.tokens import encoder, slices

SHARD_TOKENS = 1 << 20
MIN_COUNT = 12
PAIRS_A_ROUND = 2048
#: Nonterminals of a shard whose vocabulary does not fit 16-bit symbols.
WIDE_RULES = 1 << 18
_HEAD = struct.Struct("<4sIIIIIII")  # magic, base symbols, bytes of a symbol, rules, rounds, documents, symbols, ids

SHARDS = "part int, shard int, part_start bigint, n_docs int, n_tokens bigint, n_symbols bigint, payload binary"


def symbol_space(base: int) -> tuple[int, type]:
    """Symbols (ids and nonterminals) of a shard with ``base`` ids, and the type that holds them."""
    return (1 << 16, np.uint16) if 4 * base <= 3 << 16 else (base + WIDE_RULES, np.uint32)


def compress(ids: np.ndarray, doc_tokens: np.ndarray, base: int, *, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Symbols, rules (left, right), symbols per document, and rules made up to each round."""
    space, kind = symbol_space(base)
    seq = ids.astype(np.uint32)
    if len(seq) and int(seq.max()) >= base:
        raise ValueError(f"id {int(seq.max())} is outside a vocabulary of {base}")
    # Two symbols as one number: of 32 bits where the symbols have 16.
    half, key = (np.uint32(16), np.uint32) if kind is np.uint16 else (np.uint64(32), np.uint64)
    low = key((1 << int(half)) - 1)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(doc_tokens)[doc_tokens > 0] - 1] = True
    rules = np.zeros((0, 2), np.uint32)
    made = []
    while len(seq) > 1:
        room = min(PAIRS_A_ROUND, space - base - len(rules))
        if room <= 0:
            break
        pair = (seq[:-1].astype(key) << half) | seq[1:]
        inner = ~last[:-1]
        keys = np.sort(pair[inner])
        if not len(keys):
            break
        head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        count = np.diff(np.append(head, len(keys)))
        good = np.flatnonzero(count >= min_count)
        if not len(good):
            break
        order = np.lexsort((keys[head[good]], -count[good]))[:room]
        chosen = np.sort(keys[head[good[order]]])
        left, right = np.zeros(space, bool), np.zeros(space, bool)
        left[chosen >> half], right[chosen & low] = True, True
        at = np.flatnonzero(inner & left[seq[:-1]] & right[seq[1:]])
        slot = np.minimum(np.searchsorted(chosen, pair[at]), len(chosen) - 1)
        hit = chosen[slot] == pair[at]
        at, slot = at[hit], slot[hit]
        # Of overlapping occurrences (neighbouring starts) every second one is taken, from the left.
        new = np.concatenate([[True], np.diff(at) != 1])
        run = np.flatnonzero(new)
        step = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        take = step % 2 == 0
        at, slot = at[take], slot[take]
        seq[at] = base + len(rules) + slot
        last[at] = last[at + 1]
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, last = seq[stay], last[stay]
        rules = np.concatenate([rules, np.stack([chosen >> half, chosen & low], 1).astype(np.uint32)])
        made.append(len(rules))
    ends = np.flatnonzero(last) + 1
    per_doc = np.zeros(len(doc_tokens), np.int64)
    per_doc[doc_tokens > 0] = np.diff(np.concatenate([[0], ends]))
    return seq, rules, per_doc, made


def expansion_lengths(rules: np.ndarray, base: int, made: list[int]) -> np.ndarray:
    """Ids each nonterminal stands for."""
    size = np.ones(base + len(rules), np.uint32)
    done = 0
    for stop in made:
        size[base + done : base + stop] = size[rules[done:stop, 0]] + size[rules[done:stop, 1]]
        done = stop
    return size[base:]


def pack_shard(doc_ids: np.ndarray, doc_tokens: np.ndarray, ids: np.ndarray, base: int) -> tuple[bytes, int]:
    seq, rules, per_doc, made = compress(ids, doc_tokens, base)
    kind = symbol_space(base)[1]
    parts = [
        _HEAD.pack(b"RPG2", base, kind().itemsize, len(rules), len(made), len(doc_ids), len(seq), len(ids)),
        np.array(made, np.uint32), rules.astype(kind), expansion_lengths(rules, base, made),
        doc_ids.astype(np.int64), per_doc.astype(np.uint32), doc_tokens.astype(np.uint32), seq.astype(kind),
    ]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts), len(seq)


class Shard:
    """One shard read back: whole, by document, or by a range of a document's ids."""

    def __init__(self, payload: bytes) -> None:
        magic, self.base, width, n_rules, rounds, docs, symbols, self.n_tokens = _HEAD.unpack_from(payload)
        if magic != b"RPG2":
            raise ValueError("not a shard of pair-grammar token ids")
        self.kind = np.uint16 if width == 2 else np.uint32
        at = _HEAD.size

        def read(kind, n):
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.made = read(np.uint32, rounds).tolist()
        self.rules = read(self.kind, 2 * n_rules).reshape(-1, 2)
        self.sizes = read(np.uint32, n_rules)
        self.doc_ids, self.doc_symbols, self.doc_tokens = read(np.int64, docs), read(np.uint32, docs), read(np.uint32, docs)
        self.symbols = read(self.kind, symbols)

    def expand(self, seq: np.ndarray) -> np.ndarray:
        seq = seq.astype(self.kind)
        tops = [0, *self.made]
        for low, high in zip(tops[-2::-1], tops[:0:-1], strict=True):
            big = (seq >= self.base + low) & (seq < self.base + high) if high < len(self.rules) else seq >= self.base + low
            n = big.astype(np.int64) + 1
            stop = np.cumsum(n)
            out = np.empty(int(stop[-1]) if len(stop) else 0, self.kind)
            first = stop - n
            rule = self.rules[seq[big].astype(np.int64) - self.base]
            out[first] = seq
            out[first[big]], out[first[big] + 1] = rule[:, 0], rule[:, 1]
            seq = out
        return seq

    def ids(self) -> np.ndarray:
        return self.expand(self.symbols)

    def document(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard's i-th document; only symbols that reach into the range are expanded."""
        a = int(self.doc_symbols[:i].sum(dtype=np.int64))
        seq = self.symbols[a : a + int(self.doc_symbols[i])]
        size = np.ones(len(seq), np.int64)
        big = seq >= self.base
        size[big] = self.sizes[seq[big].astype(np.int64) - self.base]
        reach = np.cumsum(size)
        stop = int(reach[-1]) if stop is None else stop
        i0, i1 = int(np.searchsorted(reach, start, "right")), int(np.searchsorted(reach, stop, "left")) + 1
        skip = int(reach[i0 - 1]) if i0 else 0
        return self.expand(seq[i0:i1])[start - skip : stop - skip]


def write_shards(docs: DataFrame, tokenizer: str, *, end_id: int = 2, doc_id: str | Column = "doc_id", text: str | Column = "text") -> DataFrame:
    """Encode ``docs`` and store them as shards; returns the stored shard table (columns ``SHARDS``)."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    rows = docs.select(col(doc_id).cast("bigint").alias("doc_id"), col(text).cast("string").alias("text"))
    # The hash spreads the rows of one id, and those without an id, over several tasks.
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        base = enc.tok.get_vocab_size(with_added_tokens=True)
        held: list[tuple] = []
        shard = size = start = 0

        def flush():
            nonlocal held, shard, size, start
            keys, n, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            payload, symbols = pack_shard(keys, n, ids, base)
            out = pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, shard, start, len(keys), size, symbols, payload), (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "shard", "part_start", "n_docs", "n_tokens", "n_symbols", "payload"])
            held, shard, start, size = [], shard + 1, start + size, 0
            return out

        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            keys = batch.column(0).fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            for i, j in slices(offs, 1 << 20):
                ids, n = enc.encode_with_end(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], end_id)
                held.append((keys[i:j], n, ids))
                size += len(ids)
                if size >= SHARD_TOKENS:
                    yield flush()
        if held:
            yield flush()

    return materialize(rows.mapInArrow(trimmed(run), SHARDS), "token-shards")


def read_documents(shards: DataFrame) -> DataFrame:
    """Decode every shard: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32``."""
    spark = shards.sparkSession
    # One row for each partition of the writer: as many as it had tasks, whatever the corpus holds.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, before = {}, 0
    for r in totals:
        base[r.part] = before
        before += r.n
    before_part = spark.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, begin, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = Shard(payload.as_buffer())
                ids = s.ids().astype("<u4")
                n = s.doc_tokens.astype(np.int64)
                stop = np.cumsum(n)
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((stop - n).tolist(), stop.tolist(), strict=True)]
                keys = pa.array(s.doc_ids, mask=s.doc_ids == -(2**63))
                yield pa.RecordBatch.from_arrays([keys, pa.array(before_part.value[part] + begin + stop - n), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "part_start", "payload").mapInArrow(trimmed(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
