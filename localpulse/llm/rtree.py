"""N-gram Jaccard self-join over count vectors.

A document is its set of word shingles. Hashing the shingles into groups makes it
a point (its group counts), and the sum of coordinate minima of two points bounds
their overlap from above, so R-tree pages whose bounding boxes cannot reach the
needed overlap are pruned before any sets are compared.

A tree over all points would not prune: in many dimensions boxes of unlike
documents overlap, and the join would turn quadratic. So trees are built within
blocks that no linked pair can avoid sharing. If two sets may differ in at most D
shingles, and shingles are dealt into more than D groups by hash, then one group
at least has the same content in both. A block is the documents of like size that
share the content of one group; shared passages alone hardly ever fill a group.
That filter is exact, as are the bound and the final check of whole sets.

Order of work:
1. one pass over the texts: set size, set hash, point, block keys;
2. equal sets become one class; from here on only one representative of each moves;
3. an R-tree over each block gives every representative its first partner there
   (range queries from the block's first points, then a dual-tree join of what they
   leave; those that share most with others stand first); the partner met in most
   blocks is checked, and links give components;
4. blocks that still hold several components are joined by the trees again, one
   pair for each pair of components first, then all that is left across components;
   subtrees of one component are not descended. These pairs are checked too.
   Nothing else can link.

A block with more than ``CHUNK`` members is searched in chunks. In step 3 each holds
the block's first member; in step 4 all members outside that one's component.

Defined cases: a null or empty text has an empty set and is linked with nothing;
a text with fewer words than a shingle is one shingle; to ``near_duplicates`` rows with
one id are one document, whatever their texts, and rows with a null id are linked with
nothing and get a null component; ``keep_one`` tells rows apart by id and text, and
links those of a null id like any others; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from localpulse.llm.core import LOWER, NOT_SPACE, gram_hashes, materialize, mix64, release_since, run_hashes, scratch_count, text_buffer, trimmed, word_runs
from localpulse.llm.graph import components
from localpulse.llm.tokens import slices

#: Coordinates of a point.
GROUPS = 32
#: Ids up to which the set of documents to compare is broadcast to the scan of the texts; beyond, it is joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Entries of a tree node.
PAGE = 16
#: Members of a block that are searched in one tree.
CHUNK = 8192
#: Members of a task, about.
TASK_ROWS = 50_000
#: Range queries from a block's first points before the dual-tree join.
SEEDS = 4
#: Ratio of neighbouring size bands; above the greatest ratio of two linked sets.
_MARGIN = 1.003


@dataclass(frozen=True)
class Rule:
    """Shingle length, least Jaccard similarity in percent, and how many parities a shingle are kept, about."""

    words: int
    percent: int
    fine: int = 1

    @property
    def ratio(self) -> float:
        return 100 / self.percent * _MARGIN

    def band(self, n: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(n, 1)) / math.log(self.ratio)).astype(np.int64)

    def blocks(self, band: int) -> tuple[int, int]:
        """Groups of the grid in which bands ``band`` and ``band + 1`` meet, and how many empty groups a set may leave out."""
        most = self.ratio ** (band + 1) * (1 + self.ratio) + 1
        differ = int((100 - self.percent) * most / (100 + self.percent))
        if not differ:
            return 0, 0
        load = most / 2 / (differ + 4)
        spare = 3 + math.ceil(2 * differ * math.exp(-min(load, 50.0)))
        return differ + 1 + spare, spare


#: Least and most fine groups of a set, of whose counts the parities are kept; a power of two near the set's size, times ``Rule.fine`` (a power of two).
FINE = (256, 4096)

SKETCH = "doc_id bigint, text_hash bigint, n bigint, h1 bigint, h2 bigint, point binary, parity binary, blocks binary"
#: A row's set of shingles, up to equality.
SAME = ["h1", "h2", "n"]


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, row by row, and the row of each."""
    starts, ends = word_runs(buf, offs, NOT_SPACE)
    words = run_hashes(buf, starts, ends, LOWER)
    at = np.searchsorted(starts, offs)
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    grams = gram_hashes(words, k)
    inside = owner[: len(grams)] == owner[k - 1 :] if len(grams) else np.zeros(0, bool)
    hashes, rows = [grams[inside]], [owner[: len(grams)][inside]]
    for short in range(1, k):
        own = np.flatnonzero(n == short)
        if len(own):
            hashes.append(mix64(gram_hashes(words, short)[at[own]] + np.uint64(short)))
            rows.append(own)
    h, row = np.concatenate(hashes), np.concatenate(rows)
    first = ~pd.Series(mix64(h ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))).duplicated().to_numpy()
    h, row = h[first], row[first]
    order = np.argsort(row, kind="stable")
    return h[order], row[order]


def block_keys(h: np.ndarray, row: np.ndarray, n: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Block keys of all rows, and the row of each."""
    band = rule.band(n)
    keys, rows = [], []
    for shift in (0, -1):
        grid = band + shift
        size = {b: rule.blocks(b) if b >= 0 else (0, 0) for b in np.unique(grid).tolist()}
        groups = np.array([size[b][0] for b in grid.tolist()], np.int64)
        spare = np.array([size[b][1] for b in grid.tolist()], np.int64)
        groups[n == 0] = 0
        base = np.cumsum(groups) - groups
        total = int(groups.sum())
        use = groups[row] > 0
        hu, ru = h[use], row[use]
        slot = base[ru] + (mix64(hu ^ np.uint64(0x5851F42D4C957F2D)) % groups[ru].astype(np.uint64)).astype(np.int64)
        content = np.zeros(total, np.uint64)
        np.add.at(content, slot, mix64(hu))
        filled = np.bincount(slot, minlength=total)
        owner = np.repeat(np.arange(len(n)), groups)
        empty = np.bincount(owner[filled == 0], minlength=len(n))
        keep = (filled > 0) | (empty > spare)[owner]
        place = np.arange(total) - base[owner]
        key = mix64(content + mix64((grid[owner].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64)) + filled.astype(np.uint64))
        keys.append(key[keep])
        rows.append(owner[keep])
    key, owner = np.concatenate(keys), np.concatenate(rows)
    order = np.argsort(owner, kind="stable")
    return key[order], owner[order]


def parities(h: np.ndarray, row: np.ndarray, n: np.ndarray, fine: int) -> tuple[np.ndarray, np.ndarray]:
    """Parity bits of the fine group counts of all rows, packed, and the bytes of each row."""
    groups = fine * np.clip(2 ** np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), *FINE)
    base = np.cumsum(groups) - groups
    slot = base[row] + (mix64(h ^ np.uint64(0x1F83D9ABFB41BD6B)) & (groups[row] - 1).astype(np.uint64)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=int(groups.sum())) & 1).astype(np.uint8)), groups // 8


def packed_points(point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points in the least of 1, 2 or 4 bytes a coordinate that holds the row, and the bytes of each row."""
    top = point.max(1, initial=0)
    width = np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))
    raw = point.astype("<u4").view(np.uint8).reshape(len(point), GROUPS, 4)
    return raw[np.broadcast_to(np.arange(4) < width[:, None, None], raw.shape)], width * GROUPS


def binary_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column and where its rows start (one more entry than rows)."""
    _, where, data = column.buffers()
    where = np.frombuffer(where, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), where


def unpacked_points(column: pa.Array) -> np.ndarray:
    data, where = binary_rows(column)
    out = np.empty((len(column), GROUPS), np.int32)
    size = np.diff(where)
    for w in (1, 2, 4):
        own = np.flatnonzero(size == w * GROUPS)
        out[own] = data[where[own][:, None] + np.arange(w * GROUPS)].view(f"<u{w}")
    return out


class Parities:
    """Parity bits of the fine group counts of a batch."""

    def __init__(self, column: pa.Array) -> None:
        self.data, self.where = binary_rows(column)
        self.size = np.diff(self.where)

    def _folded(self, rows: np.ndarray, size: int) -> np.ndarray:
        """Parities at ``size`` bytes: the parts of a longer row are added up."""
        out = np.zeros((len(rows), size), np.uint8)
        for k in np.unique(self.size[rows]).tolist():
            own = np.flatnonzero(self.size[rows] == k)
            out[own] = np.bitwise_xor.reduce(self.data[self.where[rows[own]][:, None] + np.arange(k)].reshape(len(own), -1, size), 1)
        return out.view(np.uint64)

    def differ(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Unequal parities of each pair of rows at the smaller number of groups: no more than the shingles in which the sets differ."""
        out = np.empty(len(x), np.int64)
        least = np.minimum(self.size[x], self.size[y])
        for k in np.unique(least).tolist():
            for own in np.array_split(np.flatnonzero(least == k), 1 + int((least == k).sum()) * k // (8 << 20)):
                out[own] = np.bitwise_count(self._folded(x[own], k) ^ self._folded(y[own], k)).sum(1, dtype=np.int64)
        return out


def _binary_column(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _sum_by_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, np.uint64)
    np.add.at(out, row, values)
    return out


def set_hashes(h: np.ndarray, row: np.ndarray, rows: int) -> list[np.ndarray]:
    """Two 64-bit hashes of each row's set."""
    return [_sum_by_row(mix64(h ^ np.uint64(s)), row, rows).view(np.int64) for s in (0x2545F4914F6CDD1D, 0x27D4EB2F165667C5)]


def _input(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def sketches(docs: DataFrame, rule: Rule, keys_of=block_keys) -> DataFrame:
    """Columns ``SKETCH`` for every row of ``docs`` (``doc_id, text_hash, text``); ``keys_of`` (as ``block_keys``) gives the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(2))
            for i, j in slices(offs, 1 << 20):
                rows = j - i
                h, row = shingle_sets(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], rule.words)
                n = np.bincount(row, minlength=rows)
                h1, h2 = set_hashes(h, row, rows)
                point = np.bincount(row * GROUPS + (mix64(h) >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=rows * GROUPS).astype(np.int32)
                key, owner = keys_of(h, row, n, rule)
                blocks = _binary_column(key, 8 * np.bincount(owner, minlength=rows))
                points = _binary_column(*packed_points(point.reshape(rows, GROUPS)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, rows), batch.column(1).slice(i, rows), pa.array(n), pa.array(h1), pa.array(h2), points, _binary_column(*parities(h, row, n, rule.fine)), blocks], ["doc_id", "text_hash", "n", "h1", "h2", "point", "parity", "blocks"])

    return docs.mapInArrow(trimmed(run), SKETCH)


def exploded_blocks(reps: DataFrame) -> DataFrame:
    """``key, node`` for each block of each representative (``node, blocks``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, where = binary_rows(batch.column(1))
            keys = data[where[0] : where[-1]].view(np.int64)
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(where) // 8)
            for a in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + (1 << 16)]), pa.array(nodes[a : a + (1 << 16)])], ["key", "node"])

    return reps.select("node", "blocks").mapInArrow(trimmed(run), "key bigint, node bigint")


def _sets(docs: DataFrame, pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Stored ``node, items`` for the classes of ``pairs``, from a row of each class."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    nodes = materialize(classes.join(nodes, "node", "left_semi").select("node", "rep", "h1", "h2"), "nodes")
    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    few = docs.join(nodes, F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & (F.col("text_hash") == F.col("rep.text_hash"))).select("node", "text", "h1", "h2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            for i, j in slices(offs, 1 << 20):
                h, row = shingle_sets(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], rule.words)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))]).astype(np.int32)
                # Another text with the hash of the representative's is not its class.
                own = np.ones(j - i, bool)
                for c, have in zip((2, 3), set_hashes(h, row, j - i), strict=True):
                    own &= batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) == have
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))], ["node", "items"])
                yield out if own.all() else out.filter(pa.array(own))

    sets = few.mapInArrow(trimmed(run), "node bigint, items array<bigint>")
    return materialize(sets, "sets").groupBy("node").agg(F.first("items").alias("items"))  # a row that stands twice gives its set twice


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Those of the stored pairs ``a, b`` whose whole sets are similar enough."""
    if pairs.isEmpty():
        return pairs
    sets = _sets(docs, pairs, classes, rule)
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y")).cast("bigint")
    union = F.size("x") + F.size("y") - common
    return materialize(both.where(common * 100 >= union * rule.percent).select("a", "b"), "links")


def _may_link(n_a, n_b, bound, rule: Rule):
    """Whether an overlap of ``bound`` would reach the threshold: works on numbers, arrays and Columns."""
    return bound * (100 + rule.percent) >= (n_a + n_b) * rule.percent


def _may_link_fine(n_a, n_b, differ, rule: Rule):
    """The same, from a lower bound of how many shingles differ."""
    return differ * (100 + rule.percent) <= (n_a + n_b) * (100 - rule.percent)


def _packed(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """``rows`` halved at the middle of their widest coordinate until they fit a page."""
    if len(rows) <= PAGE:
        return [rows]
    own = points[rows]
    rows = rows[np.argsort(own[:, np.ptp(own, 0).argmax()], kind="stable")]
    half = PAGE * (-(-len(rows) // PAGE) // 2)
    return _packed(points, rows[:half]) + _packed(points, rows[half:])


class CountTree:
    """An R-tree over the points of a block, packed level by level into pages up to one root.

    A node keeps the least set size and the greatest count of each group below it, so
    the summed minima of two nodes bound the overlap of any two sets below them; and
    the label that all points below it share, if they do. Two nodes of one label are
    not descended.

    The sum of coordinate minima is half of what two sizes leave of the points' L1
    distance. In the fine groups, of which only parities are kept, that distance is
    at least the number of unequal parities, which bounds the minima once more.
    """

    def __init__(self, n: np.ndarray, points: np.ndarray, label: np.ndarray) -> None:
        wide = np.column_stack([points, n])
        kinds, many = np.unique(label, return_counts=True)
        # Points of one label stand together, so that whole subtrees have it.
        parts = [own for k in kinds[many > PAGE].tolist() for own in _packed(wide, np.flatnonzero(label == k))]
        self.order = np.concatenate(parts + _packed(wide, np.flatnonzero(np.isin(label, kinds[many <= PAGE]))))
        self.low, self.high, self.label = [n[self.order]], [points[self.order]], [label[self.order]]
        while len(self.low[-1]) > 1:
            heads = np.arange(0, len(self.low[-1]), PAGE)
            least, most = np.minimum.reduceat(self.label[-1], heads), np.maximum.reduceat(self.label[-1], heads)
            self.low.append(np.minimum.reduceat(self.low[-1], heads))
            self.high.append(np.maximum.reduceat(self.high[-1], heads))
            self.label.append(np.where(least == most, least, -1))

    def near(self, n: int, point: np.ndarray, rule: Rule) -> np.ndarray:
        """Points (positions of the input) that may link with ``point``: a range query."""
        found = np.zeros(1, np.int64)
        for level in range(len(self.low) - 1, -1, -1):
            found = found[_may_link(self.low[level][found], n, np.minimum(self.high[level][found], point).sum(1), rule)]
            if level:
                found = (found[:, None] * PAGE + np.arange(PAGE)).ravel()
                found = found[found < len(self.low[level - 1])]
        return self.order[found]

    def pairs(self, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points (positions of the input) of unlike labels that may link: a join of the tree with itself, depth first."""
        top = len(self.low) - 1
        todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))] if top else []
        while todo:
            level, i, j = todo.pop()
            if len(i) > 64:
                todo.append((level, i[64:], j[64:]))
                i, j = i[:64], j[:64]
            level -= 1
            x = np.broadcast_to((i[:, None] * PAGE + np.arange(PAGE))[:, :, None], (len(i), PAGE, PAGE)).ravel()
            y = np.broadcast_to((j[:, None] * PAGE + np.arange(PAGE))[:, None, :], (len(i), PAGE, PAGE)).ravel()
            ok = (y < len(self.low[level])) & ((x <= y) if level else (x < y))
            x, y = x[ok], y[ok]
            label = self.label[level]
            ok = (label[x] != label[y]) | (label[x] < 0)
            x, y = x[ok], y[ok]
            low, high = self.low[level], self.high[level]
            ok = _may_link(low[x], low[y], np.minimum(high[x], high[y]).sum(1), rule)
            if ok.any():
                if level:
                    todo.append((level, x[ok], y[ok]))
                else:
                    yield self.order[x[ok]], self.order[y[ok]]


class Blocks:
    """Whole blocks of one batch: their members in the order of block and rank."""

    def __init__(self, batch: pa.RecordBatch, heads: np.ndarray) -> None:
        self.node, self.label, self.n = (batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3, 4))
        self.points, self.parity = unpacked_points(batch.column(5)), Parities(batch.column(6))
        self.heads, self.sizes = heads, np.diff(np.append(heads, batch.num_rows))

    def _fine(self, x: np.ndarray, y: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that the fine bound leaves, and in how many parities they differ."""
        differ = self.parity.differ(x, y)
        ok = _may_link_fine(self.n[x], self.n[y], differ, rule) & (self.node[x] != self.node[y])
        return x[ok], y[ok], differ[ok]

    def _pages(self, cross: bool, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs within blocks of one page, for all of them at once."""
        small = self.sizes <= PAGE
        heads, sizes = self.heads[small], self.sizes[small]
        step = max(1, (1 << 18) // (PAGE * PAGE))
        for s in range(0, len(heads), step):
            own = sizes[s : s + step]
            row = np.repeat(heads[s : s + step], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            ahead = np.repeat(heads[s : s + step] + own, own) - row - 1
            x = np.repeat(row, ahead)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(ahead) - ahead, ahead)
            if cross:
                unlike = self.label[x] != self.label[y]
                x, y = x[unlike], y[unlike]
            ok = _may_link(self.n[x], self.n[y], np.minimum(self.points[x], self.points[y]).sum(1), rule)
            yield self._fine(x[ok], y[ok], rule)

    def _tree(self, rows: np.ndarray, label: np.ndarray) -> CountTree:
        return CountTree(self.n[rows], self.points[rows], label)

    def first_partners(self, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each member at most one partner in its block that stands before it and may link."""

        def first(x, y):
            x, y = np.minimum(x, y), np.maximum(x, y)
            order = np.lexsort((x, y))
            keep = order[np.append(True, np.diff(y[order]) != 0)] if len(y) else order
            return x[keep], y[keep]

        for x, y, _ in self._pages(False, rule):
            yield first(x, y)
        for head, size in zip(self.heads[self.sizes > PAGE].tolist(), self.sizes[self.sizes > PAGE].tolist(), strict=True):
            rows = np.arange(head, head + size)
            tree = self._tree(rows, np.arange(size))
            open_ = np.ones(size, bool)
            for _ in range(SEEDS):
                if not open_.any():
                    break
                seed = int(open_.argmax())
                open_[seed] = False
                near = tree.near(int(self.n[head + seed]), self.points[head + seed], rule)
                near = head + near[open_[near]]
                x, y, _ = self._fine(np.full(len(near), head + seed), near, rule)
                open_[y - head] = False
                yield x, y
            rest = rows[open_]
            if len(rest) > 1:
                for x, y in self._tree(rest, np.arange(len(rest))).pairs(rule):
                    yield first(*self._fine(rest[x], rest[y], rule)[:2])

    def cross_pairs(self, rule: Rule, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs across labels that may link: all of them, or for each two labels of a block (or page run) the nearest pair."""

        def chosen(x, y, differ):
            if every or not len(x):
                return x, y
            low, high = np.minimum(self.label[x], self.label[y]), np.maximum(self.label[x], self.label[y])
            order = np.lexsort((self.node[y], self.node[x], differ, high, low))
            keep = order[np.append(True, (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0))]
            return x[keep], y[keep]

        for found in self._pages(True, rule):
            yield chosen(*found)
        for head, size in zip(self.heads[self.sizes > PAGE].tolist(), self.sizes[self.sizes > PAGE].tolist(), strict=True):
            rows = np.arange(head, head + size)
            held = [np.zeros(0, np.int64)] * 3
            for x, y in self._tree(rows, np.unique(self.label[rows], return_inverse=True)[1]).pairs(rule):
                new = self._fine(rows[x], rows[y], rule)
                if every:
                    yield new[:2]
                    continue
                x, y = chosen(*(np.concatenate(z) for z in zip(held, new, strict=True)))
                held = [x, y, self.parity.differ(x, y)]
            yield held[0], held[1]


def block_pairs(members: DataFrame, rule: Rule, search) -> DataFrame:
    """Distinct pairs ``a, b`` (``a`` of higher rank) that ``search`` (of ``Blocks``) finds within blocks, and in how many blocks (``shared``).

    ``members``: ``key, chunk, node, rank, label, n, point, parity``; a block is a key and chunk.
    """
    spark = members.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, 1 + members.count() // TASK_ROWS)
    columns = ["key", "chunk", "node", "label", "n", "point", "parity", "rank"]
    sorted_ = members.select(*columns).repartition(parts, "key", "chunk").sortWithinPartitions("key", "chunk", F.desc("rank"), "node").drop("rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(batch, heads):
            for x, y in search(Blocks(batch, heads), rule):
                if len(x):
                    a, b = (batch.column(2).take(pa.array(z)) for z in (np.minimum(x, y), np.maximum(x, y)))
                    yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

        held = None
        for batch in batches:
            if held is not None and held.num_rows:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key, chunk = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            heads = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1])))
            yield from whole(batch.slice(0, int(heads[-1])), heads[:-1])
            held = batch.slice(int(heads[-1]))
        if held is not None:
            yield from whole(held, np.zeros(1, np.int64))

    return sorted_.mapInArrow(trimmed(run), "a bigint, b bigint").groupBy("a", "b").agg(F.count("*").alias("shared"))


def _chunked(members: DataFrame, everywhere) -> DataFrame:
    """``members`` (``node, size``) with ``chunk``; those of ``everywhere`` stand in all chunks of their block."""
    chunks = F.ceil(F.col("size") / CHUNK)
    own = F.array(F.pmod(F.xxhash64("node"), chunks))
    return members.withColumn("chunk", F.explode(F.when((chunks > 1) & everywhere, F.sequence(F.lit(0).cast("bigint"), chunks - 1)).otherwise(own))).drop("size")


def classes_of(sketch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored classes of equal sets (``node, h1, h2, n, rep``), and one row of each (``node, n, point, parity, blocks``).

    ``sketch``: stored columns ``SKETCH`` and ``row``, a number of the row. ``rep`` is the least row by id (nulls last) and text.
    """
    full = sketch.where("n > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "row"))
    classes = materialize(full.groupBy(*SAME).agg(least.alias("rep")).withColumn("node", F.monotonically_increasing_id()), "classes")
    reps = full.join(classes.select("node", *SAME, F.col("rep.row").alias("row")), [*SAME, "row"])
    return classes, reps.select("node", "n", "point", "parity", "blocks")


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """``members`` of the blocks that hold several components, with ``label`` and the ``first`` label of the block."""
    labelled = members.join(found, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by("label", "node").alias("first")).where("lo <> hi")
    return labelled.join(mixed.select("key", "first"), "key")


def linked(members: DataFrame, points: DataFrame, tried: DataFrame, docs: DataFrame, classes: DataFrame, rule: Rule, also: DataFrame | None = None) -> DataFrame:
    """``node, component`` from the stored pairs ``tried`` (``a, b``) and whatever else links within blocks (``members``: ``key, node, size``).

    ``tried`` is checked first; the stored pairs ``also`` link unchecked. Of blocks that then hold several components the trees give
    one pair for each two of them, and at last all pairs across components.
    """
    links = verified(tried, docs, classes, rule)
    if also is not None:
        links = links.unionByName(also)
    found = materialize(components(links), "components")
    for every in (False, True):
        split = materialize(_mixed(members, found), "split")
        if split.isEmpty():
            break
        placed = _chunked(split, F.col("label") != F.col("first"))
        more = block_pairs(placed.join(points, "node"), rule, lambda blocks, rule, every=every: blocks.cross_pairs(rule, every))
        if not every:  # of the pairs that the blocks show for two components, the one of most blocks
            of = lambda c: split.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")).distinct()  # noqa: E731, B023
            sides = more.join(of("a"), "a").join(of("b"), "b")
            more = sides.groupBy(F.least("of_a", "of_b").alias("x"), F.greatest("of_a", "of_b").alias("y")).agg(F.max_by(F.struct("a", "b"), F.struct("shared", -F.col("a"), -F.col("b"))).alias("pair")).select("pair.*")
        more = materialize(more.select("a", "b").join(tried, ["a", "b"], "left_anti"), "pairs")
        if more.isEmpty():
            break
        new = verified(more, docs, classes, rule)
        tried = tried.unionByName(more)
        if not new.isEmpty():
            links = links.unionByName(new)
            found = materialize(components(links), "components")
    return found


def named(classes: DataFrame, found: DataFrame) -> DataFrame:
    """Stored ``h1, h2, n`` of each class with its component's least row (``least``) and id."""
    of = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = of.groupBy("component").agg(F.min("rep").alias("least"))
    return materialize(of.join(least, "component").select(*SAME, "least"), "named")


def grouped(sketch: DataFrame, names: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n, least`` (null for empty sets) of every row."""
    return sketch.select("doc_id", "text_hash", *SAME).join(names, SAME, "left").select("doc_id", "text_hash", "n", "least")


def _groups(docs: DataFrame, words: int, percent: int, doc_id: str, text: str, by_id: bool) -> DataFrame:
    """``grouped`` rows; ``by_id``: rows of one id are one document, and rows without an id are left out of the groups."""
    rule = Rule(words, percent)
    docs = _input(docs, doc_id, text)
    mark = scratch_count()
    sketch = materialize(sketches(docs, rule).withColumn("row", F.monotonically_increasing_id()), "sketches")
    full = sketch.where("n > 0 AND doc_id IS NOT NULL") if by_id else sketch
    classes, reps = classes_of(full)
    shared = Window.partitionBy("key")
    members = exploded_blocks(reps).withColumn("size", F.count("*").over(shared)).where("size > 1")
    members = materialize(members, "blocks")
    # A member's rank is the number of neighbours that its blocks show: an original ranks before its copies.
    ranks = members.groupBy("node").agg(F.sum("size").alias("rank"))
    points = materialize(reps.select("node", "n", "point", "parity").join(ranks, "node"), "points")
    large = members.where(F.col("size") > CHUNK).join(ranks, "node").groupBy("key").agg(F.max_by("node", F.struct("rank", -F.col("node"))).alias("hub"))

    # Every representative's first partners by the trees; the one met in most blocks is checked.
    placed = _chunked(members.join(large, "key", "left"), F.col("node") == F.col("hub")).withColumn("label", F.col("node"))
    partners = block_pairs(placed.join(points, "node"), rule, Blocks.first_partners)
    best = partners.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    tried = materialize(best.select("a", "b"), "pairs")
    also = None
    if by_id:
        ids = full.select("doc_id", *SAME).join(classes, SAME).select("doc_id", "node")
        ids = ids.join(ids.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("doc_id", "a"), "doc_id")
        also = materialize(ids.where("a <> node").select("a", F.col("node").alias("b")).distinct(), "links")
    names = named(classes, linked(members, points, tried, docs, classes, rule, also))
    release_since(docs.sparkSession, mark + 1, but=1)  # all but the sketches and the names
    return grouped(sketch, names)


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: set size, and the least id reachable by links of similar sets."""
    out = _groups(docs, words, percent, doc_id, text, by_id=True)
    component = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("least.doc_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, *, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the least id (nulls last), then of the least text hash.

    Rows without a word stay. Rows are told apart by id and text; of rows that agree in both, one of the group's stays.
    """
    mark = scratch_count()
    rows = _groups(docs, words, percent, doc_id, text, by_id=False).where("n > 0")
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    keys = rows.groupBy(F.col("doc_id").alias("__lp_id"), F.col("text_hash").alias("__lp_text")).agg(F.bool_or(stays).alias("stays"), F.count("*").alias("times"))
    gone = materialize(keys.where("NOT stays OR times > 1"), "near-duplicates")
    release_since(docs.sparkSession, mark, but=1)
    at = F.col(doc_id).cast("bigint").eqNullSafe(F.col("__lp_id")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__lp_text"))
    out = docs.join(gone, at, "left_anti")
    twice = gone.where("stays").select("__lp_id", "__lp_text")
    if twice.isEmpty():
        return out
    whole = F.first(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("row")
    return out.unionByName(docs.join(twice, at).groupBy("__lp_id", "__lp_text").agg(whole).select("row.*"))
