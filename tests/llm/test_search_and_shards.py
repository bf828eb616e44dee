"""Positional index, curve sharding, robust outliers against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from localpulse.llm import hilbert, positional, robust
from localpulse.llm.core import text_buffer

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def hit_positions(text, items, window):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        own = words(t)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            g = own[k : k + window]
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit.update(range(i, i + len(g)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


texts = st.lists(st.text(alphabet="abé AB.\n", max_size=40), min_size=1, max_size=5)


@settings(max_examples=12, deadline=None)
@given(texts, texts)
def test_contamination(spark_holder, docs, items):
    spark = spark_holder
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in positional.contamination(positional.build_index(d), b, window=3).collect()}
    for i, t in enumerate(docs):
        n, hit, found = hit_positions(t, list(enumerate(items)), 3)
        assert got[i] == (n, hit, len(found), hit > 0)


def test_many_query_blocks_agree(spark, monkeypatch):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    index = positional.build_index(d)
    one = sorted(map(tuple, positional.contamination(index, b).collect()))
    monkeypatch.setattr(positional, "QUERY_WORDS", 300)
    assert sorted(map(tuple, positional.contamination(index, b).collect())) == one


def test_proximity(spark):
    d = spark.createDataFrame([(1, "red big fox jumps", 0), (2, "red fox jumps", 0), (3, "fox red", 0), (4, None, 0)], "doc_id bigint, text string, segment int")
    b = spark.createDataFrame([(1, "red fox jumps"), (2, None), (3, "...")], "item_id bigint, text string")
    rows = positional.search(positional.build_index(d), b, slop=1).collect()
    assert sorted((len(r.exact), len(r.near)) for r in rows) == [(0, 1), (1, 0)]


def test_decontaminate_keeps_columns_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h i j k", "x"), (2, "zzz", "y"), (None, None, "z")], "doc_id bigint, text string, n_hit string")
    b = spark.createDataFrame([(1, "b c d e f g h i j k")], "item_id bigint, text string")
    out = positional.decontaminate(d, b)
    assert out.columns == d.columns and sorted(r.n_hit for r in out.collect()) == ["y", "z"]
    assert positional.decontaminate(d, b.limit(0)).count() == 3
    assert positional.decontaminate(d.limit(0), b).count() == 0


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        index = hilbert.curve_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards_are_even_and_gapless(spark, tmp_path):
    rows = [(i, "x" * (i % 7) if i % 5 else None, f"l{i % 3}" if i % 4 else None, "s") for i in range(101)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    placed = hilbert.shard_documents(docs, 8)
    out = placed.toPandas()
    counts = out.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert len(out) == 101 and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] == counts["count"] - 1).all() and (counts["nunique"] == counts["count"]).all()
    assert hilbert.shard_documents(docs.limit(0), 8).count() == 0
    assert hilbert.manifest(placed, ["lang"]).count() == 8


def test_shards_hold_the_curve_order_and_every_row(spark, tmp_path):
    rng = np.random.Generator(np.random.PCG64(4))
    rows = [(None if i % 9 == 0 else int(rng.integers(0, 60)), "x" * int(rng.integers(0, 3)) if i % 7 else None, f"l{i % 3}" if i % 4 else None, f"s{i % 2}", i) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, shard int")
    dims = [hilbert.Dimension("lang", "category"), hilbert.Dimension("source", "category"), hilbert.Dimension("size", "log"), hilbert.Dimension("doc_id", "number")]
    hilbert.write_shards(docs, str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    sized = docs.select("*", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("size"))
    cells = {r.shard: tuple(r)[1:] for r in sized.select("shard", *hilbert.cells(sized, dims)).collect()}
    place = sorted(((r.hilbert_shard, r.hilbert_slot), r.shard, r.text, r.doc_id) for r in back.collect())
    assert [p for p, *_ in place] == [(s, k) for s in range(8) for k in range(-(-150 * (s + 1) // 8) - -(-150 * s // 8))]
    keys = []
    for _, row, text, doc_id in place:
        index = int(hilbert.curve_index(np.array([cells[row]]), hilbert.BITS)[0])
        keys.append((index, zlib.crc32((text or "").encode()), len(text or "") + 1, -1 if doc_id is None else doc_id))
    assert keys == sorted(keys)
    got = {(r.size, r.text_crc32) for r in hilbert.shard_documents(docs, 8).collect()}
    assert got == {(len(t or "") + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab #$\n\tÉ", max_size=60), max_size=6))
def test_text_counts(docs):
    got = list(zip(*(x.tolist() for x in robust.text_counts(*text_buffer(pa.array(docs, pa.string())))), strict=True))
    want = []
    for t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)))
    assert got == want


def test_outliers_do_not_mask_each_other(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    vocab = ["w" + "x" * int(k) for k in rng.integers(2, 9, 400)]
    clean = [" ".join(f"{w}{i}" for i, w in enumerate(rng.choice(vocab, 80 + int(rng.integers(0, 200))))) for _ in range(300)]
    junk = [" ".join(f"$#{i}%&" for i in range(150)) for _ in range(60)]
    rows = [(i, t, "en", "s", 0.5) for i, t in enumerate(clean + junk)] + [(900, None, None, None, 1.0), (901, "", "en", "s", 1.0)]
    out = robust.verdicts(robust.counts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, distance double"))).toPandas().set_index("doc_id")
    assert out.loc[:299].kept.mean() > 0.98 and not out.loc[300:359].kept.any()
    assert not out.loc[[900, 901]].kept.any() and out.loc[[900, 901]].base_failed.all()
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert robust.verdicts(robust.counts(empty)).count() == 0


def test_each_feature_can_reject(spark):
    rng = np.random.Generator(np.random.PCG64(2))
    rows = []
    for i in range(400):
        n = int(np.exp(rng.normal(5.5, 0.3)))
        rows.append((i, "en", "s", n, int(n * rng.normal(5.0, 0.2)), 0, 0, 0))
    odd = {900: (2500, 12500, 0, 0, 0), 901: (245, 1715, 0, 0, 0), 902: (245, 1225, 18, 0, 0), 903: (245, 1225, 0, 10, 0), 904: (245, 1225, 0, 0, 110)}
    mild = {950: (245, 1225, 1, 0, 0), 951: (245, 1225, 0, 1, 0), 952: (245, 1225, 0, 0, 6)}
    rows += [(i, "en", "s", *c) for i, c in {**odd, **mild}.items()]
    out = robust.verdicts(spark.createDataFrame(rows, robust.COUNTS)).toPandas().set_index("doc_id")
    assert not out.base_failed.any()
    assert not out.loc[list(odd)].kept.any() and out.loc[list(mild)].kept.all()
    assert out.loc[:399].kept.mean() > 0.98


def brute_mcd(x):
    """Squared distances by concentration steps with exact supports, from the same two starts, to convergence."""
    floor, p = np.array(robust.FLOOR), robust.FEATURES
    unit = np.outer(floor, floor)

    def estimate(rows, scale=1.0):
        cov = np.cov(rows.T, bias=True) * scale / unit
        width, axes = np.linalg.eigh(cov)
        free, width = int((width > 1).sum()), np.maximum(width, 1)
        return rows.mean(0), (axes / width) @ axes.T / unit, np.log(width).sum(), free

    def dist(est):
        d = x - est[0]
        return np.einsum("ni,ij,nj->n", d, est[1], d)

    h = int(np.ceil(robust.SUPPORT * len(x)))
    mid = np.median(x, 0)
    mad = np.maximum(np.abs(x - mid).mean(0) * 1.2533, floor)
    ends = []
    for est in (estimate(x), (mid, np.diag(1 / mad**2), 0.0, 0)):
        for _ in range(50):
            new = estimate(x[np.argsort(dist(est), kind="stable")[:h]])
            if abs(new[2] - est[2]) < 1e-9:
                break
            est = new
        ends.append(est)
    best = min(ends, key=lambda e: e[2])
    d = dist(best)
    scale = np.median(d) / robust.CHI2_MEDIANS[max(best[3] - 1, 0)]
    raw = estimate(x[np.argsort(d, kind="stable")[:h]], max(scale, 1e-3))
    return dist(estimate(x[dist(raw) <= robust.CHI2_975], 1.1))


@pytest.mark.parametrize("drawn", [robust.START_ROWS, 60])
def test_verdicts_against_brute_force(spark, monkeypatch, drawn):
    monkeypatch.setattr(robust, "START_ROWS", drawn)
    rng = np.random.Generator(np.random.PCG64(3))
    rows = []
    for g, (lang, source) in enumerate([("en", "a"), ("en", "b"), ("de", None)]):
        for i in range(120):
            n = int(np.exp(rng.normal(5.0 + 0.4 * g, 0.3)))
            bad = i < 15
            rows.append((None if i % 10 == 0 else i % 50, lang, source, n, int(n * rng.normal(4 + g, 0.3) * (1.6 if bad else 1)), int(rng.poisson(2)) + (60 if bad else 0), int(rng.poisson(1)), int(rng.poisson(n / 40))))
    out = robust.verdicts(spark.createDataFrame(rows, robust.COUNTS)).toPandas()
    assert len(out) == len(rows)
    near = 0
    for key, own in out[~out.base_failed].groupby(["lang", "source"], dropna=False):
        n, chars = own.n_words.to_numpy(float), own.word_chars.to_numpy(float)
        x = np.stack([np.log(n), np.log(chars / n), np.sqrt(own.n_symbols / chars), own.n_dup_lines * 10 / n, own.n_repeat_words / n], 1)
        d = brute_mcd(x)
        sure = (d < 0.8 * robust.CUTOFF) | (d > 1.25 * robust.CUTOFF)
        near += (~sure).sum()
        assert (own.kept.to_numpy() == (d <= robust.CUTOFF))[sure].all(), key
        assert np.median(np.abs(own.distance / d - 1)) < 0.1
    assert near < 15 and 40 <= (~out.kept & ~out.base_failed).sum() <= 70


def test_groups_are_not_pooled_from_fifty_rows(spark):
    """A document that is usual in one source and far out in another is judged by its own; sources too small for that share their language."""
    rng = np.random.Generator(np.random.PCG64(5))

    def row(i, source, level):
        n = int(np.exp(rng.normal(5.5, 0.2)))
        return (i, "en", source, n, int(n * rng.normal(level, 0.1)), 0, 0, 0)

    rows = [row(i, "short", 4.0) for i in range(60)] + [row(100 + i, "long", 8.0) for i in range(60)] + [(900, "en", "short", 245, 245 * 8, 0, 0, 0)]
    kept = robust.verdicts(spark.createDataFrame(rows, robust.COUNTS)).toPandas().set_index("doc_id").kept
    assert not kept[900] and kept[:199].mean() > 0.95
    few = [r for r in rows if r[0] % 100 < 35 or r[0] == 900]
    kept = robust.verdicts(spark.createDataFrame(few, robust.COUNTS)).toPandas().set_index("doc_id").kept
    assert kept[900]


def test_rows_of_one_id_get_their_own_verdicts(spark):
    rows = [(None if i % 2 else 7, "en", None, 200 + i % 30, 1000 + 5 * (i % 30), 0, 0, 0) for i in range(80)]
    rows += [(None, "en", None, 200, 4000, 0, 0, 0), (7, "en", None, 10, 50, 0, 0, 0)]
    out = robust.verdicts(spark.createDataFrame(rows, robust.COUNTS)).toPandas()
    assert len(out) == 82 and out.kept.sum() == 80
