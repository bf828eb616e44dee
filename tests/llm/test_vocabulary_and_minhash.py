"""Divergence stripes, spelling variants and tensored MinHash against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from localpulse.llm import minhash, rtree, spelling, stripes
from tests.llm.test_dedup import brute, corpus

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- divergences --------------------------------------------------------------


def audit(docs, min_docs, top):
    """The audit of rows (lang, source, text), written out."""
    held = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (c or "").translate(AZ))) for a, b, c in docs]
    out = []
    for lang in sorted({d[0] for d in held}):
        df = Counter(t for d in held if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= min_docs]
        groups = sorted({d[1] for d in held if d[0] == lang})
        count = {g: Counter(t for d in held if d[:2] == (lang, g) for t in d[2] if df[t] >= min_docs) for g in groups}
        count[None] = sum(count.values(), Counter())
        total = {g: sum(c.values()) for g, c in count.items()}
        p = lambda g, t: 1 + 1_000_000_000 * (count[g][t] + 2) // (total[g] + 2 * len(kept))  # noqa: E731, B023
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for g in groups:
            pairs = sorted((-sum(f(p(g, t), p(o, t)) for t in kept), o.encode()) for o in groups if o != g)
            terms = sorted((-f(p(g, t), p(None, t)), t.encode()) for t in kept if count[g][t] and p(g, t) > p(None, t))[:top]
            for part, rows in (("pair", pairs), ("term", terms)):
                out += [(lang, g, part, item.decode(), -v, k) for k, (v, item) in enumerate(rows, 1)]
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("block", [64, 3])
def test_divergences(spark, monkeypatch, block):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("Ab", "é", "zoo", "Ünd", "x") for b in ("", "a", "bb", "ccc", "ß")]
    docs = []
    for _ in range(300):
        source = rng.choice([None, "a", "b", "c", "d", "hot", "hot", "hot", "é", "z" * 3])
        docs.append((rng.choice([None, "en", "fr"]), source, " 7".join(rng.choice(words[: 8 + len(source or "")]) for _ in range(rng.randrange(12)))))
    docs += [("en", "a", None), ("xx", "only", "alone alone"), ("yy", "p", "few"), ("yy", "q", ""), ("en", "a", "zoo " * 30_000), *[("en", "b", "same same")] * 12]
    monkeypatch.setattr(stripes, "BLOCK", block)
    df = spark.createDataFrame(docs, "lang string, source string, text string").withColumn("value", F.lit("clash")).withColumn("block", F.lit(1)).repartition(5)
    assert told(stripes.divergences(df, min_docs=10, top=4)) == audit(docs, 10, 4)
    # A spill after every batch changes nothing.
    assert told(stripes.divergences(df, min_docs=10, top=4, stripe_bytes=1)) == audit(docs, 10, 4)


def test_divergences_of_nothing(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert stripes.divergences(none).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, v = 7 * 10**16, 10**17, 3
    row = spark.createDataFrame([(n, total, v)], "n bigint, total bigint, v bigint").select(stripes._share("n", "total", "v").alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (total + 2 * v)


# --- spelling -----------------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def spelt(docs, every, letters, occurrences, times):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= letters and c >= occurrences}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    best = {w: min(near[w], key=lambda o: (-words[o], o)) for w in words if near[w]}
    form = {w: o for w, o in best.items() if words[o] >= times * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, c, len(near[w]), form.get(w), words[form[w]] if w in form else None, root(w)) for w, c in words.items())


def test_variants(spark):
    rng = random.Random(5)
    base = ["weather", "whether", "Éclaire", "abcabcabc", "aaaaaa", "naïveté", "strength"]
    docs = []
    for i in range(400):
        words = []
        for _ in range(rng.randrange(25)):
            w = base[min(int(rng.expovariate(0.7)), len(base) - 1)]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + rng.choice("aeé") + w[k:], w[:k] + w[k + 1 :], w[:k] + rng.choice("xé") + w[k + 1 :]])
            words.append(rng.choice([w, w.upper()]))
        docs.append((rng.choice([i, i, None]), rng.choice([" ", "-", "ŝ", "7"]).join(words)))
    docs += [(1, None), (2, ""), (3, "weather"), (3, "weather"), (4, "Weather " * 50_000), (5, "q" * 100_000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("n", F.lit("clash")).withColumn("word", F.lit(1)).repartition(4)
    got = sorted(tuple(r) for r in spelling.variants(df, every=19).select("word", "n", "n_near", "form", "form_n", "root").collect())
    want = spelt(docs, 19, 6, 5, 5)
    assert got == want
    assert len({r[5] for r in want}) < len(want) and any(r[3] and r[3] != r[5] for r in want), "no chain of forms"
    plain = sorted(tuple(r) for r in spelling.variants(df).select("word", "n", "n_near", "form", "form_n", "root").collect())
    assert plain == spelt(docs, None, 6, 5, 5)


def test_near_words_of_all_lengths(spark):
    rng = random.Random(7)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(2, 9))) for _ in range(500)}
    got = {tuple(r) for r in spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_variants_of_nothing(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_forms_are_followed_in_few_rounds(spark):
    links = spark.range(1, 300).select(F.format_string("w%03d", "id").alias("word"), F.format_string("w%03d", F.col("id") - 1).alias("form"))
    got = spelling.followed(links)
    assert got.select("root").distinct().collect() == [("w000",)] and got.count() == 299


# --- tensored MinHash -----------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize(("words", "percent"), [(2, 80), (5, 80)])
def test_minhash_links(spark, seed, words, percent):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("n", F.lit("clash")).withColumn("key", F.lit(2)).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, words=words, percent=percent).collect()}
    assert got == brute(docs, words, percent)


def test_minhash_of_one_family(spark):
    """Hundreds of copies just about the threshold: shared keys by the thousand, no link lost."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(250):
        copy = list(base)
        for k in rng.sample(range(120), rng.choice([2, 5, 6, 7, 12])):
            copy[k] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, words=2, percent=80).collect()}
    assert got == brute(docs, 2, 80)


def test_minhash_of_null_repeated_and_missing_rows(spark):
    text = "one two three four five six seven eight nine ten"
    docs = [(None, text), (None, text), (7, text), (7, text), (7, "quite another text than that"), (3, None), (4, ""), (None, "lone words here")]
    got = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), words=2, percent=80).collect()), key=str)
    want = [(None, 9, 7, False), (None, 9, 7, False), (7, 9, 7, True), (7, 9, 7, True), (7, 4, 7, True), (3, 0, 3, True), (4, 0, 4, True), (None, 2, None, True)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_chance_of_sharing_a_table():
    """Sets of a given similarity agree in small hashes as often as the method says."""
    rng = np.random.default_rng(2)
    agree = []
    for _ in range(300):
        common, own = rng.integers(0, 2**63, 80, np.uint64), rng.integers(0, 2**63, 20, np.uint64)
        h = np.concatenate([common, own[:10], common, own[10:]])
        a, b = minhash.small_hashes(h, np.array([90, 90]), 20, 3)
        agree.append((a == b).mean())
    assert abs(np.mean(agree) - 0.8**3) < 0.03


def test_minhash_and_rtree_agree(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    a = minhash.near_duplicates(docs, words=5, percent=80).select("doc_id", "n_shingles", "component_id")
    b = rtree.near_duplicates(docs, words=5, percent=80)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
