"""Reply trees, language and toxicity models, and the pipeline."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from localpulse.llm import langid, replytree, toxicity
from localpulse.llm.core import text_buffer


def formatted(spark, rows, **options):
    nodes = spark.createDataFrame(rows, "tree string, node bigint, parent bigint, role string, text string, score double")
    return replytree.format_branches(nodes, **options).withColumns({"turns": replytree.parsed_turns(F.col("formatted")), "loss": replytree.loss_text(F.col("formatted"), F.col("loss_spans"))})


def test_branches_are_ranked(spark):
    rows = [("t", 1, None, "user", "q", 1.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", "good", 0.9), ("t", 4, 3, "user", "more", 0.9), ("t", 5, 4, "assistant", "fine", 0.9), ("u", 7, 99, "user", "orphan", 0.0), ("c", 1, 2, "user", "x", 1.0), ("c", 2, 1, "user", "y", 1.0), ("c", 3, 2, "user", "z", 1.0), (None, 1, None, None, None, None)]
    best = {r.tree: r for r in formatted(spark, rows).collect()}
    assert set(best) == {"t", "u", None}
    assert [t.text for t in best["t"].turns] == ["q", "good", "more", "fine"] and best["t"].loss == "goodfine"
    assert best["u"].n_turns == 1 and [tuple(t) for t in best[None].turns] == [("", "")]
    assert formatted(spark, rows, per_tree=5).where("tree = 't'").count() == 2


def test_bushy_trees_against_walking_up(spark):
    rng = random.Random(8)
    rows = [("hot" if i % 3 else f"t{i % 4}", i, None if i < 12 or rng.random() < 0.02 else rng.randrange(max(0, i - 30), i), "user", str(i), rng.choice([None, rng.random()])) for i in range(240)]
    rows += [("hot", 900, 901, "user", "", 9.0), ("hot", 901, 900, "user", "", 9.0), ("hot", 902, 901, "user", "", 9.0)]  # a cycle and a leaf below it
    known = {(r[0], r[1]): r for r in rows}
    answered = {(r[0], r[2]) for r in rows}
    want = {}
    for tree, node, *_ in rows:
        if (tree, node) in answered or node >= 900:
            continue
        path, at = [], (tree, node)
        while at in known:
            path.append(known[at])
            at = (tree, known[at][2])
        scores = [r[5] for r in path if r[5] is not None]
        want.setdefault(tree, []).append((-(sum(scores) / len(scores)) if scores else math.inf, node, [r[4] for r in reversed(path)]))
    got = {}
    for r in formatted(spark, rows, per_tree=3).collect():
        got.setdefault(r.tree, []).append((r.branch_rank, [t.text for t in r.turns]))
    assert {t: [p for _, p in sorted(b)] for t, b in got.items()} == {t: [p for *_, p in sorted(b)[:3]] for t, b in want.items()}


def test_repeated_nodes_and_clashing_columns(spark):
    rows = [("t", 1, None, "user", "q", 1.0), ("t", 1, None, "user", "r", 5.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 2, 1, "assistant", "a", 1.0)]
    nodes = spark.createDataFrame(rows, "tree string, node bigint, parent bigint, role string, text string, score double").withColumns({"key": F.lit("x"), "leaf": F.lit(7), "depth": F.lit(0)})
    for df in (nodes, nodes.orderBy(F.desc("text"))):
        out = replytree.format_branches(df).withColumn("turns", replytree.parsed_turns(F.col("formatted"))).collect()
        assert [[tuple(t) for t in r.turns] for r in out] == [[("user", "r")]]


def test_every_control_string_survives(spark):
    rng = random.Random(3)
    parts = [*replytree.CONTROL, "\\", "\\\\", "<", "|>", "\n", "é", "$1", "/", "<|", "im_end"]
    rows = []
    for i in range(40):
        rows.append((f"t{i}", 1, None, rng.choice(["assistant", "user\n", "<s>"]), "".join(rng.choices(parts, k=rng.randrange(12))), 0.0))
        rows.append((f"t{i}", 2, 1, "assistant", "".join(rng.choices(parts, k=rng.randrange(12))), 0.0))
    want = {}
    for t, _, _, role, text, _ in rows:
        want.setdefault(t, []).append((role, text))
    for r in formatted(spark, rows).collect():
        assert [tuple(t) for t in r.turns] == want[r.tree]
        assert r.loss == "".join(x for role, x in want[r.tree] if role == "assistant")
        inner = r.formatted.replace("<|im_start|>", "").replace("<|im_sep|>", "").replace("<|im_end|>\n", "")
        assert not any(c in inner for c in replytree.CONTROL)


def test_long_chain_and_turn_ties(spark):
    turns = spark.createDataFrame([(1, i, "user" if i % 2 else "assistant", f"m{i}", "x") for i in range(70)] + [(2, 0, "b", "y", "x"), (2, 0, "a", "x", "x"), (2, 0, "a", "x", "x")], "conv_id bigint, turn bigint, role string, text string, depth string")
    out = {r.tree: r for r in replytree.format_branches(replytree.turns_as_tree(turns)).withColumn("turns", replytree.parsed_turns(F.col("formatted"))).collect()}
    assert [t.text for t in out[1].turns] == [f"m{i}" for i in range(70)]
    assert [tuple(t) for t in out[2].turns] == [("a", "x"), ("a", "x"), ("b", "y")]
    assert replytree.format_branches(replytree.turns_as_tree(turns.limit(0))).count() == 0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en"), (10**6 + 1, "123 !?", "en"), (10**6 + 2, "", None)], "doc_id bigint, text string, lang string")
    df = docs.select("doc_id", "text", "lang").unionByName(extra).withColumn("score", F.lit("clash"))
    out = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").toPandas()
    known = out[out.doc_id < 10**6]
    assert (known[known.held_out].lang_pred == known[known.held_out].lang).mean() > 0.95
    assert (out[out.doc_id >= 10**6].lang_pred == "und").all() and out.score.between(0, 1).all()
    nothing = langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert (nothing.lang_pred == "und").all()
    assert langid.identify(df.limit(0)).count() == 0


def test_grammar_reads_context():
    g = toxicity.Grammar()
    plain = g.clause([], toxicity.INSULT, [])
    assert g.clause([toxicity.TARGET], toxicity.INSULT, []) > plain > g.clause([toxicity.NEGATION], toxicity.INSULT, [])
    assert g.clause([toxicity.SPEECH, toxicity.OTHER], toxicity.INSULT, []) < plain
    assert g.clause([], toxicity.THREAT, [toxicity.TARGET]) > g.clause([], toxicity.THREAT, [])
    assert g.clause([toxicity.TARGET] + [toxicity.OTHER] * 5, toxicity.INSULT, []) == plain


def test_composition_multiplies():
    a, b = toxicity.within(toxicity.TARGET, 2, {toxicity.INSULT: 3.0}), toxicity.within(toxicity.NEGATION, 1, {toxicity.INSULT: 0.5})
    c = toxicity.compose(a, b)
    for word in ([toxicity.TARGET], [toxicity.NEGATION], [toxicity.TARGET, toxicity.NEGATION], [toxicity.NEGATION, toxicity.TARGET]):
        weights = []
        for t in (a, b, c):
            state, w = 0, 1.0
            for s in [*word, toxicity.INSULT]:
                state, w = t.step(state, s)
            weights.append(w)
        assert weights[2] == pytest.approx(weights[0] * weights[1])


def test_toxicity_on_held_out_rows(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (None, "x")], "doc_id bigint, text string")
    few = docs.join(labels, "doc_id", "left_semi").select("doc_id", "text").unionByName(extra)
    out = toxicity.toxicity(few, labels).join(labels, "doc_id", "left").toPandas()
    seen = out[out.toxic.notna() & out.held_out]
    assert (seen.predicted == seen.toxic).mean() > 0.97 and seen[seen.toxic == 1].predicted.mean() > 0.9
    assert len(out) == few.count() and out.score.between(0, 1).all() and (out[out.doc_id >= 10**6].predicted == 0).all()


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", 1.0), (2, None, 2.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    assert [r.score for r in toxicity.toxicity(docs, labels).collect()] == [0.0, 0.0]
    kept = toxicity.remove_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 2


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    before = docs.count()
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, base)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert 0 < len(rows) <= before
        before, docs = len(rows), spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in cp.STAGES[-1][1](spark, docs, base).collect()} == kept
    assert {r.doc_id for r in cp.run(spark, base).collect()} == kept


def test_pipeline_runs_twice_and_takes_odd_tables(spark, tmp_path):
    import corpus_pipeline as cp

    base = "/root/testdata/sf0.001"
    first = cp.run(spark, base)
    second = cp.run(spark, base)
    rows = sorted(map(tuple, first.collect()))
    assert rows and rows == sorted(map(tuple, second.collect()))
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{base}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    few = docs.limit(30).withColumns({"shard": F.lit("clash"), "node": F.lit(1)})
    odd = few.unionByName(few.limit(1).withColumns({c: F.lit(None).cast(few.schema[c].dataType) for c in few.columns}))
    odd.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).where("doc_id IS NULL").count() == 1
    docs.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def grams_of(text):
    """Buckets of one text by the library, checked to be one for each 1-, 2- and 3-gram."""
    grams, starts = langid.ngram_buckets(*text_buffer(pa.array([text])))
    assert starts.tolist() == [0, sum(max(len(text) - k + 1, 0) for k in (1, 2, 3))]
    return grams.tolist()


def test_training_against_a_plain_ftrl():
    texts = [("the cat and the dog", 0), ("der hund und die katze", 1), ("le chien et le chat", 2), ("a dog", 0), ("ein hund", 1), ("un chat", 2)] * 4
    names, idf = ["de", "en", "fr"], np.random.Generator(np.random.PCG64(1)).uniform(1, 3, langid.BUCKETS)
    samples = []
    for t, y in texts:
        at, count = np.unique(grams_of(t), return_counts=True)
        samples.append((at, count, y))
    model = langid.train(samples, idf, names, epochs=2)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 0.05
    z, n = {}, {}

    def weight(f, k):
        zz = z.get((f, k), 0.0)
        return 0.0 if abs(zz) <= l1 else -(zz - math.copysign(l1, zz)) / ((beta + math.sqrt(n.get((f, k), 0.0))) / alpha + l2)

    for _ in range(2):
        for i, (t, y) in enumerate(texts):
            if i % 5 == 0:
                continue
            grams = grams_of(t)
            x = {g: grams.count(g) * idf[g] * langid.SCALE / len(grams) for g in set(grams)} | {"bias": 1.0}
            w = {(f, k): weight(f, k) for f in x for k in range(3)}
            logit = [sum(v * w[f, k] for f, v in x.items()) for k in range(3)]
            e = [math.exp(v - max(logit)) for v in logit]
            for f, v in x.items():
                for k in range(3):
                    g = v * (e[k] / sum(e) - (k == y))
                    old = n.get((f, k), 0.0)
                    n[f, k] = old + g * g
                    z[f, k] = z.get((f, k), 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w[f, k]
    for f in {g for t, _ in texts for g in grams_of(t)}:
        assert model.weights[f] == pytest.approx([weight(f, k) * idf[f] for k in range(3)], abs=1e-9)
    assert model.bias == pytest.approx([weight("bias", k) for k in range(3)], abs=1e-9)
    # Prediction of a batch, an empty text among it.
    grams, starts = langid.ngram_buckets(*text_buffer(pa.array(["the dog", "", "die katze"])))
    got = model.logits(grams, starts)
    for i, t in enumerate(["the dog", "", "die katze"]):
        own = grams_of(t)
        want = [model.bias[k] + sum(model.weights[g][k] for g in own) * langid.SCALE / max(len(own), 1) for k in range(3)]
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_every_language_is_learned_and_no_row_counts_twice(spark):
    rows = [(i * 10 + k, f"{chr(0x4E00 + i)}{chr(0x4E00 + i)} word{i}", f"l{i:03d}") for i in range(230) for k in range(10)]
    rows += [(rows[0][0], rows[0][1], rows[0][2])] * 50 + [(None, "x", "l000")] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    ids = langid.sampled_ids(df, 4).collect()
    per = {}
    for r in ids:
        per.setdefault(r.lang, []).append(r._d)
    assert len(per) == 230 and all(len(v) == len(set(v)) and 1 <= len(v) <= 4 for v in per.values())
    out = langid.identify(df).join(df.select("doc_id", "lang").distinct(), "doc_id").toPandas()
    assert out.lang_pred.nunique() > 215 and (out.lang_pred == out.lang).mean() > 0.9


def plain_clauses(text, lexicon):
    """The grammar's rules written out: factors of the words around each lexicon or threat word of a clause."""
    kinds = {w: k for words, k in ((toxicity.TARGETS, "target"), (toxicity.NEGATIONS, "negation"), (toxicity.REPORTED, "speech"), (toxicity.THREATS, "threat")) for w in words.split()}
    rules = {"insult": {"base": 1.0, "target": (4, 1.3), "negation": (2, 0.7), "speech": (6, 0.8), "after": (3, 1.2)}, "threat": {"base": 0.2, "target": (4, 5.0), "negation": (2, 0.4), "speech": (6, 0.5), "after": (3, 5.0)}}
    total = 0.0
    for clause in re.split(r"[.!?\n;]", text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", clause.lower())
        kind = ["insult" if w in lexicon else kinds.get(w) for w in words]
        for i, k in enumerate(kind):
            if k in rules:
                w = lexicon.get(words[i], 1.0) * rules[k]["base"]
                for trigger in ("target", "negation", "speech"):
                    reach, factor = rules[k][trigger]
                    w *= factor if trigger in kind[max(0, i - reach) : i] else 1.0
                reach, factor = rules[k]["after"]
                total += w * (factor if "target" in kind[i + 1 : i + 1 + reach] else 1.0)
    return total


def test_clauses_against_rules_written_out():
    rng = random.Random(11)
    lexicon = {"fool": 2.0, "scum": 3.5, "trottel": 1.5}
    pool = [*lexicon, "you", "your", "not", "never", "said", "kill", "hurt", "the", "apple", "of", "tú", "Said", "YOU"]
    hashes = toxicity._listed(" ".join(lexicon))
    lex = toxicity.Lexicon({0: (hashes, np.array(list(lexicon.values())))})
    texts = ["".join(rng.choice(pool) + rng.choice([" ", " ", " ", ", ", ". ", "! "]) for _ in range(rng.randrange(40))) for _ in range(120)]
    got = lex.clauses(toxicity.read_words(*text_buffer(pa.array(texts)), []))
    assert got.tolist() == pytest.approx([plain_clauses(t, lexicon) for t in texts])


def test_very_long_and_repeated_rows(spark):
    long = "you are a fool. " * 40_000
    docs = spark.createDataFrame([(1, long, "en"), (1, long, "en"), (2, "fine words here", "en"), (3, "x", None)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 1)], "doc_id bigint, toxic int")
    assert toxicity.toxicity(docs, labels).count() == 4 and langid.identify(docs).count() == 4
    turns = docs.select(F.col("doc_id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), "text")
    out = {r.tree: r.turns for r in replytree.format_branches(replytree.turns_as_tree(turns)).withColumn("turns", replytree.parsed_turns(F.col("formatted"))).collect()}
    assert [t.text for t in out[1]] == [long, long]
