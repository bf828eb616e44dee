"""Null and repeated ids decide nothing: rows of unlike texts are told apart by the filters and the pipeline."""

import corpus_pipeline
from pyspark.sql import functions as F

from localpulse.llm import positional, replytree, rtree, toxicity

PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
CLEAN = "the quiet river runs along fields of barley toward an old stone mill"
OTHER = "a wholly different account of markets and ships in the northern harbour"


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text").collect())


def test_decontaminate_tells_rows_apart(spark):
    docs = spark.createDataFrame([(None, CLEAN), (None, f"x {PASSAGE} y"), (5, OTHER), (5, PASSAGE), (6, None)], "doc_id bigint, text string")
    out = positional.decontaminate(docs, spark.createDataFrame([("b", PASSAGE)], "item_id string, text string"))
    assert sorted(texts(out), key=str) == sorted([(-1, CLEAN), (5, OTHER), (6, None)], key=str)


def test_remove_toxic_tells_rows_apart(spark, data):
    docs, labels = (spark.read.parquet(f"{data.replace("0.001", "0.01")}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.toxicity(docs, labels).join(docs, "doc_id")
    bad = scored.where("predicted = 1").orderBy(F.desc("score")).first().text
    clean = scored.where("score < 0.05 AND n_chars BETWEEN 200 AND 2000").orderBy("score", "doc_id").first().text
    odd = spark.createDataFrame([(None, clean), (None, bad), (10**6, clean), (10**6, bad)], "doc_id bigint, text string")
    out = toxicity.remove_toxic(docs.select("doc_id", "text").unionByName(odd), labels)
    assert texts(out.where("doc_id IS NULL OR doc_id = 1000000")) == [(-1, clean), (10**6, clean)]


def test_keep_one_works_on_rows(spark):
    docs = [(7, CLEAN), (7, CLEAN), (7, OTHER), (3, OTHER), (None, PASSAGE), (None, PASSAGE), (None, CLEAN), (8, None), (8, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"node": F.lit(1), "times": F.lit("x")})
    out = rtree.keep_one(df)
    assert out.columns == df.columns
    assert sorted(texts(out), key=str) == sorted([(7, CLEAN), (3, OTHER), (-1, PASSAGE), (8, None), (8, None)], key=str)


def test_pipeline_filters_tell_rows_apart(spark, data):
    """The near-duplicate and decontamination stages, one after the other."""
    item = next(r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect() if r.text and len(r.text.split()) >= 10)
    rows = [(1, CLEAN), (1, item), (None, OTHER), (None, f"{OTHER} {item}"), (2, CLEAN)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for stage in (corpus_pipeline.keep_one_of_each_group, corpus_pipeline.drop_contaminated):
        docs = stage(spark, docs, data)
    assert texts(docs) == [(-1, OTHER), (1, CLEAN)]


def test_answers_of_one_id_are_all_kept(spark):
    rows = [("t", 1, None, "user", "ask", 0.0), ("t", 2, 1, "assistant", "poor", 0.1), ("t", 2, 1, "assistant", "worse", 0.9), ("t", 3, 2, "user", "thanks", 0.0)]
    nodes = spark.createDataFrame(rows, "tree string, node bigint, parent bigint, role string, text string, score double")
    out = replytree.format_branches(nodes, per_tree=9).orderBy("branch_rank").collect()
    said = [[t.text for t in r.turns] for r in spark.createDataFrame(out).withColumn("turns", replytree.parsed_turns(F.col("formatted"))).collect()]
    assert said == [["ask", "worse"], ["ask", "poor", "thanks"]]
    assert [r.leaf for r in out] == [2, 3]
