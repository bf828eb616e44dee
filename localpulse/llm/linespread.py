"""Cross-site boilerplate: lines that stand on many distinct sites.

One HyperLogLog sketch of the sites per line hash, merged by aggregation (within
a task first, so a line that fills a third of the corpus is only a few partial
sketches), estimates each line's spread. Where the estimate is within
``BAND`` of the threshold, the distinct sites are counted exactly; beyond it the
sketch decides. Of a boilerplate line the first occurrence (least document id,
then position) stays, all others are removed.

DataFrame functions only; line texts are not moved, only 128-bit hashes of them.

Defined cases: a null text stays null and has no lines; lines without a word are
never boilerplate; a null site is a site of its own; a null id sorts first;
rows that are equal in id and text are treated alike; an empty table gives an
empty result; other columns pass through, but for input columns named ``n_lines`` or
``n_removed``, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, release_since, scratch_count

MIN_SITES = 8
BAND = 0.15
SKETCH_BITS = 12
_WORD = r"[^\x20\x09-\x0D]"


def _keys(doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))).alias("__lp_id"), F.xxhash64(F.col(text)).alias("__lp_text")]


def line_table(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """Stored ``__lp_id, __lp_text, site, pos, h1, h2`` of every line with a word."""
    lines = docs.select(*_keys(doc_id, text), F.coalesce(F.col(site).cast("string"), F.lit("\x00")).alias("site"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    lines = lines.where(F.col("line").rlike(_WORD))
    return materialize(lines.select("__lp_id", "__lp_text", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")), "lines")


def widespread(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``h1, h2, first`` of the lines that stand on at least ``min_sites`` sites."""
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"),
        F.min(F.struct("__lp_id", "pos")).alias("first"),
    )
    spread = materialize(spread.where(F.col("sites") >= min_sites * (1 - BAND)), "spread")
    near = spread.where(F.col("sites") < min_sites * (1 + BAND))
    exact = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").count()
    exact = exact.groupBy("h1", "h2").agg(F.count("*").alias("exact")).where(F.col("exact") >= min_sites)
    sure = spread.where(F.col("sites") >= min_sites * (1 + BAND)).select("h1", "h2", "first")
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi").select("h1", "h2", "first"))


def remove_boilerplate(docs: DataFrame, *, min_sites: int = MIN_SITES, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """``docs`` with ``text`` cut, and ``n_lines`` (lines with a word before) and ``n_removed``."""
    mark = scratch_count()
    lines = line_table(docs, doc_id, text, site)
    bad = materialize(widespread(lines, min_sites), "boilerplate")
    gone = lines.join(bad, ["h1", "h2"]).where(F.struct("__lp_id", "pos") != F.col("first"))
    gone = materialize(gone.groupBy("__lp_id", "__lp_text").agg(F.array_sort(F.collect_set("pos")).alias("__lp_gone")), "removed-lines")
    release_since(docs.sparkSession, mark, but=1)
    keyed = docs.withColumns(dict(zip(("__lp_id", "__lp_text"), _keys(doc_id, text), strict=True)))
    # A merge join at every size: the removed lines grow with the corpus.
    out = keyed.join(gone.hint("merge"), ["__lp_id", "__lp_text"], "left").withColumn("__lp_parts", F.split(F.col(text), "\n"))
    parts = F.col("__lp_parts")
    # array_except looks places up by hash, so that a long text takes time in proportion to its lines.
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__lp_gone"))
    kept = F.when(F.col("__lp_gone").isNull(), F.col(text)).otherwise(F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n"))
    n_lines = F.coalesce(F.size(F.filter(parts, lambda x: x.rlike(_WORD))), F.lit(0)).cast("bigint")
    n_lines = F.when(F.col(text).isNull(), F.lit(0).cast("bigint")).otherwise(n_lines)
    n_gone = F.when(F.col("__lp_gone").isNull(), F.lit(0)).otherwise(F.size("__lp_gone")).cast("bigint")
    out = out.withColumns({"__lp_kept": kept, "n_lines": n_lines, "n_removed": n_gone})
    return out.withColumn(text, F.col("__lp_kept")).drop("__lp_id", "__lp_text", "__lp_gone", "__lp_parts", "__lp_kept")
