"""Spelling variants of a vocabulary: words one edit apart, by asymmetric q-chunks.

Words are counted over whole texts, in tables that a task spills when they grow. For
the join a word of length L takes q = L // 2 and is either side of a pair: as the
*chunk* side (the shorter word, of equal lengths the smaller) it gives two disjoint
chunks, from 0 and from q; as the *gram* side it gives its grams of that q by position.
One edit changes at most one of two disjoint chunks, and moves the other by one place
at most, so every near pair meets in an equi-join on length, place and chunk. Grams at
places where no chunk can end up are not sent. The distance is verified where the
sides meet; a pair that fails leaves no row.

A word's form is its most frequent near word, if that is ``times`` as frequent; forms
are followed to the last one by pointer doubling, as counts grow ``times``-fold.

Defined cases: a null or empty text has no words; a null id reads as an empty string
where variants are derived; repeated rows count as often as they stand; of equally
frequent near words the least in code-point order is the form; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, release_since, scratch_count, trimmed

#: Code points and occurrences that a word has at least.
LETTERS = 6
OCCURRENCES = 5
#: How much more frequent a form is.
TIMES = 5
#: Bytes of counted words that a task holds, about, before it spills them.
COUNT_BYTES = 48 << 20
_RUN = re.compile("[a-zA-ZÀ-ÿ]+")


def word_counts(docs: DataFrame, *, every: int | None = None, letters: int = LETTERS, count_bytes: int = COUNT_BYTES) -> DataFrame:
    """``word, n`` of the runs of Latin letters, A-Z lower-cased, in ``docs`` (``doc_id, text``).

    With ``every``, a run of which that number divides the CRC-32 of ``<doc_id>:<run>`` loses the
    code point at CRC-32 modulo its length: misspellings that can be told beforehand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        size = 0

        def spilled() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for a in range(0, len(words), 50_000):
                part = words[a : a + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                base = zlib.crc32(b"%s:" % key.encode())
                for word, n in Counter(_RUN.findall(text.as_py().lower().decode())).items():
                    if len(word) < letters:
                        continue
                    if every:
                        h = zlib.crc32(word.encode(), base)
                        if not h % every:
                            i = h % len(word)
                            word = word[:i] + word[i + 1 :]
                            if len(word) < letters:
                                continue
                    if word not in held:
                        size += 150 + len(word)
                    held[word] += n
                if size > count_bytes:
                    yield from spilled()
                    held.clear()
                    size = 0
        yield from spilled()

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counts = docs.select(text("doc_id"), text("text")).mapInArrow(trimmed(run), "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def near_words(words: DataFrame) -> DataFrame:
    """``a, b``: the unordered pairs of distinct ``word`` that are one insertion, deletion or replacement of a code point apart.

    Words of one code point have no two chunks and are left out.
    """
    sized = words.select("word", F.char_length("word").alias("size")).where("size > 1")
    q = F.expr("size div 2")
    chunks = sized.withColumn("q", q).select(F.col("word").alias("a"), "size", F.explode(F.array(F.lit(0), F.col("q"))).alias("place"), "q")
    chunks = chunks.select("a", "size", "place", F.substr("a", F.col("place") + 1, F.col("q")).alias("chunk"))
    # The other side's length class: words as long as itself, and those one shorter, whose chunks may have moved.
    classes = sized.select(F.col("word").alias("b"), "size", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")).withColumns({"size": F.col("size") - F.col("longer"), "full": F.col("size")})
    classes = classes.where("size > 1").withColumn("q", q)
    shifts = F.sequence(F.lit(0), F.col("longer"))
    grams = classes.withColumn("shift", F.explode(shifts)).select("b", "size", "longer", "shift", "q", F.explode(F.array(F.lit(0), F.col("q"))).alias("place"))
    grams = grams.select("b", "size", "longer", "place", F.substr("b", F.col("place") + F.col("shift") + 1, F.col("q")).alias("chunk"))
    asymmetric = (F.col("longer") == 1) | (F.col("a") < F.col("b"))
    met = chunks.join(grams, ["size", "place", "chunk"]).where(asymmetric & (F.levenshtein("a", "b", 1) == 1))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def followed(forms: DataFrame) -> DataFrame:
    """``word, root`` for the rows of ``forms`` (``word, form``; no cycles): forms followed to the last, in as many steps as the logarithm of the longest chain."""
    mark = scratch_count()
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release_since(forms.sparkSession, mark, but=1)
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        at = step.select("word", "root")


def variants(docs: DataFrame, *, every: int | None = None, letters: int = LETTERS, occurrences: int = OCCURRENCES, times: int = TIMES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs`` that is long and frequent enough."""
    mark = scratch_count()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    words = materialize(word_counts(rows, every=every, letters=letters).where(F.col("n") >= occurrences), "words")
    pairs = materialize(near_words(words), "near-words")
    near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = near.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = near.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    frequent = -F.col("best.less") >= times * F.col("n")
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(frequent, F.col("best.form")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"))
    out = materialize(out, "forms")
    roots = followed(out.where("form IS NOT NULL"))
    out = materialize(out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")), "variants")
    release_since(docs.sparkSession, mark, but=1)
    return out
