"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character 1- to 3-grams, hashed into 2^16 buckets;
term frequencies are shares of the text's n-grams. Document frequencies are
counted over all training documents. The weights are trained by
follow-the-regularised-leader (proximal, per coordinate) with an elastic-net
penalty, on at most ``PER_LANGUAGE`` documents of each language, chosen by a hash of
their ids; a fifth of these is held back to fit the temperature that calibrates the
scores. Every value of the language column is learned; the model has ``BUCKETS``
weights for each.

Prediction reads only the text, the whole of it.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without training rows every text is ``und``; equal scores go to the first
language in order; repeated rows are predicted alike, and of rows with one id one is
learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, release_since, scratch_count, text_buffer, trimmed
from localpulse.llm.tokens import slices

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
PER_LANGUAGE = 500
#: Documents of all languages together; with more than eight languages each has an equal share, one at least.
MAX_SAMPLE = 4000
SCALE = 30.0
UNKNOWN = "und"

_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])
_FOLD = np.arange(256, dtype=np.uint32)
for _c in range(256):
    _low = chr(_c).lower()
    if len(_low) == 1 and ord(_low) < 256:
        _FOLD[_c] = ord(_low)
_FOLD[[9, 10, 11, 12, 13]] = 32


def ngram_buckets(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every row, row by row, and where each row starts."""
    rows = len(offs) - 1
    if not len(buf):
        return np.zeros(0, np.uint16), np.zeros(rows + 1, np.int64)
    points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum(_LEAD[buf])])[offs]
    low = points < 256
    points = np.where(low, _FOLD[np.where(low, points, 0)], points).astype(np.uint32)
    size = np.diff(ends)
    per_row = [np.maximum(size - k + 1, 0) for k in ORDERS]
    total = sum(per_row)
    starts = np.concatenate([[0], np.cumsum(total)])
    out = np.empty(int(starts[-1]), np.uint16)
    done = np.zeros(rows, np.int64)
    owner = np.repeat(np.arange(rows), size)
    place = np.arange(len(points)) - np.repeat(ends[:-1], size)
    h = np.full(len(points), 2166136261, np.uint32)
    for k, n in zip(ORDERS, per_row, strict=True):
        h = (h[: len(points) - k + 1] ^ points[k - 1 :]) * np.uint32(16777619) if k <= len(points) else h[:0]
        h ^= h >> np.uint32(13)
        own = owner[: len(h)]
        inside = place[: len(h)] < n[own]
        mixed = (h ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        own = own[inside]
        out[starts[own] + done[own] + place[: len(h)][inside]] = (mixed[inside] >> np.uint32(16)).astype(np.uint16)
        done += n
    return out, starts


def sparse_counts(grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of every bucket that occurs in a row, in that order."""
    row = np.repeat(np.arange(len(starts) - 1, dtype=np.uint64), np.diff(starts))
    keys = np.sort((row << np.uint64(16)) | grams)
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return (keys[head] >> np.uint64(16)).astype(np.int64), (keys[head] & np.uint64(BUCKETS - 1)).astype(np.int64), np.diff(np.append(head, len(keys)))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            buf, offs = text_buffer(batch.column(0))
            seen[BUCKETS] += len(offs) - 1
            for i, j in slices(offs, 1 << 20):
                grams, starts = ngram_buckets(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                seen[:BUCKETS] += np.bincount(sparse_counts(grams, starts)[1], minlength=BUCKETS)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some])], ["bucket", "n"])

    counts = docs.select("text").mapInArrow(trimmed(run), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    df = np.zeros(BUCKETS + 1, np.int64)
    for r in counts.collect():  # at most one row per bucket
        df[r.bucket] = r.n
    return df[:BUCKETS], int(df[BUCKETS])


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket x language, with the inverse document frequency taken in
    bias: np.ndarray
    temperature: float

    def logits(self, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row for each text, whose n-grams start at ``starts`` (one more entry than texts)."""
        size = np.diff(starts)
        out = np.tile(self.bias, (len(size), 1))
        some = size > 0
        at = grams.astype(np.intp)
        for k, column in enumerate(self.weights.T):
            if some.any():
                out[some, k] += np.add.reduceat(np.ascontiguousarray(column)[at], starts[:-1][some]) * (SCALE / size[some])
        return out

    def predict(self, grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the likeliest language of each text, and its probability."""
        p = softmax(self.logits(grams, starts) / self.temperature)
        return p.argmax(1), p.max(1)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], idf: np.ndarray, languages: list[str], *, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, epochs: int = 3) -> Model:
    """Fit on (buckets, their counts, language number) in the given order; every fifth is for the temperature alone."""
    k = len(languages)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def weights(at):
        zs, ns = z[at], n[at]
        return np.where(np.abs(zs) > l1, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2), 0.0)

    fit = [s for i, s in enumerate(samples) if i % 5]
    rest = [s for i, s in enumerate(samples) if not i % 5] or fit
    for _ in range(epochs):
        for at, count, y in fit:
            x = np.append(count * idf[at] * (SCALE / max(count.sum(), 1)), 1.0)
            at = np.append(at, BUCKETS)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(BUCKETS + 1))
    model = Model(languages, w[:BUCKETS] * idf[:, None], w[BUCKETS], 1.0)
    grams = np.concatenate([np.repeat(at, count) for at, count, _ in rest])
    starts = np.concatenate([[0], np.cumsum([count.sum() for _, count, _ in rest])]).astype(np.int64)
    logits, y = model.logits(grams, starts), np.array([y for *_, y in rest])

    def loss(t: float) -> float:
        return float(-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean())

    model.temperature = min((float(t) for t in np.geomspace(0.2, 20, 93)), key=loss)
    return model


def sampled_ids(rows: DataFrame, most: int) -> DataFrame:
    """``_d, lang`` of the first ``most`` ids of each language of ``rows`` (``doc_id, lang``) by their hash.

    Counts by language and range of hashes tell where enough rows are reached; only
    those rows are ranked, so no language is gathered.
    """
    hashed = rows.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).withColumn("range", F.shiftright("h", 52))
    ranges = hashed.groupBy("lang", "range").count()
    upto = F.sum("count").over(Window.partitionBy("lang").orderBy("range"))  # at most 4,096 rows a language
    ranges = ranges.withColumn("before", upto - F.col("count")).where(F.col("before") < most).select("lang", "range")
    near = hashed.join(ranges, ["lang", "range"], "left_semi").select("doc_id", "lang", "h").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    return near.withColumn("r", place).where(F.col("r") <= most).select(F.col("doc_id").alias("_d"), "lang")


def fit(docs: DataFrame, *, folds: int = 5, fold: int = 0) -> Model | None:
    """Train on ``docs`` (``doc_id, text, lang``) outside the fold; None without any labelled row."""
    rows = docs.where(~held_out(F.col("doc_id"), folds, fold) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not languages:
        return None
    df, total = document_frequencies(rows)
    idf = 1.0 + np.log((1.0 + total) / (1.0 + df))
    chosen = materialize(sampled_ids(rows, max(1, min(PER_LANGUAGE, MAX_SAMPLE // len(languages)))), "sample-ids")
    # At most MAX_SAMPLE ids, or one for each language.
    sample = rows.join(F.broadcast(chosen.select("_d").distinct()), F.col("doc_id") == F.col("_d"), "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(2))
            for i, j in slices(offs, 1 << 20):
                grams, starts = ngram_buckets(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                row, bucket, count = sparse_counts(grams, starts)
                ends = np.searchsorted(row, np.arange(j - i + 1))
                blobs = [bucket[a:b].astype(np.uint16).tobytes() + count[a:b].astype(np.uint32).tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i).cast(pa.string()), pa.array(blobs, pa.binary())], ["doc_id", "lang", "counts"])

    found = sample.select("doc_id", "row.lang", "row.text").mapInArrow(trimmed(run), "doc_id bigint, lang string, counts binary").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    samples = []
    for r in found:
        n = len(r.counts) // 6
        samples.append((np.frombuffer(r.counts, np.uint16, n).astype(np.int64), np.frombuffer(r.counts, np.uint32, n, 2 * n).astype(np.int64), languages.index(r.lang)))
    return train(samples, idf, languages) if samples else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs`` (``doc_id``, ``text``)."""
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "text", letter.alias("letter"))
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            best, scores = np.full(len(letters), -1), np.zeros(len(letters))
            for i, j in slices(offs, 1 << 18):
                best[i:j], scores[i:j] = model.predict(*ngram_buckets(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]))
            scores[~letters], best[~letters] = 0.0, -1
            names = [model.languages[b] if b >= 0 else UNKNOWN for b in best.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(trimmed(run), "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, fold: int = 0) -> DataFrame:
    """Train on the rows outside the fold and predict all rows: ``doc_id, held_out, lang_pred, score``."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    mark = scratch_count()
    model = fit(rows, folds=folds, fold=fold)
    release_since(docs.sparkSession, mark)
    out = predict(rows.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "lang_pred", "score")
