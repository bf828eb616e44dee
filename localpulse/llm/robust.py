"""Quality rules by robust multivariate outliers.

Each document gets counts and a vector of transformed statistics. For each group
(language and source; small groups are pooled by language, then all together) the
minimum covariance determinant gives a location and scatter that outliers do not
move: concentration steps keep the ``SUPPORT`` share of rows with the smallest
Mahalanobis distances and re-estimate from them, from two starts, of which the one
with the smaller determinant stays. After one reweighting step, documents beyond
``CUTOFF``, the 0.999 quantile of the chi-square distribution, are rejected. Where a
scatter is singular or narrower than ``FLOOR``, it is widened to that and no further.

The two starts are concentrated first within about ``START_ROWS`` rows of each group,
drawn evenly, which are the whole group where it has no more. From there the steps go
on over all rows until no group's determinant moves any more: the draw only shortens
the way. A step over all rows is one aggregation of moments by group and distance bin
(``BINS`` to an octave), so no group is gathered anywhere and a hot source only adds to
sums. The bin in which the support ends counts with the share of it that is still needed.

Defined cases: a null or empty text has no words and fails the base rules; a null
language or source is a value of its own; repeated rows each count; rows with a null
id or one id each get their own verdict; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.llm.core import NOT_SPACE, byte_table, gram_hashes, materialize, mix64, release_since, run_hashes, scratch_count, text_buffer, trimmed, word_runs
from localpulse.llm.tokens import slices

MIN_WORDS = 50
REPEAT_PERCENT = 50
SUPPORT = 0.75
#: Steps stop when no group's log determinant moves by more than ``SETTLED``; the number of steps is bounded because bins make them not quite monotone.
SETTLED = 1e-4
MOST_STEPS = 20
BINS = 64
#: Rows of a group, about, that the steps begin with.
START_ROWS = 2000
#: Rows a group needs for estimates of its own: ten for each feature. Of so few the support still holds 38, and the quarter
#: left out of it may be outliers of any size (the breakdown point); smaller groups have too few rows for a scatter of 15 numbers.
OWN_GROUP = 50
#: Quantiles 0.975 and 0.999 of the chi-square distribution with as many degrees of freedom as there are features (5), and medians for 1 to 5: fixed values.
CHI2_975, CUTOFF = 12.8325, 20.515
CHI2_MEDIANS = [0.4549, 1.3863, 2.3660, 3.3567, 4.3515]
#: Least standard deviation of each feature (in its own unit), so that rows that are all alike do not reject one symbol, one repeated line
#: or one repeated 3-word window (6 words) in ``MIN_WORDS`` words, which are 0.07, 0.2 and 0.12, against sqrt(CUTOFF) = 4.53 times the floor.
FLOOR = [0.10, 0.01, 0.02, 0.05, 0.03]
FEATURES = len(FLOOR)

_LINE = byte_table(lambda b: b != 10)
_SYMBOL = byte_table(lambda b: chr(b) in "#*$%&|<>")
_LEAD = byte_table(lambda b: b & 0xC0 != 0x80)

COUNTS = "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def text_counts(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """For each row: words, code points in words, symbols, lines equal to an earlier one, words in repeated 3-word windows."""
    rows = len(offs) - 1
    if not len(buf):
        return [np.zeros(rows, np.int64)] * 5

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[offs[1:]] - total[offs[:-1]]

    starts, ends = word_runs(buf, offs, NOT_SPACE)
    at = np.searchsorted(starts, offs)
    words = run_hashes(buf, starts, ends)
    n_words = np.diff(at)
    word_chars = per_row(NOT_SPACE[buf] & _LEAD[buf])
    symbols = per_row(_SYMBOL[buf])

    def repeated(hashes: np.ndarray, row: np.ndarray, keep: str | bool) -> np.ndarray:
        return pd.Series(mix64(hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))).duplicated(keep=keep).to_numpy()

    first, last = word_runs(buf, offs, _LINE)
    worded = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last = first[worded], last[worded]
    row = np.searchsorted(offs, first, "right") - 1
    dup = np.bincount(row[repeated(run_hashes(buf, first, last), row, "first")], minlength=rows)

    owner = np.repeat(np.arange(rows), n_words)
    grams = gram_hashes(words, 3)
    inside = np.flatnonzero(owner[: len(grams)] == owner[2:]) if len(grams) else np.zeros(0, np.int64)
    again = inside[repeated(grams[inside], owner[inside], False)]
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[again + k] = True
    return [n_words, word_chars, symbols, dup, np.bincount(owner[hit], minlength=rows)]


def counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts of every document (columns ``COUNTS``)."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in COUNTS.split(", ")]
        for batch in batches:
            buf, offs = text_buffer(batch.column(3))
            for i, j in slices(offs, 1 << 20):
                found = text_counts(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                own = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1).cast(pa.string()), own.column(2).cast(pa.string()), *(pa.array(x.astype(np.int64)) for x in found)], names)

    return rows.mapInArrow(trimmed(run), COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)


def features() -> list[Column]:
    """Transformed statistics of a document that passed the base rules."""
    n = F.nullif(F.col("n_words"), F.lit(0)).cast("double")
    chars = F.nullif(F.col("word_chars"), F.lit(0)).cast("double")
    return [
        F.log(n),
        F.log(chars / n),
        F.sqrt(F.col("n_symbols") / chars),
        F.col("n_dup_lines") * 10 / n,
        F.col("n_repeat_words") / n,
    ]


_X = [f"x{i}" for i in range(FEATURES)]
_PAIRS = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]


def _distance() -> Column:
    """Squared Mahalanobis distance of ``x`` from the joined ``mean`` and ``inv``."""
    d = [F.col(x) - F.col("mean")[i] for i, x in enumerate(_X)]
    return sum((d[i] * d[j] * F.col("inv")[k] * (1 if i == j else 2) for k, (i, j) in enumerate(_PAIRS)), F.lit(0.0))


def _moments() -> list[Column]:
    return [F.count("*").alias("n"), *(F.sum(x).alias(f"s_{x}") for x in _X), *(F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"s_{i}_{j}") for i, j in _PAIRS)]


_SUMS = ["n", *(f"s_{x}" for x in _X), *(f"s_{i}_{j}" for i, j in _PAIRS)]


def _solve(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, scale: np.ndarray | float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mean, inverse scatter (upper triangle), log determinant and count of directions wider than the floor from moments, a group to a row."""
    n = np.maximum(n, 1.0)[:, None]
    mean = sums / n
    cov = np.empty((len(n), FEATURES, FEATURES))
    for k, (i, j) in enumerate(_PAIRS):
        cov[:, i, j] = cov[:, j, i] = squares[:, k] / n[:, 0] - mean[:, i] * mean[:, j]
    # In units of the floor no direction is narrower than 1.
    unit = np.outer(FLOOR, FLOOR)
    width, axes = np.linalg.eigh(cov * np.reshape(scale, (-1, 1, 1)) / unit)
    free = (width > 1.0).sum(1).astype(np.int32)
    width = np.maximum(width, 1.0)
    inv = (axes / width[:, None, :]) @ axes.transpose(0, 2, 1) / unit
    return mean, np.stack([inv[:, i, j] for i, j in _PAIRS], 1), np.log(width).sum(1), free


_FOUND = "mean array<double>, inv array<double>, logdet double, free int"


def _estimates(sums: DataFrame, keys: list[str]) -> DataFrame:
    """The estimates (``_FOUND``) from moments; one row per key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            squares = df[[f"s_{i}_{j}" for i, j in _PAIRS]].to_numpy(float)
            scale = df["scale"].to_numpy(float) if "scale" in df else 1.0
            mean, inv, logdet, free = _solve(df["n"].to_numpy(float), df[[f"s_{x}" for x in _X]].to_numpy(float), squares, scale)
            yield df[keys].assign(mean=list(mean), inv=list(inv), logdet=logdet, free=free)

    fields = ", ".join(f"{k} {sums.schema[k].dataType.simpleString()}" for k in keys)
    return sums.mapInPandas(run, f"{fields}, {_FOUND}")


def _support(distances: np.ndarray) -> np.ndarray:
    """Weight of each row: 1 in the bins that lie within the ``SUPPORT`` share, the share still needed in the bin where it ends, else 0."""
    _, at, n = np.unique(np.floor(np.log2(distances + 1e-9) * BINS), return_inverse=True, return_counts=True)
    taken = np.cumsum(n) - n
    return np.clip((np.ceil(len(distances) * SUPPORT) - taken) / n, 0.0, 1.0)[at]


def _starts(drawn: DataFrame) -> DataFrame:
    """Both starts of each group, concentrated within its drawn rows."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        x = df[_X].to_numpy(float)
        squares = np.stack([x[:, i] * x[:, j] for i, j in _PAIRS], 1)
        twice = np.array([1 if i == j else 2 for i, j in _PAIRS])

        def solve(weight: np.ndarray) -> list[np.ndarray]:
            return [found[0] for found in _solve(weight.sum()[None], (weight @ x)[None], (weight @ squares)[None])]

        # Mean and scatter of all rows; medians with mean absolute deviations about them.
        mid = np.median(x, 0)
        spread = np.maximum(np.abs(x - mid).mean(0) * 1.2533, FLOOR)
        ends = []
        for now in (solve(np.ones(len(x))), [mid, np.array([spread[i] ** -2 if i == j else 0.0 for i, j in _PAIRS]), np.inf, 0]):
            for _ in range(MOST_STEPS):
                last = now[2]
                d = x - now[0]
                now = solve(_support(np.stack([d[:, i] * d[:, j] for i, j in _PAIRS], 1) @ (now[1] * twice)))
                if abs(now[2] - last) <= SETTLED:
                    break
            ends.append(now)
        return pd.DataFrame({"grp": df["grp"].iloc[0], "start": [0, 1], **{k: [end[c] for end in ends] for c, k in enumerate(["mean", "inv", "logdet", "free"])}})

    return drawn.groupBy("grp").applyInPandas(run, f"grp string, start int, {_FOUND}")


def _nearest(rows: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of the ``SUPPORT`` share of each group's rows that are nearest by the joined estimates, and the median distance."""
    at = F.floor(F.log2(_distance() + 1e-9) * BINS).alias("bin")
    binned = rows.join(params, "grp").groupBy(*keys, at).agg(*_moments())
    group = Window.partitionBy(*keys)
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    all_n = F.sum("n").over(group)
    taken = F.coalesce(F.sum("n").over(upto), F.lit(0))
    mid = F.when((taken <= all_n / 2) & (taken + F.col("n") > all_n / 2), F.pow(F.lit(2.0), (F.col("bin") + 0.5) / BINS))
    share = F.least(F.greatest((F.ceil(all_n * SUPPORT) - taken) / F.col("n"), F.lit(0.0)), F.lit(1.0))
    marked = binned.withColumns({"share": share, "median": mid})
    inside = [F.sum(F.col("share") * F.col(c)).alias(c) for c in _SUMS]
    return marked.groupBy(*keys).agg(*inside, F.max("median").alias("median"))


def verdicts(stats: DataFrame) -> DataFrame:
    """``stats`` (columns ``COUNTS``) with ``base_failed``, ``distance`` and ``kept``."""
    stats = stats.withColumn("base_failed", base_failed())
    held = materialize(stats, "counts")
    mark = scratch_count()
    own = F.concat_ws("\x1f", F.coalesce("lang", F.lit("\x00")), F.coalesce("source", F.lit("\x00")))
    by_lang = F.coalesce("lang", F.lit("\x00"))
    good = held.where(~F.col("base_failed"))
    sizes = good.groupBy("lang", "source").count().withColumn("grp", F.when(F.col("count") >= OWN_GROUP, own).otherwise(by_lang))
    pooled = Window.partitionBy("grp")
    sizes = sizes.withColumn("grp", F.when(F.sum("count").over(pooled) >= OWN_GROUP, F.col("grp")).otherwise(F.lit("")))
    sizes = sizes.withColumn("drawn", START_ROWS / F.sum("count").over(pooled))
    sizes = materialize(sizes.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "grp", "drawn"), "groups")
    same = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    rows = materialize(good.join(sizes, same).select("grp", "drawn", *(f.alias(x) for f, x in zip(features(), _X, strict=True))), "features")

    params = materialize(_starts(rows.where(F.rand(0) < F.col("drawn"))), "estimates")
    for _ in range(MOST_STEPS):
        last = params.select("grp", "start", F.col("logdet").alias("last"))
        params = materialize(_estimates(_nearest(rows, params, ["grp", "start"]), ["grp", "start"]), "estimates")
        if params.join(last, ["grp", "start"]).where(F.abs(F.col("logdet") - F.col("last")) > SETTLED).isEmpty():
            break
    best = params.groupBy("grp").agg(F.min_by(F.struct("mean", "inv", "free"), F.struct("logdet", "start")).alias("b")).select("grp", "b.*")
    # Scale so that the median distance is that of the chi-square distribution over the directions that vary, then reweight once.
    expected = F.array(*map(F.lit, CHI2_MEDIANS))[F.greatest(F.col("free") - 1, F.lit(0))]
    scaled = _nearest(rows, best, ["grp", "free"]).withColumn("scale", F.greatest(F.col("median") / expected, F.lit(1e-3)))
    raw = materialize(_estimates(scaled, ["grp"]), "estimates")
    inner = rows.join(raw, "grp").where(_distance() <= CHI2_975).groupBy("grp").agg(*_moments())
    final = materialize(_estimates(inner.withColumn("scale", F.lit(1.1)), ["grp"]), "estimates")
    release_since(stats.sparkSession, mark + 1, but=1)  # all but the groups and the last estimates
    measured = held.join(sizes, same, "left").join(final.select(F.col("grp").alias("_g"), "mean", "inv"), F.col("grp") == F.col("_g"), "left")
    measured = measured.select(held["*"], "mean", "inv", *(f.alias(x) for f, x in zip(features(), _X, strict=True)))
    out = measured.withColumn("distance", F.when(~F.col("base_failed"), _distance())).drop("mean", "inv", *_X)
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF))
