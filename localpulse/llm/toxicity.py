"""Toxicity by a weighted finite-state pattern grammar.

The grammar reads classes of words, not words alone. An insult transducer weights
lexicon words; target, negation and reported-speech transducers raise or lower
that weight by what stands before the word in its clause; a mirrored target
transducer reads the words after it; a threat counts only with a target near.
The transducers are composed into one machine, and a document's score comes from
the sum of its matched clauses' weights and their density.

The insult lexicon is learned: of at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``
labelled rows (by a hash of their ids) every word and every proper prefix of
``PREFIXES`` bytes is counted, and those enter whose documents are toxic far
beyond chance. The same rows fit the two weights of the final logistic.

Scoring reads only the text, the whole of it. Words are ``[0-9A-Za-z]`` and
non-ASCII characters, with A-Z lowered, compared by 64-bit hashes.

Defined cases: a null or empty text matches nothing and gets the score of such a
text; without labels of both kinds no lexicon is learned and every score is the
prior (0 without any label); labels with a null id or value are ignored, of several
labels of one id the largest holds, and of rows with one id one is learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from localpulse.llm.core import ALNUM, LOWER, HashTable, byte_table, materialize, mix64, release_since, row_key, run_hashes, scratch_count, text_buffer, trimmed, without, word_runs
from localpulse.llm.langid import held_out
from localpulse.llm.tokens import slices

SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 5000
PREFIXES = range(3, 11)
MIN_DOCS = 5
THRESHOLD = 0.3

#: Words that steer a clause, in English, German, French and Spanish: fixed values.
TARGETS = "you your youre yourself he she they them him her his their du dich dir ihr euch euer dein sie ihn ihnen tu toi vous vos votre ton ta ils elles eux tú usted ustedes vosotros ellos ellas"
NEGATIONS = "not no never nobody nothing isnt arent dont doesnt wasnt nicht kein keine keiner nie niemals pas jamais aucun aucune ne nunca jamás ningún ninguna tampoco"
REPORTED = "said says say called calls claimed wrote quoted quote reported alleged sagte sagt nannte schrieb behauptete dit disait appelé écrit déclaré dijo dice llamó escribió afirmó"
THREATS = "kill hurt destroy beat punch stab shoot burn töten schlagen verletzen tuer frapper détruire matar golpear destruir"

STOP, OTHER, INSULT, THREAT, TARGET, NEGATION, SPEECH = range(7)
BEFORE, AFTER = 8, 3


@dataclass
class Transducer:
    """A weighted machine over word classes: arcs (state, class) to (state, weight); a missing arc leads to state 0 with weight 1."""

    arcs: dict[tuple[int, int], tuple[int, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.arcs.get((state, symbol), (0, 1.0))

    def states(self) -> set[int]:
        return {0, *(s for s, _ in self.arcs), *(s for s, _ in self.arcs.values())}


def within(trigger: int, reach: int, factors: dict[int, float]) -> Transducer:
    """After ``trigger``, for ``reach`` words of the clause, a class of ``factors`` is weighted by its factor."""
    arcs: dict[tuple[int, int], tuple[int, float]] = {}
    for state in range(reach + 1):
        for symbol in range(OTHER, SPEECH + 1):
            left = reach if symbol == trigger else max(state - 1, 0)
            arcs[state, symbol] = (left, factors.get(symbol, 1.0) if state else 1.0)
    return Transducer(arcs)


def weighted(factors: dict[int, float]) -> Transducer:
    """One state; each class has its weight, others 0."""
    return Transducer({(0, s): (0, factors.get(s, 0.0)) for s in range(STOP, SPEECH + 1)})


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Both machines read the same classes; their weights multiply. Only states that can be reached are built."""
    number = {(0, 0): 0}
    todo, arcs = [(0, 0)], {}
    while todo:
        pair = todo.pop()
        for symbol in range(STOP, SPEECH + 1):
            (x, u), (y, v) = a.step(pair[0], symbol), b.step(pair[1], symbol)
            if (x, y) not in number:
                number[x, y] = len(number)
                todo.append((x, y))
            arcs[number[pair], symbol] = (number[x, y], u * v)
    return Transducer(arcs)


class Grammar:
    """The composed machines as tables: what a clause adds for the word it ends in."""

    def __init__(self) -> None:
        context = weighted({INSULT: 1.0, THREAT: 0.2})
        for part in (within(TARGET, 4, {INSULT: 1.3, THREAT: 5.0}), within(NEGATION, 2, {INSULT: 0.7, THREAT: 0.4}), within(SPEECH, 6, {INSULT: 0.8, THREAT: 0.5})):
            context = compose(context, part)
        self.left = self._tables(context)
        self.right = self._tables(within(TARGET, AFTER, {INSULT: 1.2, THREAT: 5.0}))

    @staticmethod
    def _tables(t: Transducer) -> tuple[list[list[int]], list[list[float]]]:
        n = max(t.states()) + 1
        return [[t.step(s, c)[0] for c in range(SPEECH + 1)] for s in range(n)], [[t.step(s, c)[1] for c in range(SPEECH + 1)] for s in range(n)]

    @staticmethod
    def _last(tables, symbols: list[int]) -> float:
        to, weight = tables
        state, w = 0, 1.0
        for c in symbols:
            w = weight[state][c]
            state = to[state][c]
        return w

    def clause(self, before: list[int], word: int, after: list[int]) -> float:
        """Weight of ``word`` after ``before`` and before ``after`` (both in reading order, within the clause)."""
        return self._last(self.left, [*before, word]) * self._last(self.right, [*reversed(after), word])


_STOPS = byte_table(lambda b: chr(b) in ".!?\n;")


@dataclass
class Words:
    """The words of a batch: hashes, prefix hashes by length, row, and number of the clause."""

    hashes: np.ndarray
    prefixes: dict[int, tuple[np.ndarray, np.ndarray]]
    row: np.ndarray
    clause: np.ndarray
    per_row: np.ndarray


def read_words(buf: np.ndarray, offs: np.ndarray, lengths) -> Words:
    starts, ends = word_runs(buf, offs, ALNUM)
    at = np.searchsorted(starts, offs)
    n = np.diff(at)
    row = np.repeat(np.arange(len(n)), n)
    stops = np.cumsum(_STOPS[buf]) if len(buf) else np.zeros(0, np.int64)
    prefixes = {}
    for k in lengths:
        longer = np.flatnonzero(ends - starts > k)
        prefixes[k] = longer, mix64(run_hashes(buf, starts[longer], starts[longer] + k, LOWER) ^ np.uint64(0xA24BAED4963EE407 + k))
    return Words(run_hashes(buf, starts, ends, LOWER), prefixes, row, row * (1 << 32) + (stops[starts] if len(starts) else stops[:0]), n)


def _listed(words: str) -> np.ndarray:
    buf, offs = text_buffer(pa.array([words]))
    starts, ends = word_runs(buf, offs, ALNUM)
    return run_hashes(buf, starts, ends, LOWER)


@dataclass
class Lexicon:
    """Weights of word and prefix hashes (0: whole words)."""

    by_length: dict[int, tuple[np.ndarray, np.ndarray]]

    def __post_init__(self) -> None:
        self.tables = {}
        for k, (hashes, weights) in self.by_length.items():
            table = HashTable(max(12, (4 * len(hashes)).bit_length()))
            table.add(hashes)
            self.tables[k] = table, weights
        context = np.concatenate([_listed(x) for x in (TARGETS, NEGATIONS, REPORTED, THREATS)])
        kinds = np.repeat([TARGET, NEGATION, SPEECH, THREAT], [len(_listed(x)) for x in (TARGETS, NEGATIONS, REPORTED, THREATS)])
        context, first = np.unique(context, return_index=True)
        self.context, self.kinds = HashTable(12), np.append(kinds[first], OTHER)
        self.context.add(context)
        self.grammar = Grammar()

    @property
    def lengths(self) -> list[int]:
        return [k for k in self.by_length if k]

    def clauses(self, words: Words) -> np.ndarray:
        """Summed weights of the matched clauses of each row."""
        out = np.zeros(len(words.per_row))
        weight = np.zeros(len(words.hashes))
        for k, (table, values) in self.tables.items():
            at, hashes = (np.arange(len(weight)), words.hashes) if k == 0 else words.prefixes[k]
            found = table.find(hashes)
            hit = found >= 0
            np.maximum.at(weight, at[hit], values[found[hit]])
        kind = self.kinds[self.context.find(words.hashes)]
        kind = np.where(weight > 0, INSULT, kind)
        ends = np.flatnonzero((kind == INSULT) | (kind == THREAT))
        clause = words.clause
        for i in ends.tolist():
            a, b = max(0, i - BEFORE), min(len(kind), i + 1 + AFTER)
            same = clause[a:b] == clause[i]
            near = kind[a:b]
            left = near[: i - a][same[: i - a]].tolist()
            right = near[i - a + 1 :][same[i - a + 1 :]].tolist()
            out[words.row[i]] += (weight[i] or 1.0) * self.grammar.clause(left, int(kind[i]), right)
        return out


def _features(total: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Inputs of the logistic: the sum of clause weights, and their density."""
    return np.stack([np.log1p(total), np.log1p(100 * total / (n_words + 20.0)), np.ones(len(total))], 1)


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        words = read_words(buf, offs, self.lexicon.lengths)
        z = _features(self.lexicon.clauses(words), words.per_row) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (p - y)) + ridge * w
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + (ridge + 1e-6) * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 3.0 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _count_features(sample: DataFrame) -> DataFrame:
    """In how many toxic and clean documents of ``sample`` (``text, toxic``) each word (``k`` = 0) and prefix occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(0))
            marks = batch.column(1).to_numpy(zero_copy_only=False) == 1
            for i, j in slices(offs, 1 << 20):
                words = read_words(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i], PREFIXES)
                toxic = marks[i:j]
                for k, (at, hashes) in {0: (np.arange(len(words.hashes)), words.hashes), **words.prefixes}.items():
                    row = words.row[at]
                    first = ~pd.Series(mix64(hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))).duplicated().to_numpy()
                    code, value = pd.factorize(hashes[first])
                    hit = toxic[row[first]]
                    t, c = np.bincount(code[hit], minlength=len(value)), np.bincount(code[~hit], minlength=len(value))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), k, np.int32)), pa.array(np.asarray(value).view(np.int64)), pa.array(t.astype(np.int64)), pa.array(c.astype(np.int64))], ["k", "hash", "t", "c"])

    counts = sample.select("text", "toxic").mapInArrow(trimmed(run), "k int, hash bigint, t bigint, c bigint")
    return counts.groupBy("k", "hash").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def fit(docs: DataFrame, labels: DataFrame, *, folds: int = 4, fold: int = 2) -> Model | float:
    """Learn from the labels (``doc_id, toxic``) outside the fold; the prior alone if they are not of both kinds."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    rows = materialize(rows.groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic")), "labels")
    held = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(held) < 2:
        return float(next(iter(held), 0))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = rows.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).unionByName(rows.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
    chosen = materialize(chosen.select(F.col("doc_id").alias("_d"), "toxic"), "sample-ids")
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN ids, of each of which one row is learned from.
    sample = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_d")).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    sample = materialize(sample.select("doc_id", "text", "toxic"), "sample")
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return held[1] / sum(held.values())
    n_t, n_c = n[1], n[0]
    counts = materialize(_count_features(sample), "features").where(F.col("t") >= MIN_DOCS)
    distinct = counts.count()
    share = n_t / (n_t + n_c)
    t, c = F.col("t"), F.col("c")
    both = t + c
    # Log-likelihood ratio of the observed toxic share against chance, in nats.
    ratio = t * F.log(t / both / share) + F.when(c > 0, c * F.log(c / both / (1 - share))).otherwise(0.0)
    weight = F.log((t + 0.5) / (n_t + 1)) - F.log((c + 0.5) / (n_c + 1))
    good = counts.withColumns({"ratio": ratio, "weight": weight}).where((F.col("ratio") > float(np.log(max(distinct, 1)) + 3)) & (F.col("weight") > 1.2))
    # Each of these stands in MIN_DOCS sampled documents at least, far beyond chance: their number is bounded by the sample's.
    lists: dict[int, tuple[list[int], list[float]]] = {}
    for r in good.orderBy(F.desc("ratio"), "k", "hash").collect():
        hashes, weights = lists.setdefault(r.k, ([], []))
        hashes.append(r.hash)
        weights.append(r.weight)
    lexicon = Lexicon({k: (np.array(h, np.int64).view(np.uint64), np.array(w)) for k, (h, w) in sorted(lists.items())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(0))
            words = read_words(buf, offs, lexicon.lengths)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(lexicon.clauses(words)), pa.array(words.per_row)], ["toxic", "total", "n"])

    found = sample.select("text", "toxic").mapInArrow(trimmed(run), "toxic int, total double, n bigint").toPandas()
    y = found["toxic"].to_numpy(float)
    per_row = np.where(y == 1, held[1] / n_t, held[0] / n_c)
    weights = fit_logistic(_features(found["total"].to_numpy(), found["n"].to_numpy()), y, per_row * len(y) / per_row.sum())
    return Model(lexicon, weights)


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (``doc_id``, ``text``)."""
    if not isinstance(model, Model):
        return docs.select("doc_id", F.lit(float(model)).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = text_buffer(batch.column(1))
            scores = [sent.value.score(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]) for i, j in slices(offs, 1 << 20)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *scores]))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id bigint, score double")


def _model(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, folds: int, fold: int) -> Model | float:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    marks = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).alias("toxic"))
    mark = scratch_count()
    model = fit(rows, marks, folds=folds, fold=fold)
    release_since(docs.sparkSession, mark)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 4, fold: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = _model(docs, labels, doc_id, text, label, folds, fold)
    out = score(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")), model)
    return out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 4, fold: int = 2) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic; rows are told apart by id and text, so null and repeated ids decide nothing."""
    model = _model(docs, labels, doc_id, text, label, folds, fold)
    mark = scratch_count()
    scores = score(docs.select(row_key(doc_id, text).alias("doc_id"), F.col(text).cast("string").alias("text")), model)
    bad = materialize(scores.where(F.col("score") >= THRESHOLD).select("doc_id"), "toxic")
    release_since(docs.sparkSession, mark, but=1)
    return without(docs, bad, doc_id, text)
