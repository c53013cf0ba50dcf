"""Toxicity categories by a classifier chain.

One linear model a category, in a fixed order: each later model also sees the probabilities of the earlier categories. While
fitting, those probabilities come from models of the other folds, so that a later model learns from what earlier ones say
about texts they have not seen. Fitting takes a bounded sample of labelled rows; scoring reads every row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import filled, smallest_hashes

#: Labelled rows that models and vocabulary are fitted on.
FIT_ROWS = 20_000
#: Words in the vocabulary, by association with a category.
VOCABULARY = 1_024
FOLDS = 3
_PUNCTUATION = bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in range(256))


def text_words(text: str | None) -> list[bytes]:
    """Words in lower case, ASCII punctuation as blanks."""
    return (text or "").lower().encode("utf-8", "replace").translate(_PUNCTUATION).split()


def labelled_sample(docs: DataFrame, labels: DataFrame, ident: str, text: str, categories: list[str], bound: int = FIT_ROWS) -> DataFrame:
    """(``id``, ``text``, ``y``) of about ``bound`` rows, 95 % of it on average, those with the smallest hashes of the id.

    Rows with a NULL id or label are left out; of labels that repeat an id the largest of each category counts.
    """
    labels = labels.dropna(subset=[ident, *categories]).groupBy(ident).agg(*[F.max(F.col(c).cast("int")).alias(c) for c in categories])
    share = 0.95 * bound / max(labels.count(), 1)
    chosen = labels.filter(smallest_hashes(share, F.lit("fit"), F.col(ident)))
    chosen = chosen.select(F.col(ident).alias("__id"), F.array(*categories).alias("y"))
    # about ``bound`` rows of an id and a few numbers, whatever the size of the tables
    return docs.select(F.col(ident).alias("id"), filled(F.col(text)).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("__id")).drop("__id")


def choose_words(sample: DataFrame, n_categories: int, size: int = VOCABULARY) -> list[str]:
    """The words most associated with any category, by a signed root of chi-square on document counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word in set(text_words(value)):
                    seen[word] += 1
                    for k, v in enumerate(y):
                        if v:
                            seen[word, k] += 1
            if len(seen) > 200_000:
                yield flush(seen)
                seen = Counter()
        if seen:
            yield flush(seen)

    def flush(seen: Counter) -> pa.RecordBatch:
        words = [w for w in seen if isinstance(w, bytes)]
        counts = [pa.array([seen[w] for w in words], pa.int64())]
        counts += [pa.array([seen[w, k] for w in words], pa.int64()) for k in range(n_categories)]
        text = pa.array([w.decode("utf-8", "replace") for w in words], pa.string())
        return pa.RecordBatch.from_arrays([text, *counts], ["word", "n", *[f"n{k}" for k in range(n_categories)]])

    schema = "word string, n bigint, " + ", ".join(f"n{k} bigint" for k in range(n_categories))
    names = ["n", *[f"n{k}" for k in range(n_categories)]]
    counted = sample.select("text", "y").mapInArrow(run, schema).groupBy("word").agg(*[F.sum(c).alias(c) for c in names]).filter("n >= 3")
    total = sample.agg(F.count("*"), *[F.sum(F.col("y")[k]) for k in range(n_categories)]).first()
    if not total[0]:
        return []
    score = F.lit(0.0)
    for k in range(n_categories):
        rate = (total[k + 1] or 0) / total[0]
        if 0 < rate < 1:
            expected = F.col("n") * F.lit(rate)
            score = F.greatest(score, F.abs(F.col(f"n{k}") - expected) / F.sqrt(expected * F.lit(1 - rate)))
    rows = counted.withColumn("score", score).orderBy(F.desc("score"), "word").limit(size).select("word").collect()
    return [row[0] for row in rows]


class Features:
    """Counts of vocabulary words in a text, as (indices, log counts)."""

    def __init__(self, words: list[str]):
        self.index = {w.encode(): k for k, w in enumerate(words)}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        count = Counter(map(self.index.get, text_words(text)))
        count.pop(None, None)
        return np.fromiter(count.keys(), np.int32, len(count)), np.log1p(np.fromiter(count.values(), np.float32, len(count)))


class Rows:
    """A sparse matrix of the rows' features."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
        self.column = np.concatenate([i for i, _ in rows]) if rows else np.empty(0, np.int32)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.empty(0, np.float32)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.column], self.n)

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * r[self.row], self.width)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: Rows, extra: np.ndarray, y: np.ndarray, use: np.ndarray, steps: int = 100, rate: float = 0.1, decay: float = 1e-4) -> tuple:
    """Logistic regression on the rows of ``use`` by Adam: word weights, weights of ``extra`` columns, and a constant."""
    parts = [np.zeros(x.width), np.zeros(extra.shape[1]), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    n = max(int(use.sum()), 1)
    positive = min(max((y * use).sum() / n, 1e-3), 1 - 1e-3)
    parts[2][0] = np.log(positive / (1 - positive))
    for step in range(1, steps + 1):
        r = (_sigmoid(x.times(parts[0]) + extra @ parts[1] + parts[2][0]) - y) * use / n
        slopes = [x.transposed_times(r) + decay * parts[0], extra.T @ r + decay * parts[1], np.array([r.sum()])]
        for k, g in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            parts[k] = parts[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return parts[0], parts[1], float(parts[2][0])


class Chain:
    """Fitted models in category order, and the probability from which each category is taken to hold."""

    def __init__(self, categories: list[str], words: list[str], models: list[tuple], limits: list[float]):
        self.categories, self.words, self.models, self.limits = categories, words, models, limits

    def probabilities(self, x: Rows) -> np.ndarray:
        extra = np.zeros((x.n, 0))
        for w, beside, constant in self.models:
            p = _sigmoid(x.times(w) + extra @ beside + constant)
            extra = np.column_stack([extra, p])
        return extra


def best_limit(p: np.ndarray, y: np.ndarray) -> float:
    """The limit with the best harmonic mean of precision and recall; 0.5 if nothing is positive."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    if not len(p) or not right[-1]:
        return 0.5
    last = np.r_[np.diff(p[order]) != 0, True]
    harmonic = np.where(last, 2 * right / (np.arange(1, len(p) + 1) + right[-1]), 0)
    k = int(harmonic.argmax())
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def fit_chain(categories: list[str], words: list[str], rows: list[tuple], y: np.ndarray, fold: np.ndarray) -> Chain:
    """``y`` has a column for each category, ``fold`` the fold of each row.

    Models see out-of-fold probabilities of earlier categories, and limits are set on out-of-fold probabilities too.
    """
    x, extra, models, limits = Rows(rows, max(len(words), 1)), np.zeros((len(rows), 0)), [], []
    for k in range(len(categories)):
        models.append(fit_linear(x, extra, y[:, k], np.ones(len(rows))))
        unseen = np.zeros(len(rows))
        for f in range(FOLDS):
            w, beside, constant = fit_linear(x, extra, y[:, k], (fold != f).astype(float))
            own = fold == f
            unseen[own] = _sigmoid(x.times(w) + extra @ beside + constant)[own]
        limits.append(best_limit(unseen, y[:, k]))
        extra = np.column_stack([extra, unseen])
    return Chain(categories, words, models, limits)


def learn(docs: DataFrame, labels: DataFrame, categories: list[str], ident: str = "doc_id", text: str = "text", bound: int = FIT_ROWS) -> Chain:
    """Vocabulary and models from a bounded sample; at most ``bound`` short rows of word numbers reach the driver."""
    sample = labelled_sample(docs, labels, ident, text, categories, bound)
    words = choose_words(sample, len(categories))
    features = Features(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features.of(v) for v in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.list_(pa.int32())), pa.array([v for _, v in rows], pa.list_(pa.float32())), *batch.columns[1:]],
                ["i", "v", "y", "fold", "key", "id"],
            )

    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int")
    # in the order of hashes: the same rows and the same sums however the tables are split
    first = sample.withColumn("key", F.xxhash64(F.lit("fit"), "id", "text"))
    fields = "i array<int>, v array<float>, y array<int>, fold int, key bigint, id string"
    read = first.select("text", "y", fold.alias("fold"), "key", F.col("id").cast("string").alias("id")).mapInArrow(run, fields)
    got = read.orderBy("key", "id").limit(bound).toPandas()
    rows = [(np.asarray(i, np.int32), np.asarray(v, np.float32)) for i, v in zip(got["i"], got["v"], strict=True)]
    y = np.array([list(v) for v in got["y"]], dtype=float).reshape(len(rows), len(categories))
    return fit_chain(categories, words, rows, y, got["fold"].to_numpy(dtype=int))


def score(docs: DataFrame, chain: Chain, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``p_<category>`` for every row of ``docs``, in place.

    NULL and empty texts are scored as texts without words; repeated rows and NULL ids are scored as they are.
    """
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(chain.words)
        for batch in batches:
            p = chain.probabilities(Rows([features.of(v) for v in batch.column(1).to_pylist()], max(len(chain.words), 1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, k]) for k in range(len(names))]], [ident, *names])

    kind = docs.schema[ident].dataType.simpleString()
    chosen = docs.select(F.col(ident), filled(F.col(text)).alias("text"))
    return chosen.mapInArrow(run, f"`{ident}` {kind}, " + ", ".join(f"`{n}` double" for n in names))


def toxicity(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Probabilities of the categories of ``labels`` (poor quality, then toxic) and the verdict for every row of ``docs``."""
    own = labels.select(ident, (1 - F.col("quality")).alias("poor"), F.col("toxic"))
    chain = learn(docs, own, ["poor", "toxic"], ident, text)
    return score(docs, chain, ident, text).select(ident, "p_poor", "p_toxic", (F.col("p_toxic") >= chain.limits[1]).alias("toxic"))
