"""Quality score of a text from a regularised quadratic discriminant over document statistics.

Each class is a normal density over the transformed statistics. Its covariance is
shrunk towards the variances of all rows, so that it stays invertible however few
rows or however constant a statistic. The Cholesky factors are taken once, when
the model is fitted; a score is the logistic of the difference of the classes'
log densities, each from a Mahalanobis distance through its factor.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weight of the diagonal towards which a class's covariance is shrunk.
SHRINKAGE = 0.05
#: Added to every variance, so that a constant statistic has one.
RIDGE = 1e-3

_UPPER, _LOWER, _WIDE, _DIGIT, _SPACE = 1, 2, 3, 4, 5
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[0xC2:], _CLASS[48:58], _CLASS[[9, 10, 11, 12, 13, 32]] = _UPPER, _LOWER, _WIDE, _DIGIT, _SPACE

STATISTICS = (
    "words",
    "upper_case",
    "exclamation",
    "symbols",
    "bars",
    "digits",
    "punctuation",
    "distinct_words",
    "doubled_words",
    "repeated_lines",
    "word_length",
    "repeated_triples",
    "lines",
)


def statistics_of(text: str) -> list[float]:
    """Logarithms of counts and of smoothed shares.

    Shares are smoothed with as many characters or words as it takes for a very
    short text to say little; an empty text has the smoothing constants alone.
    """
    words = text.split()
    n, chars = len(words), len(text)
    kinds = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=6)
    letters = int(kinds[_UPPER] + kinds[_LOWER] + kinds[_WIDE])
    lines = [line for line in text.split("\n") if line.strip()]
    doubled = sum(map(operator.eq, words, words[1:]))
    triples = max(0, n - 2)
    repeated = triples - len(set(zip(words, words[1:], words[2:])))
    marks = lambda some: sum(map(text.count, some))
    share = lambda count, of, more: (count + 0.5) / (of + more)
    return np.log(
        [
            n + 1,
            share(kinds[_UPPER], letters, 20),
            share(text.count("!"), chars, 50),
            share(marks("#*$%&<>"), chars, 50),
            share(text.count("|"), chars, 50),
            share(kinds[_DIGIT], chars, 50),
            share(marks(".,;:?"), chars, 50),
            (len(set(words)) + 5) / (n + 5),
            share(doubled, n, 10),
            share(len(lines) - len(set(lines)), len(lines), 5),
            (letters + 30) / (n + 6),
            share(repeated, n, 10),
            (len(lines) + 2) / (n + 20),
        ]
    ).tolist()


@dataclass(frozen=True)
class Model:
    """Means, inverse Cholesky factors and log constants of class 0 and 1; without them, the prior alone."""

    prior: float
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    constants: tuple[float, ...] = ()

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        if not self.means:
            return np.full(len(rows), self.prior)
        density = [c - 0.5 * (((rows - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -700, 700)))


def measure(text: Column) -> Column:
    """Statistics of a column of whole texts, an array of doubles; a null text counts as empty."""

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([statistics_of(t or "") for t in batch])

    return measured(text)


def statistics(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``statistics`` of each row."""
    return docs.select(F.col(doc_id).alias("doc_id"), measure(F.col(text)).alias("statistics"))


def fit(measured: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", label: str = "quality") -> Model:
    """Fit to the statistics of the rows that have a label of 0 or 1.

    Counts, sums and sums of products are added up by class where the rows are;
    a few hundred numbers come to the driver. Rows without a label, or with another one, and
    null ids take no part; a repeated row counts as often as it stands there. A
    class with fewer than two rows leaves the prior alone, (n1 + 1) / (n + 2), as score.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("_class")).filter("_class IN (0, 1)")
    d = len(STATISTICS)
    x = [F.col("statistics")[i] for i in range(d)]
    sums = [F.sum(v) for v in x] + [F.sum(x[i] * x[j]) for i in range(d) for j in range(i, d)]
    rows = measured.join(known, "doc_id").groupBy("_class").agg(F.count(F.lit(1)).alias("_n"), F.array(*sums).alias("_sums")).collect()
    total = {r["_class"]: (r["_n"], np.array(r["_sums"], float)) for r in rows}
    counts = [total[c][0] if c in total else 0 for c in (0, 1)]
    prior = (counts[1] + 1) / (sum(counts) + 2)
    if min(counts) < 2:
        return Model(prior)

    def moments(n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean = sums[:d] / n
        products = np.zeros((d, d))
        products[np.triu_indices(d)] = sums[d:]
        products += np.triu(products, 1).T
        return mean, (products - n * np.outer(mean, mean)) / (n - 1)

    overall = np.diag(np.diag(moments(sum(counts), total[0][1] + total[1][1])[1]))
    means, factors, constants = [], [], []
    for c in (0, 1):
        mean, spread = moments(*total[c])
        factor = np.linalg.cholesky((1 - SHRINKAGE) * spread + SHRINKAGE * overall + RIDGE * np.eye(d))
        means.append(mean)
        factors.append(np.linalg.inv(factor))
        constants.append(float(np.log(counts[c] / sum(counts)) - np.log(np.diag(factor)).sum()))
    return Model(prior, tuple(means), tuple(factors), tuple(constants))


def score(model: Model, measured: Column) -> Column:
    """Score of a column of statistics."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(np.array([*batch], float).reshape(len(batch), len(STATISTICS))))

    return scored(measured)


def score_text(model: Model, text: Column) -> Column:
    """Score of a column of whole texts, measured and scored by one worker; a null text counts as empty."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = [statistics_of(t or "") for t in batch]
            yield pd.Series(model.score(np.array(rows, float).reshape(len(batch), len(STATISTICS))))

    return scored(text)


def held_out(doc_id: str, folds: int = 5) -> Column:
    """Whether a row is kept from learning: its id's checksum is divisible by ``folds``. A null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))
