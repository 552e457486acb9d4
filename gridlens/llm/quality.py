"""Operator 4: a quality classifier on random Fourier features.

Statistics of a text (shares of kinds of characters, word lengths, repetition) are standardised and mapped to random
Fourier features, whose inner products approximate a Gaussian kernel. Every partition sums its part of the normal
equations, Spark adds the parts, and the driver solves one small ridge system. The ridge scores are calibrated by
isotonic regression on counts per score bin, so that also this step sees a bounded number of rows.

Every labelled row outside the held-out fold is used. Labels, language, source and ids are never inputs of a score.

Defined cases: null and empty texts have statistics of zero and get a score like any other; null ids are held out by
the checksum of the empty string and are never labelled; null labels are left out, several labels of one id are averaged;
without labels of both kinds every score is the average label (0.5 without labels); very long texts are measured whole, one at a
time; repeated rows are scored, and where they are labelled learnt from, one by one; extra columns are never inputs and are kept
by ``accepted``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from gridlens.llm.common import stored, whole

FEATURES = 256
RIDGE = 1e-3
SEED = 7
BINS = 1024
FOLDS = 5
THRESHOLD = 0.3
#: Standardised statistics beyond this many deviations count as this many.
CLIP = 5.0

_LOWER, _UPPER, _DIGIT, _SPACE, _HIGH = (np.array(list(x), np.int64) for x in (
    range(97, 123), range(65, 91), range(48, 58), (9, 10, 11, 12, 13, 32), range(128, 256)))
_SENTENCE = np.frombuffer(b".,;:?!'\"-()", np.uint8).astype(np.int64)
_BARS = np.frombuffer(b"|/\\_<>{}[]", np.uint8).astype(np.int64)
_MARKS = np.frombuffer(b"#$%&*@^~=+", np.uint8).astype(np.int64)
STATISTICS = 16


def statistics(text: str | None) -> np.ndarray:
    """Sixteen numbers of a whole text."""
    raw = (text or "").encode()
    out = np.zeros(STATISTICS)
    words = raw.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, n = len(raw), len(words)
    upper = counts[_UPPER].sum()
    letters = upper + counts[_LOWER].sum() + counts[_HIGH].sum()
    lines = [x for x in raw.split(b"\n") if x]
    different = len(set(words))
    out[:] = (
        np.log1p(n), (size - counts[_SPACE].sum()) / n / 10, letters / size, upper / max(letters, 1),
        counts[_DIGIT].sum() / size, counts[_SENTENCE].sum() / n, counts[_BARS].sum() / n, counts[_MARKS].sum() / n,
        counts[ord("!")] / n, counts[ord(".")] / n, counts[10] / n, np.log(different) / np.log(n) if n > 1 else 1.0,
        sum(map(eq, words, words[1:])) / n, len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        counts[_HIGH].sum() / size,
    )
    return out


def statistics_column(text: str | Column = "text") -> Column:
    @F.pandas_udf(ArrayType(DoubleType()))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return of(whole(text))


@dataclass(frozen=True)
class Model:
    """Everything a score needs: a few hundred kilobytes at most."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    solution: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def fourier(self, statistic: np.ndarray) -> np.ndarray:
        x = np.clip((statistic - self.mean) / self.deviation, -CLIP, CLIP)
        z = np.cos(x @ self.weights + self.phase) * np.sqrt(2 / self.weights.shape[1])
        return np.concatenate((z, np.ones((len(z), 1))), axis=1)

    def raw(self, statistic: np.ndarray) -> np.ndarray:
        return self.fourier(statistic) @ self.solution

    def score(self, statistic: np.ndarray) -> np.ndarray:
        """Calibrated, 0 to 1. A thousandth of the ridge score keeps the order within a level of the calibration."""
        ridge = self.raw(statistic)
        return 0.999 * np.interp(ridge, self.knots, self.levels) + 0.001 * np.clip((ridge + 1) / 3, 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: centres and levels of the pools. ``x`` rises, ``y`` are means of ``n`` rows."""
    pools: list[list[float]] = []
    for at, level, rows in zip(x, y, n):
        pools.append([at * rows, level * rows, rows])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    done = np.array(pools)
    return done[:, 0] / done[:, 2], done[:, 1] / done[:, 2]


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Fit on ``rows``: statistics (array), label (0 to 1)."""
    parts = [F.struct(F.avg(F.get("statistics", F.lit(i))).alias("m"), F.stddev_pop(F.get("statistics", F.lit(i))).alias("d"))
             for i in range(STATISTICS)]
    got = rows.agg(F.array(*parts).alias("s"), F.avg("label").alias("y"), F.count("*").alias("n"),
                   F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    prior = 0.5 if not got.n else got.y
    mean = np.array([s.m or 0.0 for s in got.s])
    deviation = np.array([s.d if s.d else 1.0 for s in got.s])
    random = np.random.default_rng(seed)
    weights = random.normal(size=(STATISTICS, features)) / np.sqrt(STATISTICS)
    model = Model(mean, deviation, weights, random.uniform(0, 2 * np.pi, features), np.zeros(features + 1),
                  np.array([0.0]), np.array([prior]))
    if not got.n or got.lo == got.hi:
        return model

    def normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            z = model.fourier(np.stack(batch["statistics"]))
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ batch["label"].to_numpy()
        yield pd.DataFrame({"line": range(features + 1), "sums": list(total)})

    def add(lines: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": lines["line"].iloc[:1], "sums": [np.sum(np.stack(lines["sums"]), axis=0)]})

    kind = "line int, sums array<double>"
    summed = rows.select("statistics", "label").mapInPandas(normal, kind).groupBy("line").applyInPandas(add, kind)
    matrix = np.stack([np.array(r.sums) for r in summed.orderBy("line").collect()])
    penalty = ridge * got.n / features * np.eye(features + 1)
    penalty[-1, -1] = 1e-9
    solved = Model(mean, deviation, weights, model.phase, np.linalg.solve(matrix[:, :-1] + penalty, matrix[:, -1]),
                   model.knots, model.levels)

    @F.pandas_udf("double")
    def raw(series: pd.Series) -> pd.Series:
        return pd.Series(solved.raw(np.stack(series)))

    scored = rows.select(F.least(F.greatest(raw("statistics"), F.lit(-1.0)), F.lit(2.0)).alias("s"), "label")
    bins = scored.groupBy(F.floor((F.col("s") + 1) * (BINS / 3)).alias("b")).agg(
        F.avg("s").alias("s"), F.avg("label").alias("y"), F.count("*").alias("n")).orderBy("b").collect()
    knots, levels = isotonic(*(np.array([r[c] for r in bins], float) for c in ("s", "y", "n")))
    return Model(mean, deviation, weights, model.phase, solved.solution, knots, levels)


def score_statistics(model: Model, column: str | Column = "statistics") -> Column:
    @F.pandas_udf("double")
    def of(series: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(series)) if len(series) else [], dtype="float64")

    return of(column)


def score_text(model: Model, text: str | Column = "text") -> Column:
    """Score of a text column in one pass."""
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([statistics(t) for t in texts])) if len(texts) else [], dtype="float64")

    return of(whole(text))


def held_out(id_column: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds == 0


def measured(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, statistics of every document, stored."""
    return stored(docs.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"),
                              statistics_column(text).alias("statistics")), "statistics")


def fit_labels(statistics_of: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality") -> Model:
    """The model of all labelled rows that are not held out."""
    known = labels.filter(F.col(label).isNotNull() & F.col(id_column).isNotNull()).groupBy(
        F.col(id_column).alias("id")).agg(F.avg(F.col(label).cast("double")).alias("label"))
    rows = statistics_of.filter(~F.col("held_out")).join(known, "id").select("statistics", "label")
    return fit(stored(rows, "training"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The contract's rows."""
    rows = measured(docs)
    score = score_statistics(fit_labels(rows, labels))
    return rows.withColumn("score", score).select(
        F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, unchanged."""
    model = fit_labels(measured(docs, id_column, text), labels, id_column)
    return docs.filter(score_text(model, text) >= threshold)
