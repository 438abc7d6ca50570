"""Quality of texts by ordinal regression on graded ratings.

A cumulative-link model: P(grade > k) = sigmoid(w.x - t_k), with one vector of
hashed-text weights shared by all grades and thresholds t_0 < t_1 < ... The
expected grade and the probability of the upper grades follow from it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import rows_of, set_apart, stored, texts_of

BUCKETS = 1 << 14
STEPS = 1 << 16
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


@dataclass
class OrdinalModel:
    """Weights by bucket, increasing thresholds, and the limit of acceptance."""

    weights: np.ndarray
    thresholds: np.ndarray
    limit: float = 0.5


class _Buckets(dict):
    """The buckets of a word: of the word itself, and of its shape."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) > 300_000:
            self.clear()
        shape = _LETTERS.sub(
            lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word
        )
        shape = "\0" + _DIGITS.sub("9", shape)[:12]
        hashed = (xxhash.xxh32_intdigest(x) % (BUCKETS - 1) + 1 for x in (word.lower(), shape))
        value = self[word] = tuple(hashed)
        return value


def features(text: str, seen: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: the root of each bucket's share in the words.

    Bucket 0 has the share of words equal to the word before them.
    """
    words = text.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    pairs = np.array([seen[w] for w in words], np.int32)
    buckets, counts = np.unique(pairs, return_counts=True)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    buckets = np.concatenate([[0], buckets]).astype(np.int32)
    values = np.sqrt(np.concatenate([[same], counts]) / len(words)).astype(np.float32)
    return buckets, values


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_ordinal(
    index: np.ndarray, values: np.ndarray, ends: np.ndarray, grades: np.ndarray, top: int,
    rounds: int = 200, rate: float = 0.3, ridge: float = 1e-5,
) -> OrdinalModel:
    """Adam on the likelihood of grades 0..top; row i has the buckets up to ``ends[i]``.

    Thresholds are the first one and positive steps, so they stay in order.
    """
    starts = np.concatenate([[0], ends[:-1]])
    rows = np.repeat(np.arange(len(ends)), ends - starts)
    share = [np.clip((grades > k).mean(), 1e-3, 1 - 1e-3) for k in range(top)]
    cuts = -np.log(np.array(share) / (1 - np.array(share)))
    steps = np.log(np.maximum(np.diff(cuts), 1e-2))
    theta = np.concatenate([np.zeros(BUCKETS), cuts[:1], steps])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n = len(grades)

    def thresholds() -> np.ndarray:
        return np.cumsum(np.concatenate([theta[BUCKETS : BUCKETS + 1], np.exp(theta[BUCKETS + 1 :])]))

    for step in range(1, rounds + 1):
        t = np.concatenate([[-np.inf], thresholds(), [np.inf]])
        score = np.bincount(rows, values * theta[index], minlength=n)
        # P(grade) = above(grade) - above(grade + 1), above(k) = sigmoid(score - t_k)
        with np.errstate(invalid="ignore"):
            above, below = _sigmoid(score - t[grades]), _sigmoid(score - t[grades + 1])
        p = np.maximum(above - below, 1e-9)
        da, db = above * (1 - above) / p, below * (1 - below) / p
        slope = da - db
        gradient = np.zeros_like(theta)
        gradient[:BUCKETS] = np.bincount(index, values * slope[rows], minlength=BUCKETS) / n
        gradient[:BUCKETS] -= ridge * theta[:BUCKETS]
        by_cut = np.zeros(top + 2)
        np.add.at(by_cut, grades, -da)
        np.add.at(by_cut, grades + 1, db)
        by_cut = by_cut[1:-1] / n
        tail = np.cumsum(by_cut[::-1])[::-1]
        gradient[BUCKETS] = tail[0]
        gradient[BUCKETS + 1 :] = tail[1:] * np.exp(theta[BUCKETS + 1 :])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return OrdinalModel(theta[:BUCKETS].astype(np.float32), thresholds())


def _held_out() -> Column:
    """Whether a document is in the fourth that is kept out of the fit."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 3


def _graded(ratings: DataFrame, grade: str) -> DataFrame:
    """doc_id and its least grade."""
    rated = ratings.where(F.col("doc_id").isNotNull() & F.col(grade).isNotNull())
    return rated.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(grade).cast("int").alias("grade"))


def rated_rows(docs: DataFrame, ratings: DataFrame, grade: str, bound: int) -> DataFrame:
    """doc_id, data and ``grade`` of at most ``bound`` rated texts of the fit, picked by the hash of their id."""
    picked = (
        _graded(ratings, grade)
        .where(~_held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
        .select(F.col("doc_id").alias("picked_"), "grade")
    )
    return texts_of(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("picked_")).drop("picked_")


def fit(
    docs: DataFrame, ratings: DataFrame, grade: str = "quality", bound: int = 6000,
    lost_good: float = 0.005,
) -> OrdinalModel:
    """The model of a bounded sample of rated texts, fitted in one task.

    Grades are whole numbers from 0. A quarter of the rated texts is kept out of
    the fit; the limit is set on all of them, so that at most ``lost_good`` of the
    texts with a grade in the upper half would be rejected, and is 0.5 at most.
    Without ratings, or with one grade alone, the model accepts every text.
    """
    rows = stored(rated_rows(docs, ratings, grade, bound), "rated")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Buckets()
        for batch in rows_of(batches):
            found = [features(t.as_py().decode(errors="replace"), seen) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i.tobytes() for i, _ in found], pa.binary()),
                    pa.array([v.tobytes() for _, v in found], pa.binary()),
                    batch.column(1).cast(pa.int32()),
                    batch.column(2).cast(pa.int64()),
                ],
                names=["index", "values", "grade", "pick"],
            )

    def fitted(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["pick", "index", "values"], kind="stable")
        grades = np.maximum(sample["grade"].to_numpy(), 0)
        top = int(grades.max())
        if len(set(grades)) < 2:
            return pd.DataFrame({"weights": [b""], "thresholds": [b""]})
        index = [np.frombuffer(x, np.int32) for x in sample["index"]]
        values = [np.frombuffer(x, np.float32) for x in sample["values"]]
        model = fit_ordinal(
            np.concatenate(index), np.concatenate(values).astype(float), np.cumsum([len(i) for i in index]), grades, top
        )
        return pd.DataFrame({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tobytes()]})

    pick = F.xxhash64("doc_id").alias("pick")
    found = (
        rows.select("data", "grade", pick)
        .mapInArrow(featured, "index binary, values binary, grade int, pick long")
        .groupBy(F.lit("all").alias("all"))
        .applyInPandas(fitted, "weights binary, thresholds binary")
        .first()
    )
    if found is None or not found.weights:
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.zeros(1), 0.0)
    model = OrdinalModel(np.frombuffer(found.weights, np.float32), np.frombuffer(found.thresholds))
    model.limit = min(0.5, _lowest(docs, _graded(ratings, grade), model, lost_good))
    return model


def _lowest(docs: DataFrame, graded: DataFrame, model: OrdinalModel, lost: float) -> float:
    """The limit that at most ``lost`` of all good texts kept out of the fit lie below; 0 without such texts.

    Texts are scored where they lie and only ids and scores meet the ratings.
    Scores are counted in steps of 1 / STEPS, and the limit is one of these.
    """
    judged = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(_held_out()), model)
    good = graded.where(_held_out() & (F.col("grade") >= upper_grade(len(model.thresholds)))).select("doc_id")
    counts = (
        judged.select("doc_id", F.floor(F.col("tail_") * STEPS).alias("step"))
        .join(good, "doc_id")
        .groupBy("step")
        .agg(F.count("*").alias("n"))
        .collect()  # at most STEPS + 1 rows
    )
    left = lost * sum(r.n for r in counts)
    for step, n in sorted((r.step, r.n) for r in counts):
        left -= n
        if left < 0:
            return step / STEPS
    return 0.0


def upper_grade(top: int) -> int:
    """The least grade of the upper half of 0..top."""
    return top // 2 + 1 if top > 1 else 1


def scored(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``docs`` with expected_ (grade), tail_ (probability of the upper grades) and accepted_.

    Null text counts as empty, which has no features and is judged by the
    thresholds alone. Rows and their columns stay as they are.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    upper = upper_grade(len(model.thresholds))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = [*docs.columns, "expected_", "tail_", "accepted_"]
    at = docs.columns.index("text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, m = _Buckets(), known.value
        for batch in rows_of(batches):
            expected, tails = [], []
            for text in batch.column(at):
                index, values = features(text.as_py() or "", seen)
                above = _sigmoid(float(m.weights[index] @ values) - m.thresholds)
                expected.append(float(above.sum()))
                tails.append(float(above[upper - 1]))
            added = [
                pa.array(expected, pa.float64()),
                pa.array(tails, pa.float64()),
                pa.array([p >= m.limit for p in tails], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return docs.mapInArrow(compute, schema + ", expected_ double, tail_ double, accepted_ boolean")


def classified(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    """doc_id, expected_grade, tail_probability and accepted of every whole text."""
    model = fit(docs, ratings)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", F.col("expected_").alias("expected_grade"),
        F.col("tail_").alias("tail_probability"), F.col("accepted_").alias("accepted"),
    )


def accepted(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is accepted; columns stay."""
    docs, named = set_apart(docs)
    judged = scored(docs, fit(docs, ratings))
    accept: Column = F.col("accepted_")
    return named(judged.where(accept))
