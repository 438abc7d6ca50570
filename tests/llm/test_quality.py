"""The quality classifier and the ledger of quality rules."""

from __future__ import annotations

import collections
import math
import re

import duckdb
import numpy as np
import pytest
import xxhash

from stocklens.llm import quality_classifier, quality_rules
from stocklens.llm.queries import oracle_sql, queries
from tests.llm.conftest import PATH

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_thresholds_stay_ordered_and_grades_are_learned():
    rng = np.random.default_rng(0)
    n, top = 1500, 3
    latent = rng.normal(size=n)
    grades = np.digitize(latent + 0.3 * rng.logistic(size=n), [-1, 0, 1])
    index = np.tile([5, 9], n).astype(np.int32)
    values = np.column_stack([np.maximum(latent, 0), np.maximum(-latent, 0)]).ravel()
    model = quality_classifier.fit_ordinal(index, values, np.arange(2, 2 * n + 1, 2), grades, top)
    assert (np.diff(model.thresholds) > 0).all()
    score = model.weights[5] * np.maximum(latent, 0) + model.weights[9] * np.maximum(-latent, 0)
    expected = (1 / (1 + np.exp(-(score[:, None] - model.thresholds)))).sum(axis=1)
    truth = (1 / (1 + np.exp(-(latent[:, None] - [-1, 0, 1]) / 0.3))).sum(axis=1)
    assert np.abs(expected - truth).mean() < 0.1
    assert np.abs(expected - grades).mean() < np.abs(truth - grades).mean() + 0.02


def _rated(prose):
    good = [(i, prose(i, 80)) for i in range(60)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in prose(i, 80).split())) for i in range(30)]
    return good, bad


def test_classifier_rejects_what_is_rated_low(spark, docs, prose):
    good, bad = _rated(prose)
    fresh = [(500, prose(900, 70)), (501, " ".join(w.upper() + "!!" for w in prose(901, 70).split())), (502, None), (503, ""), (None, prose(902)), (500, prose(900, 70))]
    df = docs(*good, *bad, *fresh)
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (7, None), (9999, 0)], "doc_id long, quality int"
    )
    kept = quality_classifier.accepted(df, labels)
    assert kept.columns == df.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert set(ids) >= {i for i, _ in good} | {500, 502, 503, None}
    assert not set(ids) & ({i for i, _ in bad} | {501})
    assert ids[500] == 2
    assert quality_classifier.accepted(df, labels.limit(0)).count() == df.count()
    assert quality_classifier.accepted(df.limit(0), labels).count() == 0


def test_graded_ratings_order_texts(spark, docs, prose):
    """Four grades: a text's grade follows the share of words in capitals."""
    rows, ratings = [], []
    for i in range(160):
        grade = i % 4
        words = prose(i, 40).split()
        rows.append((i, " ".join(w.upper() if k % 4 < 3 - grade else w for k, w in enumerate(words))))
        ratings.append((i, grade))
    model = quality_classifier.fit(docs(*rows), spark.createDataFrame(ratings, "doc_id long, quality int"))
    assert len(model.thresholds) == 3
    found = quality_classifier.scored(docs(*rows), model).select("doc_id", "expected_").collect()
    means = [np.mean([r.expected_ for r in found if r.doc_id % 4 == g]) for g in range(4)]
    assert means == sorted(means)


def test_query_separates_the_labels(spark):
    rows = queries()["op1_quality_classifier"](spark, PATH).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{PATH}/documents.parquet").count()
    right = [r.accepted == bool(labels[r.doc_id]) for r in rows if r.doc_id in labels]
    assert np.mean(right) > 0.95


def plain_measures(text: str | None) -> tuple:
    text = text or ""
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    )


def test_ledger_edges(spark, docs, prose):
    rows = [
        (1, None), (2, ""), (3, " \t\x0b\n"), (4, "a b c d e f g h a b c d e f g h"), (5, "x " * 40),
        (6, prose(1, 30_000)), (7, "línea\nlínea\n\n \nz"), (None, "# * $"), (8, prose(1, 30)), (8, prose(1, 30)),
        (9, "a b   c"),
    ]
    entries = quality_rules.ledger(docs(*rows))
    found = {
        (r.doc_id, i): tuple(r)[1:7] for i, r in enumerate(entries.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures").collect())
    }
    assert sorted(str((k[0], *v[:5])) for k, v in found.items()) == sorted(str((i, *plain_measures(t))) for i, t in rows)
    assert entries.limit(0).count() == 0


def test_policies_and_ablations(spark):
    sets = [0, 0, 1, 4, 5, 4, 12]
    entries = spark.createDataFrame([(i, f) for i, f in enumerate(sets)], "doc_id long, failures int")
    policy = quality_rules.Policy("t", ("few_words", "symbols", "repeated_lines"))
    judged = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.judged(entries, policy).collect()}
    assert judged == {0: (False, True), 1: (False, True), 2: (True, False), 3: (False, False), 4: (True, False), 5: (False, False), 6: (False, False)}
    rows = {r.rule: (r.n_failed, r.n_decided) for r in quality_rules.ablations(entries, policy).collect()}
    assert rows == {"few_words": (2, 1), "symbols": (4, 2), "repeated_lines": (1, 0)}
    lenient = quality_rules.Policy("l", ("symbols", "repeated_lines"), tolerated=1)
    assert {r.doc_id for r in quality_rules.judged(entries, lenient).where("kept").collect()} == {0, 1, 3, 5}


def test_rules_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{PATH}/documents.parquet'")
    df = queries()["op9_quality_rules"](spark, PATH)
    result = con.execute(oracle_sql()["op9_quality_rules"])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, result.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("text", ["", "one", "x " * 500])
def test_features_of_any_text(text):
    index, values = quality_classifier.features(text, quality_classifier._Buckets())
    assert len(index) == len(values)
    assert np.isfinite(values).all()


def test_limit_comes_from_all_held_out_texts(spark, docs, prose):
    def text(i: int) -> str:
        return " ".join(w.upper() + "!!" if k % 40 < i % 40 else w for k, w in enumerate(prose(i, 40).split()))

    df = docs(*((i, text(i)) for i in range(1200)))
    labels = spark.createDataFrame([(i, int(i % 40 < 20 or i % 7 == 0)) for i in range(1200)], "doc_id long, quality int")
    model = quality_classifier.fit(df, labels, bound=100, lost_good=0.05)
    rated = quality_classifier.scored(df, model).join(labels, "doc_id").where("pmod(xxhash64(doc_id), 4) = 3 AND quality = 1")
    good = sorted(r.tail_ for r in rated.collect())
    assert len(good) > 100
    steps = quality_classifier.STEPS
    assert model.limit == min(0.5, np.floor(good[int(0.05 * len(good))] * steps) / steps)
    assert 0 < model.limit < 0.5


def test_few_distinct_words_fail_at_any_length(docs, prose):
    rng = np.random.default_rng(5)
    few = {n: " ".join(f"w{k}" for k in rng.integers(0, 20, n)) for n in (49, 50, 499, 500, 501, 2000, 2001, 30_000)}
    rows = list(few.items()) + [(100_000 + n, prose(n, n, words=4000)) for n in (60, 500, 501, 2000, 2001, 30_000)]
    bit = quality_rules.mask("few_distinct_words")
    found = {r.doc_id: r for r in quality_rules.ledger(docs(*rows)).collect()}
    assert {i for i, r in found.items() if r.failures & bit} == {50, 499, 500, 501, 2000, 2001, 30_000}
    for i, text in rows:
        words = text.split()
        assert found[i].n_distinct_words == sum(len(set(words[k : k + 500])) for k in range(0, len(words), 500))


def plain_probabilities(text: str | None, model: quality_classifier.OrdinalModel) -> list[float]:
    """P(grade > k) for every threshold, from dictionaries and a sum over words."""
    words = (text or "").split()
    shares: dict[int, float] = collections.Counter()
    for word in words:
        shape = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word)
        for key in (word.lower(), "\0" + re.sub(r"\d+", "9", shape)[:12]):
            shares[xxhash.xxh32_intdigest(key) % (quality_classifier.BUCKETS - 1) + 1] += 1 / len(words)
    if words:
        shares[0] += sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words)
    score = sum(float(model.weights[b]) * math.sqrt(v) for b, v in shares.items())
    return [1 / (1 + math.exp(-max(-30.0, min(30.0, score - t)))) for t in model.thresholds]


def test_scores_match_plain_ones(spark, docs, prose):
    """Four grades on odd texts, and the query on its whole table."""
    rows = [(i, " ".join(w.upper() if k % 4 < 3 - i % 4 else w for k, w in enumerate(prose(i, 40).split()))) for i in range(160)]
    ratings = spark.createDataFrame([(i, i % 4) for i, _ in rows], "doc_id long, quality int")
    model = quality_classifier.fit(docs(*rows), ratings)
    tried = rows[:40] + [(900, None), (901, ""), (902, "same same same Same 12 12,5 É1é _"), (None, "x"), (903, prose(5, 20_000))]
    found = {r.doc_id: r for r in quality_classifier.scored(docs(*tried), model).collect()}
    for i, text in tried:
        above = plain_probabilities(text, model)
        assert found[i].expected_ == pytest.approx(sum(above), rel=1e-4, abs=1e-6)
        assert found[i].tail_ == pytest.approx(above[quality_classifier.upper_grade(3) - 1], rel=1e-4, abs=1e-6)
    table, labels = (spark.read.parquet(f"{PATH}/{n}.parquet") for n in ("documents", "labels"))
    model = quality_classifier.fit(table, labels)
    found = {r.doc_id: r for r in queries()["op1_quality_classifier"](spark, PATH).collect()}
    for r in table.collect():
        [p] = plain_probabilities(r.text, model)
        assert found[r.doc_id].tail_probability == pytest.approx(p, rel=1e-3, abs=1e-5)
        assert found[r.doc_id].accepted == (found[r.doc_id].tail_probability >= model.limit)


def test_fitted_weights_are_near_the_best(spark):
    """No small step along the gradient of a plainly written likelihood gains much."""
    rng = np.random.default_rng(2)
    rows = [(np.array([0, 1 + int(x > 0), 3]), np.array([0.2, abs(x), 0.5])) for x in rng.normal(size=400)]
    score = np.array([v[1] * (2.0 if i[1] == 2 else -2.0) for i, v in rows])
    grades = np.digitize(score + rng.logistic(size=400), [-1.0, 1.0])
    index, values = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    model = quality_classifier.fit_ordinal(index, values, 3 * np.arange(1, 401), grades, 2)

    def loss(weights, cuts) -> float:
        total = 0.0
        for (i, v), g in zip(rows, grades, strict=True):
            s = float(weights[i] @ v)
            above = [1.0, *(1 / (1 + math.exp(c - s)) for c in cuts), 0.0]
            total -= math.log(above[g] - above[g + 1])
        return total / len(rows)

    best = loss(model.weights, model.thresholds)
    assert model.weights[2] > 1 > -1 > model.weights[1]
    for step in (-0.2, 0.2):
        for b in range(4):
            moved = model.weights.copy()
            moved[b] += step
            assert loss(moved, model.thresholds) > best - 2e-3
        for k in range(2):
            cuts = model.thresholds.copy()
            cuts[k] += step
            assert loss(model.weights, cuts) > best - 2e-3
