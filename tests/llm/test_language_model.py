"""Base scores against plain counts; the model's probabilities and its seating."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from stocklens.llm import language_model
from stocklens.llm import pitman_yor as py
from stocklens.llm.queries import queries
from tests.llm.conftest import PATH


def plain(rows: list) -> list:
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    counts: Counter = Counter()
    for (i, _), t in zip(rows, tokens, strict=True):
        if fold(i) != 1:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, fold(i) == 1, len(t), sum(1 for x in t if counts[x]), n, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t))
        for (i, _), t in zip(rows, tokens, strict=True)
    ]


def _check(df, rows: list) -> list:
    found = df.collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    got = sorted((tuple(r[:6]) for r in found), key=key)
    for a, b in zip(got, sorted(plain(rows), key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
    return found


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{PATH}/documents.parquet").collect()]
    found = _check(queries()["op10_lm_scoring"](spark, PATH), rows)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 and r.perplexity > 1 for r in found)


def test_edges(docs, prose):
    rows = [(1, None), (2, ""), (3, "ONE two"), (3, "ONE two"), (None, "one"), (4, prose(1, 20_000)), (5, "é É \x0b x")]
    found = _check(language_model.scores(docs(*rows)), rows)
    assert len({r.score for r in found if r.doc_id == 3}) == 1
    assert language_model.scores(docs(*rows).limit(0)).count() == 0
    only_held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    _check(language_model.scores(docs((only_held, "some words"))), [(only_held, "some words")])


def test_hot_words_and_pairs_give_the_same_scores(docs, prose, monkeypatch):
    """Many small buckets, hot words and pairs, against one bucket with neither."""
    rows = [(i, ("again " * (i % 40)) + prose(i, 60) + " the end" * (i % 5)) for i in range(300)]
    one = _check(language_model.scores(docs(*rows), burn_in=0, samples=1), rows)
    monkeypatch.setattr(language_model, "FLUSH", 700)
    monkeypatch.setattr(language_model, "BUCKET", 900)
    monkeypatch.setattr(language_model, "HOT", 40)
    many = _check(language_model.scores(docs(*rows).repartition(3), burn_in=0, samples=1), rows)
    assert sum(r.score for r in many) == pytest.approx(sum(r.score for r in one), rel=0.01)


def _model(contexts: int, rows: list[tuple[int, int, int]]) -> tuple[py.Model, py.Bucket]:
    """A model of (word, context, customers) in one bucket, before any sweep."""
    rows = sorted(rows)
    words = np.array(sorted({w for w, _, _ in rows}), np.uint64)
    multi = [r for r in rows if r[2] >= 2]
    bucket = py.Bucket(
        0, words, np.array([sum(c for w, _, c in rows if w == x) for x in words]),
        np.array([sum(1 for w, _, c in rows if w == x and c == 1) for x in words]),
        np.array([list(words).index(w) for w, _, _ in multi], np.int64),
        np.array([c for _, c, _ in multi], np.int64), np.array([n for _, _, n in multi], np.int64),
    )
    customers = np.zeros(contexts)
    single = np.zeros(contexts)
    for _, c, n in rows:
        customers[c] += n
        single[c] += n == 1
    model = py.Model(contexts, customers, len(words), int(customers.sum()), np.zeros(0, np.uint64), np.zeros(0), 0.6, 1.5, 0.4, 2.0, single)
    return model, bucket


def _totals(model: py.Model, bucket: py.Bucket, s: py.Seating) -> py.Totals:
    tables = np.bincount(bucket.context, s.tables, minlength=model.contexts) + model.single_tables
    return py.Totals(tables, np.zeros(0), np.zeros(0), float(s.root_customers.sum()), float(s.root_tables.sum()))


def test_probabilities_of_a_context_add_up_to_one():
    rng = np.random.default_rng(3)
    rows = [(w, c, int(rng.integers(1, 9))) for w in range(10, 40) for c in range(5) if rng.random() < 0.4]
    model, bucket = _model(5, rows)
    for _ in range(4):
        model.history.append(_totals(model, bucket, py.sweeps(model, bucket, len(model.history))[-1]))
    counts = {(w, c): n for w, c, n in rows}
    unknown = np.uint64(999)
    words = np.append(bucket.words, unknown)
    for context in range(5):
        n = np.array([counts.get((int(w), context), 0) for w in words])
        p = py.predictive(model, bucket, 3, np.arange(len(words)), np.full(len(words), context), n, words)
        assert p.sum() == pytest.approx(1.0, abs=1e-9)
        assert (p > 0).all()


def test_tables_follow_the_exact_conditional():
    """Draws of t for one dish against probabilities computed by listing all seatings."""
    c, others, root, strength, discount = 5, 3.0, 0.2, 1.2, 0.5
    weights = np.zeros(c + 1)

    def sit(sizes: list[int], n: int, weight: float) -> None:
        if n == c:
            weights[len(sizes)] += weight
            return
        sit([*sizes, 1], n + 1, weight * (strength + discount * (others + len(sizes))) * root)
        for k, size in enumerate(sizes):
            sit([*sizes[:k], size + 1, *sizes[k + 1 :]], n + 1, weight * (size - discount))

    sit([], 0, 1.0)
    rng = np.random.default_rng(1)
    n = 40_000
    drawn = py.seat(rng, np.full(n, c), np.full(n, others), np.full(n, root), strength, discount, py.stirling(discount))
    share = np.bincount(drawn, minlength=c + 1) / n
    assert share == pytest.approx(weights / weights.sum(), abs=0.01)


def test_large_dishes_are_seated():
    rng = np.random.default_rng(1)
    n = np.array([65, 1000, 10**6])
    t = py.seat(rng, n, np.zeros(3), np.full(3, 0.01), 1.0, 0.5, py.stirling(0.5))
    assert (t >= 1).all() and (t <= n).all() and (np.diff(t) >= 0).all()


@pytest.mark.parametrize(("burn_in", "samples"), [(0, 1), (1, 2)])
def test_scores_equal_those_of_a_model_held_in_one_place(docs, prose, burn_in, samples):
    """Counts in dictionaries and every sweep drawn again, against kept seatings and packed buckets."""
    rows = [(i, prose(i, 40, words=60)) for i in range(60)] + [(70, ""), (None, "w1 w2"), (71, "w1 never seen")]
    hashed = lambda t: language_model.tokens_of((t or "").encode(), language_model._Hashes()).tolist()
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5
    texts = [(i, [(w, u >> 48) for w, u in zip(t, [language_model.START, *t[:-1]], strict=True)]) for i, x in rows for t in [hashed(x)]]
    pairs: Counter = Counter()
    for i, t in texts:
        if fold(i) != 1:
            pairs.update(t)
    model, bucket = _model(language_model.CONTEXTS, [(w, u, n) for (w, u), n in pairs.items()])
    share = lambda a, b: float(np.clip(a / (a + 2 * b), 0.1, 0.95)) if a else 0.5
    model.strength = model.root_strength = 1.0
    model.discount = share(sum(n == 1 for n in pairs.values()), sum(n == 2 for n in pairs.values()))
    spread = Counter(w for w, _ in pairs)
    model.root_discount = share(sum(n == 1 for n in spread.values()), sum(n == 2 for n in spread.values()))
    for _ in range(burn_in + samples + 1):
        model.history.append(_totals(model, bucket, py.sweeps(model, bucket, len(model.history))[-1]))
    found = {r.doc_id: r.score for r in language_model.scores(docs(*rows), burn_in, samples).collect()}
    for i, t in texts:
        words = np.unique(np.array([w for w, _ in t], np.uint64))
        place = np.searchsorted(words, np.array([w for w, _ in t], np.uint64))
        counts = np.array([pairs[x] for x in t])
        p = py.predictive(model, bucket, samples, place, np.array([u for _, u in t], np.int64), counts, words)
        assert found[i] == pytest.approx(float(np.log10(p).sum()), rel=1e-9)
