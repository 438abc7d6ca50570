"""Benchmark passages: exact, with words replaced, and clean texts."""

from __future__ import annotations

import itertools
import random

import numpy as np

from stocklens.llm import decontamination
from stocklens.llm.queries import queries
from tests.llm.conftest import PATH


def plain_hits(text: str, item: str) -> tuple[int, int] | None:
    """The longest stretch on any diagonal, by trying all."""
    a, b = decontamination.WORDS.findall(text.lower()), decontamination.WORDS.findall(item.lower())
    best = (0, 0)
    for shift in range(-len(b) + 1, len(a)):
        same = [0 <= i + shift < len(a) and a[i + shift] == b[i] for i in range(len(b))]
        inside = [i for i in range(len(b)) if 0 <= i + shift < len(a)]
        if not inside or not any(same):
            continue
        for s in range(inside[0], inside[-1] + 1):
            for e in range(s + 1, inside[-1] + 2):
                if sum(same[s:e]) >= 0.8 * (e - s) - 1e-9:
                    best = max(best, (e - s, sum(same[s:e])))
    return best if best[0] >= min(13, len(b)) and len(b) >= 5 else None


def _found(df) -> dict:
    return {(r.doc_id, r.item_id): (r.n_overlap, r.n_equal) for r in df.collect()}


def test_passages_are_found_and_clean_texts_left(spark, docs, prose):
    rng = random.Random(2)
    items = spark.createDataFrame(
        [(1, prose(11, 40, 5000)), (2, prose(12, 25, 5000)), (3, "a short item of eight plain words here"), (4, None), (5, ""), (1, prose(11, 40, 5000))],
        "item_id long, text string",
    )
    passage = prose(11, 40, 5000).split()
    replaced = [w if k % 7 else "other" for k, w in enumerate(passage)]
    texts = [
        (10, prose(1) + " " + " ".join(passage).upper() + ", " + prose(2)),
        (11, prose(3) + " " + " ".join(replaced)),
        (12, prose(4) + " " + " ".join(passage[5:25]) + " " + prose(5)),
        (13, prose(6, 3000, 5000)),
        (14, "Well: a short, item of eight plain words here."),
        (15, None), (16, ""), (None, " ".join(passage)), (17, " ".join(rng.sample(passage, len(passage)))),
    ]
    found = _found(decontamination.contaminated(docs(*texts), items))
    assert found == {
        (d, i): hit
        for d, t in texts
        for i, item in ((1, prose(11, 40, 5000)), (2, prose(12, 25, 5000)), (3, "a short item of eight plain words here"))
        if (hit := plain_hits(t or "", item))
    }
    assert {d for d, _ in found} == {10, 11, 12, 14, None}
    df = docs(*texts)
    left = decontamination.without_passages(df, items)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [13, 15, 16, 17]
    assert decontamination.contaminated(df.limit(0), items).count() == 0
    assert decontamination.without_passages(df, items.limit(0)).count() == len(texts)


def test_longest_stretch_against_all_stretches():
    rng = np.random.default_rng(1)
    for _ in range(300):
        same = rng.random(rng.integers(1, 30)) < 0.7
        start, end, equal = decontamination._longest(same, 0.8)
        lengths = [
            e - s for s in range(len(same)) for e in range(s + 1, len(same) + 1)
            if 10 * same[s:e].sum() >= 8 * (e - s)
        ]
        assert end - start == max(lengths, default=0)
        assert equal == same[start:end].sum()


def test_query_finds_every_copied_item(spark):
    found = _found(queries()["op7_decontamination"](spark, PATH))
    texts = spark.read.parquet(f"{PATH}/documents.parquet").collect()
    items = spark.read.parquet(f"{PATH}/benchmark.parquet").collect()
    words = lambda t: " ".join(decontamination.WORDS.findall(t.lower()))
    whole = {(d.doc_id, i.item_id) for d in texts for i in items if words(i.text) in words(d.text)}
    assert whole <= set(found)


def test_a_mask_meets_only_kept_words_wherever_words_are_replaced():
    for n in range(5, 26):
        masks = [(len(m), int(m[::-1], 2)) for m in decontamination._masks([n])]
        places = [kept << at for length, kept in masks for at in range(n - length + 1)]
        replaced = [sum(1 << i for i in at) for at in itertools.combinations(range(n), n // 5)]
        assert not [r for r in replaced if all(r & p for p in places)], n


def test_replaced_words_at_every_place_are_found(spark, docs):
    lengths = [*range(5, 14), 15]
    originals = {n: [f"{chr(96 + n)}{k}" for k in range(n)] for n in lengths}
    items = spark.createDataFrame([(n, " ".join(w)) for n, w in originals.items()], "item_id long, text string")
    texts, expected = [], {}
    for n, words in originals.items():
        for at in itertools.combinations(range(n), n // 5):
            text = " ".join("new" if k in at else w for k, w in enumerate(words))
            texts.append((len(texts), f"some words {text} and more"))
            expected[len(texts) - 1, n] = plain_hits(texts[-1][1], " ".join(words))
    assert None not in expected.values()
    assert _found(decontamination.contaminated(docs(*texts), items)) == expected
    few = items.where("item_id = 5")
    assert set(_found(decontamination.contaminated(docs(*texts), few))) == {(d, n) for d, n in expected if n == 5}
