"""Folding, matching, exceptions, and learning of the toxicity lexicon."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocklens.llm import toxicity
from stocklens.llm.queries import queries
from tests.llm.conftest import PATH


def test_folding():
    assert toxicity.folded("Ídïоt") == " idiot "  # with a Cyrillic o
    assert toxicity.folded("1d10t, $tup1d!") == " idiot stupid "
    assert toxicity.folded("ｓｔｕｐｉｄ st\N{ZERO WIDTH SPACE}upid") == " stupid stupid "
    assert toxicity.folded("a$$$ b!!") == " a b "
    assert toxicity.folded("") == toxicity.folded(" \n") == "  "


def test_matches_and_exceptions():
    lexicon = toxicity.Lexicon({" bad ": 2.0, " bad": 1.0, " worse": 3.0}, (" not bad ",))
    machine = lexicon.automaton()
    found = toxicity.matches(machine, " bad baddest not bad worsen abad ")
    assert sorted(found) == [(0, 4, 2.0), (4, 7, 1.0), (20, 25, 3.0)]
    assert toxicity.matches(toxicity.Lexicon().automaton(), " bad ") == []
    assert toxicity.amount(machine, " bad ") > toxicity.amount(machine, " bad " + "word " * 500) > 0


def _corpus(prose, n: int = 400) -> tuple[list, list]:
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 40).split()
        toxic = i % 4 == 0
        if toxic:
            words[i % 30] = ["blorg", "snarkle", "grimpers"][i % 3]
        elif i % 40 == 1:
            words[5:7] = ["gentle", "blorg"]  # a harmless phrase
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def _learned(spark, docs, prose):
    rows, labels = _corpus(prose)
    labels = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (77_777, 1, 1)], "doc_id long, quality int, toxic int")
    return rows, labels, toxicity.learn(docs(*rows), labels)


def test_lexicon_is_learned_with_its_exceptions(spark, docs, prose):
    rows, _, lexicon = _learned(spark, docs, prose)
    assert any(e.startswith(" snark") for e in lexicon.weights)
    assert " gentle blorg " in lexicon.exceptions
    fresh = [
        (9000, prose(9000, 40) + " SN4RKLE " + prose(9001, 10)), (9001, prose(9002, 60)), (9002, None), (9003, ""),
        (9004, prose(9003, 20) + " gentle blorg " + prose(9004, 20)), (9005, "blоrg"), (9006, prose(1, 30_000)),
        (None, "blorg"), (9000, prose(9000, 40) + " SN4RKLE " + prose(9001, 10)),
    ]
    scored = toxicity.scores(docs(*rows, *fresh), lexicon)
    found = scored.collect()
    assert len(found) == len(rows) + len(fresh)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = {r.doc_id: r.held_out for r in found}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)
    predicted = {r.doc_id: r.predicted for r in found}
    assert [predicted[i] for i in (9000, 9001, 9002, 9003, 9004, 9005, 9006, None)] == [1, 0, 0, 0, 0, 1, 0, 1]
    right = [predicted[i] == int(i % 4 == 0) for i, _ in rows if held[i]]
    assert np.mean(right) > 0.97


def test_held_out_labels_are_not_read(spark, docs, prose):
    rows, labels, lexicon = _learned(spark, docs, prose)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs(*rows), flipped) == lexicon


def test_without_labels_or_rows(spark, docs, prose):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(docs((1, prose(1))), empty)
    assert [r.predicted for r in toxicity.scores(docs((1, prose(1)), (2, None)), lexicon).collect()] == [0, 0]
    assert toxicity.scores(docs((1, "x")).limit(0), lexicon).count() == 0


def test_query_on_held_out_rows(spark):
    path = PATH.replace("sf0.001", "sf0.01")
    rows = queries()["op4_toxicity"](spark, path).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{path}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9
    assert not [r for r in rows if r.doc_id is None]


def plain_learned(texts: list[tuple[str, int]], entries: int = 2000) -> dict[str, float]:
    """Log-odds of words and beginnings of words, from counts of whole texts in one dictionary."""
    counts: dict[str, list[int]] = {}
    for text, toxic in texts:
        words = set(toxicity.folded(text).split())
        for term in {f" {w} " for w in words} | {" " + w[:n] for w in words for n in range(5, 10) if n <= len(w)}:
            counts.setdefault(term, [0, 0])[toxic] += 1
    n = [sum(y == k for _, y in texts) for k in (0, 1)]
    odds = {
        t: math.log((c[1] + 0.1) / (n[1] + 0.2)) - math.log((c[0] + 0.1) / (n[0] + 0.2)) for t, c in counts.items() if c[1] >= 4
    }
    strong = sorted((t for t, w in odds.items() if w > 2), key=lambda t: (-odds[t] * math.sqrt(counts[t][1]), len(t), t))
    found: dict[str, float] = {}
    for term in sorted(strong[:entries], key=lambda t: (len(t), t)):
        if odds[term] > max((found[term[:k]] for k in range(2, len(term)) if term[:k] in found), default=0.0) + 0.7:
            found[term] = odds[term]
    return found


def plain_score(text: str | None, lexicon: toxicity.Lexicon) -> tuple[float, int]:
    """Every entry tried at every place."""
    text = toxicity.folded(text or "")
    inside = [(i, i + len(p)) for p in lexicon.exceptions for i in range(len(text)) if text.startswith(p, i)]
    total, n = 0.0, 0
    for i in range(len(text)):
        fits = [e for e in lexicon.weights if text.startswith(e, i)]
        if fits:
            entry = max(fits, key=len)
            end = i + len(entry) - 1
            if not any(s <= i and end <= e for s, e in inside):
                total, n = total + lexicon.weights[entry], n + 1
    amount = total / (1 + math.log1p(text.count(" ") / 50))
    return 1 / (1 + math.exp(-(lexicon.offset + lexicon.slope * amount))), n


def test_lexicon_and_scores_match_plain_ones(spark, docs, prose):
    rows, _, lexicon = _learned(spark, docs, prose)
    toxic = {i: y for i, _, y in _corpus(prose)[1]}
    fitted = [(t, toxic[i]) for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    assert lexicon.weights == pytest.approx(plain_learned(fitted), rel=1e-9)
    tried = rows[:60] + [(9000, None), (9001, ""), (9002, "gentle blorg blorg SN4RKLE grimpersnarkle " + prose(3, 200))]
    found = {r.doc_id: r for r in toxicity.scores(docs(*tried), lexicon).collect()}
    for i, text in tried:
        score, n = plain_score(text, lexicon)
        assert (found[i].score, found[i].n_matches) == (pytest.approx(score, rel=1e-9), n)
        assert found[i].predicted == int(score >= 0.3)


def test_query_matches_plain_scores(spark):
    docs_, labels = (spark.read.parquet(f"{PATH}/{n}.parquet") for n in ("documents", "labels"))
    lexicon = toxicity.learn(docs_, labels)
    texts = {r.doc_id: r.text for r in docs_.where("length(text) < 1500").collect()}
    found = {r.doc_id: r for r in queries()["op4_toxicity"](spark, PATH).collect()}
    assert len(found) == docs_.count()
    for i, text in texts.items():
        assert found[i].score == pytest.approx(plain_score(text, lexicon)[0], rel=1e-9)
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
