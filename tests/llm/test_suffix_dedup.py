"""Repeated strings of 100 bytes against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from stocklens.llm import common, suffix_dedup
from stocklens.llm.queries import queries
from tests.llm.conftest import PATH


def plain(rows: list) -> list:
    """Of rows (doc_id, text) in order of id: the result, by a set of all strings."""
    seen: dict[bytes, tuple] = {}
    out = []
    for key, (doc, text) in enumerate(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.setdefault(s, (key, p))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _rows(df) -> list:
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet").orderBy("doc_id").collect()
    assert _rows(queries()["op5_suffix_dedup"](spark, PATH)) == sorted(plain([(d.doc_id, d.text) for d in docs]), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_any_texts(docs, prose, seed):
    rng = random.Random(seed)
    passages = [prose(50 + i, 30) for i in range(4)]
    rows = [(0, None), (1, ""), (2, "a" * 99), (3, "a" * 100), (4, "a" * 5000), (5, "ab" * 400), (6, "é" * 300)]
    for i in range(7, 40):
        parts = [rng.choice([*passages, prose(rng.randrange(1000), 15), "ab" * rng.randrange(90)]) for _ in range(rng.randrange(1, 6))]
        text = rng.choice(["", " ", "x"]).join(parts)
        rows.append((i, text[rng.randrange(3) :]))
    rows.append((40, rows[20][1]))
    rows.append((41, prose(7, 20_000)))  # over one piece of 60,000 strings
    rows.append((42, prose(8, 30) + rows[41][1][50_000:70_000]))
    expected = plain(rows)
    shuffled = rng.sample(rows, len(rows))
    assert _rows(suffix_dedup.deduplicated(docs(*shuffled).repartition(5))) == sorted(expected, key=str)


def test_null_ids_come_last_and_equal_rows_alike(docs, prose):
    text = prose(1, 60)
    found = _rows(suffix_dedup.deduplicated(docs((None, text), (5, text), (5, text), (7, prose(2, 60)))))
    whole = plain([(5, text)])[0]
    assert found.count(whole) == 2
    assert plain([(5, text), (None, text)])[1] in found
    assert plain([(7, prose(2, 60))])[0] in found


def test_empty_table(docs):
    assert suffix_dedup.deduplicated(docs((1, "x")).limit(0)).count() == 0


def test_every_string_has_its_anchor():
    """Stretches cover each start once, and equal strings have equal grams."""
    rng = random.Random(3)
    data = bytes(rng.choice(b"ab ") for _ in range(3000))
    data += data[500:900] + b"a" * 400
    found = list(zip(*suffix_dedup.stretches(data), strict=True))
    starts = [p for _, _, first, last in found for p in range(first, last + 1)]
    assert starts == list(range(len(data) - 99))
    grams: dict[bytes, set] = {}
    for gram, _, first, last in found:
        for p in range(first, last + 1):
            grams.setdefault(data[p : p + 100], set()).add(gram)
    assert all(len(g) == 1 for g in grams.values())


def test_workers_get_small_batches_one_after_the_other(docs, prose):
    df = docs((1, prose(1)), (2, prose(1)))
    spark = df.sparkSession
    for key in common.BATCHES:
        spark.conf.unset(key)
    common.ship(spark)
    assert {k: spark.conf.get(k) for k in common.BATCHES} == common.BATCHES
    key = next(iter(common.BATCHES))
    spark.conf.set(key, "77")
    common.ship(spark)
    assert spark.conf.get(key) == "77"  # what the session says holds
    spark.conf.unset(key)
    plan = suffix_dedup.deduplicated(df)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    nodes = [line.lstrip(" :+-") for line in plan]
    assert not any(a.startswith("MapInArrow") and b.startswith("MapInArrow") for a, b in zip(nodes, nodes[1:], strict=False))
