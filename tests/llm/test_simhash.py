"""SimHash groups against brute force over all pairs."""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import functions as F

from stocklens.llm import simhash
from stocklens.llm.queries import queries
from stocklens.llm.graph import components
from tests.llm.conftest import PATH

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text: str | None) -> int:
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict[int, int], links) -> dict[int, int]:
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in prints}


def test_query_matches_brute_force(spark):
    rows = queries()["op8_simhash"](spark, PATH).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{PATH}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    found = plain_components(prints, links)
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", found[i]) for i in ids
    }
    assert len(set(found.values())) < len(ids)


def test_every_pair_within_three_bits_is_linked(spark):
    import random

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for f in base:
        for n in (1, 2, 3, 3, 4, 5):
            flipped = f
            for b in rng.sample(range(64), n):
                flipped ^= 1 << b
            prints.add(flipped)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    found = {tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    expected = {
        (a, b) for a in signed for b in signed
        if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3
    }
    assert found == expected


def test_edges(spark, docs, prose):
    df = docs(
        (3, None), (1, ""), (2, " \t\n"), (9, "One two"), (8, "one TWO"), (None, "one two"), (None, None),
        (5, prose(1, 30_000)), (7, prose(1, 30_000)), (7, prose(1, 30_000)), (4, "É é"),
    )
    rows = simhash.simhash_components(df).collect()
    assert len(rows) == 11
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[1].fingerprint == "0" * 16
    assert by_id[8].component_id == by_id[9].component_id == 8
    assert by_id[7].component_id == 5
    assert sorted(r.component_id for r in rows if r.doc_id is None) == [1, 8]
    assert simhash.simhash_components(df.limit(0)).count() == 0


def test_one_of_each_keeps_one_row(spark, docs, prose):
    rows = [(5, prose(1)), (7, prose(1)), (5, prose(1)), (None, prose(1)), (8, prose(2)), (None, prose(3)), (None, prose(3)), (1, None), (2, "")]
    df = docs(*rows)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(5, prose(1)), (8, prose(2)), (None, prose(3)), (1, None)], key=str
    )
    assert simhash.one_of_each(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(edges.union(spark.createDataFrame([(1000, 2000), (2000, 2000)], "a long, b long")))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**dict.fromkeys(range(301), 0), 1000: 1000, 2000: 1000}
