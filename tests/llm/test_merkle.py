from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from stocklens.llm import merkle, oracle, queries, sha_states

from .conftest import DOCS, PATH


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests: list[str]) -> list[list[str]]:
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain(rows: list[tuple]) -> list[tuple]:
    """Whole runs are hashed again at every level; rows are (doc_id, source, lang, n_chars, text)."""
    order = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    of = {}
    for s in order:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        of[s] = own, tree([leaf(r) for r in own])
    top = tree([of[s][1][-1][0] for s in order])
    out = []
    for at_source, s in enumerate(order):
        for at, row in enumerate(of[s][0]):
            value, beside = leaf(row), []
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                value = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for place, levels in ((at, of[s][1]), (at_source, top)):
                for level in levels[:-1]:
                    first = place // 16 * 16
                    run, slot = list(level[first : first + 16]), place - first
                    beside += run[:slot] + run[slot + 1 :]
                    run[slot] = value
                    value, place = sha("".join(run)), place // 16
            root = top[-1][0]
            out.append((row[0], leaf(row), of[s][1][-1][0], root, sha("".join(beside)), value, value == root))
    return sorted(out, key=repr)


def test_states_are_those_of_sha256():
    rng = random.Random(1)
    digests = [[sha(str(rng.random())) for _ in range(n)] for n in (1, 2, 15, 16)]
    for run in digests:
        state = np.tile(sha_states.START, (1, 1))
        for d in run:
            state = sha_states.advance(state, sha_states.to_blocks([d]))
        again = sha_states.from_bytes(sha_states.to_bytes(state))
        assert sha_states.to_hex(sha_states.closed(again, np.array([len(run)]))) == [sha("".join(run))]


@pytest.fixture
def built(spark):
    def build(rows):
        df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
        for name in ("tree", "at", "digest", "place", "part", "row", "path", "kids", "root"):
            df = df.withColumn(name, F.lit(name))
        got = merkle.manifest(df)
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return sorted(map(tuple, got.collect()), key=repr)

    return build


def test_trees_of_several_levels(built):
    rng = random.Random(2)
    rows = [(i, "big" if i < 300 else f"s{i % 19}", "en", i, f"Text {i} " + "X" * rng.randrange(40)) for i in range(360)]
    rng.shuffle(rows)
    got = built(rows)
    assert got == plain(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_nulls_repeated_rows_and_lone_leaves(built):
    rows = [
        (None, None, None, None, None), (5, None, "en", 1, "A"), (5, "", "en", 1, "A"), (5, "é", "en", None, "Ä" * 9),
        (7, "z", None, 3, ""), (7, "z", None, 3, ""), (7, "z", None, 3, "other"), (-3, "Z", "de", 0, "long " * 20000),
    ]
    assert built(rows) == plain(rows)


def test_one_source_and_one_row(built):
    rows = [(i, "only", "en", 1, "T" + str(i)) for i in range(33)]
    assert built(rows) == plain(rows)
    assert built(rows[:1]) == plain(rows[:1])
    assert built(rows[:1])[0][4] == sha("")


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).collect() == []


def test_query_matches_sql(spark):
    got = sorted(map(tuple, queries.queries()["op11_merkle_manifest"](spark, PATH).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{PATH}/documents.parquet'")
    assert got == sorted(con.execute(oracle.MERKLE_MANIFEST).fetchall(), key=repr)
