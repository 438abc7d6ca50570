"""Encoding against the SentencePiece library, decoding against the text."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from stocklens.llm import sentencepiece_bpe as bpe
from stocklens.llm.queries import queries
from tests.llm.conftest import PATH

sentencepiece = pytest.importorskip("sentencepiece")
pytestmark = pytest.mark.skipif(not os.path.exists(bpe.MODEL), reason="no model file here")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=bpe.MODEL)


@pytest.fixture(scope="module")
def pieces():
    return bpe.load()


def test_query_matches_the_library(spark, library):
    rows = queries()["op2_sentencepiece"](spark, PATH).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{PATH}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id])
        assert r.round_trip
        assert r.n_tokens == len(r.ids)


def _texts() -> list:
    rng = random.Random(4)
    alphabet = "ab éñththe.,!²m_{}0129中文日本\t\n#*=-/ ooo  xe\N{GRINNING FACE}ﬁ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [
        *texts, "", " ", "  ", "a" * 3000, "ab" * 1500, "▁", " " * 100, "=" * 500, "中" * 300,
        "x" * 119, "x" * 120, "x" * 121, " ".join(texts) * 5, "\0a\0b", "m²", "².", "a\nb\r\n",
    ]


def test_any_text(spark, docs, library, pieces):
    texts = _texts()
    df = docs(*enumerate(texts), (None, "no id"), (-1, None), (0, texts[0]))
    rows = bpe.encoded(df, pieces, bound=3).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        text = "no id" if r.doc_id is None else "" if r.doc_id == -1 else texts[r.doc_id]
        assert r.ids == library.encode(text), repr(text)
        assert r.round_trip or "▁" in text
    assert bpe.encoded(df.limit(0), pieces).count() == 0


def test_the_fold_equals_the_heap(spark, pieces):
    """Every fragment through the relational lattice, none through the lookup of frequent ones."""
    found = sorted({f for t in _texts() for f in bpe.fragments(t, pieces) if len(f) <= bpe.LONG})
    distinct = spark.createDataFrame([(f,) for f in found], "fragment string").repartition("fragment")
    encoded = {r.fragment: r.ids for r in bpe.encoded_fragments(distinct, pieces).collect()}
    assert encoded == {f: bpe._ids(bpe.merges(f, pieces.ranks)[0], pieces) for f in found}


def test_grouping_of_edges_needs_no_shuffle(spark, pieces):
    distinct = spark.createDataFrame([("ab",)], "fragment string").groupBy("fragment").agg(F.count("*").alias("n"))
    plan = bpe.encoded_fragments(distinct, pieces)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_decoding(spark, docs, library, pieces):
    texts = _texts()
    rows = spark.createDataFrame(
        [(i, library.encode(t)) for i, t in enumerate(texts)] + [(None, None), (9999, [])], "doc_id long, ids array<int>"
    )
    found = {r.doc_id: r.text for r in bpe.decoded(rows.withColumn("text", F.lit("x")), pieces).collect()}
    assert found[None] is None
    assert found[9999] == ""
    assert all(found[i] == t.replace("▁", " ") for i, t in enumerate(texts))


def test_a_model_without_byte_pieces(spark):
    """Unknown characters get the unknown id, one each."""
    ids = {"▁": 1, "a": 2, "b": 3, "ab": 4, "▁ab": 5, "ba": 6}
    ranks = {"ab": 0, "▁ab": 1, "ba": 2, "a": 3, "b": 4, "▁": 5}
    small = bpe.Pieces(ids, ranks, [], 0, [b"?", b" ", b"a", b"b", b"ab", b" ab", b"ba"])
    distinct = spark.createDataFrame([("▁ab",), ("bab",), ("▁éb",), ("aba",)], "fragment string").repartition("fragment")
    found = {r.fragment: r.ids for r in bpe.encoded_fragments(distinct, small).collect()}
    assert found == {"▁ab": [5], "bab": [3, 4], "▁éb": [1, 0, 3], "aba": [4, 2]}


def test_rare_fragments_are_shuffled_once_and_not_written(spark, docs, tmp_path, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(40)) for _ in range(20)]
    written, kept = [], bpe.stored
    monkeypatch.setattr(bpe, "stored", lambda df, name: written.append(name) or kept(df, name))
    docs(*enumerate(texts)).write.parquet(f"{tmp_path}/docs")
    df = bpe.encoded(spark.read.parquet(f"{tmp_path}/docs"), bound=1)
    assert len(df.collect()) == 20
    assert written == ["frequent"]
    assert df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") == 1


def test_texts_are_written_once_and_never_shuffled(docs, prose):
    made = docs(*((i, prose(i)) for i in range(40)), (None, "no id"), (41, None))
    plan = bpe.encoded(made)._jdf.queryExecution().executedPlan().toString().split("\n")
    shuffled = [line for at, line in enumerate(plan) if at and "Exchange" in plan[at - 1]]
    assert shuffled and not any("data" in line for line in shuffled)


def test_sets_and_what_is_packed_for_them():
    rows = pa.RecordBatch.from_pydict({
        "row": pa.array([7, 8, 9], pa.int64()), "doc_id": pa.array([1, None, 1], pa.int64()),
        "data": pa.array([b"a" * bpe.SET, b"", b"b"], pa.binary()),
    })
    found = list(bpe._in_sets(iter([rows])))
    assert [b["set"].to_pylist() for b in found] == [[7, 8, 8]]
    batches = [
        pa.RecordBatch.from_pydict({
            "fragment": pa.array(f, pa.string()), "ids": pa.array(i, pa.list_(pa.int32())), "set": pa.array(b, pa.int64())
        })
        for f, i, b in ((["é▁", "ab"], [[1, 2], [3]], [5, 2]), (["c"], [[4, 5]], [5]), ([], [], []))
    ]
    unpack = zstandard.ZstdDecompressor().decompress
    rows = [r for batch in bpe._pack(iter(batches)) for r in batch.to_pylist()]
    assert [r["set"] for r in rows] == [2, 5]
    assert [unpack(r["fragments"]).decode() for r in rows] == ["ab", "é▁c"]
    sizes = [np.frombuffer(unpack(r["sizes"]), np.int32).reshape(2, -1).tolist() for r in rows]
    assert sizes == [[[2], [1]], [[2, 1], [2, 2]]]
    assert [np.frombuffer(unpack(r["ids"]), np.int32).tolist() for r in rows] == [[3], [1, 2, 4, 5]]
    assert list(bpe._pack(iter([]))) == []


def test_fragments_are_encoded_once_for_all_sets_and_folded_in_batches(spark, pieces):
    """No fold is interpreted row by row; rows of a fragment may fall into several Arrow batches."""
    found = sorted({f for t in _texts() for f in bpe.fragments(t, pieces) if len(f) <= bpe.LONG})[:300]
    rows = [(n % 7 + k, f) for n, f in enumerate(found) for k in range(n % 4 + 1)] + [(2, found[2])] * 3
    asked = spark.createDataFrame(rows, "set long, fragment string").repartition(2, "fragment")
    packed = bpe.packed_by_set(asked, pieces)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "aggregate(" not in plan and "collect_list" not in plan
    unpack = zstandard.ZstdDecompressor().decompress
    answers = []
    for r in packed.collect():
        sizes = np.frombuffer(unpack(r["sizes"]), np.int32).reshape(2, -1)
        joined, ids = unpack(r["fragments"]).decode(), np.frombuffer(unpack(r["ids"]), np.int32).tolist()
        ends, ids_ends = np.cumsum(sizes[0]).tolist(), np.cumsum(sizes[1]).tolist()
        for n, m, end, ids_end in zip(*sizes.tolist(), ends, ids_ends, strict=True):
            answers.append((r["set"], joined[end - n : end], ids[ids_end - m : ids_end]))
    expected = [(s, f, bpe._ids(bpe.merges(f, pieces.ranks)[0], pieces)) for s, f in rows]
    assert sorted(answers) == sorted(expected)


def test_batches_are_cut_between_fragments_only(pieces, monkeypatch):
    def edge(s: int, e: int, piece: str) -> tuple:
        return None, ((pieces.ids[piece] + 1) * bpe.PLACES + e) * bpe.PLACES + s

    own = [edge(0, 1, "a"), edge(0, 2, "an"), edge(1, 2, "n")]
    rows = [("an", 4), ("an", 1), *own, ("an", 9), ("a", 3), edge(0, 1, "a"), ("a", 5)]
    schema = pa.schema([("fragment", pa.string()), ("value", pa.int64())])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True))], schema) for r in rows]
    monkeypatch.setattr(bpe, "EDGES", 2)
    table = bpe._own_merges(pieces)
    found = [tuple(r.values()) for b in bpe._answers(iter(batches), table, pieces) for r in b.to_pylist()]
    both = [[pieces.ids["an"]], [pieces.ids["a"]]]
    assert found == [("an", both[0], 4), ("an", both[0], 1), ("an", both[0], 9), ("a", both[1], 3), ("a", both[1], 5)]
    with pytest.raises(ValueError, match="came apart"):
        list(bpe._answers(iter(batches[:2] + batches[3:]), table, pieces))
    with pytest.raises(ValueError, match="came apart"):
        list(bpe._answers(iter([*batches[:5], batches[6]]), table, pieces))
