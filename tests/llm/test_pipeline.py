"""The pipeline stage by stage against plain versions, and its edges."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stocklens.llm import decontamination, pii, sentencepiece_bpe
from tests.llm.conftest import PATH
from tests.llm.test_decontamination import plain_hits
from tests.llm.test_pii import BASE
from tests.llm.test_simhash import plain_components, plain_fingerprint

pytestmark = pytest.mark.skipif(not os.path.exists(sentencepiece_bpe.MODEL), reason="no model file here")


def _texts(df) -> dict:
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_on_the_test_tables(spark, tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    kept = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, PATH)
        if number < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept.append(docs)
    quality, single, clean, redacted, tokens = kept

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
    first = _texts(quality)
    right = [(i in first) == bool(q) for i, q in labels.items()]
    assert sum(right) > 0.95 * len(right)

    prints = {i: plain_fingerprint(t) for i, t in first.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    second = _texts(single)
    assert set(second) == set(plain_components(prints, links).values())

    third = _texts(clean)
    items = [r.text for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    words = lambda t: " ".join(decontamination.WORDS.findall(t.lower()))
    whole = {i for i, t in second.items() if any(words(x) in words(t) for x in items)}
    gone = set(second) - set(third)
    assert whole <= gone
    leaks = decontamination.contaminated(single.where(single.doc_id.isin(list(gone))), spark.read.parquet(f"{PATH}/benchmark.parquet"))
    assert {r.doc_id for r in leaks.collect()} == gone

    fourth = _texts(redacted)
    assert set(fourth) == set(third)
    spans = {r.doc_id: r.spans for r in pii.personal_data(clean).collect()}
    for i, text in third.items():
        expected, shift = text, 0
        marks = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans[i].split(",") if x))
        for s, e, kind in marks:
            mark = f"[{kind.upper()}]"
            expected = expected[: s + shift] + mark + expected[e + shift :]
            shift += len(mark) - (e - s)
        assert fourth[i] == expected
        assert not any(re.search(p, fourth[i]) for k, p, _ in BASE if k == "email")

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.MODEL)
    rows = {r.doc_id: r for r in tokens.collect()}
    assert {i: list(r.ids) for i, r in rows.items()} == {i: library.encode(t) for i, t in fourth.items()}
    assert all(r.round_trip for r in rows.values())


def test_stages_on_odd_rows(spark, docs, prose):
    rows = [(1, None), (2, ""), (None, "x"), (None, None), (5, prose(1, 20_000)), (5, prose(1, 20_000)), (6, prose(2))]
    df = docs(*rows)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, df, PATH)
        assert out.columns == df.columns
        assert out.schema == df.schema or [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
        assert out.count() <= len(rows)
        assert stage(spark, df.limit(0), PATH).count() == 0


def test_a_passage_is_removed_with_its_document(spark, docs, prose):
    item = prose(77, 40, 4000)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = docs((1, prose(1) + " " + item), (2, prose(2)))
    assert plain_hits(prose(1) + " " + item, item) is not None
    assert [r.doc_id for r in decontamination.without_passages(df, items).collect()] == [2]


def test_columns_named_like_those_inside_come_back(spark, docs, prose):
    names = (
        "simhash_", "fp_", "group_", "order_", "i_", "t_", "leaked_", "expected_", "tail_", "accepted_", "base_", "proposed_",
        "taught_", "known_", "added_", "all_", "spans_", "pieces_", "text_", "is_changed_", "row", "part", "hash", "other0", "other5",
    )
    df = docs((1, prose(1, 40) + " mail me@mail.example.com"), (2, prose(2, 60)), (3, None), extra=False)
    for name in names:
        df = df.withColumn(name, F.lit(name))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, df, PATH)
        assert out.columns == df.columns
        found = out.collect()
        assert found and all(r[name] == name for r in found for name in names)
