from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from stocklens.llm import alignment, queries
from stocklens.llm.common import table
from tokenizers import Tokenizer

from .conftest import DOCS, PATH


@pytest.fixture(scope="module")
def models():
    return alignment.load()


@pytest.fixture(scope="module")
def plain(models):
    """Both libraries on whole texts; groups from the ends of decoded bytes."""
    a = Tokenizer.from_file(alignment.BYTE_LEVEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)
    known = alignment.Aligner(models)

    def groups(text):
        if not text:
            return []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a, bytes_b = [known.bytes_a[i] for i in ids_a], [known.bytes_b[i] for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []

        def ends(parts):
            at = 0
            return [at := at + len(p) for p in parts]

        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        cuts = sorted(set(ends_a) & set(ends_b))
        number = {end: k for k, end in enumerate(cuts)}
        out = [([], []) for _ in cuts]
        for side, ids, tops in ((0, ids_a, ends_a), (1, ids_b, ends_b)):
            k = 0
            for i, end in zip(ids, tops, strict=True):
                out[k][side].append(i)
                k = number.get(end, k - 1) + 1 if end in number else k
        return out

    def compute(texts):
        docs = [groups(t) for t in texts]
        count = Counter()
        for g in docs:
            count.update({(x, y) for p, q in g for x in p for y in q})
        most = defaultdict(int)
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        out = []
        for g in docs:
            links = [(x, y) for p, q in g for x in p for y in q]
            written = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in g)
            out.append((
                sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(links),
                sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links),
                hashlib.sha256(written.encode()).hexdigest() if g else "",
            ))
        return out

    return compute


def rows(df):
    return [tuple(r)[1:] for r in df.orderBy("doc_id", "groups_sha256").collect()]


def odd_texts(n: int, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    letters = "aé日😀\0 \n\tx<s>|ꙮ🧿'’s1  ． 　\xa0﻿‍\U0001f9ff"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_matches_whole_texts(docs, plain):
    texts = odd_texts(400) + [
        "", " ", "  ", "\n", "x" * 3000, "日本語" * 200, "<|endoftext|> <s></s> [INST]", "naïve  café\n\n x ", "a ▁b", "▁",
        "=" * 777, "க்ஷ " * 50, "\U0001f9ff" * 30,
    ]
    df = docs(*enumerate(texts))
    want = plain(texts)
    assert rows(alignment.aligned_documents(df)) == want
    assert rows(alignment.aligned_documents(df, hot=50)) == want  # nearly all by the join
    assert rows(alignment.aligned_documents(df, hot=0)) == want
    assert sum(w[0] == 0 for w in want) >= 3


def test_nulls_repeated_rows_and_extra_columns(docs, plain):
    texts = [None, "one two", "one two", "one three", ""]
    df = docs(*[(1, t) for t in texts])
    assert rows(alignment.aligned_documents(df)) == sorted(plain(texts), key=lambda r: r[-1])


def test_empty_table(spark):
    assert alignment.aligned_documents(spark.createDataFrame([], DOCS)).collect() == []
    assert rows(alignment.aligned_documents(spark.createDataFrame([(1, None, "", "", 0)], DOCS))) == [(0,) * 6 + ("",)]


def test_what_is_forgotten_is_made_again(models):
    texts = odd_texts(200, seed=4) + ["a b c d " * 9]
    small, large = alignment.Aligner(models, keep=40), alignment.Aligner(models)

    def digests(aligner, size):
        found = []
        for start in range(0, len(texts), size):
            for made in aligner.documents(texts[start : start + size]):
                found.append((*made[:5], made[5].tolist(), made[6].tolist()))
        return found

    assert digests(small, 3) == digests(large, 50)
    assert digests(small, 3) == digests(large, 7)
    assert len(small.place) < 400


def test_long_groups_count_equal_ids(models, monkeypatch):
    texts = odd_texts(60, seed=6)
    usual = [(m[5].tolist(), m[6].tolist()) for m in alignment.Aligner(models).documents(texts)]
    monkeypatch.setattr(alignment, "LARGE", 1)
    assert [(m[5].tolist(), m[6].tolist()) for m in alignment.Aligner(models).documents(texts)] == usual


def test_query_matches_whole_texts(spark, plain):
    texts = [r.text for r in table(spark, PATH, "documents").orderBy("doc_id").collect()]
    assert rows(queries.queries()["op12_tokenizer_alignment"](spark, PATH)) == plain(texts)
