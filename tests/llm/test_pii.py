"""Personal data: base spans against plain patterns, added spans, redaction."""

from __future__ import annotations

import hashlib
import re

import pytest

from stocklens.llm import pii
from stocklens.llm.queries import queries
from tests.llm.conftest import PATH


def _luhn(s: str) -> bool:
    digits = [int(c) for c in s if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def _count(s: str) -> int:
    return sum(c in "0123456789" for c in s)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= _count(s) <= 19 and _luhn(s)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= _count(s) <= 15),
]


def plain(text: str | None) -> list[str]:
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern, passes in BASE
        for m in re.finditer(pattern, text or "")
        if passes(m.group())
    ]


def _check(df, texts: list) -> dict:
    rows = df.collect()
    assert len(rows) == len(texts)
    expected = sorted((str(i), ",".join(plain(t))) for i, t in texts)
    digest = {(i, hashlib.sha256(s.encode()).hexdigest()) for i, s in expected}
    assert sorted((str(r.doc_id), r.base_sha256) for r in rows) == sorted(
        (i, hashlib.sha256(s.encode()).hexdigest()) for i, s in expected
    )
    assert digest
    for r in rows:
        found = r.spans.split(",") if r.spans else []
        assert len(found) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
        order = [(pii.KINDS.index(k), int(s)) for k, s, _ in (f.split(":") for f in found)]
        assert order == sorted(order)
    return {r.doc_id: r.spans for r in rows}


def test_query_matches_plain_patterns(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{PATH}/documents.parquet").collect()]
    _check(queries()["op3_pii"](spark, PATH), texts)


@pytest.fixture(scope="module")
def hard() -> list:
    card = "4539 1488 0343 6467"
    return [
        (1, None), (2, ""), (3, "é a@b.c, x.y@z-1.co.uk. a@b a@b.c_d@e.f @x.y a@@b.c ü1@é.de"),
        (4, "1.2.3.4 01.002.0003.255 256.1.1.1 1.2.3.4.5.6.7.8.9 1.2..3.4.5.6 999999999999.1.1.1"),
        (5, f"{card} x{card.replace(' ', '-')}y 4539148803436468 {card} {card}"),
        (6, "+1 (017) 555-7713, +12 +1.2.3.4.5.6.7.8.9.0 ++491711234567 +1 (826) 555-4081 190.137.223.204 +49 170 1234567 )"),
        (7, "9" * 30_000), (8, "a" * 30_000 + "@"), (9, "a." * 15_000 + "@b" + ".c" * 3000),
        (10, "+" * 5000 + "1 " * 5000), (None, "a@b.c"), (11, f"ok a@b.c {card}"), (11, f"ok a@b.c {card}"),
        (12, "\N{GRINNING FACE}\N{GRINNING FACE} a@b.c \N{GRINNING FACE} 1.2.3.4"),
    ]


def test_hard_texts(docs, hard):
    _check(pii.personal_data(docs(*hard)), hard)
    assert pii.personal_data(docs(*hard).limit(0)).count() == 0


def _filled(prose, n: int = 120) -> list:
    """Documents in which personal data is plain, and a few in which two spans run together."""
    rows = []
    for i in range(n):
        phone, ip = f"+1 ({100 + i}) 555-{1000 + i}", f"10.{i}.7.{i + 1}"
        rows.append((i, f"{prose(i, 20)} {phone} {prose(i + 500, 20)} {ip} {prose(i + 900, 5)} m{i}@mail.example.com end"))
    return rows + [(1000, "call +1 (826) 555-4081 190.137.223.204 now"), (1001, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"')]


def test_run_together_phone_is_added_and_tokens_are_not(docs, prose):
    rows = _filled(prose)
    found = _check(pii.personal_data(docs(*rows)), rows)
    assert found[1000] == "ip:23:38,phone:5:22"
    assert found[1001] == ""


def test_redaction(docs, prose):
    rows = _filled(prose) + [(2000, None), (2001, ""), (2002, "clean text 12"), (None, "me@mail.example.com")]
    df = docs(*rows)
    out = pii.redacted(df)
    assert out.columns == df.columns
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == len(rows)
    assert found[1000].text == "call [PHONE] [IP] now"
    assert found[1000].n_chars == len(found[1000].text)
    assert found[2000].text is None
    assert found[2001].text == ""
    assert found[2002].text == "clean text 12"
    assert found[None].text == "[EMAIL]"
    for i, text in rows[:120]:
        expected = text
        for kind, pattern, _ in BASE:
            if kind != "card":
                expected = re.sub(pattern, f"[{kind.upper()}]", expected)
        assert found[i].text == expected
    assert pii.redacted(df.limit(0)).count() == 0


def test_spellings_the_base_does_not_know_are_added(docs, prose):
    rows = _filled(prose) + [
        (3000, "call (017) 555-7713 now"), (3001, "write to jo.doe (at) mail (dot) example (dot) org please"),
        (3002, "order 4539148803436468 and host 256.1.1.1 here"), (3003, 'secret = "a1234567890123456b"'),
    ]
    found = _check(pii.personal_data(docs(*rows)), rows)
    assert found[3000] == "phone:5:19"
    assert found[3001] == "email:9:49"
    assert found[3002] == found[3003] == ""
    out = {r.doc_id: r.text for r in pii.redacted(docs(*rows)).collect()}
    assert out[3000] == "call [PHONE] now"
    assert out[3001] == "write to [EMAIL] please"


def test_a_hot_kind_leaves_the_others_their_thresholds(docs, prose):
    hot = [(5000 + i, " ".join(str(4539148803430000 + 100 * i + k) for k in range(100))) for i in range(100)]
    fits = [
        pii.fit(pii.with_proposals(docs(*rows), "text"), bound=400).thresholds
        for rows in (_filled(prose), _filled(prose) + hot)
    ]
    assert {pii.KINDS[k] for k in fits[0]} == {"email", "ip", "phone"}
    assert {pii.KINDS[k] for k in fits[1]} >= {"email", "ip", "phone"}
