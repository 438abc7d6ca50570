from __future__ import annotations

import random
import re
from collections import defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F
from stocklens.llm import main_text, queries
from stocklens.llm.common import stored_by, table

from .conftest import PATH

PAGES = "page_id long, url string, html string"


@pytest.fixture
def texts(spark):
    def run(*rows):
        df = spark.createDataFrame(list(rows), PAGES)
        for name in ("row", "host", "text", "blocks", "left", "right", "at", "n", "k", "rest", "rule"):
            df = df.withColumn(name, F.lit(name))
        got = main_text.extracted(df)
        assert got.columns == ["page_id", "url", "text", "n_chars", "n_repeated"]
        found = got.orderBy("page_id", "text").collect()
        assert all(r.n_chars == len(r.text) for r in found)
        return [r.text for r in found]

    return run


def one(html: str) -> str:
    return "\n".join(t for state, _, t in main_text.blocks(html) if state == main_text.CONTENT)


def test_blocks_of_an_article():
    page = (
        '<!DOCTYPE html><head><title>No</title><script>var t="</p><article>";</script></head><body>'
        "<header><h1>Site</h1></header><nav><ul><li><a href=x>Home<li>More</ul></nav><!-- <p>no</p> -->"
        '<article class="post"><header><h1>A &amp; B</h1></header><p>one\n  <b>t</b>wo<br>three<p>caf&eacute; &#x41;&am 3 &lt; 4'
        '<div class="comments"><p>First!</p></div><aside>See also</aside><form><p>Mail</p></form>'
        "<ul><li>x<li>y</ul><table><tr><td>1<td>2</table><footer>by me</footer><p>last</article><footer>(c)</footer>"
    )
    assert one(page).split("\n") == ["A & B", "one two three", "café A&am 3 < 4", "x", "y", "1", "2", "last"]


@pytest.mark.parametrize("name", ["ad", "siteNotice", "cookie-bar", "side sidebar", "reader_comments", "newsletter"])
def test_named_elements_go(name):
    assert one(f'<main><p>a</p><div class="{name}"><p>b</p></div><div id="{name}">c</div><p>d</p></main>') == "a\nd"


def test_odd_markup():
    assert one("<article>a < b &amp; c <3</article>") == "a < b & c <3"
    assert one('<article><p title="a>b">x</p></article') == "x\n</article"  # an end tag that does not end is text
    assert one("<article><p>x</div></p>y</article>z") == "x\ny"
    assert one("<article><style>p{}</style><textarea>t</textarea>x<svg><title>t</title><text>u</text></svg></article>") == "x"
    assert one("<article><p>" + "long " * 50000 + "</article>") == ("long " * 50000).strip()
    assert one("<article>" + '<a "' * 2000) != ""
    assert one("") == one("<article></article>") == ""


def plain(pages: list[tuple]) -> list[str]:
    """Every pair of equal windows of every two pages of a host, marked token by token."""
    streams = []
    for page_id, url, page in pages:
        host = re.match(r"[^/?#]*", (url or "").partition("://")[2])[0].lower()
        made = main_text.blocks(page or "")
        rest = [(state, path, text) for state, path, text in made if state != main_text.CONTENT]
        stream = [(k, t) for k, (_, path, text) in enumerate(rest) for t in main_text.tokens(path, text)]
        streams.append((page_id, host, made, rest, stream))
    seen = defaultdict(set)
    size = main_text.LONG
    windows = [[tuple(t for _, t in s[4][i : i + size]) for i in range(len(s[4]) - size + 1)] for s in streams]
    for (page_id, host, *_), own in zip(streams, windows, strict=True):
        for w in own:
            if page_id is not None:
                seen[host, w].add(page_id)
    marks, share = [], defaultdict(lambda: [0, 0])
    for (_, host, _, rest, stream), own in zip(streams, windows, strict=True):
        gone = [False] * len(stream)
        for i, w in enumerate(own):
            if len(seen[host, w]) > 1:
                gone[i : i + size] = [True] * size
        marks.append(gone)
        for (k, _), g in zip(stream, gone, strict=True):
            share[host, rest[k][1]][0] += 1
            share[host, rest[k][1]][1] += g
    out = []
    for (_, host, made, rest, stream), gone in zip(streams, marks, strict=True):
        content = [t for state, _, t in made if state == main_text.CONTENT]
        if not content:
            for k, (state, path, _) in enumerate(rest):
                n, repeated = share[host, path]
                left = [t for (j, t), g in zip(stream, gone, strict=True) if j == k and not g and not t.startswith("\0")]
                if state == main_text.OPEN and 2 * repeated <= n and left:
                    content.append(" ".join(left))
        out.append("\n".join(content))
    return out


def made_pages(n: int) -> list[tuple]:
    rng = random.Random(7)
    word = lambda: "w" + str(rng.randrange(2000))
    notices = [" ".join(word() for _ in range(12)) for _ in range(3)]
    pages = []
    for i in range(n):
        paragraphs = "".join(f"<p>{' '.join(word() for _ in range(rng.randrange(1, 30)))}</p>" for _ in range(4))
        frame = f"<div class=x7>{rng.choice(notices)} {word()}</div>" if i % 3 else ""
        end = f"<div class=q{i}>{rng.choice(notices)}</div>"
        kind = i % 4
        body = f"<article>{paragraphs}</article>" if kind == 0 else f"<div class=t>{paragraphs}{notices[0]}</div>" if kind < 3 else ""
        pages.append((i, f"http://h{rng.randrange(3)}.x/{i}", f"<html><body>{frame}{body}{end}</body>"))
    return pages


def test_repeated_strings_go_where_markup_says_nothing(texts):
    pages = made_pages(60)
    got = texts(*pages)
    assert got == plain(pages)
    with_article = [t for (i, *_), t in zip(pages, got, strict=True) if i % 4 == 0]
    assert all(with_article)
    assert not any(t in x for x in got for t in ("\0",))


def test_nulls_repeated_rows_and_empty_tables(texts, spark):
    same = "<body><div>one two three four five six seven eight</div><p>own words</p></body>"
    pages = [
        (None, None, None), (None, None, same), (1, "http://a.x/", same), (1, "http://a.x/", same), (2, "no host", ""),
        (3, "http://b.x/", same), (4, "http://b.x/", same.replace("own", "other")), (5, "http://B.x?q", same),
    ]
    got = texts(*pages)
    want = plain(pages)
    assert sorted(got) == sorted(want)
    assert got[2] == got[3] == "one two three four five six seven eight\nown words"  # one page, twice
    assert main_text.extracted(spark.createDataFrame([], PAGES)).collect() == []


def test_articles_keep_what_they_share(texts):
    shared = "<article><p>" + "the same passage in two articles of a host " * 3 + "</p></article>"
    got = texts((1, "http://a.x/1", shared), (2, "http://a.x/2", shared))
    assert got[0] == got[1] != ""


def test_query_matches_the_article_of_each_page(spark):
    rows = queries.queries()["op13_html_extraction"](spark, PATH).collect()
    got = {r.page_id: r.text for r in rows}
    for r in table(spark, PATH, "pages").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        pieces = (re.sub(r"</?b>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id] == "\n".join(t for p in pieces if (t := " ".join(unescape(p).split())))


def test_articles_and_menus_go_through_the_method_too(spark):
    menu = "<nav><ul><li>one two three four five six</li></ul></nav>"
    shared = "a passage that two articles of a host have in common"
    pages = [(i, "http://a.x/", f"{menu}<article><p>own{i} {shared}</p></article>") for i in range(2)]
    pages.append((2, "http://b.x/", f"{menu}<article><p>{shared}</p></article>"))  # another host
    rows = main_text.extracted(spark.createDataFrame(pages, PAGES)).orderBy("page_id").collect()
    assert [r.text for r in rows] == [f"own0 {shared}", f"own1 {shared}", shared]
    # the menu with its element, the element of the paragraph behind it, and the passage; not the word of its own
    assert [r.n_repeated for r in rows] == [7 + 1 + 11, 7 + 1 + 11, 0]


def test_keys_and_slots():
    rng = np.random.default_rng(1)
    for bits in (27, 32, 40, 64):
        keys = np.unique(rng.integers(0, (1 << 64) - 1, 1000, np.uint64) >> np.uint64(64 - bits))
        assert (main_text._unsqueezed(main_text._squeezed(keys)) == keys).all()
        first, second = main_text._slots(keys << np.uint64(64 - bits))
        assert (first >> (main_text.SLOT - main_text.RANGE) == second >> (main_text.SLOT - main_text.RANGE)).all()
        assert max(first.max(), second.max()) < 1 << main_text.SLOT


def exchanged(df) -> list[str]:
    """The columns of what the plan shuffles."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [line for at, line in enumerate(lines) if at and "Exchange" in lines[at - 1]]


def test_texts_are_written_once_and_never_shuffled(spark):
    df = spark.range(1000).selectExpr("id % 7 AS set", "id")
    found = stored_by(df, "sevens", "set", 4)
    assert not any(t.name.startswith("stocklens") for t in spark.catalog.listTables())
    assert not exchanged(found.groupBy("set").count())
    assert sorted(map(tuple, found.groupBy("set").count().collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]
    pages = spark.createDataFrame(made_pages(60), PAGES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = exchanged(main_text.extracted(pages))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffled and not any("blocks" in line or "html" in line for line in shuffled)


def test_sets_of_pages_make_no_difference(spark):
    """Also for rows with one page_id in several sets, which are one page, and for pages without one."""
    pages = made_pages(40)
    own = " ".join(f"only{i}" for i in range(20))
    pages += [(99, "http://h0.x/", f"<div class=own>{own} {i}</div>") for i in range(6)] + [(None, u, p) for _, u, p in pages[:3]]
    df = spark.createDataFrame(pages, PAGES)
    key = ["page_id", "url", "text", "n_repeated"]
    one, many = (
        sorted(map(str, main_text.extracted(d).select(key).collect())) for d in (df.coalesce(1), df.repartition(9))
    )
    assert one == many
    assert sum("n_repeated=0" in r and "only0" in r for r in one) == 6


def test_what_is_sent_of_a_set():
    def sent(name, keys, page, page_ids=None):
        of = main_text._keys(np.array(keys, np.uint64), np.array(page, np.int32))
        return of, main_text._sent(pa.table({"set": [name]}), of, page_ids, 64, 7)

    top = 1 << 60
    a, of_a = sent(1, [top, 5, 5, 9, 7, 7], [0, 0, 0, 0, 0, 1], np.array([10, 11]))
    b, of_b = sent(2, [9, 5, 5, top], [0, 0, 1, -1], np.array([10, 12]))
    rows = pa.concat_tables([of_a, of_b])
    ranges = sorted(set(rows["range"].to_pylist()))
    assert len(ranges) == 2
    judged = pa.concat_tables(
        main_text._compared(rows.filter(pa.compute.equal(rows["range"], r)), 2, 7) for r in ranges
    )
    own = [main_text._answer(of, judged.filter(pa.compute.equal(judged["set"], k)), 2, 7) for k, of in ((1, a), (2, b))]
    # 9 is on one page in two rows, the first key on a page and on one without an id
    assert own[0].tolist() == [False, True, True, False, True, True]
    assert own[1].tolist() == [False, True, True, False]
