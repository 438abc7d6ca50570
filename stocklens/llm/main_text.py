"""The main text of web pages: repetition within a host, checked by markup.

A page is cut into blocks, and all of them, whatever element they are in, form
one stream of tokens. The suffixes of the streams of a host are brought
together by their first ``LONG`` tokens, as neighbours in a suffix array whose
common prefix is that long. Tokens under such a string that starts on several
pages are boilerplate. An element most of whose tokens on a host are
boilerplate is a template and goes as a whole; of other blocks the unique runs
stay.

Markup checks that verdict where it says what is text. Blocks inside an
article, or inside an element named after content, are whole again, as what two
articles share is theirs. Blocks in menus, footers, forms and the like go, and
those in elements named after adverts, notices or comments; on pages with an
article all others go too.

Texts are written once, in sets of pages, and never shuffled. A set sends the
first bits of its suffixes, sorted and compressed, to the tasks that compare
them, and gets a bit for each in return. Few suffixes repeat; those that may are
compared again, by 64 other bits and the page they are on.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import rows_of, stored, stored_by
from stocklens.llm.url_filters import with_host

LONG = 6  # tokens of a repeated string; each block starts with one that names its element
SET = 1 << 23  # characters of text of a set of pages, some million suffixes
SPARE = 6  # bits of a hash at first, beyond those that number all suffixes
GROUP = 23  # bits to number the suffixes that are compared in one group; more groups as there are more
SLOT, RANGE = 27, 10  # bits to number the slots for marks of repeated suffixes, and of those that both slots share
CONTENT, OPEN, NAMED, OTHER = 1, 0, -1, -2  # text; undecided; named as no text; no text by its kind

# Elements and the words in names of elements that say what is in them.
RAW = "script style textarea title iframe noembed noframes xmp".split()
VOID = frozenset("area base col embed hr img input link meta param source track wbr br".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q"
    " ruby rb rp rt s samp small span strike strong sub sup time tt u var picture audio video map object".split()
)
NOT_TEXT = frozenset(
    "nav footer aside form head noscript template select button svg math canvas dialog menu fieldset".split()
)
OTHER_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar"
    " navigation breadcrumb breadcrumbs sidebar footer masthead topbar cookie cookies consent notice notices gdpr popup"
    " modal overlay newsletter subscribe subscription signup login search share sharing social related recommended"
    " comment comments disqus reply replies widget toolbar pagination pager copyright disclaimer skip hidden".split()
)
CONTENT_WORDS = frozenset("article articlebody post entry story content main maintext bodytext".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
CLOSED_BY_NEXT = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b[^>]*+>.*?(?:</(?P=raw)\b[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+>|<[!?][^>]*+>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _state(name: str, given: dict[str, str], above: int) -> int:
    """What an element holds, by its name and attributes and by what it is in."""
    if above == OTHER or name in NOT_TEXT or "hidden" in given or given.get("aria-hidden") == "true":
        return OTHER
    if name in ("html", "body"):
        return above
    role = given.get("role", "").lower()
    words = {w.lower() for key in ("class", "id") for w in _WORD.findall(given.get(key, ""))}
    if above == NAMED or role in OTHER_ROLES or words & OTHER_WORDS:
        return NAMED
    if above == CONTENT:
        return CONTENT  # also what heads an article
    if name == "header" or "header" in words:
        return NAMED
    named = name in ("article", "main") or role in ("main", "article") or given.get("itemprop") == "articleBody"
    return CONTENT if named or words & CONTENT_WORDS else above


def blocks(page: str) -> list[tuple[int, str, str]]:
    """(state, element, text) of each block in page order.

    White space is one space, ``<br>`` too; character references are decoded
    within each piece of text. An element is named by its path.
    """
    found: list[tuple[int, str, str]] = []
    stack: list[tuple[str, int, str]] = [("", OPEN, "")]
    held: list[str] = []
    at = 0

    def end_block() -> None:
        if held:
            _, state, path = stack[-1]
            if text := " ".join("".join(held).split()):
                found.append((state, path, text))
            held.clear()

    def drop(k: int) -> None:
        end_block()
        del stack[k:]

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            held.append(html.unescape(piece) if "&" in piece else piece)
        at = m.end()
        name = m["name"]
        if name is None:  # comments, scripts, declarations
            continue
        name = name.lower()
        if name in INLINE:
            continue
        if name == "br":
            held.append(" ")
            continue
        if m["end"]:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name), 0)
            if k:
                drop(k)
            else:
                end_block()
            continue
        if stack[-1][0] == "p":  # closed by any block
            drop(len(stack) - 1)
        else:
            end_block()
        if name in VOID or m["more"].endswith("/"):
            continue
        if name in CLOSED_BY_NEXT:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in CLOSED_BY_NEXT[name]:
                    break
                if stack[k][0] == name or {stack[k][0], name} in ({"dt", "dd"}, {"td", "th"}):
                    drop(k)
                    break
        given = _attributes(m["more"]) if m["more"].strip() else {}
        label = f"{name}.{given.get('class', '')}#{given.get('id', '')}" if given else name
        path = f"{stack[-1][2]}/{_DIGITS.sub('0', label)}"
        stack.append((name, _state(name, given, stack[-1][1]), path))
    if at < len(page):
        held.append(html.unescape(page[at:]))
    end_block()
    return found


PAGES = (
    "set long, at int, page_id long, url string, host string, article boolean,"
    " blocks array<struct<element:string,state:int,text:string>>"
)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All blocks of every page; a set of pages is named after the row of its first one."""
    kind = pa.list_(pa.struct([("element", pa.string()), ("state", pa.int32()), ("text", pa.string())]))
    name = at = None
    size = 0
    for batch in rows_of(batches):
        sets, places, found = [], [], []
        for row, page in zip(batch.column("row").to_pylist(), batch.column("html"), strict=True):
            if name is None or size >= SET:
                name, at, size = row, 0, 0
            made = blocks(page.as_py() or "")
            size += sum(len(text) for _, _, text in made)
            sets.append(name)
            places.append(at)
            found.append([{"element": path, "state": state, "text": text} for state, path, text in made])
            at += 1
        articles = [any(b["state"] == CONTENT for b in made) for made in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sets, pa.int64()), pa.array(places, pa.int32()), *(batch.column(c) for c in ("page_id", "url", "host")),
             pa.array(articles, pa.bool_()), pa.array(found, kind)],
            names=["set", "at", "page_id", "url", "host", "article", "blocks"],
        )


def tokens(element: str, text: str) -> list[str]:
    """The tokens of a block: one for its element, then its words."""
    return ["\0" + element, *text.split()]


_SPREAD = [[np.uint64(pow(base, k, 1 << 64)) for k in range(LONG)] for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def _named(values: pa.Array, prefix: str = "", seed: int = 0) -> np.ndarray:
    """64 bits of every value."""
    coded = values.dictionary_encode()
    names = [xxhash.xxh3_64_intdigest(prefix + v, seed) for v in coded.dictionary.to_pylist()]
    return np.array(names, np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]


@dataclass
class Stream:
    """The tokens of a set of pages, page after page."""

    elements: pa.Array  # of blocks
    states: np.ndarray
    texts: pa.Array
    page_of: np.ndarray  # the page each block is of
    first: np.ndarray  # the first token of each block, and the end
    at: np.ndarray  # the tokens at which a suffix of ``LONG`` tokens starts
    heads: list[np.ndarray]  # the first tokens of these suffixes, as twice 64 bits with the host
    page: np.ndarray  # a number for the page_id each is of; -1 without one
    page_ids: np.ndarray  # by that number


def _stream(pages: pa.Table) -> Stream:
    listed = pages["blocks"].combine_chunks()
    flat = listed.flatten()
    elements, states, texts = (flat.field(k) for k in range(3))
    page_of = np.repeat(np.arange(len(pages)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
    words = pc.split_pattern(texts, " ")  # blocks have no other white space
    first = np.concatenate([[0], np.cumsum(1 + pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
    stream = np.zeros(first[-1], np.uint64)
    is_word = np.ones(len(stream), bool)
    is_word[first[:-1]] = False
    stream[first[:-1]] = _named(elements, "\0")
    stream[is_word] = _named(words.flatten())
    page_of_token = np.repeat(page_of, np.diff(first))
    n = max(0, len(stream) - LONG + 1)
    at = np.flatnonzero(page_of_token[:n] == page_of_token[len(stream) - n :])
    hosts = pages["host"].combine_chunks()
    heads = []
    for k, spread in enumerate(_SPREAD):
        head = np.zeros(n, np.uint64)
        for i, by in enumerate(spread):
            head += stream[i : i + n] * by
        heads.append(head[at] ^ _named(hosts, seed=k)[page_of_token[at]])
        stream = (stream ^ (stream >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)  # of other bits for the second half
    coded = pages["page_id"].combine_chunks().dictionary_encode()
    numbers = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    page_ids = coded.dictionary.to_numpy(zero_copy_only=False).astype(np.int64)
    return Stream(
        elements, states.to_numpy(zero_copy_only=False), texts, page_of, first, at, heads, numbers[page_of_token[at]], page_ids
    )


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 64 bits, by bytes of equal weight."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def _squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys, by their steps."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unsqueezed(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data), dtype=np.uint64)


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), count=n).astype(bool)


def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two slots of each key (its highest bits come first), both in the range of the key."""
    within = np.uint64(SLOT - RANGE)
    mixed = ((keys & ~np.uint64((1 << 64 - SLOT) - 1)) | (keys >> np.uint64(64 - SLOT))) * np.uint64(0x9E3779B97F4A7C15)
    second = (keys >> np.uint64(64 - RANGE) << within) | (mixed >> (np.uint64(64) - within))
    return (keys >> np.uint64(64 - SLOT)).astype(np.int64), second.astype(np.int64)


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where sorted keys (their highest bits come first) are cut into ``1 << ranges`` ranges."""
    return np.searchsorted(keys >> np.uint64(64 - ranges), np.arange((1 << ranges) + 1, dtype=np.uint64))


def _top(keys: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits, where they are."""
    return keys >> np.uint64(64 - bits) << np.uint64(64 - bits)


@dataclass
class Keys:
    """The different keys of a set, and for each key which of its pages have it."""

    keys: np.ndarray  # sorted
    which: np.ndarray  # the key of every suffix
    found: np.ndarray  # on a page with an id
    several: np.ndarray  # on pages with different ids
    page: np.ndarray  # the number of one of the pages


def _keys(keys: np.ndarray, page: np.ndarray) -> Keys:
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    if not len(starts):
        none = np.zeros(0, bool)
        return Keys(keys, which, none, none, which)
    pages = page[order]
    last = np.maximum.reduceat(pages, starts)
    least = np.minimum.reduceat(np.where(pages < 0, np.iinfo(pages.dtype).max, pages), starts)
    return Keys(ordered[starts], which, last >= 0, (last >= 0) & (least != last), last)


SENT = "range int, set long, bits int, keys binary, found binary, several binary, ids binary"
JUDGED = "round int, range int, set long, repeated binary"


def _sent(pages: pa.Table, of: Keys, page_ids: np.ndarray | None, bits: int, ranges: int) -> pa.Table:
    """The first ``bits`` bits of the keys by range; with the page of those on one page only, if ``page_ids`` are given."""
    cuts = _cuts(of.keys, ranges)
    keys = of.keys >> np.uint64(64 - bits)
    ids = None
    if page_ids is not None and len(keys):
        ids = np.zeros(len(keys), np.int64)
        lone = of.found & ~of.several
        ids[lone] = page_ids[of.page[lone]]
    rows = [
        (k, _squeezed(keys[a:z]), _bits(of.found[a:z]), _bits(of.several[a:z]), None if ids is None else _packed(ids[a:z]))
        for k, (a, z) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        if a < z
    ]
    name = pages["set"][0].as_py() if len(pages) else None
    return pa.table({
        "range": pa.array([r[0] for r in rows], pa.int32()),
        "set": pa.array([name] * len(rows), pa.int64()),
        "bits": pa.array([bits] * len(rows), pa.int32()),
        **{c: pa.array([r[k] for r in rows], pa.binary()) for k, c in enumerate(("keys", "found", "several", "ids"), 1)},
    })


def _compared(rows: pa.Table, number: int, ranges: int) -> pa.Table:
    """For every set and every key of a range, whether it is on several pages.

    Without ids keys in two sets pass for that: those of one page in two rows as well.
    """
    pieces = []
    for r in rows.to_pylist():
        keys = _unsqueezed(r["keys"]) << np.uint64(64 - r["bits"])
        ids = None if r["ids"] is None else _unpacked(r["ids"]).view(np.int64)
        pieces.append((keys, _flags(r["found"], len(keys)), _flags(r["several"], len(keys)), ids))
    keys = np.concatenate([p[0][p[1]] for p in pieces])
    several = np.concatenate([p[2][p[1]] for p in pieces])
    lone = [p[3] is None for p in pieces]
    ids = np.arange(len(keys)) if any(lone) else np.concatenate([p[3][p[1]] for p in pieces])
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    repeated = keys
    if len(starts):
        ids = ids[order]
        apart = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
        repeated = keys[starts][apart | np.logical_or.reduceat(several[order], starts)]
    marks = np.zeros(1 << (SLOT - min(ranges, RANGE)), bool)
    for slots in _slots(repeated):
        marks[slots & (len(marks) - 1)] = True
    found = []
    for own, *_ in pieces:
        here = np.ones(len(own), bool)
        for slots in _slots(own):
            here &= marks[slots & (len(marks) - 1)]
        some = np.flatnonzero(here)  # few more than there are
        if len(some):
            place = np.minimum(np.searchsorted(repeated, own[some]), len(repeated) - 1)
            here[some] = repeated[place] == own[some]
        found.append(_bits(here))
    return pa.table({
        "round": pa.array([number] * len(rows), pa.int32()),
        "range": rows["range"],
        "set": rows["set"],
        "repeated": pa.array(found, pa.binary()),
    })


def _answer(of: Keys, judged: pa.Table, number: int, ranges: int) -> np.ndarray:
    """For every suffix, whether its key was found on several pages."""
    cuts = _cuts(of.keys, ranges)
    repeated = np.zeros(len(of.keys), bool)
    for r in judged.to_pylist():
        if r["round"] == number:
            a, z = cuts[r["range"]], cuts[r["range"] + 1]
            repeated[a:z] = _flags(r["repeated"], z - a)
    return repeated[of.which]


FOUND = (
    "set long, at int, page_id long, url string, host string, element string, n long, repeated long,"
    " counts array<long>, left array<struct<element:string,text:string>>"
)


def _covered(pages: pa.Table, stream: Stream, starts: np.ndarray) -> pa.Table:
    """What repeated strings cover: tokens of each page of a set, tokens of each element, unique runs of undecided blocks."""
    repeated = np.zeros(stream.first[-1], bool)
    for i in range(LONG):
        repeated[starts + i] = True
    total = np.concatenate([[0], np.cumsum(repeated)])
    n, gone = np.diff(stream.first), np.diff(total[stream.first])
    counts = np.zeros(len(pages), np.int64)
    np.add.at(counts, stream.page_of, gone)
    place = pages["at"].to_numpy()
    hosts = pages["host"].combine_chunks()
    sums = pa.table({"host": hosts.take(pa.array(stream.page_of)), "element": stream.elements, "n": n, "repeated": gone})
    out = [
        {"set": pages["set"][0].as_py(), "counts": counts[np.argsort(place)].tolist()},
        *sums.group_by(["host", "element"]).aggregate([("n", "sum"), ("repeated", "sum")])
        .rename_columns(["host", "element", "n", "repeated"]).to_pylist(),
    ]
    ends = np.searchsorted(stream.page_of, np.arange(len(pages) + 1))
    for i in np.flatnonzero(~pages["article"].to_numpy()).tolist():
        left = []
        for b in range(ends[i], ends[i + 1]):
            if stream.states[b] == OPEN:
                element, text = stream.elements[b].as_py(), stream.texts[b].as_py()
                here = repeated[stream.first[b] : stream.first[b + 1]]
                runs = [t for t, g in zip(tokens(element, text)[1:], here[1:], strict=True) if not g]
                left.append({"element": element, "text": " ".join(runs)})
        given = {c: pages[c][i].as_py() for c in ("set", "at", "page_id", "url", "host")}
        out.append(given | {"repeated": int(counts[i]), "left": left})
    text, number = pa.string(), pa.int64()
    return pa.Table.from_pylist(out, pa.schema([
        ("set", number), ("at", pa.int32()), ("page_id", number), ("url", text), ("host", text), ("element", text),
        ("n", number), ("repeated", number), ("counts", pa.list_(number)),
        ("left", pa.list_(pa.struct([("element", text), ("text", text)]))),
    ]))


def _judged(sets: DataFrame, chars: int) -> DataFrame:
    """``FOUND`` of every set of pages."""
    many = (chars // 8).bit_length()  # bits to number about all suffixes
    bits, ranges = min(64, many + SPARE), max(7, many - GROUP)
    pages = sets.select("set", "at", "page_id", "host", "blocks").groupBy("set")

    def by_first(stream: Stream) -> Keys:
        return _keys(_top(stream.heads[0], bits), stream.page)

    def by_second(stream: Stream, judged: pa.Table) -> tuple[np.ndarray, Keys]:
        some = np.flatnonzero(_answer(by_first(stream), judged, 1, ranges))
        return some, _keys(stream.heads[1][some], stream.page[some])

    def send(pages: pa.Table) -> pa.Table:
        return _sent(pages, by_first(_stream(pages)), None, bits, ranges)

    def send_again(pages: pa.Table, judged: pa.Table) -> pa.Table:
        stream = _stream(pages)
        return _sent(pages, by_second(stream, judged)[1], stream.page_ids, 64, ranges)

    def cover(pages: pa.Table, judged: pa.Table) -> pa.Table:
        stream = _stream(pages)
        some, keys = by_second(stream, judged)
        return _covered(pages, stream, stream.at[some[_answer(keys, judged, 2, ranges)]])

    first = pages.applyInArrow(send, SENT).groupBy("range")
    once = stored(first.applyInArrow(lambda rows: _compared(rows, 1, ranges), JUDGED), "first")
    again = pages.cogroup(once.groupBy("set")).applyInArrow(send_again, SENT).groupBy("range")
    twice = stored(again.applyInArrow(lambda rows: _compared(rows, 2, ranges), JUDGED), "second")
    return stored(
        sets.groupBy("set").cogroup(once.union(twice).groupBy("set")).applyInArrow(cover, FOUND), "judged", "zstd"
    )


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_repeated of every page.

    ``n_repeated`` counts the tokens of the stream under strings of at least
    ``LONG`` tokens that start on another page of the host as well. Null and
    empty html has an empty text, a null url has the host ``""``, repeated rows
    stay and are no other page, nor is a page without an id, and other columns
    are not read.
    """
    # the host comes with the row it is of: page_id need not be unique
    given = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"),
    )
    hosted = with_host(given.select(F.struct("*").alias("page_id"), "url")).select("page_id.*", "host")
    chars = given.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    sets = stored_by(
        hosted.select("row", "page_id", "url", "host", "html").mapInArrow(_parsed, PAGES),
        "pages", "set", -(-chars // SET), "zstd",
    )
    judged = _judged(sets, chars)
    template = (
        judged.where("element IS NOT NULL")
        .groupBy("host", "element")
        .agg(F.sum("n").alias("n"), F.sum("repeated").alias("repeated"))
        .where("2 * repeated > n")
        .select("host", "element")
    )
    undecided = judged.where("left IS NOT NULL")
    runs = undecided.select("set", "at", "host", F.posexplode("left").alias("k", "b")).select(
        "set", "at", "host", "k", "b.element", "b.text"
    )
    texts = (
        runs.where("text <> ''").join(template, ["host", "element"], "left_anti")
        .groupBy("set", "at")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "text"))), lambda x: x["text"]), "\n").alias("text"))
    )
    rest = undecided.join(texts, ["set", "at"], "left").select(
        "page_id", "url", F.coalesce("text", F.lit("")).alias("text"), F.col("repeated").alias("n_repeated")
    )
    counts = judged.where("counts IS NOT NULL").select("set", "counts")
    whole = F.array_join(F.transform(F.filter("blocks", lambda b: b["state"] == CONTENT), lambda b: b["text"]), "\n")
    articles = sets.where("article").join(counts, "set").select(
        "page_id", "url", whole.alias("text"), F.get("counts", F.col("at")).alias("n_repeated")
    )
    return articles.union(rest).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
