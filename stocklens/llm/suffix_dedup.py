"""Repeated strings of 100 bytes removed from texts, across the whole corpus.

A suffix array over every byte would sort a tuple of 16 bytes or more for each
byte of the corpus. Only equality of the first 100 bytes of suffixes matters
here, so a sample of the suffixes is sorted and everything else is induced from
it, level by level:

1. Sample. Of the 32-byte grams inside a string of 100 bytes, the least by hash
   (the leftmost of equal ones) is its anchor. Equal strings have equal anchors
   at the same place, so comparing suffixes at anchors finds every repeat, and
   an anchor serves 35 neighbouring strings on average. A stretch of strings
   with one anchor becomes one tuple: gram, name of the stretch, place.
2. Sort. Tuples are shuffled and sorted by gram and name. Of equal stretches all
   but the earliest are repeats as a whole.
3. Induce. Only where a gram comes with different stretches (at the ends of a
   passage) are the single strings of the earliest stretches named and sorted
   by name, and all but the earliest of each name are repeats.

Tasks drop what they can decide alone: of equal tuples in one task only the
earliest goes on, so a group of copies sends one tuple per task. Names are
128 bits (64 of the gram, 64 of the rest).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import rows_of, stored, texts_of

LENGTH = 100
GRAM = 32
PLACES = LENGTH - GRAM + 1
PIECE = 60_000  # strings handled at a time
FLUSH = 1 << 22  # bytes whose tuples are gathered in a task
BUCKET = 1 << 23  # bytes of text meant for a bucket
BITS = 24

_BYTE_NAMES = np.array([xxhash.xxh64_intdigest(bytes([i])) for i in range(256)], np.uint64)


def _grams(piece: np.ndarray) -> np.ndarray:
    """A hash of the gram at every place."""
    h, m = _BYTE_NAMES[piece], 1
    while m < GRAM:
        h = h[:-m] * np.uint64(0x9E3779B97F4A7C15) + h[m:]
        h ^= h >> np.uint64(29)
        m *= 2
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def stretches(data: bytes) -> tuple[np.ndarray, ...]:
    """Grams, names, first and last starts of the stretches of strings that share an anchor."""
    found = []
    whole = np.frombuffer(data, np.uint8)
    strings = len(data) - LENGTH + 1
    name = xxhash.xxh3_64_intdigest
    for base in range(0, max(strings, 0), PIECE):
        n = min(PIECE, strings - base)
        grams = _grams(whole[base : base + n + LENGTH - 1])
        least = (grams & ~np.uint64(0xFFFF)) | np.arange(len(grams), dtype=np.uint64)
        m = 1
        while 2 * m <= PLACES:
            least = np.minimum(least[:-m], least[m:])
            m *= 2
        least = np.minimum(least[:n], least[PLACES - m : PLACES - m + n])
        anchors = (least & np.uint64(0xFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        last = np.append(first[1:], n) - 1
        at = anchors[first]
        gram, first, last, seed = grams[at], first + base, last + base, (at - first).tolist()
        spans = zip(first.tolist(), (last + LENGTH).tolist(), seed, strict=True)
        names = np.fromiter((name(data[f:e], s) for f, e, s in spans), np.uint64, len(at))
        found.append((gram, names, first, last))
    if len(found) == 1:
        return found[0]
    if not found:
        return (*(np.zeros(0, np.uint64),) * 2, *(np.zeros(0, np.int64),) * 2)
    return tuple(map(np.concatenate, zip(*found, strict=True)))


# ---- packed tuples ----------------------------------------------------------------------
#
# A row holds the tuples of one bucket: two names of 64 bits, the place of the
# document in the row's list of documents, and the first and last start.

PACKED = "bucket int, kind int, ids binary, texts binary, a binary, b binary, doc binary, first binary, last binary"
NAMES = [c.split()[0] for c in PACKED.split(", ")]
_TYPES = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *[(n, pa.binary()) for n in NAMES[2:]]])
TUPLES, RANGES, WANTED = 0, 1, 2


class Tuples:
    """Columns of tuples; a document is its id and the hash of its text."""

    __slots__ = ("ids", "texts", "a", "b", "first", "last")

    def __init__(self, ids, texts, a, b, first, last):
        self.ids, self.texts, self.a, self.b, self.first, self.last = ids, texts, a, b, first, last

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at) -> Tuples:
        return Tuples(*(getattr(self, c)[at] for c in self.__slots__))


def _order(t: Tuples) -> np.ndarray:
    """By name, then earliest first."""
    return np.lexsort((t.first, t.texts, t.ids, t.b, t.a))


def _new(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _documents(t: Tuples) -> np.ndarray:
    """A hash of the document, which deals and marks it."""
    h = (t.ids.view(np.uint64) ^ (t.texts.view(np.uint64) >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ t.texts.view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _deal(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of hashes; mixed first, as the grams of anchors are the small ones."""
    hashes = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _pack(t: Tuples, kind: int, hashes: np.ndarray, buckets: int, offset: int = 0) -> list[list]:
    if not len(t):
        return []
    bucket = _deal(hashes, buckets).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    t, bucket = t.take(order), bucket[order]
    starts = np.flatnonzero(_new(bucket))
    rows = []
    for start, stop in zip(starts, [*starts[1:], len(bucket)], strict=True):
        part = t.take(slice(start, stop))
        by_doc = np.lexsort((part.texts, part.ids))
        new = _new(part.ids[by_doc], part.texts[by_doc])
        place = np.empty(len(part), np.uint32)
        place[by_doc] = np.cumsum(new) - 1
        rows.append([
            int(bucket[start]) + offset, kind, part.ids[by_doc][new].tobytes(), part.texts[by_doc][new].tobytes(),
            part.a.tobytes() if kind == TUPLES else b"", part.b.tobytes() if kind == TUPLES else b"",
            place.tobytes(), part.first.astype(np.uint32).tobytes(), (part.last - part.first).astype(np.uint32).tobytes(),
        ])
    return rows


def _batch(rows: list[list]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _TYPES]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _TYPES, strict=True)], schema=_TYPES)


def _unpack(rows: pd.DataFrame) -> Tuples:
    ids, texts = [], []
    for i, x, d in zip(rows["ids"], rows["texts"], rows["doc"], strict=True):
        place = np.frombuffer(d, np.uint32)
        ids.append(np.frombuffer(i, np.int64)[place])
        texts.append(np.frombuffer(x, np.int64)[place])
    join = lambda c, kind: np.frombuffer(b"".join(rows[c]), kind)
    first = join("first", np.uint32).astype(np.int64)
    none = np.zeros(0, np.int64)
    return Tuples(
        np.concatenate(ids) if ids else none, np.concatenate(texts) if texts else none,
        join("a", np.uint64), join("b", np.uint64), first, first + join("last", np.uint32),
    )


def _merged(t: Tuples) -> Tuples:
    """Ranges of starts that touch or overlap, joined; names are dropped."""
    if not len(t):
        return t
    order = np.lexsort((t.last, t.first, t.texts, t.ids))
    ids, texts, first, last = t.ids[order], t.texts[order], t.first[order], t.last[order]
    doc = np.cumsum(_new(ids, texts))
    # the furthest end so far in the document; documents are kept apart by a large step
    step = int(last.max()) + 2
    reach = np.maximum.accumulate(last + doc * step)
    new = np.ones(len(ids), bool)
    new[1:] = first[1:] + doc[1:] * step > reach[:-1] + 1
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(ids)) - 1
    none = np.zeros(len(start), np.uint64)
    return Tuples(ids[start], texts[start], none, none, first[start], reach[end] - doc[end] * step)


def _earliest(t: Tuples) -> tuple[Tuples, Tuples]:
    """Of each name the earliest tuple, in order, and all later ones.

    Equal rows of the table have the same document and place; none is later than the other.
    """
    t = t.take(_order(t))
    new = _new(t.a, t.b)
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    same = (t.ids == t.ids[group]) & (t.texts == t.texts[group]) & (t.first == t.first[group])
    return t.take(new), t.take(~new & ~same)


# ---- passes -----------------------------------------------------------------------------


def _source(docs: DataFrame) -> DataFrame:
    """doc_id (null: the largest), the hash of the text, data."""
    return texts_of(docs).select(
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.xxhash64("data").alias("text"), "data",
        F.col("doc_id").isNull().alias("missing"),
    )


def _tuples(source: DataFrame, buckets: int) -> DataFrame:
    """Stretches by the bucket of their gram; repeats inside a task as ranges (bucket: of the document)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def flush() -> pa.RecordBatch:
            first, later = _earliest(Tuples(*(np.concatenate(c) for c in zip(*parts, strict=True))))
            later = _merged(later)
            rows = _pack(first, TUPLES, first.a, buckets)
            return _batch(rows + _pack(later, RANGES, _documents(later), buckets, offset=buckets))

        for batch in rows_of(batches):
            for doc, text, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = data.as_py()
                if len(raw) < LENGTH:
                    continue
                found = stretches(raw)
                n = len(found[0])
                parts.append((np.full(n, doc, np.int64), np.full(n, text, np.int64), *found))
                held += len(raw)
                if held >= FLUSH:
                    yield flush()
                    parts, held = [], 0
        if parts:
            yield flush()

    return source.select("id", "text", "data").mapInArrow(compute, PACKED)


def _sorted_tuples(packed: DataFrame, buckets: int) -> DataFrame:
    """Ranges that repeat, and stretches whose single strings have to be compared, by document."""

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        out = [list(r) for r in rows[rows["kind"] == RANGES].itertuples(index=False)]
        rows = rows[rows["kind"] == TUPLES]
        if len(rows):
            first, later = _earliest(_unpack(rows))
            later = _merged(later)
            grams = np.flatnonzero(_new(first.a))
            several = np.repeat(np.diff(np.append(grams, len(first))) > 1, np.diff(np.append(grams, len(first))))
            wanted = first.take(several)
            out += _pack(later, RANGES, _documents(later), buckets, offset=buckets)
            out += _pack(wanted, WANTED, _documents(wanted), buckets, offset=buckets)
        return pd.DataFrame(out, columns=NAMES)

    return packed.groupBy("bucket").applyInPandas(sort, PACKED)


def _marks(ranges: DataFrame) -> np.ndarray:
    """A bit table of fixed size (2 MB) over the documents of packed rows; it only spares work."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (BITS - 3), np.uint8)
        for batch in batches:
            for row in batch.to_pylist():
                n = np.zeros(len(row["ids"]) // 8, np.uint64)
                t = Tuples(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["texts"], np.int64), n, n, n, n)
                for s in _slots(_documents(t)):
                    np.bitwise_or.at(table, s >> 3, (1 << (s & 7)).astype(np.uint8))
        words = table.view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(words[at])], names=["at", "bits"])

    found = ranges.select("ids", "texts").mapInArrow(slots, "at long, bits long")
    table = np.zeros(1 << (BITS - 6), np.int64)
    for row in found.groupBy("at").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
        table[row.at] = row.bits
    return table.view(np.uint8)


def _slots(hashes: np.ndarray) -> list[np.ndarray]:
    return [((hashes >> np.uint64(s)) & np.uint64((1 << BITS) - 1)).astype(np.int64) for s in (0, 19, 38)]


def _marked(batch: pa.RecordBatch, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a batch's documents, and which of them are marked."""
    ids, texts = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    n = np.zeros(len(ids), np.uint64)
    hashes = _documents(Tuples(ids, texts, n, n, n, n))
    inside = np.ones(len(ids), bool)
    for s in _slots(hashes):
        inside &= (bits[s >> 3] >> (s & 7)) & 1 == 1
    return hashes, inside


def _dealt(source: DataFrame, marks: np.ndarray, buckets: int) -> DataFrame:
    """The documents that are marked, with their bucket."""
    known = source.sparkSession.sparkContext.broadcast(marks)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            hashes, inside = _marked(batch, known.value)
            bucket = pa.array((_deal(hashes, buckets).astype(np.int64) + buckets).astype(np.int32))
            out = pa.RecordBatch.from_arrays([bucket, *batch.columns], names=["bucket", "id", "text", "data", "missing"])
            yield out.filter(pa.array(inside))

    return source.mapInArrow(deal, "bucket int, id long, text long, data binary, missing boolean")


def _strings(docs: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """The single strings of the wanted stretches, by the bucket of their name."""

    def name(docs: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(docs) or not len(wanted):
            return pd.DataFrame([], columns=NAMES)
        t = _unpack(wanted)
        data = {(i, x): d for i, x, d in zip(docs["id"], docs["text"], docs["data"], strict=True)}
        parts = []
        one, two = xxhash.xxh3_64_intdigest, xxhash.xxh64_intdigest
        for i, x, first, last in zip(t.ids.tolist(), t.texts.tolist(), t.first.tolist(), t.last.tolist(), strict=True):
            text = data[i, x]
            strings = [text[p : p + LENGTH] for p in range(first, last + 1)]
            parts.append((
                np.full(len(strings), i, np.int64), np.full(len(strings), x, np.int64),
                np.array([one(s) for s in strings], np.uint64), np.array([two(s) for s in strings], np.uint64),
                np.arange(first, last + 1), np.arange(first, last + 1),
            ))
        first, later = _earliest(Tuples(*(np.concatenate(c) for c in zip(*parts, strict=True))))
        later = _merged(later)
        rows = _pack(first, TUPLES, first.a, buckets)
        return pd.DataFrame(rows + _pack(later, RANGES, _documents(later), buckets, offset=buckets), columns=NAMES)

    return docs.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInPandas(name, PACKED)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(data: bytes, first: np.ndarray, last: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, maximal runs of them, and what is left."""
    n = len(data)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, last + LENGTH, -1)
    gone = np.cumsum(edges[:n]) > 0
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (n and gone[0]))
    return int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()


def deduplicated(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept bytes of every document.

    A byte goes if a string of 100 bytes that covers it starts earlier too: in
    a smaller doc_id, or further left in the same document. Null text counts as
    empty; texts under 100 bytes stay whole. A null id comes after all others;
    rows with the same id but other text are ordered by the text's hash, and
    equal rows count as one document and get equal results.
    """
    source = _source(docs)
    total = source.agg(F.sum(F.length("data"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    found = stored(_sorted_tuples(_tuples(source, buckets), buckets), "stretches")
    ranges, wanted = found.where(F.col("kind") == RANGES), found.where(F.col("kind") == WANTED)
    strings = _strings(_dealt(source, _marks(wanted), buckets), wanted, buckets)
    single = stored(
        _sorted_tuples(strings, buckets).where(F.col("kind") == RANGES), "strings"
    )
    ranges = ranges.union(single)
    marks = _marks(ranges)
    known = docs.sparkSession.sparkContext.broadcast(marks)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that are not marked; in the same worker that tells so, as each takes memory."""
        for batch in rows_of(batches):
            batch = batch.filter(pa.array(~_marked(batch, known.value)[1]))
            texts = [t.as_py() for t in batch.column(2)]
            ids = [None if m else i for i, m in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            zero = pa.array([0] * len(texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), zero, zero,
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                    pa.array(texts if with_kept else [b""] * len(texts), pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    def cut(docs: pd.DataFrame, ranges: pd.DataFrame) -> pd.DataFrame:
        t = _merged(_unpack(ranges))
        starts = np.flatnonzero(_new(t.ids, t.texts)) if len(t) else []
        here = {
            (int(t.ids[s]), int(t.texts[s])): slice(s, e) for s, e in zip(starts, [*starts[1:], len(t)], strict=True)
        }
        out = []
        for row in docs.itertuples(index=False):
            at = here.get((row.id, row.text), slice(0, 0))
            removed, spans, kept = _kept(row.data, t.first[at], t.last[at])
            out.append([
                None if row.missing else row.id, len(row.data), removed, spans, hashlib.sha256(kept).hexdigest(),
                kept if with_kept else b"",
            ])
        frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
        return frame.astype({"doc_id": "Int64"})

    schema = RESULT + ", kept binary"
    untouched = source.mapInArrow(whole, schema)
    touched = _dealt(source, marks, buckets)
    changed = touched.groupBy("bucket").cogroup(ranges.groupBy("bucket")).applyInPandas(cut, schema)
    found = untouched.union(changed)
    return found if with_kept else found.drop("kept")
