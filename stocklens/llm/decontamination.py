"""Benchmark passages in documents, found by spaced seeds.

Texts become sequences of lower-case words. A seed is a fixed mask over
consecutive words; words where the mask has 0 are ignored, so a passage with
some words replaced still has positions where a mask meets only kept words.
Hashes of masked windows of both sides are joined, and around each hit the two
texts are compared word by word on its diagonal.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import rows_of, set_apart, stored, texts_of

# Fixed masks of seven words each. Wherever replaced words lie in a stretch of 13
# to 25 words, at most a fifth of them, one mask meets none; a longer stretch can
# be cut into such pieces, one of which has its share. Tests try all places.
MASKS = ("11011111", "111101011", "11001000011011", "1110010001011", "111000100111")
# The same for items that count only as a whole, by their number of words.
SHORT_MASKS = {
    5: ("1111", "10111", "11011", "11101"),
    6: ("11101", "100111"),
    7: ("111011", "1101101", "101111"),
    8: ("111011", "11011001"),
    9: ("1111011", "110011101"),
    10: ("1111011", "11001111", "1110100011", "1101010101", "10110111"),
    11: ("1101111", "1100011011", "111100011"),
    12: ("11011111", "111101011", "11000110111", "111110000011"),
}
MIN_OVERLAP = 13
MIN_ITEM = 5
SIMILARITY = 0.8
BITS = 24
SHIFTS = (0, 20, 40)
WORDS = re.compile(r"\w+")

_FACTORS = np.array([xxhash.xxh64_intdigest(bytes([i])) | 1 for i in range(64)], np.uint64)


class _Words(dict):
    """Word hashes, computed on first sight; starts anew when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _tokens(text: str, seen: _Words) -> np.ndarray:
    words = WORDS.findall(text.lower())
    return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """A hash for every place of the mask."""
    n = len(tokens) - len(mask) + 1
    total = np.full(max(n, 0), int(mask, 2) * 64 + len(mask), np.uint64)
    if n > 0:
        for i, bit in enumerate(mask):
            if bit == "1":
                total += tokens[i : i + n] * _FACTORS[i]
    return _mix(total)


def _slot(hashes: np.ndarray, shift: int) -> np.ndarray:
    return ((hashes >> np.uint64(shift)) & np.uint64((1 << BITS) - 1)).view(np.int64)


def _longest(same: np.ndarray, similarity: float) -> tuple[int, int, int]:
    """Longest stretch in which the share of equal words is ``similarity``: start, end, equal."""
    equal = np.concatenate([[0], np.cumsum(same)])
    gain = 10 * equal - np.arange(len(equal)) * round(10 * similarity)  # whole numbers
    lowest = np.minimum.accumulate(gain)
    # for each end, the first start whose gain is not above that of the end
    starts = np.searchsorted(-lowest, -gain, side="left")
    lengths = np.arange(len(gain)) - starts
    end = int(np.argmax(lengths))
    start = int(starts[end])
    return start, end, int(equal[end] - equal[start])


def _masks(lengths: list[int]) -> list[str]:
    """The masks for items of these numbers of words, each once."""
    return list(dict.fromkeys(m for n in sorted(lengths, reverse=True) for m in SHORT_MASKS.get(n, MASKS)))


def _item_seeds(items: DataFrame) -> DataFrame:
    """item_id, tokens, and its seeds as hash and place; items below five words have none."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Words()
        for batch in rows_of(batches):
            ids, packed, hashes, places = [], [], [], []
            for item, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = _tokens(data.as_py().decode(errors="replace"), seen)
                n = len(tokens)
                found, at = [], []
                for mask in _masks([n]) if n >= MIN_ITEM else ():
                    seeds = _seeds(tokens, mask)
                    found += seeds.view(np.int64).tolist()
                    at += range(len(seeds))
                ids.append(item)
                packed.append(tokens.tobytes())
                hashes.append(found)
                places.append(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(packed, pa.binary()),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=["item_id", "tokens", "hashes", "places"],
            )

    source = texts_of(items.withColumnRenamed("item_id", "doc_id"))
    return source.mapInArrow(
        compute, "item_id long, tokens binary, hashes array<long>, places array<int>"
    )


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_overlap, n_equal): passages of items in documents.

    A passage is a stretch of at least 13 words (the whole item where it is
    shorter) that lie opposite each other on one diagonal, 0.8 or more of them
    equal; per pair the longest one is returned. Items below five words are
    left out. Null and empty texts hold nothing. A document without an id is
    reported under null, and repeated rows once.

    What is broadcast is a bit table of fixed size (2 MB) over the items'
    hashes, the number of words in the longest item, and the masks for the
    lengths that occur. It only spares rows; the join on the hashes decides.
    """
    spark = docs.sparkSession
    items = stored(_item_seeds(items), "items")
    seeds = items.select(
        "item_id", F.explode(F.arrays_zip("hashes", "places")).alias("s")
    ).select("item_id", F.col("s.hashes").alias("hash"), F.col("s.places").alias("place"))

    sizes = items.select((F.length("tokens") / 8).cast("int").alias("n"))
    widest = sizes.agg(F.max("n")).first()[0] or 0
    cut = F.least("n", F.lit(MIN_OVERLAP)).alias("n")
    masks = _masks([r.n for r in sizes.where(F.col("n") >= MIN_ITEM).select(cut).distinct().collect()])
    span = max(map(len, masks), default=0)
    slot = F.explode(F.array(*[
        F.shiftrightunsigned("hash", s).bitwiseAND(F.lit((1 << BITS) - 1)) for s in SHIFTS
    ]))
    filled = (
        seeds.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 5).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))").alias("bits"))
    )
    table = np.zeros(1 << (BITS - 5), np.uint32)
    for row in filled.toLocalIterator():
        table[row.word] = row.bits
    known = spark.sparkContext.broadcast(table)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, bits = _Words(), known.value

        def may_hit(hashes: np.ndarray) -> np.ndarray:
            at = None
            for shift in SHIFTS:
                s = _slot(hashes if at is None else hashes[at], shift)
                hit = (bits[s >> 5] >> (s & 31).astype(np.uint32)) & 1 == 1
                at = np.flatnonzero(hit) if at is None else at[hit]
            return at

        def hits_of(texts: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            """Document, places and hashes of hits; texts are laid out with gaps that match nothing."""
            gap = np.zeros(span, np.uint64)
            line = np.concatenate([x for t in texts for x in (t, gap)])
            starts = np.cumsum([0, *(len(t) + span for t in texts)])
            places, hashes = [], []
            for mask in masks:
                found = _seeds(line, mask)
                at = may_hit(found)
                places.append(at)
                hashes.append(found[at])
            if not masks:
                return
            places, hashes = np.concatenate(places), np.concatenate(hashes)
            order = np.argsort(places, kind="stable")
            places, hashes = places[order], hashes[order]
            docs = np.searchsorted(starts, places, side="right") - 1
            for doc in np.unique(docs).tolist():
                here = slice(*np.searchsorted(docs, [doc, doc + 1]))
                yield doc, places[here] - starts[doc], hashes[here]

        for batch in rows_of(batches):
            out = {"doc_id": [], "start": [], "tokens": [], "hashes": [], "places": []}
            ids = batch.column(0).to_pylist()
            texts = [_tokens(t.as_py().decode(errors="replace"), seen) for t in batch.column(1)]
            for number, places, hashes in hits_of(texts):
                doc, tokens = ids[number], texts[number]
                # hits further apart than the longest item have nothing in common
                for part in np.split(np.arange(len(places)), np.flatnonzero(np.diff(places) > widest) + 1):
                    first = max(0, int(places[part[0]]) - widest)
                    out["doc_id"].append(doc)
                    out["start"].append(first)
                    out["tokens"].append(tokens[first : int(places[part[-1]]) + span + widest].tobytes())
                    out["hashes"].append(hashes[part].view(np.int64).tolist())
                    out["places"].append((places[part] - first).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["doc_id"], pa.int64()),
                    pa.array(out["start"], pa.int64()),
                    pa.array(out["tokens"], pa.binary()),
                    pa.array(out["hashes"], pa.list_(pa.int64())),
                    pa.array(out["places"], pa.list_(pa.int32())),
                ],
                names=list(out),
            )

    found = texts_of(docs).mapInArrow(
        candidates,
        "doc_id long, start long, tokens binary, hashes array<long>, places array<int>",
    )
    found = stored(found.withColumn("part", F.xxhash64("doc_id", "start", "tokens")), "seeds")
    hits = found.select("part", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "part", F.col("s.hashes").alias("hash"), F.col("s.places").alias("at")
    )
    diagonals = (
        hits.join(seeds, "hash")
        .select("part", "item_id", (F.col("at") - F.col("place")).alias("shift"))
        .groupBy("part", "item_id")
        .agg(F.collect_set("shift").alias("shifts"))
    )
    parts = found.select("part", "doc_id", F.col("tokens").alias("text")).dropDuplicates(["part"])
    pairs = diagonals.join(parts, "part").join(items.select("item_id", "tokens"), "item_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            docs_, items_, lengths, equals = [], [], [], []
            for row in batch.to_pylist():
                text = np.frombuffer(row["text"], np.uint64)
                item = np.frombuffer(row["tokens"], np.uint64)
                best = (0, 0)
                for shift in row["shifts"]:
                    low, high = max(0, -shift), min(len(item), len(text) - shift)
                    same = item[low:high] == text[low + shift : high + shift]
                    start, end, equal = _longest(same, SIMILARITY)
                    best = max(best, (end - start, equal))
                if best[0] >= min(MIN_OVERLAP, len(item)):
                    docs_.append(row["doc_id"])
                    items_.append(row["item_id"])
                    lengths.append(best[0])
                    equals.append(best[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (docs_, items_, lengths, equals)],
                names=["doc_id", "item_id", "n_overlap", "n_equal"],
            )

    checked = pairs.select("doc_id", "item_id", "shifts", "text", "tokens").mapInArrow(
        verify, "doc_id long, item_id long, n_overlap long, n_equal long"
    )
    best = F.max(F.struct("n_overlap", "n_equal")).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def without_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` less the documents that hold a passage of an item; columns stay."""
    found = contaminated(docs, items).select(F.col("doc_id").alias("leaked_")).distinct()
    found = stored(found, "leaked")
    docs, named = set_apart(docs)
    return named(docs.join(found, F.col("doc_id").eqNullSafe(F.col("leaked_")), "left_anti"))
