"""Alignment of the tokens that two tokenizers make of the same text.

Both libraries say which characters a token covers. Where a token of each ends
at the same character, the text is cut; only where a character is spread over
several tokens (bytes of it, or byte pieces) are the decoded bytes of the
tokens compared as well. What lies between two cuts is a group, and all its
tokens of one side are linked with all of the other.

Neither tokenizer joins anything across a space that follows a character which
is no white space, so texts are aligned in such fragments, and a worker keeps
those it has seen. Linked pairs of ids are kept with each document, counted in
Spark by document, and looked up: the most frequent ones, at most ``HOT``, in a
broadcast table, all others by a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import rows_of, stored, texts_of

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
HOT = 1 << 18  # pairs of ids that are looked up without a join
SEEN = 800_000  # fragments a worker keeps
LARGE = 256  # links of a group from which on equal ids are counted first
FLUSH = 1 << 21  # pairs that are counted at a time

_APART = re.compile(r"(?<=\S)(?= )")
_SPACED = re.compile(r"\s ")


@dataclass(frozen=True)
class Models:
    """The two model files, read where the job is started."""

    byte_level: str
    pieces: bytes


def load(byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> Models:
    return Models(Path(byte_level).read_text(encoding="utf-8"), Path(pieces).read_bytes())


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as it is, other bytes from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        found[chr(0x100 + n)] = b
    return found


def cuts(spans: np.ndarray) -> np.ndarray:
    """Tokens that cover a character at which they end and that the next token has no part of."""
    following = np.r_[spans[1:, 0], spans[-1:, 1]]
    return np.flatnonzero((spans[:, 1] > spans[:, 0]) & (following >= spans[:, 1]))


def common_ends(a: list[int], b: list[int]) -> Iterator[tuple[int, int]]:
    """Where two runs of byte lengths reach the same sum: tokens of each so far."""
    i = j = at_a = at_b = 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            at_a, i = at_a + a[i], i + 1
        elif j < len(b):
            at_b, j = at_b + b[j], j + 1
        else:
            return
        if at_a == at_b and at_a:
            yield i, j


class Aligner:
    """Both tokenizers, and what became of the fragments seen so far."""

    def __init__(self, models: Models, keep: int = SEEN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs tasks side by side
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(models.byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=models.pieces)
        byte_of = _byte_of_character()
        names_a = {i: t for t, i in self.a.get_vocab().items()}
        top = max(names_a, default=-1) + 1
        self.bytes_a = [bytes(byte_of.get(c, 0) for c in names_a.get(i, "")) for i in range(top)]
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.byte_pieces = {i for i in range(size) if self.b.is_byte(i)}
        self.bytes_b = [
            bytes([int(n[3:5], 16)]) if i in self.byte_pieces else n.replace(SPACE, " ").encode() for i, n in enumerate(names)
        ]
        self.n_b = size
        # no piece holds a space after another character, else texts are aligned whole
        self.in_fragments = not any(re.search(f"[^{SPACE}]{SPACE}", n) for n in names)
        as_bytes = np.zeros(size, bool)
        as_bytes[list(self.byte_pieces)] = True
        self.is_byte_piece = as_bytes
        self.comma_a, self.bar_a = [f"{i}," for i in range(top)], [f"{i}|" for i in range(top)]
        self.comma_b, self.end_b = [f"{i}," for i in range(size)], [f"{i};" for i in range(size)]
        self.keep = keep
        self.place: dict[str, int] = {}
        self.texts: list[str] = []  # groups as written in the digest, a semicolon after each
        self.pairs: list[bytes] = []  # pairs and their links, both as uint32
        self.numbers = np.zeros((keep, 4), np.int64)  # a, b, groups, links; -1 where bytes differ
        self.uses = np.zeros(keep, np.int64)
        self.learn([""])

    def forget(self) -> None:
        """Half of the fragments go, those that fewer texts had."""
        n = len(self.texts)
        stay = np.sort(np.argsort(-self.uses[:n], kind="stable")[: self.keep // 2])
        names = list(self.place)
        self.place = {names[i]: k for k, i in enumerate(stay.tolist())}
        self.texts = [self.texts[i] for i in stay.tolist()]
        self.pairs = [self.pairs[i] for i in stay.tolist()]
        self.numbers[: len(stay)], self.uses[: len(stay)] = self.numbers[stay], self.uses[stay]
        self.uses[len(stay) :] = 0

    def fragments(self, text: str) -> list[str]:
        """The text after the space put in front, cut before spaces that follow a character; without that space."""
        if not self.in_fragments:
            return [text]
        marked = " " + text
        if "  " not in marked and not _SPACED.search(marked):
            return marked.split(" ")[1:]
        return [f[1:] for f in _APART.split(marked)]

    def _refined(self, a: list[int], b: list[int]) -> list[tuple[int, int]]:
        """Ends of the groups of a stretch, by decoded bytes: tokens of each so far."""
        return list(common_ends([len(self.bytes_a[i]) for i in a], [len(self.bytes_b[i]) for i in b]))

    def _keep(self, fragments: list[str], numbers: np.ndarray, texts: list[str], pairs: list[bytes]) -> None:
        start = len(self.texts)
        end = start + len(fragments)
        while end > len(self.numbers):  # one slice of documents may hold more than is kept after it
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.place.update(zip(fragments, range(start, end), strict=True))
        self.texts += texts
        self.pairs += pairs
        self.numbers[start:end], self.uses[start:end] = numbers, 0

    def learn(self, fragments: list[str]) -> None:
        """Aligns fragments not seen before: together where a space may stand between them."""
        alone = [f for f in fragments if not f or f[-1].isspace()]
        together = fragments
        if alone:
            apart = set(alone)
            together = [f for f in fragments if f not in apart]
        if not self._learn(together):
            alone += together
        for f in alone:
            if not self._learn([f]):
                self._keep([f], np.array([[-1, 0, 0, 0]]), [""], [b""])

    def _learn(self, fragments: list[str]) -> bool:
        """Whether both tokenizers give the bytes of the joined fragments back; if so, they are kept."""
        if not fragments:
            return True
        text = " ".join(fragments)
        left = self.a.encode(" " + text, add_special_tokens=False)
        ids_a, spans_a = left.ids, left.offsets
        if text:
            right = self.b.encode(text, return_type="offset_mapping")
            ids_b, spans_b = right["ids"], right["offsets"]
        else:  # a space at a text's end, of which the second library gives nothing by itself
            ids_b, spans_b = [self.b.piece_to_id(SPACE)], [(0, 0)]
        data = (" " + text).encode()
        if b"".join([self.bytes_b[i] for i in ids_b]) != data or b"".join([self.bytes_a[i] for i in ids_a]) != data:
            return False
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        at_a = np.fromiter(chain.from_iterable(spans_a), np.int64, 2 * len(a)).reshape(-1, 2)
        at_b = np.fromiter(chain.from_iterable(spans_b), np.int64, 2 * len(b)).reshape(-1, 2) + 1
        at_b[0, 0] = 0  # the space in front has no place in the second library's text
        cut_a, cut_b = cuts(at_a), cuts(at_b)
        ends, of_a, of_b = np.intersect1d(at_a[cut_a, 1], at_b[cut_b, 1], assume_unique=True, return_indices=True)
        to_a, to_b = cut_a[of_a] + 1, cut_b[of_b] + 1

        # stretches with characters spread over tokens, on both sides of more than one token
        shared = np.zeros(len(a) + 1, np.int64)
        shared[1:-1] = at_a[1:, 0] < at_a[:-1, 1]
        odd = np.add.reduceat(shared[1:], np.r_[0, to_a[:-1]]) + np.add.reduceat(self.is_byte_piece[b].astype(np.int64), np.r_[0, to_b[:-1]])
        many = (np.diff(to_a, prepend=0) > 1) & (np.diff(to_b, prepend=0) > 1)
        refine = np.flatnonzero((odd > 0) & many)
        if len(refine):
            more_a, more_b, more_ends = [], [], []
            for g in refine.tolist():
                from_a, from_b = (to_a[g - 1], to_b[g - 1]) if g else (0, 0)
                for i, j in self._refined(ids_a[from_a : to_a[g]], ids_b[from_b : to_b[g]])[:-1]:
                    more_a.append(from_a + i)
                    more_b.append(from_b + j)
                    more_ends.append(ends[g])
            order = np.argsort(np.r_[to_a, np.array(more_a, np.int64)], kind="stable")
            to_a, to_b, ends = (
                np.r_[x, np.array(y, np.int64)][order] for x, y in ((to_a, more_a), (to_b, more_b), (ends, more_ends))
            )

        last = np.cumsum(np.fromiter(map(len, fragments), np.int64, len(fragments)) + 1)
        group_to = np.searchsorted(ends, last, side="right")  # groups up to the end of each fragment
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        links = n_a * n_b
        upto = lambda x: np.diff(np.r_[0, np.cumsum(x)][group_to], prepend=0)
        numbers = np.stack([upto(n_a), upto(n_b), upto(np.ones(len(links), np.int64)), upto(links)], axis=1)

        table, pair_to = self._linked(a, b, to_a - n_a, to_b - n_b, n_a, n_b)
        pair_ends = (8 * np.r_[0, pair_to][group_to]).tolist()
        written, widths = self._written(ids_a, ids_b, to_a, to_b, n_a, n_b)
        text_ends = np.r_[0, np.cumsum(widths)][group_to].tolist()
        self._keep(
            fragments,
            numbers,
            [written[i:j] for i, j in pairwise([0, *text_ends])],
            [table[i:j] for i, j in pairwise([0, *pair_ends])],
        )
        return True

    def _linked(self, a, b, from_a, from_b, n_a, n_b) -> tuple[bytes, np.ndarray]:
        """Pairs with their links as bytes, and how many there are up to each group's end."""
        links = n_a * n_b
        large = np.flatnonzero(links > LARGE)
        sizes = links.copy()
        extra = {}
        for g in large.tolist():  # of long groups, equal ids first
            x, count_x = np.unique(a[from_a[g] : from_a[g] + n_a[g]], return_counts=True)
            y, count_y = np.unique(b[from_b[g] : from_b[g] + n_b[g]], return_counts=True)
            extra[g] = (x[:, None] * self.n_b + y).ravel(), (count_x[:, None] * count_y).ravel()
            sizes[g] = len(x) * len(y)
        upto = np.cumsum(sizes)
        table = np.ones((int(upto[-1]) if len(upto) else 0, 2), np.uint32)
        plain = np.where(links > LARGE, 0, sizes)
        group = np.repeat(np.arange(len(sizes)), plain)
        place = np.arange(len(group)) - np.repeat(np.cumsum(plain) - plain, plain)
        codes = a[from_a[group] + place // n_b[group]] * self.n_b + b[from_b[group] + place % n_b[group]]
        table[(upto - sizes)[group] + place, 0] = codes
        for g, (code, weight) in extra.items():
            table[upto[g] - sizes[g] : upto[g]] = np.stack([code, weight], axis=1)
        return table.tobytes(), upto

    def _written(self, ids_a, ids_b, to_a, to_b, n_a, n_b) -> tuple[str, np.ndarray]:
        """All groups as written in the digest, and the length of each."""
        before = np.cumsum(n_a + n_b) - (n_a + n_b)
        words: list[str] = [""] * (len(ids_a) + len(ids_b))
        out_a = (np.arange(len(ids_a)) + np.repeat(before - (to_a - n_a), n_a)).tolist()
        out_b = (np.arange(len(ids_b)) + np.repeat(before + n_a - (to_b - n_b), n_b)).tolist()
        comma_a, comma_b = self.comma_a, self.comma_b
        for at, i in zip(out_a, ids_a, strict=True):
            words[at] = comma_a[i]
        for at, i in zip(out_b, ids_b, strict=True):
            words[at] = comma_b[i]
        for at in (to_a - 1).tolist():
            words[out_a[at]] = self.bar_a[ids_a[at]]
        for at in (to_b - 1).tolist():
            words[out_b[at]] = self.end_b[ids_b[at]]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return "".join(words), np.add.reduceat(sizes, before) if len(before) else sizes

    def documents(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, n_links, groups_sha256, and distinct pairs with their links, of each text."""
        found = [self.fragments(t) if t else [] for t in texts]
        new = self._new(found)
        if len(self.place) + len(new) > self.keep:
            self.forget()
            new = self._new(found)
        self.learn(new)
        for parts in found:
            yield self._document(parts)

    def _new(self, found: list[list[str]]) -> list[str]:
        place = self.place
        return list(dict.fromkeys([f for parts in found for f in parts if f not in place]))

    def _document(self, found: list[str]) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        none = 0, 0, 0, 0, "", np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if not found:
            return none
        in_order = list(map(self.place.__getitem__, found))
        places, times = np.unique(np.array(in_order, np.int64), return_counts=True)
        self.uses[places] += 1
        numbers = self.numbers[places]
        if (numbers[:, 0] < 0).any():
            return none
        n_a, n_b, n_groups, n_links = (numbers * times[:, None]).sum(axis=0).tolist()
        digest = hashlib.sha256("".join(map(self.texts.__getitem__, in_order))[:-1].encode()).hexdigest()
        joined = list(map(self.pairs.__getitem__, places.tolist()))
        table = np.frombuffer(b"".join(joined), np.uint32).reshape(-1, 2)
        each = np.repeat(times, np.fromiter(map(len, joined), np.int64, len(joined)) // 8)
        order = np.argsort(table[:, 0])
        codes, weights = table[order, 0], (table[:, 1] * each)[order]
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        return n_a, n_b, n_groups, n_links, digest, codes[first], np.add.reduceat(weights, first)


_aligners: dict[int, Aligner] = {}


def _aligner(models: Models) -> Aligner:
    """The worker's own, which later tasks go on with."""
    key = hash(models)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(models)
    return _aligners[key]


def _squeezed(codes: np.ndarray, weights: np.ndarray) -> bytes:
    gaps = np.diff(codes, prepend=np.uint32(0))
    return zstandard.ZstdCompressor(level=1).compress(gaps.tobytes() + weights.tobytes())


def _unsqueezed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(data)
    n = len(plain) // 12
    return np.cumsum(np.frombuffer(plain, np.uint32, n), dtype=np.uint32), np.frombuffer(plain, np.int64, n, 4 * n)


def alignments(docs: DataFrame, models: Models) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and linked pairs as ``pairs``.

    ``row`` tells repeated rows apart. ``pairs`` are sorted codes a * B + b, B
    being the second tokenizer's size, with the number of links of each.
    """
    given = docs.sparkSession.sparkContext.broadcast(models)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(given.value)
        kinds = (*[pa.int64()] * 4, pa.string(), pa.binary())
        names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs")
        for batch in rows_of(batches, 128):
            texts = [data.as_py().decode(errors="replace") for data in batch.column("data")]
            rows = [(*made[:5], _squeezed(*made[5:])) for made in aligner.documents(texts)]
            made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *made], names=["row", "doc_id", *names])

    numbered = texts_of(docs, F.monotonically_increasing_id().alias("row")).select("row", "doc_id", "data")
    return numbered.mapInArrow(
        compute,
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary",
    )


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """a, b, n, best: documents that hold the pair linked, and whether no pair of a is in more.

    Tasks count their documents' pairs first. The highest counts are one row
    for each id of the first tokenizer, and broadcast.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"]
            )

        for batch in batches:
            for data in batch.column(0):
                codes = _unsqueezed(data.as_py())[0]
                held.append(codes)
                size += len(codes)
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counts = (
        aligned.select("pairs")
        .mapInArrow(count, "code long, n long")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
        .select(F.expr(f"CAST(code div {size_b} AS int)").alias("a"), F.expr(f"CAST(code % {size_b} AS int)").alias("b"), "n")
    )
    counts = stored(counts, "pairs")
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(highest), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_of_hot(counts: DataFrame, bound: int) -> float:
    """The count from which on there are at most ``bound`` pairs; from sums by steps of the count."""
    step = F.floor(F.log2("n") * 8).alias("step")
    sizes = sorted(counts.groupBy(step).count().collect(), reverse=True)  # at most 8 x 63 rows
    total, least = 0, float("inf")
    for at, n in sizes:
        total += n
        if total > bound:
            break
        least = at
    return least


def aligned_documents(docs: DataFrame, models: Models | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A null or empty text, or one that a tokenizer does not give back byte by
    byte, has zeros and an empty digest, and its pairs count nowhere. Repeated
    rows stay and count as documents of their own. Columns other than doc_id
    and text are not read.
    """
    models = models or load()
    context = docs.sparkSession.sparkContext
    size_b = Aligner(models).n_b
    aligned = stored(alignments(docs, models), "alignments")
    counts = stored(pair_counts(aligned, size_b), "counts").withColumn("code", F.col("a").cast("long") * size_b + F.col("b"))
    least = _least_of_hot(counts, hot)
    is_hot = F.floor(F.log2("n") * 8) >= least
    table = counts.where(is_hot).select("code", "n", "best").toArrow()  # at most ``hot`` rows
    order = np.argsort(code := table["code"].to_numpy())
    known = context.broadcast((code[order].astype(np.uint32), table["n"].to_numpy()[order], table["best"].to_numpy()[order]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over frequent pairs, and the other pairs."""
        hot_codes, n, best = known.value
        for batch in rows_of(batches):
            sums, bests, codes_left, weights_left = [], [], [], []
            for data in batch.column("pairs"):
                codes, weights = _unsqueezed(data.as_py())
                at = np.searchsorted(hot_codes, codes)
                at[at == len(hot_codes)] = 0
                found = hot_codes[at] == codes if len(hot_codes) else np.zeros(len(codes), bool)
                here, w = at[found], weights[found]
                sums.append(int((n[here] * w).sum()) if len(here) else 0)
                bests.append(int(w[best[here]].sum()) if len(here) else 0)
                codes_left.append(codes[~found].astype(np.int64))
                weights_left.append(weights[~found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sums, pa.int64()), pa.array(bests, pa.int64()),
                 pa.array(codes_left, pa.list_(pa.int64())), pa.array(weights_left, pa.list_(pa.int64()))],
                names=["row", "count_sum", "n_best", "codes", "weights"],
            )

    sums = aligned.select("row", "pairs").mapInArrow(
        look_up, "row long, count_sum long, n_best long, codes array<long>, weights array<long>"
    )
    sums = stored(sums, "sums")
    others = sums.where(F.size("codes") > 0).select("row", F.explode(F.arrays_zip("codes", "weights")).alias("x"))
    others = others.select("row", F.col("x.codes").alias("code"), F.col("x.weights").alias("weight"))
    rest = others.join(counts.where(~is_hot).select("code", "n", "best"), "code").select(
        "row", (F.col("n") * F.col("weight")).alias("count_sum"), F.when(F.col("best"), F.col("weight")).otherwise(0).alias("n_best")
    )
    all_sums = sums.select("row", "count_sum", "n_best").union(rest).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return aligned.drop("pairs").join(all_sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
