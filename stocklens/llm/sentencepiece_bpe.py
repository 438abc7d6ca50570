"""SentencePiece encoding as a relational lattice, and decoding.

A BPE model merges, again and again, the two neighbours whose joined piece
ranks best, the leftmost of equals. The result is a best path: write down the
merges inside the pieces of a path as sorted pairs (rank, place); of all paths
over the same characters BPE yields the one whose list comes first, a longer
list before its own beginning. Such lists can be compared after any common
continuation, so a Viterbi fold over the ends of a lattice finds the path.

The lattice is relational. Texts fall into fragments at places no piece spans
(before spaces, between letters and other characters, around digits). Distinct
fragments are exploded into substrings up to the longest piece, joined with
the piece table, and folded in Arrow batches, all fragments of a batch and of
one length at a time.

Only distinct fragments go through the lattice. The most frequent fragments of
a bounded sample are encoded first and broadcast; all others are encoded once
for the whole corpus and sent back to the sets of documents that need them.
Texts are written once, in such sets, and not shuffled. The sample decides where a fragment is looked up, not how it is encoded.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.llm.common import rows_of, stored, stored_by, texts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
PLACES = 1 << 7
LAST = (1 << 31) - 1
LONG = 120  # characters; longer fragments are merged by a heap
CUT = 32  # from here on fragments are also cut between characters that no piece has together
HOT = 1 << 17
EDGES = 1 << 19  # held by a fold, and all those of one fragment
WORDS = 1 << 19  # different words of sets whose rare fragments are looked for; a set has some 250,000
CELLS = 1 << 21  # numbers of the merges of paths, at a time
SET = 1 << 23  # bytes of text of a set of documents
PART = 1 << 22  # bytes of text whose rare fragments are meant for one task

_FRAGMENTS = re.compile(rf"{SPACE}*(?:[^\W\d]+|\d|[^\w{SPACE}]+)|{SPACE}+")
_WORDS = re.compile(rf"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _is_apart(left: str, right: str) -> bool:
    """Whether the fragment pattern cuts between the two characters."""
    return len(_FRAGMENTS.findall(left + right)) > 1


@dataclass
class Pieces:
    """A BPE model: pieces with their ids and ranks, byte pieces, and the id of unknown ones."""

    ids: dict[str, int]
    ranks: dict[str, int]
    bytes_: list[int]  # by value; empty without byte pieces
    unknown: int
    texts: list[bytes] = field(default_factory=list)  # by id, what each piece stands for
    glue: frozenset[str] = frozenset()
    pairs: frozenset[str] = frozenset()
    longest: int = 1

    def __post_init__(self) -> None:
        glue, pairs = set(), set()
        for piece in self.ids:
            inner = piece.lstrip(SPACE)
            for a, b in zip(inner, inner[1:], strict=False):
                if _is_apart(a, b):
                    glue.add(a if re.match(r"[^\W\d]", a) else b)
            pairs.update(a + b for a, b in zip(piece, piece[1:], strict=False))
        self.glue, self.pairs = frozenset(glue), frozenset(pairs)
        self.longest = max(map(len, self.ids), default=1)


def load(path: str = MODEL) -> Pieces:
    """The piece table of a SentencePiece model file of type BPE with identity normalisation."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
    as_byte = {i: int(names[i][3:5], 16) for i in range(size) if model.is_byte(i)}
    normal = [i for i in range(size) if i not in special and i not in as_byte]
    order = {s: n for n, s in enumerate(sorted({-model.get_score(i) for i in normal}))}
    values = {b: i for i, b in as_byte.items()}
    texts = [
        b"" if i in special else bytes([as_byte[i]]) if i in as_byte else names[i].replace(SPACE, " ").encode()
        for i in range(size)
    ]
    return Pieces(
        {names[i]: i for i in normal},
        {names[i]: order[-model.get_score(i)] for i in normal},
        [values[b] for b in range(256)] if len(values) == 256 else [],
        model.unk_id(),
        texts,
    )


# ---- fragments --------------------------------------------------------------------------


def _cut(fragment: str, pairs: frozenset[str]) -> Iterator[str]:
    start = 0
    for i in range(1, len(fragment)):
        if fragment[i - 1 : i + 1] not in pairs:
            yield fragment[start:i]
            start = i
    yield fragment[start:]


def fragments(text: str, pieces: Pieces) -> list[str]:
    """The text in fragments that are encoded one by one; spaces are part of them."""
    if not text:
        return []
    marked = SPACE + text.replace(" ", SPACE)
    if any(g in marked for g in pieces.glue):
        found = []
        for word in _WORDS.findall(marked):
            whole = any(g in word for g in pieces.glue)
            found += [word] if whole else _FRAGMENTS.findall(word)
    else:
        found = _FRAGMENTS.findall(marked)
    if max(map(len, found)) > CUT:
        found = [p for f in found for p in (_cut(f, pieces.pairs) if len(f) > CUT else (f,))]
    return found


def merges(text: str, ranks: dict[str, int]) -> tuple[list[str], list[tuple[int, int]]]:
    """The symbols BPE leaves of ``text``, and its merges as (rank, place) in order.

    Of a model whose joined pieces may rank before their parts, the rank of a
    merge is that of the worst merge before it.
    """
    symbols: list[str | None] = list(text)
    right = [*range(1, len(symbols)), -1]
    left = list(range(-1, len(symbols) - 1))
    heap: list[tuple[int, int, str, int]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0:
            joined = symbols[i] + symbols[j]
            if joined in ranks:
                heapq.heappush(heap, (ranks[joined], i, joined, j))

    for i in range(len(symbols) - 1):
        offer(i, i + 1)
    done, worst = [], 0
    while heap:
        rank, i, joined, j = heapq.heappop(heap)
        if symbols[i] is None or right[i] != j or symbols[i] + symbols[j] != joined:
            continue
        worst = max(worst, rank)
        done.append((worst, i))
        symbols[i], symbols[j] = joined, None
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        offer(left[i], i)
        offer(i, right[i])
    return [s for s in symbols if s is not None], done


def _ids(symbols: Iterable[str], pieces: Pieces) -> list[int]:
    out: list[int] = []
    for s in symbols:
        if s in pieces.ids:
            out.append(pieces.ids[s])
        elif pieces.bytes_:
            out += [pieces.bytes_[b] for b in s.encode()]
        else:
            out.append(pieces.unknown)
    return out


# ---- the lattice ------------------------------------------------------------------------


def _formed(pieces: Pieces) -> Iterator[tuple[str, int, list[int]]]:
    """Pieces with their ids and their own merges as sorted rank x 128 + place."""
    for piece, number in pieces.ids.items():
        left, done = merges(piece, pieces.ranks)
        if len(left) == 1:  # others are never the result of merging
            yield piece, number, sorted(r * PLACES + at for r, at in done)


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """piece and id. One row per piece of the model that merging leads to."""
    return spark.createDataFrame([row[:2] for row in _formed(pieces)], "piece string, id int")


def _own_merges(pieces: Pieces) -> np.ndarray:
    """By id, the merges inside the piece: one less than its characters, then ``LAST``."""
    table = np.full((max(pieces.ids.values(), default=0) + 1, max(pieces.longest - 1, 1)), LAST, np.int32)
    for _, number, key in _formed(pieces):
        table[number, : len(key)] = key
    return table


def _is_before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a row of ``a`` comes before that of ``b``, by the first number that differs."""
    at = (a != b).argmax(axis=1)[:, None]
    return (np.take_along_axis(a, at, 1) < np.take_along_axis(b, at, 1))[:, 0]


def _best_paths(n: int, f: np.ndarray, s: np.ndarray, e: np.ndarray, id_: np.ndarray, own: np.ndarray, count: int):
    """Folds the edges (s, e, id) of ``count`` fragments ``f`` of ``n`` characters, all fragments at a time.

    Extends the best paths to where edges start, by their ends. Gives the pieces of the best paths
    in order: their fragments, starts and ids.
    """
    order = np.argsort(e * PLACES - s, kind="stable")  # by ends, shortest first
    f, s, e, id_ = f[order], s[order], e[order], id_[order]
    cuts = np.flatnonzero(np.diff(e * PLACES - s)) + 1
    keys = [np.full((count, 1), LAST, np.int32)]  # by end, merges of the best paths in order, then LAST
    starts, ids = np.zeros((n + 1, count), np.int32), np.full((n + 1, count), -1, np.int32)
    for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(f)], strict=True):
        start, end, to, pick = int(s[a]), int(e[a]), f[a:z], id_[a:z]
        if end == start + 1:  # every fragment has it, and nothing merges inside
            best = np.full((count, max(end - 1, 1)), LAST, np.int32)
            best[:, : keys[start].shape[1]] = keys[start]
            keys.append(best)
            starts[end, to], ids[end, to] = start, pick
            continue
        best, before = keys[end], keys[start]
        first = np.minimum(before[to, 0], own[pick, 0] + start)
        hope = first <= best[to, 0]  # others lose by their first merge
        to, pick = to[hope], pick[hope]
        if not len(to):
            continue
        key = np.concatenate([before[to], own[pick, : end - start - 1] + start], axis=1)
        key.sort(axis=1)
        width = min(best.shape[1], key.shape[1])
        full = np.full((len(to), best.shape[1]), LAST, np.int32)
        full[:, :width] = key[:, :width]
        won = _is_before(full, best[to])
        to, pick = to[won], pick[won]
        best[to] = full[won]
        starts[end, to], ids[end, to] = start, pick
    at, left = np.full(count, n), np.arange(count)
    steps = []
    while len(left):  # follows the starts of the last pieces from the end
        begin = starts[at[left], left]
        steps.append((left, begin, ids[at[left], left]))
        at[left] = begin
        left = left[begin > 0]
    f, s, id_ = (np.concatenate(c) for c in zip(*reversed(steps), strict=True))
    order = np.argsort(f, kind="stable")
    return f[order], s[order], id_[order]


def _folded(texts: pa.Array, of: np.ndarray, s: np.ndarray, e: np.ndarray, id_: np.ndarray, own: np.ndarray, pieces: Pieces):
    """fragment and ids, from the edges (s, e, id) of the fragments ``of`` of ``texts``, in order."""
    lengths = pc.utf8_length(texts).to_numpy()
    if (np.bincount(of[e == s + 1], minlength=len(texts)) != lengths).any():
        raise ValueError("the edges of a fragment came apart")
    by_edge = lengths[of]
    for n in np.unique(lengths).tolist():
        mine, edges = np.flatnonzero(lengths == n), np.flatnonzero(by_edge == n)
        rank = np.searchsorted(mine, of[edges])
        most = max(1, CELLS // (n * n))  # fragments at a time
        for low in range(0, len(mine), most):
            now = mine[low : low + most]
            first, last = np.searchsorted(rank, [low, low + most])
            here = edges[first:last]
            f, begin, ids = _best_paths(n, rank[first:last] - low, s[here], e[here], id_[here], own, len(now))
            offsets = np.concatenate([[0], np.cumsum(np.bincount(f, minlength=len(now)))]).astype(np.int32)
            names, found = texts.take(pa.array(now)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            unknown = np.unique(f[ids < 0])
            if len(unknown):  # characters that are no pieces
                lists = []
                for i in unknown.tolist():
                    span, text = slice(offsets[i], offsets[i + 1]), names[i].as_py()
                    path = zip(begin[span].tolist(), ids[span].tolist(), strict=True)
                    lists.append([j for at, k in path for j in (_ids(text[at], pieces) if k < 0 else (k,))])
                known = np.setdiff1d(np.arange(len(now)), unknown)
                names = names.take(pa.array(np.append(known, unknown)))
                found = pa.concat_arrays([found.take(pa.array(known)), pa.array(lists, found.type)])
            yield pa.RecordBatch.from_arrays([names, found], names=["fragment", "ids"])


def _answered(table: pa.Table, own: np.ndarray, pieces: Pieces) -> pa.Table:
    """fragment, ids and set of the rows with a fragment, whose edges are among the rows."""
    is_named, values = pc.is_valid(table["fragment"]).to_numpy(), table["value"].to_numpy()
    named, edges = table["fragment"].drop_null().combine_chunks(), values[~is_named]
    s, e, id_ = edges & (PLACES - 1), edges // PLACES & (PLACES - 1), (edges // PLACES**2 - 1).astype(np.int32)
    after = np.cumsum(is_named)[~is_named] - 1  # the named row before
    leading, of = np.unique(after, return_inverse=True)
    found = pa.Table.from_batches(_folded(named.take(pa.array(leading)), of, s, e, id_, own, pieces))
    at = pc.index_in(named, found["fragment"].combine_chunks())
    if at.null_count:
        raise ValueError("a fragment came apart from its edges")
    ids = found["ids"].combine_chunks().take(at)
    return pa.table({"fragment": named, "ids": ids, "set": pa.array(values[is_named])})


def _answers(batches: Iterator[pa.RecordBatch], own: np.ndarray, pieces: Pieces) -> Iterator[pa.RecordBatch]:
    """As ``_answered``, some rows at a time; the rows of a fragment lie together."""
    held, size, bound = [], 0, EDGES
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < bound:
            continue
        table = pa.Table.from_batches(held)
        places = np.flatnonzero(pc.is_valid(table["fragment"]).to_numpy())
        named = table["fragment"].drop_null()
        others = np.flatnonzero(pc.not_equal(named, named[-1]).to_numpy())
        cut = int(places[others[-1] + 1]) if len(others) else 0  # the last fragment may go on in the next batch
        if cut:
            yield from _answered(table[:cut], own, pieces).to_batches()
        held, size = table[cut:].to_batches(), size - cut
        bound = max(EDGES, 2 * size)
    if size:
        yield from _answered(pa.Table.from_batches(held), own, pieces).to_batches()


def _lattice(asked: DataFrame, pieces: Pieces) -> DataFrame:
    """A row (fragment, set) for each of ``asked``, after those that lead their edges as ``value``.

    ``value`` holds start, end and id + 1 of an edge, without a fragment: fewer
    columns for the many rows that go to the folds. The piece table is broadcast:
    a model's vocabulary does not grow with the corpus. Neither the explosions
    nor that join move rows, so the rows of a fragment stay together; the folds
    check that the edges of its characters are all there.
    """
    first = F.lit(-1)
    span = F.when(F.col("leads"), F.sequence(first, F.length("fragment") - 1)).otherwise(F.array(first))
    starts = asked.select("fragment", "set", F.explode(span).alias("s"))
    room = F.least(F.lit(pieces.longest), F.length("fragment") - F.col("s"))
    sizes = F.sequence(F.lit(1), F.when(F.col("s") < 0, F.lit(1)).otherwise(room))
    edges = starts.select("fragment", "set", "s", F.explode(sizes).alias("size")).select(
        "fragment", "set", "s", "size", F.expr("substring(fragment, s + 1, size)").alias("piece")
    )
    # a character that is no piece keeps its place without an id
    table = F.broadcast(piece_table(asked.sparkSession, pieces))
    joined = edges.join(table, "piece", "left").where("id IS NOT NULL OR size = 1")
    number = F.coalesce("id", F.lit(-1)).cast("long") + 1
    edge = (number * PLACES + F.col("s") + F.col("size")) * PLACES + F.col("s")
    return joined.select(
        F.when(F.col("s") < 0, F.col("fragment")).alias("fragment"),
        F.when(F.col("s") < 0, F.col("set")).otherwise(edge).alias("value"),
    )


def encoded_fragments(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """fragment and ids of distinct fragments, which have at most ``LONG`` characters."""
    leading = distinct.select("fragment", F.lit(0).cast("long").alias("set"), F.lit(True).alias("leads"))
    known = distinct.sparkSession.sparkContext.broadcast((_own_merges(pieces), pieces))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _answers(batches, *known.value):
            yield batch.select(["fragment", "ids"])

    return _lattice(leading, pieces).mapInArrow(fold, "fragment string, ids array<int>")


def packed_by_set(asked: DataFrame, pieces: Pieces) -> DataFrame:
    """Fragments and ids by set, compressed, of rows with a set and a fragment, dealt by fragment.

    Each fragment is encoded once, with the least of its sets; its other rows
    take the ids from there.
    """
    least = asked.groupBy("fragment").agg(F.min("set").alias("least"))
    # a merge join leaves nothing to sort
    rows = asked.join(least, "fragment").sortWithinPartitions("fragment")
    rows = rows.select("fragment", "set", (F.col("set") == F.col("least")).alias("leads"))
    known = asked.sparkSession.sparkContext.broadcast((_own_merges(pieces), pieces))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _pack(_answers(batches, *known.value))

    return _lattice(rows, pieces).mapInArrow(fold, "set long, fragments binary, sizes binary, ids binary")


# ---- documents --------------------------------------------------------------------------


def _text(data) -> str:
    return data.as_py().decode(errors="replace")


def _frequent(docs: DataFrame, pieces: Pieces, bound: int) -> DataFrame:
    """At most HOT fragments, the most frequent ones of at most ``bound`` documents."""
    known = docs.sparkSession.sparkContext.broadcast(pieces)
    picked = (
        docs.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("picked_"))
        .distinct()
        .orderBy(F.xxhash64("picked_"), "picked_")
        .limit(bound)
    )
    sample = texts_of(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("picked_"), "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in rows_of(batches):
            for data in batch.column(0):
                found.update(f for f in fragments(_text(data), known.value) if len(f) <= LONG)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["fragment", "n"]
        )

    counted = sample.select("data").mapInArrow(count, "fragment string, n long")
    return (
        counted.groupBy("fragment")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "fragment")
        .limit(HOT)
        .select("fragment")
    )


class Lexicon(dict):
    """Frequent fragments with their ids as packed numbers; asks ``others`` for the rest."""

    def __init__(self, entries: Iterable, pieces: Pieces):
        super().__init__(entries)
        self.pieces, self.others = pieces, {}

    def __missing__(self, fragment: str) -> bytes:
        if len(fragment) > LONG:
            ids = _ids(merges(fragment, self.pieces.ranks)[0], self.pieces)
            return np.array(ids, np.int32).tobytes()
        return self.others[fragment]


def _lexicon(encoded: DataFrame, pieces: Pieces) -> Lexicon:
    """At most HOT fragments."""
    table = encoded.toArrow()
    ids = (np.array(i, np.int32).tobytes() for i in table["ids"].to_pylist())
    return Lexicon(zip(table["fragment"].to_pylist(), ids, strict=True), pieces)


def _in_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their set, which is named after the row of its first one."""
    name, size = None, 0
    for batch in rows_of(batches):
        sets = []
        for row, n in zip(batch.column("row").to_pylist(), pc.binary_length(batch.column("data")).to_pylist(), strict=True):
            if name is None or size >= SET:
                name, size = row, 0
            sets.append(name)
            size += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(sets, pa.int64()), batch.column("doc_id"), batch.column("data")], names=["set", "doc_id", "data"]
        )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments and ids by set, compressed."""
    squeeze = zstandard.ZstdCompressor(level=3).compress

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        table = table.take(np.argsort(table["set"].to_numpy(), kind="stable")).combine_chunks()
        sets, starts = np.unique(table["set"].to_numpy(), return_index=True)
        starts = np.append(starts, len(table)).astype(np.int32)
        fragments, ids = (table[c].combine_chunks() for c in ("fragment", "ids"))
        joined = pc.binary_join(pa.ListArray.from_arrays(starts, fragments), "").to_pylist()
        sizes = np.array([pc.utf8_length(fragments), pc.list_value_length(ids)], np.int32)
        flat = ids.flatten().to_numpy().astype(np.int32)
        at = np.concatenate([[0], np.cumsum(sizes[1])])[starts]
        columns = [
            [squeeze(f.encode()) for f in joined],
            [squeeze(sizes[:, a:z].tobytes()) for a, z in zip(starts[:-1], starts[1:], strict=True)],
            [squeeze(flat[a:z].tobytes()) for a, z in zip(at[:-1], at[1:], strict=True)],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(sets), *(pa.array(c, pa.binary()) for c in columns)], names=["set", "fragments", "sizes", "ids"]
        )

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size > 200_000:
            yield flush(held)
            held, size = [], 0
    if size:
        yield flush(held)


def encoded(docs: DataFrame, pieces: Pieces | None = None, bound: int = 8000) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of every whole text.

    ``ids`` are those the SentencePiece library gives for the model, without
    start or end; ``round_trip`` tells that decoding them gives the text again.
    Null and empty texts have no ids. Repeated rows stay, and columns other
    than doc_id and text are not read.
    """
    pieces = pieces or load()
    spark = docs.sparkSession
    context = spark.sparkContext
    model = context.broadcast(pieces)
    frequent = _frequent(docs, pieces, bound).repartition(F.col("fragment"))
    lexicon = _lexicon(stored(encoded_fragments(frequent, pieces), "frequent"), pieces)
    known = context.broadcast(lexicon)

    source = texts_of(docs)
    total = source.agg(F.sum(F.length("data"))).first()[0] or 0
    numbered = source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "data")
    sets = stored_by(
        numbered.mapInArrow(_in_sets, "set long, doc_id long, data binary"), "texts", "set", -(-total // SET), "zstd"
    )

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, lex = model.value, known.value
        seen: dict[int, tuple[set[str], set[str]]] = {}  # by set: different words, and fragments
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, (words, found) in seen.items():
                found.update(fragments(" ".join(words), p))
                own = [f for f in found if f not in lex and len(f) <= LONG]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(own), pa.int64()), pa.array(own, pa.string())], names=["set", "fragment"]
                )

        for batch in rows_of(batches):
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if name not in seen and held > WORDS // 4:  # as a rule, once for each set
                    yield from flush()
                    seen, held = {}, 0
                own = seen.setdefault(name, (set(), set()))
                held -= sum(map(len, own))
                text = _text(data)
                words = text.replace(SPACE, " ").split(" ")
                if "" in words:  # a fragment with several spaces, or of nothing else
                    own[1].update(fragments(text, p))
                else:
                    own[0].update(words)
                held += sum(map(len, own))
            if held > WORDS:
                yield from flush()
                seen, held = {}, 0
        yield from flush()

    # partitions small enough that a partition's rows are sorted in memory
    parts = max(1, -(-total // PART))
    asked = sets.select("set", "data").mapInArrow(rare, "set long, fragment string").repartition(parts, "fragment")
    packed = packed_by_set(asked, pieces)

    def assemble(docs: pa.Table, lexicons: pa.Table) -> pa.Table:
        p, lex = model.value, known.value
        own = lex.others = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for row in lexicons.to_pylist():
            sizes = np.frombuffer(unpack(row["sizes"]), np.int32).reshape(2, -1)
            joined, ids = unpack(row["fragments"]).decode(), unpack(row["ids"])
            at = at_id = 0
            for n, n_ids in zip(sizes[0].tolist(), (4 * sizes[1]).tolist(), strict=True):
                own[joined[at : at + n]] = ids[at_id : at_id + n_ids]
                at, at_id = at + n, at_id + n_ids
        values = [b"".join(map(lex.__getitem__, fragments(_text(data), p))) for data in docs["data"]]
        flat = np.frombuffer(b"".join(values), np.int32)
        counts = np.array([len(ids) // 4 for ids in values], np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        # all texts of the set are decoded at once; what differs as bytes is compared as text
        spelled = pa.array(p.texts, pa.large_binary()).take(pa.array(flat))
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(spelled).to_numpy())])[offsets].tolist()
        joined = memoryview(spelled.buffers()[2] or b"")
        same = []
        for data, ids, start, end in zip(docs["data"], values, ends[:-1], ends[1:], strict=True):
            equal = bytes(joined[start:end]) == b" " + data.as_py()
            same.append(equal or decode(np.frombuffer(ids, np.int32).tolist(), p) == _text(data))
        return pa.table({
            "doc_id": docs["doc_id"].combine_chunks(),
            "n_tokens": pa.array(counts, pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            "round_trip": pa.array(same, pa.bool_()),
        })

    return (
        sets.groupBy("set")
        .cogroup(packed.groupBy("set"))
        .applyInArrow(assemble, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")
    )


def decode(ids: Iterable[int], pieces: Pieces) -> str:
    """The text of ids: pieces joined, spaces for their marks, the space in front dropped."""
    texts = pieces.texts
    joined = b"".join([texts[i] for i in ids]).decode(errors="replace")
    return joined[1:] if joined.startswith(" ") else joined


def decoded(rows: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give null."""
    known = rows.sparkSession.sparkContext.broadcast(pieces or load())

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = [None if i is None else decode(i, known.value) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(compute, "doc_id long, text string")
