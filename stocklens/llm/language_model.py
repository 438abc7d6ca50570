"""Texts scored by a hierarchical Pitman-Yor model learned from the corpus itself.

Words and contexts are hashes: a word has 64 bits, its context is one of 65,536
buckets of the word before. Every pass over the corpus sends tokens, packed, to
buckets by their word's hash, so that a word's restaurant entries and its root
customers meet in one bucket. Two things would make a bucket hot. Words with a
large part of all tokens are dealt by word and context, and their root
customers are summed over buckets. Pairs that are frequent themselves are
scored where they are read and sent nowhere.

Between sweeps only totals move: tables by context and by hot word. Their
number is fixed by the settings, not by the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm import pitman_yor as py
from stocklens.llm.common import dropped, remainder, rows_of, stored, texts_of

CONTEXTS = 1 << 16
FLUSH = 1 << 19  # tokens packed at a time; twice as many are counted at a time
BUCKET = 1 << 20  # tokens meant for a bucket
HOT = 1 << 18  # tokens from which a word or pair is hot; also the most that can be
START = xxhash.xxh64_intdigest(b"\0start")
END = xxhash.xxh64_intdigest(b"\0end")
CHUNK = 4096


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def tokens_of(data: bytes, seen: dict) -> np.ndarray:
    """Hashes of the lower-case words and of the end."""
    words = data.lower().split()  # on bytes: A-Z, and exactly \x20 and \x09-\x0D
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Documents gathered to about ``FLUSH`` tokens: ids, flags, words, contexts, places."""
    seen = _Hashes()
    ids, train, parts, n = [], [], [], 0

    def packed():
        words = np.concatenate(parts)
        lengths = np.array([len(p) for p in parts])
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[np.cumsum(lengths) - lengths] = START
        contexts = (before >> np.uint64(48)).astype(np.uint16)
        return ids, np.array(train, bool), words, contexts, lengths

    for batch in rows_of(batches):
        for doc, data, learn in zip(
            batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True
        ):
            ids.append(doc)
            train.append(learn)
            parts.append(tokens_of(data.as_py(), seen))
            n += len(parts[-1])
            if n >= FLUSH or len(ids) >= 60_000:
                yield packed()
                ids, train, parts, n = [], [], [], 0
    if ids:
        yield packed()


def _key(words: np.ndarray, contexts: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """What deals a token out: its word's hash, for hot words mixed with the context."""
    if not len(hot):
        return words
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    mixed = (words ^ contexts.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return np.where(hot[at] == words, mixed, words)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _sorted(words, contexts, keys) -> np.ndarray:
    """Order by dealing key, then context; stable. 48 bits of the key order well enough to pack."""
    return np.argsort((keys & ~np.uint64(0xFFFF)) | contexts, kind="stable")


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted columns begins."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


PACKED = "bucket int, flush long, words binary, sizes binary, contexts binary, places binary, counts binary"
NAMES = [c.split()[0] for c in PACKED.split(", ")]
_TYPES = pa.schema([
    ("bucket", pa.int32()), ("flush", pa.int64()), *[(n, pa.binary()) for n in NAMES[2:]]
])


def _packed_rows(flush: int, buckets, words, contexts, places, counts) -> Iterator[list]:
    """A row for each bucket; a word shared by neighbouring entries is stored once."""
    starts = _runs(buckets)
    for start, stop in zip(starts, [*starts[1:], len(buckets)], strict=True):
        w = words[start:stop]
        first = _runs(w)
        sizes = np.diff(np.append(first, len(w))).astype(np.uint32)
        yield [
            int(buckets[start]), flush, w[first].tobytes(), sizes.tobytes(),
            contexts[start:stop].tobytes(), places[start:stop].tobytes(), counts[start:stop].tobytes(),
        ]


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], schema=_TYPES
    )


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """words, contexts, places, counts and the row's number of all entries."""
    words = np.concatenate([
        np.repeat(np.frombuffer(w, np.uint64), np.frombuffer(s, np.uint32))
        for w, s in zip(rows["words"], rows["sizes"], strict=True)
    ])
    join = lambda name, kind: np.frombuffer(b"".join(rows[name]), kind)
    contexts = join("contexts", np.uint16)
    lengths = np.array([len(c) // 2 for c in rows["contexts"]])
    return words, contexts, join("places", np.uint16), join("counts", np.uint32), np.repeat(np.arange(len(rows)), lengths)


# ---- learning ---------------------------------------------------------------------------


def _source(docs: DataFrame) -> DataFrame:
    """doc_id, data and whether the text is learned from."""
    return texts_of(docs, (remainder(F.col("doc_id"), 5) != 1).alias("train"))


def _frequent(source: DataFrame) -> tuple[int, np.ndarray]:
    """The number of tokens, and the words that would make a bucket hot.

    The limit is a share of 1 / HOT of all tokens, which is four of those
    counted at a time on average; words that occur less in a flush are not reported from it,
    so half the limit counts. Fewer than 2 HOT words can reach that.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        n = 0

        def flush() -> pa.RecordBatch:
            often = [(w, c) for w, c in found.items() if c >= 4]
            words = [xxhash.xxh64_intdigest(w) for w, _ in often]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *np.array(words, np.uint64).view(np.int64).tolist()], pa.int64()),
                    pa.array([n, *(c for _, c in often)], pa.int64()),
                ],
                names=["word", "n"],
            )

        for batch in rows_of(batches):
            for data in batch.column(0):
                words = data.as_py().lower().split()
                found.update(words)
                found[b"\0end"] += 1  # hashed as END
                n += len(words) + 1
                if n >= 2 * FLUSH:
                    yield flush()
                    found, n = Counter(), 0
        if n:
            yield flush()

    counted = stored(
        source.select("data").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")),
        "frequent",
    )
    total = counted.where("word IS NULL").first()
    total = total.n if total else 0
    least = max(HOT, total // HOT)
    hot = counted.where(F.col("word").isNotNull() & (F.col("n") > least // 2)).collect()
    return total, np.sort(np.array([r.word for r in hot], np.int64).view(np.uint64))


STATE = (
    "bucket int, words binary, counts binary, singles binary, dish binary, contexts binary,"
    " customers binary, totals binary"
)
SEATED = (
    "bucket int, words binary, counts binary, singles binary, dish binary, contexts binary, customers binary,"
    " tables array<binary>, root_tables array<binary>"
)


def _restaurants(source: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """One row for each bucket: words, dishes of two customers or more, totals by context."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, (_, train, words, contexts, lengths) in enumerate(_flushes(batches)):
            learn = np.repeat(train, lengths)
            words, contexts = words[learn], contexts[learn]
            if not len(words):
                continue
            keys = _key(words, contexts, hot)
            order = _sorted(words, contexts, keys)
            words, contexts, keys = words[order], contexts[order], keys[order]
            first = _runs(keys, words, contexts)
            counts = np.diff(np.append(first, len(words))).astype(np.uint32)
            yield _batch(list(_packed_rows(
                task + number, _bucket(keys[first], buckets), words[first], contexts[first],
                np.zeros(len(first), np.uint16), counts,
            )))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        words, contexts, _, counts, _ = _unpacked(rows)
        order = np.lexsort((contexts, words))
        words, contexts, counts = words[order], contexts[order], counts[order].astype(np.int64)
        first = _runs(words, contexts)
        counts = np.add.reduceat(counts, first)
        words, contexts = words[first], contexts[first]
        start = _runs(words)
        dish = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(words))))
        multi = counts >= 2
        singles = np.bincount(dish[~multi], minlength=len(start))
        totals = np.concatenate([
            np.bincount(contexts, counts, minlength=CONTEXTS),
            np.bincount(contexts, minlength=CONTEXTS),
            [(counts == 1).sum(), (counts == 2).sum()],
        ])
        return pd.DataFrame({
            "bucket": [int(rows["bucket"].iloc[0])],
            "words": [words[start].tobytes()],
            "counts": [np.add.reduceat(counts, start).astype(np.int64).tobytes()],
            "singles": [singles.astype(np.int32).tobytes()],
            "dish": [dish[multi].astype(np.int32).tobytes()],
            "contexts": [contexts[multi].tobytes()],
            "customers": [counts[multi].astype(np.int64).tobytes()],
            "totals": [totals.astype(np.int64).tobytes()],
        })

    packed = source.mapInArrow(pack, PACKED)
    return stored(packed.groupBy("bucket").applyInPandas(merge, STATE), "restaurants")


def _loaded(row) -> py.Bucket:
    take = lambda name, kind: np.frombuffer(row[name], kind)
    return py.Bucket(
        int(row["bucket"]), take("words", np.uint64), take("counts", np.int64),
        take("singles", np.int32).astype(np.int64), take("dish", np.int32),
        take("contexts", np.uint16).astype(np.int64), take("customers", np.int64),
    )


def _summed(state: DataFrame, columns: list[str], vector: Callable, size: int) -> np.ndarray:
    """The sum over rows of a vector of ``size`` numbers, added up in tasks and then by pieces of it."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for i in range(batch.num_rows):
                total += vector(batch.slice(i, 1).to_pylist()[0])
        pieces = range(0, size, CHUNK)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p // CHUNK for p in pieces], pa.int32()),
                pa.array([total[p : p + CHUNK].tobytes() for p in pieces], pa.binary()),
            ],
            names=["piece", "part"],
        )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(p) for p in rows["part"]], axis=0)
        return pd.DataFrame({"piece": rows["piece"].iloc[:1], "part": [total.tobytes()]})

    pieces = (
        state.select(*columns)
        .mapInArrow(partial, "piece int, part binary")
        .groupBy("piece")
        .applyInPandas(add, "piece int, part binary")
        .collect()
    )
    out = np.zeros(size)
    for row in pieces:
        part = np.frombuffer(row.part)
        out[row.piece * CHUNK : row.piece * CHUNK + len(part)] = part
    return out


BUCKET_COLUMNS = ["bucket", "words", "counts", "singles", "dish", "contexts", "customers"]


def _hot_tables(model: py.Model, customers: np.ndarray, before: py.Totals | None, number: int) -> np.ndarray:
    """Tables of the hot words at the root; their customers come from many buckets."""
    if before is None or not len(customers):
        return np.ones(len(customers))
    rng = np.random.default_rng([1 << 31, number])
    base = np.full(len(customers), 1.0 / (model.vocabulary + 1))
    others = np.maximum(before.root_tables - before.hot_tables, 0.0)
    return py.seat(
        rng, customers.astype(np.int64), others, base, model.root_strength,
        model.root_discount, py.stirling(model.root_discount),
    ).astype(float)


def _kept_seatings(row, bucket: py.Bucket) -> list[py.Seating]:
    """The last seatings of a bucket, the newest at the end; the first one where none is kept."""
    kept = [
        (np.frombuffer(t, np.int32).astype(np.int64), np.frombuffer(r, np.int32).astype(np.int64))
        for t, r in zip(row["tables"], row["root_tables"], strict=True)
    ]
    return [py.Seating(t, py.at_root(bucket, t), r) for t, r in kept] or [py.first_seating(bucket)]


def _seated(state: DataFrame, model: py.Model, samples: int) -> DataFrame:
    """The restaurants after one more sweep, with their last ``samples`` seatings."""
    known = state.sparkSession.sparkContext.broadcast(model)
    number = len(model.history) - 1

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1):
            [row] = batch.to_pylist()
            bucket = _loaded(row)
            kept = _kept_seatings(row, bucket)
            new = py.sweep(known.value, bucket, kept[-1], number)
            last = [*kept, new][-samples:] if row["tables"] else [new]
            arrays = [
                pa.array([[getattr(s, c).astype(np.int32).tobytes() for s in last]], pa.list_(pa.binary()))
                for c in ("tables", "root_tables")
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *arrays], names=[*BUCKET_COLUMNS, "tables", "root_tables"])

    return stored(state.select(*BUCKET_COLUMNS, "tables", "root_tables").mapInArrow(seat, SEATED), "seated")


def _totals(state: DataFrame, model: py.Model) -> py.Totals:
    """Totals of the seating that the restaurants are in."""
    rounds, hots = len(model.history), len(model.hot)
    known = state.sparkSession.sparkContext.broadcast(model)

    def vector(row: dict) -> np.ndarray:
        m, bucket = known.value, _loaded(row)
        seating = _kept_seatings(row, bucket)[-1]
        tables = np.bincount(bucket.context, seating.tables, minlength=CONTEXTS)
        hot, at = py.hot_places(m, bucket.words)
        by_hot = np.bincount(at[hot], seating.root_customers[hot], minlength=hots)[:hots]
        cold = [seating.root_customers[~hot].sum(), seating.root_tables[~hot].sum()]
        return np.concatenate([tables, by_hot, cold])

    summed = _summed(state, [*BUCKET_COLUMNS, "tables", "root_tables"], vector, CONTEXTS + hots + 2)
    customers = summed[CONTEXTS : CONTEXTS + hots]
    tables = _hot_tables(model, customers, model.history[-1] if rounds else None, rounds)
    return py.Totals(
        tables=summed[:CONTEXTS] + model.single_tables,
        hot_customers=customers,
        hot_tables=tables,
        root_customers=float(summed[-2] + customers.sum()),
        root_tables=float(summed[-1] + tables.sum()),
    )


def learn(source: DataFrame, burn_in: int = 2, samples: int = 2) -> tuple[py.Model, DataFrame, int]:
    """The model after ``burn_in`` + ``samples`` sweeps, its restaurants, and the number of buckets."""
    total, hot = _frequent(source)
    buckets = max(1, -(-total // BUCKET))
    state = _restaurants(source, buckets, hot)
    hots = len(hot)
    model = py.Model(CONTEXTS, np.zeros(CONTEXTS), 0, 0, hot, np.zeros(hots))
    known = state.sparkSession.sparkContext.broadcast(model)

    def count(row: dict) -> np.ndarray:
        words, counts = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["counts"], np.int64)
        singles = np.frombuffer(row["singles"], np.int32) + np.bincount(
            np.frombuffer(row["dish"], np.int32), minlength=len(words)
        )
        is_hot, at = py.hot_places(known.value, words)
        by_hot = np.bincount(at[is_hot], counts[is_hot], minlength=hots)[:hots]
        cold = [(~is_hot).sum(), (singles[~is_hot] == 1).sum(), (singles[~is_hot] == 2).sum()]
        multi = np.bincount(np.frombuffer(row["contexts"], np.uint16), minlength=CONTEXTS)
        return np.concatenate([np.frombuffer(row["totals"], np.int64), multi, by_hot, cold])

    summed = _summed(state, ["words", "counts", "singles", "dish", "contexts", "totals"], count, 3 * CONTEXTS + 2 + hots + 3)
    model.customers = summed[:CONTEXTS]
    dishes = summed[CONTEXTS : 2 * CONTEXTS]
    once, twice = summed[2 * CONTEXTS : 2 * CONTEXTS + 2]
    rest = summed[2 * CONTEXTS + 2 :]
    model.single_tables = dishes - rest[:CONTEXTS]
    model.hot_counts = rest[CONTEXTS : CONTEXTS + hots]
    distinct, root_once, root_twice = rest[CONTEXTS + hots :]
    model.vocabulary = int(distinct + (model.hot_counts > 0).sum())
    model.train_tokens = int(model.customers.sum())
    share = lambda a, b: float(np.clip(a / (a + 2 * b), 0.1, 0.95)) if a else 0.5
    model.discount, model.root_discount = share(once, twice), share(root_once, root_twice)
    nobody = F.expr("CAST(array() AS array<binary>)")
    seated = state.withColumns({"tables": nobody, "root_tables": nobody})
    model.history.append(_totals(seated, model))  # before any sweep
    for number in range(burn_in + samples):
        last, seated = seated, _seated(seated, model, samples)
        if number:
            dropped(last)
        model.history.append(_totals(seated, model))
    return model, seated, buckets


# ---- scoring ----------------------------------------------------------------------------


def _hot_pairs(model: py.Model, state: DataFrame, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, log10 probabilities and word counts of the pairs that are frequent in training.

    At most HOT pairs can have that many of all tokens.
    """
    known = state.sparkSession.sparkContext.broadcast(model)
    least = max(HOT // 4, model.train_tokens // HOT)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for row in chain.from_iterable(b.to_pylist() for b in (x.slice(i, 1) for x in batches for i in range(x.num_rows))):
            bucket = _loaded(row)
            often = np.flatnonzero(bucket.customers > least)
            if not len(often):
                continue
            counts, context, dish = bucket.customers[often], bucket.context[often], bucket.dish[often]
            seatings = _kept_seatings(row, bucket)
            p = py.predictive(m, bucket, samples, dish, context, counts, bucket.words, seatings)
            hot, at = py.hot_places(m, bucket.words)
            seen = bucket.counts.astype(float)
            seen[hot] = m.hot_counts[at[hot]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_pair_key(bucket.words[dish], context).view(np.int64)),
                    pa.array(np.log10(p)),
                    pa.array(seen[dish]),
                ],
                names=["pair", "log_p", "seen"],
            )

    found = state.mapInArrow(pairs, "pair long, log_p double, seen double").collect()
    keys = np.array([r.pair for r in found], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r.log_p for r in found])[order], np.array([r.seen for r in found])[order]


def _pair_key(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return words * np.uint64(0x9E3779B97F4A7C15) + contexts.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def scores(docs: DataFrame, burn_in: int = 2, samples: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity.

    Null text counts as empty and has the end as its one token. Repeated rows
    are learned from and scored as often as they occur; a null id counts as
    empty text for the fold. Without training texts every word is unknown.
    """
    source = _source(docs)
    model, state, buckets = learn(source, burn_in, samples)
    pair_keys, pair_log, pair_seen = _hot_pairs(model, state, samples)
    context = docs.sparkSession.sparkContext
    known = context.broadcast((model, pair_keys, pair_log, pair_seen))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, keys_, logs, seen = known.value
        task = TaskContext.get().partitionId() << 32
        for number, (ids, train, words, contexts, lengths) in enumerate(_flushes(batches)):
            flush = task + number
            places = np.repeat(np.arange(len(ids), dtype=np.uint16), lengths)
            own = np.zeros((3, len(ids)))
            if len(keys_):
                pair = _pair_key(words, contexts)
                at = np.minimum(np.searchsorted(keys_, pair), len(keys_) - 1)
                here = keys_[at] == pair
                p, at = places[here], at[here]
                own[0] = np.bincount(p, logs[at], minlength=len(ids))
                own[1] = np.bincount(p, m.base_log(seen[at]), minlength=len(ids))
                own[2] = np.bincount(p, minlength=len(ids))
                words, contexts, places = words[~here], contexts[~here], places[~here]
            id_array = np.array([0 if i is None else i for i in ids], np.int64)
            missing = np.array([i is None for i in ids], np.uint8)
            rows = [[
                buckets + flush % buckets, flush, id_array.tobytes(), missing.tobytes(),
                train.astype(np.uint8).tobytes(), lengths.astype(np.int64).tobytes(), own.tobytes(),
            ]]
            if len(words):
                keys = _key(words, contexts, m.hot)
                order = _sorted(words, contexts, keys)
                words, contexts, keys, places = words[order], contexts[order], keys[order], places[order]
                first = _runs(keys, words, contexts, places)
                counts = np.diff(np.append(first, len(words))).astype(np.uint32)
                counts = 2 * counts + train[places[first]]
                rows += _packed_rows(
                    flush, _bucket(keys[first], buckets), words[first], contexts[first],
                    places[first], counts.astype(np.uint32),
                )
            yield _batch(rows)

    def score(key, rows: pd.DataFrame, restaurants: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return rows.drop(columns="bucket")
        if key[0] >= buckets:
            return rows.drop(columns="bucket")
        m = known.value[0]
        words, contexts, places, counts, row = _unpacked(rows)
        learned, counts = (counts & 1).astype(bool), (counts >> 1).astype(np.int64)
        order = np.lexsort((contexts, words))
        w, c = words[order], contexts[order].astype(np.int64)
        del words, contexts
        first = _runs(w, c)
        pair = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(w))))
        in_training = np.bincount(pair, np.where(learned, counts, 0)[order], minlength=len(first))
        w, c = w[first], c[first]
        distinct = _runs(w)
        word = np.repeat(np.arange(len(distinct)), np.diff(np.append(distinct, len(w))))
        vocabulary = w[distinct]
        empty = np.zeros(0, np.int64)
        if len(restaurants):
            bucket = _loaded(restaurants.iloc[0])
            seatings = _kept_seatings(restaurants.iloc[0], bucket)
        else:
            bucket = py.Bucket(int(key[0]), empty.view(np.uint64), empty, empty, empty, empty, empty)
            seatings = [py.first_seating(bucket)] * samples
        p = py.predictive(m, bucket, samples, word, c, in_training, vocabulary, seatings)
        seen = np.zeros(len(vocabulary))
        if len(bucket.words):
            at = np.minimum(np.searchsorted(bucket.words, vocabulary), len(bucket.words) - 1)
            same = bucket.words[at] == vocabulary
            seen[same] = bucket.counts[at[same]]
        hot, at = py.hot_places(m, vocabulary)
        seen[hot] = m.hot_counts[at[hot]]
        log_p, log_base, is_known = np.log10(p), m.base_log(seen), seen > 0
        pair_of = np.empty(len(order), np.int64)
        pair_of[order] = pair
        del order, pair, learned
        of = lambda x: x[pair_of] * counts
        # entries of one document in one flush are added up before they go on
        where = row.astype(np.int64) * 65536 + places
        cells, cell = np.unique(where, return_inverse=True)
        sums = [np.bincount(cell, of(x)) for x in (log_p, log_base[word], is_known[word])]
        at_row = cells >> 16
        out = []
        for i, flush in enumerate(rows["flush"]):
            here = slice(*np.searchsorted(at_row, [i, i + 1]))
            out.append([
                flush, (cells[here] & 65535).astype(np.uint16).tobytes(),
                *[s[here].tobytes() for s in sums], b"",
            ])
        return pd.DataFrame(out, columns=NAMES[1:])

    def assemble(rows: pd.DataFrame) -> pd.DataFrame:
        whole = rows[rows["counts"].str.len() > 0].iloc[0]
        ids = np.frombuffer(whole["words"], np.int64)
        missing = np.frombuffer(whole["sizes"], np.uint8).astype(bool)
        train = np.frombuffer(whole["contexts"], np.uint8).astype(bool)
        lengths = np.frombuffer(whole["places"], np.int64)
        totals = np.frombuffer(whole["counts"]).reshape(3, -1).copy()
        for part in rows[rows["counts"].str.len() == 0].itertuples():
            places = np.frombuffer(part.words, np.uint16)
            for k, column in enumerate((part.sizes, part.contexts, part.places)):
                totals[k][places] += np.frombuffer(column)
        return pd.DataFrame({
            "doc_id": pd.Series(ids).astype("Int64").mask(missing),
            "held_out": ~train,
            "n_tokens": lengths,
            "n_known": totals[2].round().astype(np.int64),
            "base_score": totals[1],
            "score": totals[0],
        })

    packed = source.mapInArrow(pack, PACKED)
    parts = (
        packed.groupBy("bucket")
        .cogroup(state.groupBy("bucket"))
        .applyInPandas(score, PACKED.replace("bucket int, ", ""))
    )
    found = parts.groupBy("flush").applyInPandas(
        assemble,
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
