"""SimHash near-duplicates through an index of byte positions.

A fingerprint is eight bytes. Fingerprints that differ in at most three bits
differ in at most three bytes, so they share at least five bytes position by
position. Postings of single bytes would hold 1/256 of all fingerprints each;
the index therefore posts triples of positional bytes. The eight triples inside
the two halves of a fingerprint suffice: five shared positions put three into
one half. Pairs that meet in a posting have their shared positional bytes
counted, those below the guaranteed five go, and the bit distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import rows_of, set_apart, stored, texts_of
from stocklens.llm.graph import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
BYTES = 8


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of the text's word shingles, as an unsigned 64-bit number."""
    words = data.lower().split()  # on bytes: A-Z, and exactly \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest = xxhash.xxh64_digest
    shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    counts = np.zeros(64, np.int64)
    for start in range(0, len(shingles), 1 << 14):
        hashes = b"".join([digest(s, SEED) for s in shingles[start : start + (1 << 14)]])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, BYTES), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(shingles)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``simhash_``, the fingerprint as a signed long, in front of each row."""
    schema = "simhash_ long, " + ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields
    )
    at, names = docs.columns.index("text"), ["simhash_", *docs.columns]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = (t.as_py() for t in batch.column(at).cast(pa.binary()))
            prints = [fingerprint(t or b"", shingle) for t in texts]
            column = pa.array(np.array(prints, np.uint64).astype(np.int64))
            yield pa.RecordBatch.from_arrays([column, *batch.columns], names=names)

    return docs.mapInArrow(add, schema)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long, for every document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            column = pa.array(np.array(prints, np.uint64).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["doc_id", "fp"])

    return texts_of(docs).mapInArrow(compute, "doc_id long, fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    differing = a.bitwiseXOR(b)
    return sum(
        (F.when(_byte(differing, i) == 0, 1).otherwise(0) for i in range(BYTES)), F.lit(0)
    )


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fp`` within ``max_bits``.

    ``max_bits`` may be 3 at most, which the eight triples are enough for.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the index of byte triples covers distances of 0 to 3 bits")
    fp = F.col("fp")
    triples = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
    postings = [
        sum((F.shiftleft(_byte(fp, p), 8 * k) for k, p in enumerate(t)), F.lit(n << 24))
        for n, t in enumerate(triples)
    ]
    index = prints.select("fp", F.explode(F.array(*postings)).alias("posting"))
    a, b = index.withColumnRenamed("fp", "a"), index.withColumnRenamed("fp", "b")
    return (
        a.join(b, "posting")
        .where(F.col("a") < F.col("b"))
        .where(shared_bytes(F.col("a"), F.col("b")) >= BYTES - max_bits)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        .select("a", "b")
        .distinct()
    )


def near_duplicates(prints: DataFrame) -> DataFrame:
    """(fp, component_id): the smallest doc_id reachable from a fingerprint over links.

    ``prints`` has doc_id and fp, one row per document. Copies share a
    fingerprint and count as one node; null ids are passed over, a component
    without any id gets null.
    """
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(nodes))
    linked = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return linked.join(least, "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Null text counts as empty; a text without words has fingerprint zero, and a
    text with fewer words than a shingle hashes its whole sequence. Repeated
    rows come out as often as they went in.
    """
    prints = stored(fingerprints(docs, shingle), "simhash")
    found = near_duplicates(prints)
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` without near duplicates: of each component the smallest id stays.

    Columns stay as they are. Rows without an id come last; among rows with
    the same id the smallest text stays, and of equal rows one.
    """
    docs, named = set_apart(docs)
    marked = stored(with_fingerprints(docs, shingle), "marked")
    prints = marked.select(F.col("simhash_").alias("fp"), "doc_id")
    found = near_duplicates(prints).withColumnRenamed("fp", "simhash_")
    found = found.select(F.col("simhash_").alias("fp_"), F.col("component_id").alias("group_"))
    order = F.struct(
        F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"),
        F.xxhash64("text").alias("t"),
    )
    groups = marked.select("simhash_", order.alias("order_")).join(
        found, F.col("simhash_") == F.col("fp_")
    )
    # a component without any id is known by its least fingerprint alone
    key = F.coalesce(F.col("group_"), F.col("simhash_"))
    anonymous = F.col("group_").isNull()
    firsts = groups.groupBy(key.alias("k"), anonymous.alias("anonymous")).agg(
        F.min("order_").alias("order_"), F.min_by("simhash_", "order_").alias("simhash_")
    )
    firsts = firsts.select(
        F.col("simhash_").alias("fp_"), F.col("order_.i").alias("i_"), F.col("order_.t").alias("t_")
    )
    here = (
        (F.col("simhash_") == F.col("fp_"))
        & F.col("doc_id").eqNullSafe(F.col("i_"))
        & (F.xxhash64("text") == F.col("t_"))
    )
    kept = marked.join(firsts, here, "left_semi")
    again = (
        marked.groupBy("simhash_", "doc_id", F.xxhash64("text").alias("t_"))
        .count()
        .where("count > 1")
        .select(F.col("simhash_").alias("fp_"), F.col("doc_id").alias("i_"), "t_")
    )
    single = kept.join(again, here, "left_anti")
    repeated = kept.join(again, here, "left_semi").dropDuplicates(["simhash_", "doc_id"])
    return named(single.union(repeated))
