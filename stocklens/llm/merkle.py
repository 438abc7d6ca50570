"""A Merkle tree of a dataset whose parents keep the SHA state before each child.

Leaves are hashes of rows. Per source, 16 neighbours make a parent, up to one
subroot; subroots make the root in the same way. A parent keeps its children's
digests and, for each, the hash state reached before it. To fold a leaf to the
root, each parent's state before the child is taken up, and only the child's
new digest and those right of it are hashed.

Leaves are numbered by a sort over ranges, not within a source, so a source
that holds most rows is many ranges. Parents hold 16 rows at most. Paths to the
root are handed down from parents to children, so no join has a key with more
than 16 partners, and documents meet their path 16 at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.llm import sha_states
from stocklens.llm.common import rows_of, stored

FANOUT = 16
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id counts rows in its lower bits
PATH = "array<struct<kids:string,slot:int,state:binary>>"


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The hash of a row: each value after its length in bytes, ``-`` for null."""

    def item(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(item, (doc_id, source, lang, n_chars, text))), 256)


def tampered(doc_id: Column, text: Column) -> Column:
    """The text in lower case (A-Z) where 5 divides crc32 of the id; rows without an id stay."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate(text, CAPITALS, CAPITALS.lower())).otherwise(text)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, their number in this order, and ``part``, the range they are in.

    Rows are dealt by ranges and counted there; only one number for each range
    meets in one task.
    """
    ranges = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(
        rows.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(_IN_PARTITION).alias("row")),
        "ranges",
    )
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))  # one row for each range
    return dealt.join(F.broadcast(firsts), "part").withColumn("at", F.col("first") + F.col("row")).drop("first", "row")


def _with_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parents from their children: the state before each child, and the digest."""
    for batch in rows_of(batches, 4096):
        kids = batch.column("kids").to_pylist()
        counts = np.array([len(k) // sha_states.BLOCK for k in kids], np.int64)
        padded = sha_states.to_blocks([k.ljust(FANOUT * sha_states.BLOCK, "0") for k in kids]).reshape(-1, FANOUT, 16)
        state = np.tile(sha_states.START, (len(kids), 1))
        kept = np.zeros((len(kids), FANOUT, 8), np.uint32)
        for slot in range(FANOUT):
            here = np.flatnonzero(counts > slot)
            kept[here, slot] = state[here]
            state[here] = sha_states.advance(state[here], padded[here, slot])
        digests = sha_states.to_hex(sha_states.closed(state, counts))
        states = [kept[i, :n].astype(">u4").tobytes() for i, n in enumerate(counts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), batch.column("at"), batch.column("n"), batch.column("kids"),
             pa.array(states, pa.binary()), pa.array(digests, pa.string())],
            names=["tree", "at", "n", "kids", "states", "digest"],
        )


def _parents(nodes: DataFrame) -> DataFrame:
    """The level above: tree, at, n (nodes of the tree there), kids, states, digest."""
    kids = F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"])
    above = F.floor((F.first("n") + FANOUT - 1) / FANOUT).cast("long").alias("n")
    grouped = nodes.groupBy("tree", F.expr(f"at div {FANOUT}").alias("run")).agg(F.array_join(kids, "").alias("kids"), above)
    return grouped.select("tree", F.col("run").alias("at"), "n", "kids").mapInArrow(
        _with_states, "tree long, at long, n long, kids string, states binary, digest string"
    )


def levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, at, n, digest), until every tree has one node."""
    found = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        found.append(stored(_parents(nodes.where("n > 1")), f"{name}{len(found) + 1}"))
        nodes, most = found[-1], -(-most // FANOUT)
    return found


def _tops(nodes: DataFrame, above: list[DataFrame]) -> DataFrame:
    """tree and digest of the last node of every tree."""
    found = nodes.where("n = 1").select("tree", "digest")
    for level in above:
        found = found.union(level.where("n = 1").select("tree", "digest"))
    return found


def _handed_down(parents: DataFrame) -> DataFrame:
    """tree, at, path and end of the children of parents with their own path."""
    slots = parents.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"length(kids) div {sha_states.BLOCK} - 1"))).alias("slot"))
    step = F.struct("kids", "slot", F.expr("substring(states, slot * 32 + 1, 32)").alias("state"))
    at = F.col("at") * FANOUT + F.col("slot")
    return slots.select("tree", at.alias("at"), F.concat(F.array(step), F.col("path")).alias("path"), "end")


def _paths(above: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest of the levels with the path of its nodes, from ``tops`` with tree, path and end."""
    found = None
    for level in reversed(above):
        own = level.where("n = 1").join(tops, "tree")
        if found is not None:
            own = own.unionByName(level.where("n > 1").join(_handed_down(found), ["tree", "at"]))
        found = own
    return found


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds the documents of a run to the root, and hashes their siblings."""
    for batch in rows_of(batches, 512):
        rows = batch.to_pylist()
        steps, values, owner, slots = [], [], [], []
        for number, row in enumerate(rows):
            own = [] if row["n"] == 1 else [{"kids": row["kids"], "slot": None, "state": row["states"]}]
            steps.append(own + row["path"])
            for slot, doc in enumerate(row["docs"]):
                values.append(doc["changed"] or doc["leaf"])
                owner.append(number)
                slots.append(slot)
        owner_of, slot_of = np.array(owner, np.int64), np.array(slots, np.int64)
        blocks = sha_states.to_blocks(values) if values else np.zeros((0, 16), np.uint32)
        for depth in range(max(map(len, steps), default=0)):
            here = [s[depth] if depth < len(s) else None for s in steps]
            with_step = np.array([s is not None for s in here])
            counts = np.array([len(s["kids"]) // sha_states.BLOCK if s else 0 for s in here], np.int64)
            kids = sha_states.to_blocks([(s["kids"] if s else "").ljust(FANOUT * sha_states.BLOCK, "0") for s in here])
            kids = kids.reshape(-1, FANOUT, 16)
            docs = np.flatnonzero(with_step[owner_of])
            at = np.array([
                slot if here[o]["slot"] is None else here[o]["slot"] for o, slot in zip(owner_of[docs], slot_of[docs], strict=True)
            ], np.int64)
            state = sha_states.from_bytes([
                here[o]["state"][32 * a : 32 * a + 32] if here[o]["slot"] is None else here[o]["state"]
                for o, a in zip(owner_of[docs], at, strict=True)
            ])
            for slot in range(FANOUT):
                on = np.flatnonzero((at <= slot) & (slot < counts[owner_of[docs]]))
                if len(on):
                    given = np.where((at[on] == slot)[:, None], blocks[docs[on]], kids[owner_of[docs[on]], slot])
                    state[on] = sha_states.advance(state[on], given)
            if len(docs):
                blocks[docs] = sha_states.to_blocks(sha_states.to_hex(sha_states.closed(state, counts[owner_of[docs]])))
        folded = blocks.astype(">u4").tobytes().decode()
        out, number = [], 0
        for row, path in zip(rows, steps, strict=True):
            others = []
            for step in path:
                if step["slot"] is not None:
                    cut = sha_states.BLOCK * step["slot"]
                    others.append(step["kids"][:cut] + step["kids"][cut + sha_states.BLOCK :])
            above, end = "".join(others), row["end"]
            for slot, doc in enumerate(row["docs"]):
                cut = sha_states.BLOCK * slot
                beside = "" if row["n"] == 1 else row["kids"][:cut] + row["kids"][cut + sha_states.BLOCK :]
                proof = hashlib.sha256((beside + above).encode()).hexdigest()
                new = folded[sha_states.BLOCK * number : sha_states.BLOCK * (number + 1)]
                out.append((doc["doc_id"], doc["leaf"], end["subroot"], end["root"], proof, new, new == end["root"]))
                number += 1
        kinds = (pa.int64(), *[pa.string()] * 5, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
            names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Leaves of a source come by doc_id (null first), then by their hash; repeated
    rows are leaves of their own. ``folded_root`` is made of the leaf of the
    tampered row, ``verified`` tells that it is the root. A null source is a
    source, a null value is hashed as ``-``, an empty table has no rows. Columns
    beside the five of documents are not read.
    """
    doc_id, source = F.col("doc_id").cast("long"), F.col("source")
    own = [doc_id, source, F.col("lang"), F.col("n_chars"), F.col("text")]
    changed = [*own[:4], tampered(doc_id, F.col("text"))]
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    leaves = stored(
        docs.select(
            # null sources first, then by bytes; a row's place lets equal rows be in several ranges
            F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("source"),
            doc_id.alias("doc_id"), leaf(*own).alias("leaf"),
            F.when(hit, leaf(*changed)).alias("changed"), F.monotonically_increasing_id().alias("place"),
        ),
        "leaves",
    )
    placed = numbered(leaves, "source", "doc_id", "leaf", "place")
    parts = placed.groupBy("part", "source").agg(F.min("at").alias("lowest"), F.count("*").alias("rows"))
    sources = parts.groupBy("source").agg(F.min("lowest").alias("tree"), F.sum("rows").alias("n"))
    # a source that holds many rows has a key for each of its ranges
    known = parts.select("part", "source").join(sources, "source")
    nodes = stored(
        placed.join(known, ["part", "source"]).select(
            "tree", (F.col("at") - F.col("tree")).alias("at"), "n", F.col("leaf").alias("digest"), "doc_id", "changed"
        ),
        "nodes",
    )
    above = levels(nodes, "level")

    tops = stored(_tops(nodes, above), "subroots")
    order = numbered(tops, "tree").withColumnRenamed("tree", "own").drop("part")
    n_trees = tops.count()
    roots = stored(order.select(F.lit(0).cast("long").alias("tree"), "at", F.lit(n_trees).cast("long").alias("n"), "digest", "own"), "roots")
    over = levels(roots, "over")
    none = F.expr(f"CAST(array() AS {PATH})").alias("path")
    if over:
        last = over[-1].select("tree", none, F.col("digest").alias("end"))
        paths = roots.join(_handed_down(_paths(over, last)), ["tree", "at"])
    else:
        paths = roots.select("*", none, F.col("digest").alias("end"))
    end = F.struct(F.col("digest").alias("subroot"), F.col("end").alias("root")).alias("end")
    subroots = stored(paths.select(F.col("own").alias("tree"), "path", end), "paths")

    doc = F.struct("at", F.col("digest").alias("leaf"), "doc_id", "changed")
    runs = nodes.groupBy("tree", F.expr(f"at div {FANOUT}").alias("at")).agg(
        F.sort_array(F.collect_list(doc)).alias("docs"), F.first("n").alias("n")
    )
    lone = runs.where("n = 1").drop("at").withColumns({"kids": F.lit(""), "states": F.lit(b"")})
    given = ("docs", "n", "kids", "states", "path", "end")
    folding = lone.join(subroots, "tree").select(*given)
    if above:
        paths = _paths(above, subroots).select("tree", "at", "kids", "states", "path", "end")
        folding = folding.union(runs.where("n > 1").join(paths, ["tree", "at"]).select(*given))
    return folding.mapInArrow(
        _folded,
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
