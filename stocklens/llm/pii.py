"""Personal data: exact base spans, and further spans chosen by boosted trees.

Base rules find spans that pass a check of their kind. Generators of high
recall propose spans that may overlap each other and the base, such as a phone
number whose match the base rule ran on into the number after it. Boosted trees
score every proposal by its format and context. They learn from proposals that
equal a base span, from base spans rewritten in the spellings the base does not
know, and, as negative ones, from proposals and rewritten spans that fail the
check of their kind or stand in a token; all others have no label. A threshold
per kind is calibrated on labelled spans kept out of the fit. Proposals that
reach it join the base spans.

Everything here is DataFrame expressions. Spans are code points, end exclusive.
Arrays of spans are made and merged in one pass each, block by block, and texts
are looked into by pieces of fixed size, so work grows with the text also where
one holds very many spans. Documents travel as one struct; no column of theirs
can clash with those added here.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import set_apart, stored

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive repeats and the starts \G (where the last match
# ended) or "not inside such a run" find the same matches in linear time.
_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests that every text with such a span passes.
GATES = {
    "email": r"[A-Za-z0-9]@[A-Za-z0-9]|[._%+-]@[A-Za-z0-9-]|@-",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9]",
}
# Proposals: kind, pattern, gate.
GENERATORS = (
    ("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?)[A-Za-z0-9-]++)++", r"@|\(at\)|\[at\]"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?!\.?[0-9])", r"[0-9]\.[0-9]"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])", r"[0-9](?:[\x20-]?[0-9]){12}"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])", r"[0-9]{13}"),
    ("card", r"(?<![0-9])3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![0-9])", r"[0-9](?:[\x20-]?[0-9]){12}"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])", r"\+[0-9]"),
    ("phone", r"(?<![0-9+.])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.])", r"[0-9]\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
)

SPAN = "array<struct<s:int,e:int,m:string>>"
PLACES = "array<struct<kind:int,s:int,e:int>>"
FEATURES = (
    "kind", "length", "digits", "separators", "luhn", "octets", "before", "after",
    "brackets", "digits_before", "digits_after", "cue", "dots", "digit_groups",
)


BLOCK = 128  # entries that are appended to one array
PIECE = 1024  # characters


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed a single time."""
    return F.get(F.transform(F.array(value), use), 0)


def _scan(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """What ``step`` emits for each item, given the state it left at the one before.

    ``step`` returns the new state and an array of type ``kind`` to append.
    Blocks of ``BLOCK`` items have arrays of their own: an append copies no
    more than a block.
    """
    none = F.expr(f"CAST(array() AS {kind})")
    nothing = F.expr(f"CAST(array() AS array<{kind}>)")

    def inner(acc: Column, x: Column) -> Column:
        new, out = step(acc["state"], x)
        return F.struct(new.alias("state"), F.concat(acc["out"], out).alias("out"))

    def outer(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["state"].alias("state"), none.alias("out")), inner)
        return _once(done, lambda d: F.struct(
            d["state"].alias("state"), F.concat(acc["blocks"], F.array(d["out"])).alias("blocks")
        ))

    def scanned(items: Column) -> Column:
        n = F.size(items)
        firsts = F.sequence(F.lit(0), n - 1, F.lit(BLOCK))
        block = lambda at: F.sequence(at, F.least(at + (BLOCK - 1), n - 1))
        # single entries are taken out, as a slice copies the whole array
        blocks = F.transform(firsts, lambda at: F.transform(block(at), lambda i: F.get(items, i)))
        start = F.struct(state.alias("state"), nothing.alias("blocks"))
        return F.when(n > 0, F.aggregate(blocks, start, outer, lambda acc: F.flatten(acc["blocks"]))).otherwise(none)

    return _once(items, scanned)


def _pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}+"), F.lit(0))


def _between(pieces: Column, s: Column, e: Column) -> Column:
    """Characters from ``s`` to ``e`` of the text cut into pieces."""
    first = F.floor(s / PIECE).cast("int")
    last = F.floor(e / PIECE).cast("int")
    short = F.concat(F.get(pieces, first), F.when(last > first, F.coalesce(F.get(pieces, last), F.lit(""))).otherwise(""))
    joined = F.when(last <= first + 1, short).otherwise(F.array_join(F.slice(pieces, first + 1, last - first + 1), ""))
    cut = _once(joined, lambda j: F.substring(j, s - first * PIECE + 1, e - s))
    return F.when((e > s) & (first < F.size(pieces)), cut).otherwise("")


def _place(spans: Column, s: Column) -> Column:
    """How many of the spans, sorted and apart from each other, start at ``s`` or before; by halving."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(spans) + F.lit(1))).cast("int"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        ahead = F.get(spans, middle)["s"] <= s
        return F.when(acc["low"] >= acc["high"], acc).otherwise(F.struct(
            F.when(ahead, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(ahead, acc["high"]).otherwise(middle).alias("high"),
        ))

    start = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    return F.when(F.size(spans) == 0, 0).otherwise(F.aggregate(steps, start, halve, lambda acc: acc["low"]))


def _meets(spans: Column, s: Column, e: Column) -> Column:
    """Whether one of the spans, sorted and apart from each other, overlaps [s, e)."""
    before = lambda n: F.coalesce(F.get(spans, n - 1)["e"] > s, F.lit(False))
    after = lambda n: F.coalesce(F.get(spans, n)["s"] < e, F.lit(False))
    return _once(_place(spans, s), lambda n: before(n) | after(n))


def _found(text: Column, pattern: str, gate: str) -> Column:
    """Start, end and text of all matches, from the pieces between them."""
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    both = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps, lambda m, gap: F.struct(m.alias("m"), gap.alias("gap"))
    )

    def add(at: Column, x: Column) -> tuple[Column, Column]:
        s = at + x["gap"]
        e = s + F.length(x["m"])
        return e, F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))

    # the last piece has no match after it
    matches = F.filter(both, lambda x: x["m"].isNotNull())
    none = F.expr(f"CAST(array() AS {SPAN})")
    spans = _scan(matches, F.lit(0), add, SPAN)
    return F.when(F.rlike(text, F.lit(gate)), spans).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of ``m`` pass the check-sum, the last digit counted once."""
    reverse = F.reverse(_digits(m))
    digits = F.filter(F.split(reverse, ""), lambda c: c != "")
    worth = F.transform(
        digits,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return F.rlike(m, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    if kind == "card":
        return n.between(13, 19) & luhn(m)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _passing(kind: str):
    return lambda x: _passes(kind, x["m"])


def _side(c: Column) -> Column:
    """The class of a neighbouring character: 0 none, 1 space, 2 letter, 3 digit, 4 quote, 5 other."""
    return (
        F.when(c == "", 0)
        .when(F.rlike(c, F.lit(r"^\s")), 1)
        .when(F.rlike(c, F.lit(r"^\p{L}")), 2)
        .when(F.rlike(c, F.lit("^[0-9]")), 3)
        .when(F.rlike(c, F.lit("^[\"'=]")), 4)
        .otherwise(5)
    )


def _features(kind: str, x: Column, pieces: Column) -> Column:
    m, s, e = x["m"], x["s"], x["e"]
    around = F.struct(
        _between(pieces, F.greatest(s - 12, F.lit(0)), s).alias("before"), _between(pieces, e, e + 12).alias("after")
    )
    return _once(around, lambda c: _described(kind, m, c["before"], c["after"]))


def _described(kind: str, m: Column, before: Column, after: Column) -> Column:
    truth = lambda c: F.when(c, 1).otherwise(0)
    values = {
        "kind": F.lit(KINDS.index(kind)),
        "length": F.least(F.length(m), F.lit(80)),
        "digits": F.least(F.length(_digits(m)), F.lit(40)),
        "separators": F.least(F.length(F.regexp_replace(m, r"[^\x20().-]", "")), F.lit(20)),
        "luhn": truth(luhn(m)),
        "octets": truth(F.rlike(m, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))),
        "before": _side(F.right(before, F.lit(1))),
        "after": _side(F.left(after, F.lit(1))),
        "brackets": truth(m.contains("(")),
        "digits_before": F.length(_digits(before)),
        "digits_after": F.length(_digits(after)),
        "cue": truth(F.rlike(before, F.lit(r"(?i)(?:token|secret|key|id|no\.?)\W*$"))),
        "dots": F.least(F.length(F.regexp_replace(m, "[^.]", "")), F.lit(9)),
        "digit_groups": F.least(F.size(F.split(m, "[^0-9]+")), F.lit(12)),
    }
    return F.array(*[values[name].cast("int") for name in FEATURES])


PROPOSAL = "array<struct<kind:int,s:int,e:int,f:array<int>,y:int>>"


NO_LABEL = -1
PRIOR = 10  # labelled spans that a kind's share of right ones is taken to rest on already


def _label(kind: str, x: Column, f: Column, base: Column) -> Column:
    """1 for a base span, 0 for what fails its check or stands in a word or token, else no label.

    What overlaps a base span without being one has none: it cannot be chosen.
    """
    before, after, cue = (f[FEATURES.index(name)] for name in ("before", "after", "cue"))
    inside = (before == 2) | (after == 2) if kind != "email" else F.lit(False)
    same = _once(_place(base, x["s"]), lambda n: F.coalesce(
        (F.get(base, n - 1)["s"] == x["s"]) & (F.get(base, n - 1)["e"] == x["e"]), F.lit(False)
    ))
    return (
        F.when(same, 1)
        .when(_meets(base, x["s"], x["e"]), NO_LABEL)
        .when(~_passes(kind, x["m"]) | inside | ((before == 4) & (cue == 1)), 0)
        .otherwise(NO_LABEL)
    )


def _rewritten(kind: str, m: Column) -> list[tuple[Column, int]]:
    """Other spellings of a base span, and corrupt ones that fail its check, with their labels."""
    if kind == "email":
        name, host = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
        return [
            (F.concat(name, F.lit(f" {a}at{z} "), F.replace(host, F.lit("."), F.lit(f" {a}dot{z} "))), 1)
            for a, z in ("()", "[]")
        ]
    if kind == "ip":
        return [(F.regexp_replace(m, "^[0-9]+", "999"), 0)]
    if kind == "card":
        last = F.pmod(F.right(m, F.lit(1)).cast("int") + 1, F.lit(10)).cast("string")
        return [(F.concat(F.left(m, F.length(m) - 1), last), 0)]
    return [
        (F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]?", ""), 1),
        (F.concat(m, F.lit(" 190.137.223.204")), 0),  # run on
    ]


def _taught(kind: str, base: Column, pieces: Column) -> list[Column]:
    """Rewritten base spans in the places of the base spans, where a generator would propose them."""
    generated = "|".join(f"(?:{p})" for k, p, _ in GENERATORS if k == kind)

    def spans(number: int, label: int) -> Column:
        written = F.transform(
            base, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), _rewritten(kind, x["m"])[number][0].alias("m"))
        )
        whole = F.filter(written, lambda x: F.rlike(x["m"], F.lit(f"^(?:{generated})$")))
        return F.transform(whole, lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), x["s"].alias("s"), x["e"].alias("e"),
            _features(kind, x, pieces).alias("f"), F.lit(label).alias("y"),
        ))

    return [spans(i, y) for i, (_, y) in enumerate(_rewritten(kind, F.lit("")))]


def with_proposals(docs: DataFrame, text: str) -> DataFrame:
    """row (a document), base_ (spans of each kind), proposed_ (kind, span, features, label), taught_ (the same)."""
    t = F.coalesce(F.col(text), F.lit(""))
    packed = docs.select(F.struct("*").alias("row"), t.alias("text_"), _pieces(t).alias("pieces_"))
    t, pieces = F.col("text_"), F.col("pieces_")
    base = F.struct(*[
        F.filter(_found(t, PATTERNS[k], GATES[k]), _passing(k)).alias(k) for k in KINDS
    ])
    packed = packed.withColumn("base_", base)

    def proposals(kind: str, pattern: str, gate: str) -> Column:
        known = F.col("base_")[kind]
        described = F.transform(
            _found(t, pattern, gate),
            lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"), _features(kind, x, pieces).alias("f")),
        )
        return F.transform(
            described,
            lambda x: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["f"].alias("f"),
                _label(kind, x, x["f"], known).alias("y"),
            ),
        )

    parts = [proposals(*g).cast(PROPOSAL) for g in GENERATORS]
    taught = [x.cast(PROPOSAL) for k in KINDS for x in _taught(k, F.col("base_")[k], pieces)]
    # several generators may propose the same span: equal ones are neighbours when sorted
    distinct = _once(
        F.sort_array(F.concat(*parts)), lambda all_: F.filter(all_, lambda p, i: (i == 0) | (p != F.get(all_, i - 1)))
    )
    plain = F.struct(*[
        F.transform(F.col("base_")[k], lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS
    ])
    return packed.select("row", plain.alias("base_"), distinct.alias("proposed_"), F.concat(*taught).alias("taught_"))


# ---- boosted trees ----------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """feature <= cut goes left, else right; a leaf has only a value."""

    value: float
    feature: int = -1
    cut: int = 0
    left: Node | None = None
    right: Node | None = None

    def column(self, f: Column) -> Column:
        if self.feature < 0 or self.left is None or self.right is None:
            return F.lit(self.value)
        return F.when(f[self.feature] <= self.cut, self.left.column(f)).otherwise(self.right.column(f))


@dataclass(frozen=True)
class Boosted:
    """Trees, and for kinds with enough labelled spans the margin from which they are trusted.

    ``default`` is that of the others: where the model itself is as sure as it is asked to be.
    """

    trees: tuple[Node, ...]
    offset: float
    thresholds: dict[int, float]
    default: float = math.inf

    def margin(self, f: Column) -> Column:
        return reduce(lambda a, t: a + t.column(f), self.trees, F.lit(self.offset))


def _split(rows: DataFrame, depth: int, ridge: float, least: float) -> list[tuple[int, int, int, float, float, float, float]]:
    """For each leaf (path_) its best split, from sums by feature and value.

    The sums shrink to leaves x features x values (at most 81 of each) before
    the best cut of each leaf is taken.
    """
    long = rows.select("path_", "g_", "h_", F.posexplode("f").alias("feature", "value"))
    sums = long.groupBy("path_", "feature", "value").agg(F.sum("g_").alias("g"), F.sum("h_").alias("h"))
    return [(r.path_, r.feature, r.value, r.g, r.h) for r in sums.collect()]


def _grown(rows: DataFrame, depth: int, rate: float, ridge: float, least: float) -> Node:
    """One tree of gradients g_ and curvatures h_, level by level."""
    shape: dict[int, tuple[int, int]] = {}
    values: dict[int, float] = {}

    def path(f: Column, at: int, level: int) -> Column:
        if at not in shape:
            return F.lit(at)
        feature, cut = shape[at]
        return F.when(f[feature] <= cut, path(f, 2 * at, level + 1)).otherwise(path(f, 2 * at + 1, level + 1))

    for level in range(depth + 1):
        sums: dict[int, dict[int, list]] = {}
        for p, feature, value, g, h in _split(rows.withColumn("path_", path(F.col("f"), 1, 0)), depth, ridge, least):
            sums.setdefault(p, {}).setdefault(feature, []).append((value, g, h))
        for p, by_feature in sorted(sums.items()):
            if p < 1 << level:
                continue
            any_feature = by_feature[min(by_feature)]
            g_all, h_all = sum(x[1] for x in any_feature), sum(x[2] for x in any_feature)
            values[p] = rate * g_all / (h_all + ridge)
            if level == depth:
                continue
            best = (1e-6, None)
            for feature, found in sorted(by_feature.items()):
                g = h = 0.0
                for value, dg, dh in sorted(found)[:-1]:
                    g, h = g + dg, h + dh
                    if h < least or h_all - h < least:
                        continue
                    gain = g * g / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
                    if round(gain, 9) > round(best[0], 9):
                        best = (gain, (feature, value))
            if best[1]:
                shape[p] = best[1]

    def node(at: int) -> Node:
        if at not in shape:
            return Node(values.get(at, 0.0))
        return Node(0.0, *shape[at], node(2 * at), node(2 * at + 1))

    return node(1)


def fit(proposed: DataFrame, bound: int = 20_000, trees: int = 6, depth: int = 3, precision: float = 0.95) -> Boosted:
    """Trees of at most ``bound`` labelled proposals, and thresholds of all kept out of the fit.

    ``proposed`` has proposed_ and taught_ by document; a rewritten span falls on
    the same side as its original. Each kind has its own share of ``bound``,
    picked by a hash from three fourths of the proposals. All of the last fourth
    sets the thresholds: for each kind the least margin from which ``precision``
    of them are positive, ``PRIOR`` spans of just that share counted in. Where
    no labelled span of a kind was kept out, the probability of the trees has
    to be ``precision``; so few spans differ from many only by what they show.
    """
    labelled = F.filter(F.concat("proposed_", "taught_"), lambda p: p["y"] != NO_LABEL)
    # the text is left behind before there is a row for each proposal
    short = proposed.select(F.col("row.doc_id").alias("doc_id"), labelled.alias("labelled"))
    rows = short.select("doc_id", F.explode("labelled").alias("p")).select(
        "p.kind", "p.f", "p.y", F.xxhash64("doc_id", "p.s", "p.e", "p.kind").alias("pick")
    )
    inside = F.pmod("pick", F.lit(4)) != 3
    shares = [
        rows.where(inside & (F.col("kind") == k)).orderBy("pick", "f", "y").limit(bound // len(KINDS))
        for k in range(len(KINDS))
    ]
    learn = stored(reduce(DataFrame.union, shares), "proposals")
    counts = learn.agg(F.count("*").alias("n"), F.sum("y").alias("y")).first()
    if not counts.n or not 0 < counts.y < counts.n:
        return Boosted((), 0.0, {})
    offset = math.log(counts.y / (counts.n - counts.y))
    grown: list[Node] = []
    for _ in range(trees):
        margin = Boosted(tuple(grown), offset, {}).margin(F.col("f"))
        p = 1 / (1 + F.exp(-margin))
        grown.append(
            _grown(learn.select("f", (F.col("y") - p).alias("g_"), (p * (1 - p)).alias("h_")), depth, 0.6, 1.0, 2.0)
        )
    model = Boosted(tuple(grown), offset, {})
    margins = (
        rows.where(~inside)
        .groupBy("kind", F.round(model.margin(F.col("f")), 9).alias("margin"))
        .agg(F.count("*").alias("n"), F.sum("y").alias("y"))
        .collect()  # a row for each kind and set of leaves
    )
    thresholds: dict[int, float] = {}
    for kind in range(len(KINDS)):
        n = y = 0
        for row in sorted((r for r in margins if r.kind == kind), key=lambda r: -r.margin):
            n, y = n + row.n, y + row.y
            if y + PRIOR * precision >= precision * (n + PRIOR):
                thresholds[kind] = row.margin
        if n and kind not in thresholds:
            thresholds[kind] = math.inf
    return Boosted(model.trees, offset, thresholds, math.log(precision / (1 - precision)))


def with_spans(proposed: DataFrame, model: Boosted) -> DataFrame:
    """Adds all_: kind (number), s and e of base spans and chosen proposals, by kind and start.

    Of chosen proposals that overlap each other or a base span of their kind,
    the base and then the first and shortest stay: a longer one has run on.
    """

    def numbered(kind: int):
        return lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))

    base = F.concat(*[F.transform(F.col("base_")[k], numbered(i)) for i, k in enumerate(KINDS)])

    def chosen(p: Column) -> Column:
        limit = F.lit(model.default)
        for kind, threshold in model.thresholds.items():
            limit = F.when(p["kind"] == kind, F.lit(threshold)).otherwise(limit)
        return F.round(model.margin(p["f"]), 9) >= limit

    def meets_base(p: Column) -> Column:
        found = F.lit(False)
        for i, kind in enumerate(KINDS):
            found = F.when(p["kind"] == i, _meets(F.col("base_")[kind], p["s"], p["e"])).otherwise(found)
        return found

    more = F.filter(F.col("proposed_"), lambda p: chosen(p) & ~meets_base(p))
    ordered = F.array_sort(F.transform(
        more, lambda p: F.struct(p["kind"].alias("kind"), p["s"].alias("s"), p["e"].alias("e"))
    ))

    def keep(last: Column, p: Column) -> tuple[Column, Column]:
        free = (last["kind"] != p["kind"]) | (last["e"] <= p["s"])
        return F.when(free, p).otherwise(last), F.when(free, F.array(p)).otherwise(F.expr(f"CAST(array() AS {PLACES})"))

    nothing = F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("s"), F.lit(0).alias("e"))
    df = proposed.withColumns({"known_": base, "ordered_": ordered})
    df = df.withColumn("added_", _scan(F.col("ordered_"), nothing, keep, PLACES)).drop("ordered_")
    return df.withColumn("all_", F.array_sort(F.concat("known_", "added_")))


def _listed(spans: Column) -> Column:
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["s"], x["e"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, for every whole text.

    Null text counts as empty and has no spans. Repeated rows stay, columns
    other than doc_id and text are not read.
    """
    found = with_proposals(docs.select("doc_id", "text"), "text")
    kept = found.withColumn("row", F.struct(F.col("row.doc_id").alias("doc_id")))
    proposed = stored(kept, "pii")
    found = with_spans(proposed, fit(proposed))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.size(F.col("base_")[k]).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(F.array_sort("known_")), 256).alias("base_sha256"),
        _listed(F.col("all_")).alias("spans"),
        F.size("added_").cast("long").alias("n_added"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span in text replaced by its kind in brackets, n_chars brought up to date.

    Spans that overlap are replaced as one, named by the first. Other columns
    and rows stay as they are; null text stays null.
    """
    names = docs.columns
    docs, named = set_apart(docs)
    proposed = stored(with_proposals(docs, "text"), "pii")
    found = with_spans(proposed, fit(proposed))
    text = F.col("row")["text"]
    by_place = F.array_sort(F.transform(
        "all_", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))
    ))
    name = lambda x: F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), x["kind"] + 1)
    found = found.select("row", by_place.alias("spans_"), _pieces(text).alias("pieces_"))
    pieces = F.col("pieces_")

    def replace(at: Column, x: Column) -> tuple[Column, Column]:
        fresh = F.array(_between(pieces, at, x["s"]), name(x))
        written = F.when(x["s"] >= at, fresh).otherwise(F.array().cast("array<string>"))
        return F.greatest(at, x["e"]), written

    last = F.array_max(F.transform("spans_", lambda x: x["e"]))
    written = F.array_join(_scan(F.col("spans_"), F.lit(0), replace, "array<string>"), "")
    changed = F.when(F.size("spans_") > 0, F.concat(written, _between(pieces, last, F.length(text)))).otherwise(text)
    found = found.select("row", changed.alias("text_"), (F.size("spans_") > 0).alias("is_changed_"))
    own = F.col("row")

    def value(name: str, given: str) -> Column:
        if name == "text":
            return F.col("text_").alias(name)
        if given == "n_chars":
            counted = F.length("text_").cast(docs.schema[name].dataType)
            return F.when(F.col("is_changed_"), counted).otherwise(own[name]).alias(name)
        return own[name].alias(name)

    return named(found.select(*map(value, docs.columns, names)))
