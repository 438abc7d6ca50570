"""Toxicity by a weighted lexicon that is matched with an Aho-Corasick automaton.

Texts are folded first: capitals, accents, look-alike letters of other scripts
and digits written for letters become plain letters. The lexicon holds words
and beginnings of words with the log-odds of toxic texts that contain them.
Exception phrases, an entry with the word before or after it as harmless texts
have it, cancel the match inside them. The sum of weights, normalised by
length, goes through a fitted logistic curve.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import remainder, rows_of, stored, texts_of

# Letters of other scripts that look like Latin ones, and digits used for letters.
LOOK_ALIKES = dict(
    zip(
        "абвгдеёзикмнопрстухьіјѕԁӏαβγεικνορτυχωϲ",
        "abbgaee3nkmhonpctyxbijsdlabyeikvoptuxwc",
        strict=True,
    )
) | {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "ı": "i", "ł": "l", "ø": "o", "đ": "d"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SYMBOLS = re.compile(r"[@$!|](?=[^\W\d_])")
SYMBOL_LETTERS = {"@": "a", "$": "s", "!": "i", "|": "i"}
GAPS = re.compile(r"[\W_]+")


def _fold_table() -> dict[int, str]:
    table = {ord(k): v for k, v in (LOOK_ALIKES | DIGITS).items()}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)]:
        plain = unicodedata.normalize("NFKD", chr(code)).lower()
        plain = "".join(c for c in plain if not unicodedata.combining(c))
        if plain != chr(code) and plain.isascii() and code not in table:
            table[code] = plain
    for code in [*range(0x300, 0x370), 0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF]:
        table[code] = ""  # loose accents and invisible characters
    return table


FOLD = _fold_table()


def folded(text: str) -> str:
    """Folded words with one space before each and one at the end; empty texts give one space."""
    text = text.lower()
    if not text.isascii() or any(d in text for d in DIGITS):
        text = text.translate(FOLD)
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = SYMBOLS.sub(lambda m: SYMBOL_LETTERS[m[0]], text)
    return " " + " ".join(GAPS.sub(" ", text).split()) + " "


@dataclass
class Lexicon:
    """Entries such as ' word ' or ' begin' with weights, exceptions, and the curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    offset: float = -4.0
    slope: float = 0.0

    def automaton(self):
        machine = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        machine.make_automaton()
        return machine


def matches(machine, text: str) -> list[tuple[int, int, float]]:
    """Start, end and weight of the entries found; at one start the longest, none inside an exception."""
    if not len(machine):
        return []
    best: dict[int, tuple[int, float]] = {}
    excepted = []
    for end, (size, weight) in machine.iter(text):
        start = end - size + 1
        if weight is None:
            excepted.append((start, end))
        elif start not in best or best[start][0] < end:
            best[start] = (end, weight)
    found = [(s, e, w) for s, (e, w) in best.items()]
    if excepted:
        found = [m for m in found if not any(s <= m[0] and m[1] <= e + 1 for s, e in excepted)]
    return found


def amount(machine, text: str) -> float:
    """The weights found, normalised by the length of the folded text."""
    total = sum(w for _, _, w in matches(machine, text))
    return total / (1 + math.log1p(text.count(" ") / 50)) if total else 0.0


def probability(amounts: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    return 1 / (1 + np.exp(-(lexicon.offset + lexicon.slope * amounts)))


# ---- learning ---------------------------------------------------------------------------


def learning_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """toxic, doc_id and data of at most ``bound`` labelled rows outside the held-out fold.

    Rows are picked by the hash of their id, so the pick does not follow the
    order of ids. At most ``bound`` ids are broadcast.
    """
    picked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(remainder(F.col("doc_id"), 4) != 2)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
        .select(F.col("doc_id").alias("picked_"), "toxic")
    )
    return texts_of(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("picked_")).drop("picked_")


PREFIXES = range(5, 10)


def _terms(text: str) -> set[str]:
    words = set(text.split())
    found = {f" {w} " for w in words}
    for w in words:
        found.update(" " + w[:n] for n in PREFIXES if n <= len(w))
    return found


def _text(data) -> str:
    return folded(data.as_py().decode(errors="replace"))


def _counted(rows: DataFrame, terms_of, least: int) -> DataFrame:
    """(term, toxic, clean): in how many texts of either label a term occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            terms = list(toxic.keys() | clean.keys())
            arrays = [
                pa.array(terms, pa.string()),
                pa.array([toxic[t] for t in terms], pa.int64()),
                pa.array([clean[t] for t in terms], pa.int64()),
            ]
            toxic.clear()
            clean.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["term", "toxic", "clean"])

        for batch in rows_of(batches):
            for data, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update(terms_of(_text(data)))
            if len(toxic) + len(clean) > 400_000:
                yield flush()
        yield flush()

    counted = rows.select("data", "toxic").mapInArrow(count, "term string, toxic long, clean long")
    return (
        counted.groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") + F.col("clean") >= least)
    )


def learn(
    docs: DataFrame, labels: DataFrame, bound: int = 8000, entries: int = 2000
) -> Lexicon:
    """The lexicon of a bounded sample of labelled texts; empty where labels lack one side.

    An entry occurs in at least four toxic texts and its log-odds exceed two.
    At most ``entries`` entries with the strongest evidence reach the driver.
    """
    rows = stored(learning_rows(docs, labels, bound), "labelled")
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon(offset=math.log((n_toxic + 0.5) / (n_toxic + n_clean + 10)))
    odds = F.log((F.col("toxic") + 0.1) / (n_toxic + 0.2)) - F.log((F.col("clean") + 0.1) / (n_clean + 0.2))
    strong = (
        _counted(rows, _terms, 4)
        .withColumn("weight", odds)
        .where("toxic >= 4 AND weight > 2")
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), F.length("term"), "term")
        .limit(entries)
        .collect()
    )
    weights: dict[str, float] = {}
    for row in sorted(strong, key=lambda r: (len(r.term), r.term)):
        # a longer entry is kept where it says clearly more than the beginning it has
        below = max((weights[row.term[:n]] for n in range(2, len(row.term)) if row.term[:n] in weights), default=0.0)
        if row.weight > below + 0.7:
            weights[row.term] = row.weight
    lexicon = Lexicon(weights)

    machines: list = []  # the automaton is built in the tasks, once in each

    def phrases(text: str) -> set[str]:
        if not machines:
            machines.append(lexicon.automaton())
        return _phrases(machines[0], text)

    harmless = (
        _counted(rows, phrases, 3)
        .where("toxic = 0")
        .orderBy(F.desc("clean"), "term")
        .limit(entries)
        .collect()
    )
    lexicon.exceptions = tuple(sorted(r.term for r in harmless))
    scored = rows.select("data", "toxic").mapInArrow(_amounts(lexicon), "amount double, toxic int")
    sample = scored.toPandas()  # two numbers for each of ``bound`` rows
    lexicon.offset, lexicon.slope = _curve(sample["amount"].to_numpy(), sample["toxic"].to_numpy())
    return lexicon


def _phrases(machine, text: str) -> set[str]:
    """Every match with the whole word before it, and with the one after it."""
    found = set()
    for start, end, _ in matches(machine, text):
        stop = end if text[end] == " " else text.find(" ", end)
        before = text.rfind(" ", 0, start) if start else -1
        after = text.find(" ", stop + 1)
        if before >= 0:
            found.add(text[before : stop + 1])
        if after >= 0:
            found.add(text[start : after + 1])
    return found


def _amounts(lexicon: Lexicon):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in rows_of(batches):
            amounts = [amount(machine, _text(t)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(amounts, pa.float64()), batch.column(1).cast(pa.int32())],
                names=["amount", "toxic"],
            )

    return compute


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope of the logistic curve, by Newton steps with a small ridge."""
    design = np.column_stack([np.ones_like(x), x])
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 1e-2 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return float(beta[0]), float(beta[1])


def scores(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted and n_matches of every whole text.

    Null text counts as empty; a text without matches gets the curve's value at
    zero. Only the text enters a score. Repeated rows stay.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in rows_of(batches):
            texts = [_text(t) for t in batch.column(1)]
            p = probability(np.array([amount(machine, t) for t in texts], float), lexicon)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(p, pa.float64()),
                    pa.array((p >= threshold).astype(np.int32)),
                    pa.array([len(matches(machine, t)) for t in texts], pa.int64()),
                ],
                names=["doc_id", "score", "predicted", "n_matches"],
            )

    scored = texts_of(docs).mapInArrow(
        compute, "doc_id long, score double, predicted int, n_matches long"
    )
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "n_matches"
    )
