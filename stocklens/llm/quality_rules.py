"""Quality rules kept as a ledger: measured once, judged by versioned policies.

Every rule is evaluated once per document and sets one bit of ``failures``;
the measurements stay beside it. A policy is a mask over the bits and how many
of them it tolerates, so another policy, or the effect of leaving a rule out,
is computed from the stored bits without reading a text again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\\x20\\x09-\\x0D]"
WINDOW = 8
BLOCK = 500  # words among which distinct ones are counted

# The rules in the order of their bits, as conditions on the measurements.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_lines >= 4 AND 10 * n_dup_lines > 4 * n_lines",
    "long_words": "word_chars > 12 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "shouting": "n_letters >= 50 AND 10 * n_capitals > 4 * n_letters",
    "few_distinct_words": "n_words >= 50 AND 10 * n_distinct_words < 4 * n_words",
    "exclamations": "10 * n_exclamations > 2 * n_words",
}
BASE_RULES = ("few_words", "repeated_windows")

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_letters", "n_capitals", "n_exclamations",
)


def mask(*rules: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


@dataclass(frozen=True)
class Policy:
    """Rejects a document with more than ``tolerated`` failures among ``rules``."""

    version: str
    rules: tuple[str, ...]
    tolerated: int = 0

    def rejects(self, failures: Column) -> Column:
        return F.bit_count(failures.bitwiseAND(F.lit(mask(*self.rules)))) > self.tolerated


POLICIES = (
    Policy("1", BASE_RULES),
    Policy("2", tuple(RULES)),
    Policy("2-lenient", tuple(r for r in RULES if r not in BASE_RULES), tolerated=1),
)
CURRENT = POLICIES[1]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text (null: empty).

    Words are runs without white space. The words of windows of eight that
    occur twice or more count as repeated, the first occurrence included.
    Windows are compared by a 64-bit hash. Distinct words are counted in every
    block of ``BLOCK`` words, the last one shorter, and summed: their share does
    not fall with the length of a text. Repeated rows stay, columns other
    than doc_id and text are not read.
    """
    df = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("t"))
    df = df.withColumn("words", F.expr(f"filter(split(t, '{SPACE}+'), w -> w != '')"))
    df = df.withColumn("lines", F.expr("filter(split(t, '\\n'), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"))
    df = df.withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
    following = ", ".join(f"get(hashes, i + {k})" for k in range(1, WINDOW))
    df = df.select(
        "doc_id",
        F.expr("CAST(size(words) AS BIGINT)").alias("n_words"),
        F.expr("CAST(length(array_join(words, '')) AS BIGINT)").alias("word_chars"),
        F.expr("CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '')) AS BIGINT)").alias("n_symbols"),
        F.expr("CAST(size(lines) AS BIGINT)").alias("n_lines"),
        F.expr("CAST(size(lines) - size(array_distinct(lines)) AS BIGINT)").alias("n_dup_lines"),
        F.expr(
            f"CASE WHEN size(hashes) = 0 THEN 0L WHEN size(hashes) <= {BLOCK} THEN CAST(size(array_distinct(hashes)) AS BIGINT)"
            f" ELSE aggregate(sequence(0, size(hashes) - 1, {BLOCK}), 0L, (n, at) ->"
            f" n + size(array_distinct(transform(sequence(at, least(at + {BLOCK}, size(hashes)) - 1), i -> get(hashes, i))))) END"
        ).alias("n_distinct_words"),
        F.expr("CAST(length(regexp_replace(t, '[^\\\\p{L}]+', '')) AS BIGINT)").alias("n_letters"),
        F.expr("CAST(length(regexp_replace(t, '[^\\\\p{Lu}]+', '')) AS BIGINT)").alias("n_capitals"),
        F.expr("CAST(length(t) - length(replace(t, '!', '')) AS BIGINT)").alias("n_exclamations"),
        F.expr(
            f"transform(slice(hashes, 1, greatest(size(hashes) - {WINDOW - 1}, 0)),"
            f" (h, i) -> xxhash64(h, {following}))"
        ).alias("windows"),
    )
    # most texts repeat no window; only the others have their windows sorted
    df = df.withColumn("repeats", F.expr("size(array_distinct(windows)) < size(windows)"))
    df = df.withColumn(
        "sorted",
        F.expr("CASE WHEN repeats THEN sort_array(transform(windows, (h, i) -> struct(h, i))) END"),
    )
    df = df.withColumn(
        "starts",
        F.expr(
            "sort_array(transform(filter(sorted, (x, k) -> get(sorted, k - 1).h = x.h"
            " OR get(sorted, k + 1).h = x.h), x -> x.i))"
        ),
    )
    covered = (
        f"aggregate(starts, struct(0L AS n, -{WINDOW} AS last), (a, s) ->"
        f" struct(a.n + least({WINDOW}, s - a.last) AS n, s AS last), a -> a.n)"
    )
    return df.withColumn("n_repeat_words", F.expr(f"coalesce({covered}, 0L)")).select(
        "doc_id", *MEASURES
    )


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements, and ``failures`` with one bit for each rule that fails."""
    bits = [
        F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0))
        for i, condition in enumerate(RULES.values())
    ]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measured(docs).withColumn("failures", failures)


def judged(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """The ledger with base_failed and kept: the base rules bind every policy."""
    base_failed = F.col("failures").bitwiseAND(F.lit(mask(*BASE_RULES))) != 0
    return entries.withColumn("base_failed", base_failed).withColumn(
        "kept", ~F.col("base_failed") & ~policy.rejects(F.col("failures"))
    )


def ablations(entries: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """rule, n_failed, and n_decided: rejected documents that would be kept without the rule.

    The ledger shrinks to one row for each set of bits before anything else.
    """
    sets = entries.groupBy("failures").agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(mask(r)).alias("bit")) for r in policy.rules
    ]))
    failures, bit = F.col("failures"), F.col("r.bit")
    without = failures.bitwiseAND(F.bitwise_not(bit))
    decided = policy.rejects(failures) & ~policy.rejects(without)
    return (
        sets.select("failures", "n", rules.alias("r"))
        .groupBy("r.rule")
        .agg(
            F.sum(F.when(failures.bitwiseAND(bit) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(decided, F.col("n")).otherwise(0)).alias("n_decided"),
        )
    )
