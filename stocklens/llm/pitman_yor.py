"""Numerics of the hierarchical Pitman-Yor model: seating, sweeps, probabilities.

A restaurant belongs to a context (a bucket of the word before) and its dishes
are words. A dish of c customers sits at t tables; every table is a customer of
the root restaurant that all contexts share, whose base is uniform over the
vocabulary and one unknown word. Only t has to be kept, as the sizes of tables
are summed out: P(t | c) is S(c, t) prod_i (strength + discount (T + i)) P^t
with generalised Stirling numbers S, T the tables of the other dishes and P the
root's probability of the dish. A sweep draws t anew for every dish in every
context, then the tables of every dish at the root, given the totals after the
sweep before. Draws are seeded by bucket and sweep, so a sweep run again after
a lost executor gives the same seating.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

EXACT = 64


@dataclass
class Totals:
    """What all buckets together hold after a sweep."""

    tables: np.ndarray  # of each context
    hot_customers: np.ndarray  # tables of each hot word in all contexts
    hot_tables: np.ndarray  # of each hot word at the root
    root_customers: float
    root_tables: float


@dataclass
class Model:
    """Counts of the corpus, settings, and the totals of the sweeps so far."""

    contexts: int
    customers: np.ndarray  # of each context
    vocabulary: int
    train_tokens: int
    hot: np.ndarray  # hashes of hot words, sorted
    hot_counts: np.ndarray
    discount: float = 0.8
    strength: float = 1.0
    root_discount: float = 0.5
    root_strength: float = 1.0
    single_tables: np.ndarray | None = None  # of each context: dishes with one customer
    history: list[Totals] = field(default_factory=list)

    def root_probability(self, customers, tables, totals: Totals) -> np.ndarray:
        spread = self.root_strength + self.root_discount * totals.root_tables
        own = np.maximum(customers - self.root_discount * tables, 0.0)
        return (own + spread / (self.vocabulary + 1)) / (self.root_strength + totals.root_customers)

    def probability(self, counts, tables, context, root, totals: Totals) -> np.ndarray:
        """Of words seen ``counts`` times at ``tables`` tables in their context."""
        own = np.maximum(counts - self.discount * tables, 0.0)
        back = self.strength + self.discount * totals.tables[context]
        return (own + back * root) / (self.strength + self.customers[context])

    def base_log(self, counts) -> np.ndarray:
        """log10 of the smoothed unigram probability."""
        total = self.train_tokens + 0.5 * (self.vocabulary + 1)
        return np.log10((counts + 0.5) / total)


@dataclass
class Bucket:
    """A bucket's words and the dishes with two customers or more, in sorted order."""

    number: int
    words: np.ndarray  # uint64
    counts: np.ndarray  # customers of each word in all its contexts here
    singles: np.ndarray  # contexts in which a word has one customer
    dish: np.ndarray  # place of the dish's word in words
    context: np.ndarray
    customers: np.ndarray


def stirling(discount: float, size: int = EXACT) -> np.ndarray:
    """log S(c, t) for c, t up to ``size``."""
    table = np.full((size + 1, size + 1), -np.inf)
    table[0, 0] = 0.0
    t = np.arange(1, size + 1)
    with np.errstate(divide="ignore"):
        for c in range(size):
            stay = np.where(c - discount * t > 0, table[c, 1:] + np.log(np.maximum(c - discount * t, 1e-300)), -np.inf)
            table[c + 1, 1:] = np.logaddexp(table[c, :-1], stay)
    return table


def seat(rng, customers, others, root, strength: float, discount: float, logs: np.ndarray) -> np.ndarray:
    """Tables drawn for dishes of ``customers``, given ``others`` tables and the root's probability.

    Up to 64 customers the draw is from the exact conditional. Beyond, customers
    are seated in order, in blocks of up to a 32nd of those already seated.
    """
    tables = np.ones(len(customers), np.int64)
    if not len(customers):
        return tables
    log_root = np.log(root)
    order = np.argsort(customers, kind="stable")
    sizes, starts = np.unique(customers[order], return_index=True)
    for c, start, stop in zip(sizes, starts, [*starts[1:], len(order)], strict=True):
        if c < 2 or c > EXACT:
            continue
        for at in range(start, stop, max(1, 200_000 // int(c))):
            pick = order[at : min(stop, at + max(1, 200_000 // int(c)))]
            steps = np.log(strength + discount * (others[pick, None] + np.arange(c)))
            weight = np.cumsum(steps + log_root[pick, None], axis=1) + logs[c, 1 : c + 1]
            tables[pick] = 1 + np.argmax(weight + rng.gumbel(size=weight.shape), axis=1)
    large = np.flatnonzero(customers > EXACT)
    if len(large):
        c, seated, t = customers[large], np.ones(len(large), np.int64), np.ones(len(large), np.int64)
        while (left := c - seated).any():
            block = np.minimum(left, np.maximum(1, seated // 32))
            new = (strength + discount * (others[large] + t)) * root[large]
            share = new / (new + np.maximum(seated - discount * t, 1e-9))
            t += rng.binomial(block, np.clip(share, 0.0, 1.0))
            seated += block
        tables[large] = t
    return tables


@dataclass
class Seating:
    tables: np.ndarray  # of the dishes with two customers or more
    root_customers: np.ndarray  # of each word
    root_tables: np.ndarray


def at_root(bucket: Bucket, tables: np.ndarray) -> np.ndarray:
    """Customers of each word at the root: its tables in all contexts."""
    return bucket.singles + np.bincount(bucket.dish, tables, minlength=len(bucket.words)).astype(np.int64)


def first_seating(bucket: Bucket) -> Seating:
    """Before any sweep: one table for each dish."""
    tables = np.ones(len(bucket.dish), np.int64)
    return Seating(tables, at_root(bucket, tables), np.ones(len(bucket.words), np.int64))


def sweep(model: Model, bucket: Bucket, now: Seating, number: int) -> Seating:
    """The seating after one more sweep, given the totals after the sweep before."""
    totals = model.history[number]
    hot, at_hot = hot_places(model, bucket.words)
    rng = np.random.default_rng([bucket.number, number])
    root = root_of(model, totals, now, hot, at_hot)
    others = np.maximum(totals.tables[bucket.context] - now.tables, 0.0)
    logs = stirling(model.discount)
    tables = seat(rng, bucket.customers, others, root[bucket.dish], model.strength, model.discount, logs)
    customers = at_root(bucket, tables)
    base = np.full(len(bucket.words), 1.0 / (model.vocabulary + 1))
    others = np.maximum(totals.root_tables - now.root_tables, 0.0)
    logs = stirling(model.root_discount)
    root_tables = seat(rng, customers, others, base, model.root_strength, model.root_discount, logs)
    return Seating(tables, customers, root_tables)


def sweeps(model: Model, bucket: Bucket, rounds: int) -> list[Seating]:
    """The bucket's seating before the first sweep and after each of ``rounds`` sweeps."""
    found = [first_seating(bucket)]
    for number in range(min(rounds, len(model.history))):
        found.append(sweep(model, bucket, found[-1], number))
    return found


def root_of(model: Model, totals: Totals, seating: Seating, hot, at_hot) -> np.ndarray:
    """The root's probability of each word; hot words are spread over buckets and known from the totals."""
    customers, tables = seating.root_customers.astype(float), seating.root_tables.astype(float)
    if hot.any():
        customers[hot] = totals.hot_customers[at_hot[hot]]
        tables[hot] = totals.hot_tables[at_hot[hot]]
    return model.root_probability(customers, tables, totals)


def hot_places(model: Model, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are hot, and their places in the list of hot words."""
    if not len(model.hot):
        return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(model.hot, words), len(model.hot) - 1)
    return model.hot[at] == words, at


def predictive(
    model: Model, bucket: Bucket, samples: int, word: np.ndarray, context: np.ndarray,
    counts: np.ndarray, words: np.ndarray, seatings: list[Seating] | None = None,
) -> np.ndarray:
    """Mean probability over the last ``samples`` seatings of (word, context) pairs.

    ``seatings`` are those, where they are kept; else they are drawn again.

    ``word`` is the place in ``words`` (distinct hashes), ``counts`` how often
    the pair occurred in training.
    """
    place = np.minimum(np.searchsorted(bucket.words, words), max(len(bucket.words) - 1, 0))
    known = (bucket.words[place] == words) if len(bucket.words) else np.zeros(len(words), bool)
    keys = bucket.dish.astype(np.int64) * model.contexts + bucket.context
    wanted = place[word].astype(np.int64) * model.contexts + context
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    multi = known[word] & (counts >= 2)
    if len(keys):
        multi &= keys[at] == wanted
    else:
        multi &= False
    hot, at_hot = hot_places(model, words)
    total = np.zeros(len(word))
    if seatings is None:
        seatings = sweeps(model, bucket, len(model.history) - 1)
    for totals, seating in zip(model.history[-samples:], seatings[-samples:], strict=True):
        customers, tables = np.zeros(len(words)), np.zeros(len(words))
        customers[known] = seating.root_customers[place[known]]
        tables[known] = seating.root_tables[place[known]]
        customers[hot], tables[hot] = totals.hot_customers[at_hot[hot]], totals.hot_tables[at_hot[hot]]
        root = model.root_probability(customers, tables, totals)
        seated = np.where(counts > 0, 1.0, 0.0)
        seated[multi] = seating.tables[at[multi]]
        total += model.probability(counts, seated, context, root[word], totals)
    return total / samples
