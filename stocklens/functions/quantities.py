"""Exact arithmetic and text tests used across operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quantities keep ten decimals and 18 digits before the point; a sum of them
# has ten digits more before the point than one of them can have.
QUANTITY = "decimal(28,10)"

# Factors of a product that keeps ten decimals: 16 + 11 digits before the point.
_FACTOR, _COUNT = "decimal(26,10)", "decimal(11,0)"

# Digits of a decimal, and how many after the point are summed without loss.
_MOST, _MOST_AFTER = 38, 25


@dataclass(frozen=True)
class Amount:
    """A column of quantities, and how its type is summed without loss.

    Up to 18 digits before and ten after the point it is a ``QUANTITY``; other
    decimals of up to 28 digits keep their type. One sum is exact then. Of
    longer decimals whole and fractional parts are summed apart and put
    together in the total, which has the decimals of the column. A total that
    has too many digits for that is an error under ANSI rules, else null.
    """

    column: Column
    digits: int
    scale: int

    @classmethod
    def of(cls, df: DataFrame, name: str) -> Amount:
        kind, column = df.schema[name].dataType, F.col(name)
        if not isinstance(kind, T.DecimalType) or (kind.scale <= 10 and kind.precision - kind.scale <= 18):
            return cls(column.cast(QUANTITY), 28, 10)
        if kind.scale > _MOST_AFTER:
            raise ValueError(f"{name} has {kind.scale} decimals, more than {_MOST_AFTER} are not summed")
        return cls(column, kind.precision, kind.scale)

    @property
    def _is_short(self) -> bool:
        return self.digits <= 28

    @property
    def _has_short_products(self) -> bool:
        return (self.digits, self.scale) == (28, 10)

    def summed(self, where: Column | None = None) -> Column:
        """Aggregate to be put into ``value`` or ``again``; rows outside ``where`` count as 0."""

        def chosen(x: Column) -> Column:
            return x if where is None else F.when(where, x).otherwise(F.lit(0))

        if self._is_short:
            return F.sum(chosen(self.column))
        return self._apart(lambda x: F.sum(chosen(x)), self.column)

    def again(self, sums: str) -> Column:
        """Aggregate over groups that ``summed`` was made of."""
        if self._is_short:
            return F.sum(sums)
        return F.struct(*[F.sum(F.col(sums)[part]).alias(part) for part in ("whole", "part")])

    def value(self, sums: Column, count: Column | None = None) -> Column:
        """The total, or ``count`` times as much."""
        if not self._is_short:
            return self._together(sums, count)
        if count is None or self._has_short_products:
            return sums if count is None else times(sums, count)
        return self._together(self._apart(lambda x: x, sums), count)

    def total(self, where: Column | None = None) -> Column:
        """Aggregate: the exact sum."""
        return self.value(self.summed(where))

    def total_times(self, count: Column) -> Column:
        """Aggregate: the exact sum, each row counted ``count`` times."""
        if self._has_short_products:
            return F.sum(times(self.column, count))
        return self._together(self._apart(lambda x: F.sum(x * count.cast(_COUNT)), self.column))

    @staticmethod
    def _apart(make: Callable[[Column], Column], value: Column) -> Column:
        """What lies below the value as a whole number, and the rest of it in [0, 1)."""
        return F.struct(make(F.floor(value)).alias("whole"), make(F.pmod(value, _one())).alias("part"))

    def _together(self, sums: Column, count: Column | None = None) -> Column:
        def carried(whole: Column, part: Column) -> tuple[Column, Column]:
            below = F.pmod(part, _one()).cast(f"decimal({self.scale + 1},{self.scale})")
            return (whole + F.floor(part)).cast(f"decimal({_MOST},0)"), below

        whole, part = carried(sums["whole"], sums["part"])
        if count is not None:
            factor = count.cast(_COUNT)
            whole, part = carried(whole * factor, part * factor)
        # a decimal sum of the two would lose its last digit, so their digits are joined
        mirrored = (whole < 0) & (part > 0)
        digits = F.when(mirrored, 2 - part).otherwise(1 + part).cast("string")
        sign = F.when(whole < 0, "-").otherwise("")
        front = F.when(mirrored, whole + 1).otherwise(whole)
        # negating a decimal would keep 34 digits of it
        plain = F.regexp_replace(front.cast(f"decimal({_MOST},0)").cast("string"), "^-", "")
        text = F.concat(sign, plain, F.substr(digits, F.lit(2)))
        return text.cast(f"decimal({_MOST},{self.scale})")


def _one() -> Column:
    return F.lit(1).cast("decimal(1,0)")


def times(quantity: Column, count: Column) -> Column:
    """A quantity times a whole number, without losing decimals."""
    return quantity.cast(_FACTOR) * count.cast(_COUNT)


def is_positive(values: Iterable[Column]) -> Column:
    """Whether the sum of decimals of any types is above zero; no digit of it is lost."""
    values = list(values)
    whole = reduce(add, [F.floor(v).cast(f"decimal({_MOST},0)") for v in values])
    part = reduce(add, [F.pmod(v, _one()) for v in values])
    below = F.floor(part)
    return (whole + below > 0) | ((whole + below == 0) & (part > below))


def whole_units(total: Column) -> Column:
    """Rounded half away from zero; nothing sold counts as 0."""
    return F.coalesce(F.round(total, 0).cast("bigint"), F.lit(0).cast("bigint"))


def contains_any(column: Column, parts: Iterable[str]) -> Column:
    return reduce(or_, [column.contains(p) for p in parts])


def contains_none(column: Column, parts: Iterable[str]) -> Column:
    """Null text fails the test, as it does for NOT LIKE."""
    return reduce(and_, [~column.contains(p) for p in parts])
