"""Exact distinct counts that add up like sums."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .numeric import as_column

WORD_BITS = 64


@dataclass(frozen=True)
class DistinctIds:
    """Whole-number ids from 0 up as bits of ``size`` words, one ``bigint`` aggregate each.

    Words are combined with ``bit_or``, so partial results of any grouping can be combined again, in the same hash
    aggregation as sums.  320 ids cover the 265 zones; other ids are for the caller to group by (:meth:`outside`).
    """

    column: str
    size: int = 5

    def words(self) -> list[Column]:
        """Per row: the bit of the id in its word, NULL in the others."""
        word = f"cast({self.column} div {WORD_BITS} as int)"
        bit = f"shiftleft(1L, cast({self.column} % {WORD_BITS} as int))"
        return [F.expr(f"if({self.column} >= 0 and {word} = {k}, {bit}, null)") for k in range(self.size)]

    def outside(self) -> Column:
        """The id where the words do not hold it, else NULL."""
        value = as_column(self.column)
        return F.when(~value.between(0, WORD_BITS * self.size - 1), value)

    def count(self, words: Sequence[Column]) -> Column:
        """Number of ids in combined words."""
        return sum((F.coalesce(F.bit_count(w), F.lit(0)) for w in words[1:]), F.coalesce(F.bit_count(words[0]), F.lit(0))).cast("bigint")


def first_of(column: str, keys: Sequence[str], columns: Sequence[str]) -> Column:
    """True on one row of each (``keys``, ``column``), false on the others and where ``column`` is NULL.

    Rows are told apart by ``columns``.  Those with NULL need no order and are spread by the other columns.
    """
    value, others = F.col(column), [c for c in columns if c != column]
    spread = [F.when(value.isNull(), F.col(c)) for c in others]
    place = F.row_number().over(Window.partitionBy(*keys, column, *spread).orderBy(*others))
    return value.isNotNull() & (place == 1)
