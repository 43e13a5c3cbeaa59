"""Rounding and guarded division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: ColumnLike, digits: int) -> Column:
    """Round a double half-up at ``digits`` (0 to 4) decimals.

    A value less than half of the tenth decimal below a tie counts as the tie, which drops the binary noise of a
    quotient, so that 1.00499999999999989 rounds to 1.01.  Sums need :func:`exact_sum` to not depend on order.
    It is plain arithmetic, as Spark's ``round`` makes a ``BigDecimal`` of every value; from 1e13 on, where doubles
    have no such decimals any more, the last bit of a value may change.
    """
    number, scale = as_column(value).cast("double"), 10.0**digits
    size = F.rint(F.abs(number) * scale + 0.5 * 10.0 ** (digits - 10))  # which also takes ties up
    return F.signum(number) * size / scale + 0.0  # adding zero turns -0.0 into 0.0


def positive_ratio(numerator: ColumnLike, denominator: ColumnLike, default: float | None = None) -> Column:
    """Quotient where the denominator is positive, else ``default``."""
    bottom = as_column(denominator)
    return F.when(bottom > 0, as_column(numerator) / bottom).otherwise(F.lit(default).cast("double"))


def guarded_ratio(
    numerator: ColumnLike, denominator: ColumnLike, default: float | None = None, digits: int = 2, scale: float = 1.0
) -> Column:
    """:func:`positive_ratio` times ``scale``, rounded; ``default`` is not scaled."""
    bottom = as_column(denominator)
    quotient = as_column(numerator) / bottom
    if scale != 1.0:
        quotient = quotient * scale
    return F.when(bottom > 0, round_half_up(quotient, digits)).otherwise(F.lit(default).cast("double"))


def safe_divide(numerator: ColumnLike, denominator: ColumnLike, default: float = 0) -> Column:
    """Quotient as double, or ``default`` when the denominator is zero or NULL."""
    bottom = as_column(denominator).cast("double")
    return F.coalesce(
        F.when((bottom == 0) | bottom.isNull(), F.lit(default).cast("double")),
        as_column(numerator).cast("double") / F.nullif(bottom, F.lit(0.0)),
    )


#: Sums are kept in whole numbers, so the order of rows cannot matter: millions, ten-thousandths of what is left,
#: and a rest in units of 1e-12, which is 0 for values of up to four decimals.
SUM_BASE, SUM_SCALE, SUM_REST = 1e6, 1e4, 1e12
#: Larger values, infinities and NaN are added up as doubles.
SUM_HUGE = 1e18


def sum_parts(value: ColumnLike, finite: bool = False, bounded: bool = False, rounded: bool = False) -> dict[str, Column]:
    """The numbers of a row whose sums make an exact sum, by name; see :func:`joined_sum`.

    Columns of which more is known need fewer: ``finite`` for those without values of 1e18 and more, ``bounded`` for
    those that rules keep below a million, ``rounded`` for those that were rounded to four decimals or fewer.  A value
    that breaks such a promise gives the same sum or an overflow error.
    """
    number = as_column(value).cast("double")
    parts = {}
    if not (finite or bounded):
        usual = F.abs(number) < SUM_HUGE
        parts["huge"] = F.when(~usual, number)
        number = F.when(usual, number).when(number.isNotNull(), F.lit(0.0))
    if not bounded:
        parts["large"] = (number / SUM_BASE).cast("bigint")
        number = number - parts["large"] * SUM_BASE
    parts["units"] = F.rint(number * SUM_SCALE).cast("bigint")
    if not rounded:
        parts["rest"] = F.rint((number - parts["units"] / SUM_SCALE) * SUM_REST).cast("bigint")
    return parts


def joined_sum(sums: dict[str, Column]) -> Column:
    """The sum as double, from the sums of each part; NULL when there was no value."""
    total = sums["units"] / SUM_SCALE
    if "rest" in sums:
        total = total + sums["rest"] / SUM_REST
    if "large" in sums:
        total = sums["large"] * SUM_BASE + total
    return total + F.coalesce(sums["huge"], F.lit(0.0)) if "huge" in sums else total


def exact_sum(value: ColumnLike, **known: bool) -> Column:
    """Aggregate: sum as double, independent of the order of rows, of values of any size (see :func:`sum_parts`)."""
    return joined_sum({name: F.sum(part) for name, part in sum_parts(value, **known).items()})


def exact_avg(value: ColumnLike, **known: bool) -> Column:
    """Aggregate: :func:`exact_sum` over the number of values."""
    return exact_sum(value, **known) / F.count(as_column(value))


def percent_of_rows(matching: Column, digits: int) -> Column:
    """Aggregate: share of rows for which ``matching`` holds, in percent."""
    return round_half_up(F.count_if(matching) * 100.0 / F.count(F.lit(1)), digits)


def clean_number(text: ColumnLike, to_type: str) -> Column:
    """Typed number from text; NULL when the text is no finite number.

    Integers go through double, so ``"1.0"`` counts as 1.
    """
    number = as_column(text).try_cast("double")
    finite = F.when(F.abs(number) < float("inf"), number)
    return finite if to_type == "double" else finite.try_cast(to_type)
