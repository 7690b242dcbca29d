"""Number expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


# Digits after the point of amounts and distances in exact sums, unless told otherwise.
SCALE = 6


def _units(amount: Column | str, scale: int) -> Column:
    """The amount in whole units of 10^-scale, as decimal(18, 0); an error where it isn't whole."""
    column = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    scaled = column * float(10**scale)
    whole = F.rint(scaled)
    noise = F.greatest(F.lit(float(10**scale)), F.abs(scaled)) * 1e-9
    # Above 2^53 a double no longer tells units apart.
    fits = (F.abs(whole) < float(1 << 53)) & (F.abs(whole - scaled) <= noise)
    message = F.concat(F.lit(f"not an exact amount of scale {scale}: "), column.cast("string"))
    number = F.when(fits, whole).otherwise(F.raise_error(message))
    return F.when(column.isNotNull(), number).cast("long").cast("decimal(18,0)")


def exact(amount: Column | str, scale: int = SCALE) -> Column:
    """A double as a decimal of the given scale, to be added and compared without rounding.

    An amount with more digits than the scale holds (beyond the noise of doubles), or of more than 2^53
    units, is an error: nothing is rounded or becomes null unseen.
    """
    return _units(amount, scale) * F.lit(Decimal(1).scaleb(-scale))


def exact_sum(amount: Column | str, scale: int = SCALE) -> Column:
    """The sum as a decimal of the given scale, whatever the order of the rows; an error beyond 28 digits."""
    return F.sum(_units(amount, scale)) * F.lit(Decimal(1).scaleb(-scale))


# Halves of a whole number of units that sums keep apart: neither overflows below 2^36 rows.
_HALF = 26
# Below these sizes a cell that is no whole number of units is added as a decimal, of 18 or 4 digits after the point.
_SMALL, _LARGE = 1e12, 1e24


def whole_units(amount: Column | str, scale: int = SCALE) -> Column:
    """The amount in whole units of 10^-scale as a long; null where it has none, NaN and infinities included."""
    column = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    scaled = column * float(10**scale)
    whole = F.rint(scaled)
    # A few last places of a double, as a product of amounts may be off.
    noise = F.abs(scaled) * 2.0**-49
    return F.when((F.abs(whole) < float(1 << 53)) & (F.abs(whole - scaled) <= noise), whole.cast("long"))


def total(amount: Column | str, scale: int = SCALE) -> Column:
    """The sum of any doubles, as a double that doesn't depend on the order of the rows; null without a number.

    Cells that are whole units of 10^-scale, as money is, are added as whole numbers, in two halves. Others
    are added as decimals in two bins by size, rounded beyond the 18th digit after the point (the 4th from
    10^12 on). NaN, infinities and cells from 10^24 on are added as doubles: NaN and infinities come out as
    such, and only those huge cells are rounded by order.
    """
    return total_of(total_parts(amount, scale), scale)


def total_parts(amount: Column | str, scale: int = SCALE) -> list[Column]:
    """The sums that a total is made of: aggregates that may be stored, and added up to those of more rows."""
    column = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    units = whole_units(column, scale)
    odd, size = units.isNull() & column.isNotNull(), F.abs(column)
    return [
        F.sum(F.shiftright(units, _HALF)),
        F.sum(units.bitwiseAND(F.lit((1 << _HALF) - 1))),
        F.sum(F.when(odd & (size < _SMALL), column.cast("decimal(38,18)"))),
        F.sum(F.when(odd & (size >= _SMALL) & (size < _LARGE), column.cast("decimal(38,4)"))),
        F.sum(F.when(odd & ~(size < _LARGE), column)),
    ]


def total_of(parts: Sequence[Column], scale: int = SCALE) -> Column:
    """The total as a double, of the parts that :func:`total_parts` gives."""
    high, low, *others = parts
    whole = (high.cast("decimal(28,0)") * F.lit(Decimal(1 << _HALF)) + low.cast("decimal(28,0)")) * F.lit(Decimal(1).scaleb(-scale))
    zero = F.lit(0.0)
    summed, known = F.coalesce(whole.cast("double"), zero), high.isNotNull()
    for other in others:
        summed, known = summed + F.coalesce(other.cast("double"), zero), known | other.isNotNull()
    return F.when(known, summed)


def weight(rows: Column | str) -> Column:
    """A row count as a factor whose products overflow with an error at 38 digits, not at 19."""
    return (F.col(rows) if isinstance(rows, str) else rows).cast("decimal(38,0)")


def money_text(amount: Column | str) -> Column:
    """``1234.5`` as ``'1,234.50'``."""
    return F.format_number(amount, 2)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole; null where whole is 0 (plain ``/`` fails there under ANSI mode)."""
    return F.try_divide(F.col(part) if isinstance(part, str) else part, F.col(whole) if isinstance(whole, str) else whole)


def percent_text(part: Column | str, whole: Column | str) -> Column:
    """Share of whole in percent as text with two decimals."""
    return F.format_number(ratio(part, whole) * 100, 2)
