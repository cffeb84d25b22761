"""Sums and means that do not depend on row order.

A sum of doubles changes in its last digits with the partitioning, so a lost executor or another
cluster size could flip a flag at its limit. Here a value is split into its whole number and its
rest in two steps of six digits, all integers, which add exactly; the total goes back to a double. Integer
sums stay in generated code, a decimal sum costs several times more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

DIGITS = 12  # decimal digits kept of every summed value
MONEY_DIGITS = 6  # of differences of amounts, whose last digits are what their doubles left over


def finite(value: Column | str) -> Column:
    """The value as a double; NaN and infinities, which no sum can hold, count as missing."""
    number = _col(value).cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def exact_sum(value: Column | str, digits: int = DIGITS, over: WindowSpec | None = None) -> Column:
    """Sum of the finite values, each kept to ``digits`` (at most 12) decimal digits.

    Of those a double holds about 15 significant ones: values from 1,000 keep 9 decimals, from 1,000,000 six, so that
    0.1 sums as 0.1 and not as the double next to it. A total beyond 9e18 stops the query; it is never wrong.
    """
    number = finite(value)
    whole = F.rint(number)
    scaled = (number - whole) * 1e6
    upper = F.rint(scaled) if digits >= 6 else F.rint(scaled / 10.0**(6 - digits)) * 10.0**(6 - digits)
    parts = [whole, upper]
    if digits > 6:
        size, least = F.abs(number), 10.0**(12 - digits)
        unit = F.when(size < 1e3, least).when(size < 1e6, max(least, 1e3)).otherwise(1e6)
        parts.append(F.rint((scaled - upper) * 1e6 / unit) * unit)
    sums = [F.sum(p.cast("long")) for p in parts]
    if over is not None:
        sums = [s.over(over) for s in sums]
    units = [s.cast("decimal(20,0)") for s in sums]
    total = units[0].cast("decimal(32,12)") + units[1] * F.lit("0.000001").cast("decimal(7,6)")
    if digits > 6:
        total = total + units[2] * F.lit("0.000000000001").cast("decimal(13,12)")
    return total.cast("double")


def exact_avg(value: Column | str, digits: int = DIGITS, over: WindowSpec | None = None) -> Column:
    n = F.count(finite(value))
    if over is not None:
        n = n.over(over)
    return ratio(exact_sum(value, digits, over), n)


@dataclass(frozen=True)
class Moments:
    """Count, means and centred second moments of pairs, as aggregate expressions."""

    n: Column
    mean_x: Column
    mean_y: Column
    sxx: Column
    sxy: Column
    syy: Column

    def corr(self) -> Column:
        """Pearson's r; NULL where one side does not vary."""
        varies = (self.sxx > 0) & (self.syy > 0)
        return F.when(varies, F.greatest(F.least(self.sxy / F.sqrt(self.sxx) / F.sqrt(self.syy), F.lit(1.0)), F.lit(-1.0)))

    def slope(self) -> Column:
        """Of the least-squares line of y on x; NULL where x does not vary."""
        return ratio(self.sxy, self.sxx)

    def intercept(self) -> Column:
        return self.mean_y - self.slope() * self.mean_x


def moments(x: Column | str, y: Column | str) -> Moments:
    """Moments of the pairs whose sides are both finite, each side kept to six decimals.

    Sums of values and of products are decimals and add exactly, in any order and grouping; means are taken out of the
    sums of products before anything becomes a double, so that large means cost no digits. A value from 1e12 stops
    the query.
    """
    a, b = finite(x), finite(y)
    both = a.isNotNull() & b.isNotNull()
    a, b = (F.when(both, v).cast("decimal(18,6)") for v in (a, b))
    n, sum_a, sum_b = F.count(F.when(both, 1)), F.sum(a), F.sum(b)

    def centred(products: Column, left: Column, right: Column) -> Column:
        mean = F.try_divide(right, n.cast("decimal(20,0)")).cast("decimal(36,18)")
        return (F.sum(products) - left * mean).cast("double")

    def mean(total: Column) -> Column:
        return ratio(total.cast("double"), n)
    return Moments(n, mean(sum_a), mean(sum_b), centred(a * a, sum_a, sum_a), centred(a * b, sum_a, sum_b),
                   centred(b * b, sum_b, sum_b))


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives NULL for a zero or missing divisor."""
    return top / F.nullif(bottom.cast("double"), F.lit(0.0))


def round_money(value: Column) -> Column:
    """Round to cents, halves away from zero, as the number reads in decimal digits."""
    return F.round(value.cast("decimal(38,6)"), 2).cast("double")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
