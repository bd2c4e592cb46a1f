"""Money sums that do not depend on the order rows arrive in.

Adding doubles gives a different last digit for every partitioning or task
retry. Each amount is therefore counted in units of ten digits behind the point.
Those of an ordinary amount (below ORDINARY) fit a bigint and are added as three
of 17 binary digits each: a sum of decimals costs ten times as much. A part's
sum is exact for 70 million million rows. The few larger amounts are added as
decimals. What no such decimal can hold (NaN, infinities, 1e18 and more) is
added beside them as a double, so it shows in the result as in any sum of
doubles and stops nothing.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,10)"
SUM = "decimal(38,10)"
#: Below this an amount's units are told exactly by one product of doubles.
ORDINARY = 100_000.0
PART_BITS = 17


def _is_ordinary(amount: str) -> Column:
    return F.abs(amount) < ORDINARY


def _ordinary_sum(amount: str) -> Column:
    """Decimal sum of the ordinary amounts, put together from the parts' sums once per group."""
    units = F.when(_is_ordinary(amount), F.floor(F.col(amount) * 1e10 + 0.5))
    mask = F.lit((1 << PART_BITS) - 1)
    parts = [units.bitwiseAND(mask), F.shiftright(units, PART_BITS).bitwiseAND(mask), F.shiftright(units, 2 * PART_BITS)]
    sums = [F.sum(part).cast("decimal(20,0)") * F.lit(1 << PART_BITS * at).cast("decimal(11,0)") for at, part in enumerate(parts)]
    return ((sums[0] + sums[1] + sums[2]).cast("decimal(28,0)") * F.lit("0.0000000001").cast("decimal(10,10)")).cast(SUM)


def exact_sum(amount: str) -> Column:
    """The part of a sum that decimals can hold; NULL if there is none."""
    large = F.sum(F.when(~_is_ordinary(amount), F.col(amount).try_cast(MONEY)))
    ordinary = _ordinary_sum(amount)
    return F.when(large.isNull(), ordinary).otherwise(F.coalesce(ordinary, F.lit(0).cast(SUM)) + large)


def other_sum(amount: str) -> Column:
    """The part they cannot hold; NULL in all ordinary cases."""
    return F.sum(F.when(~_is_ordinary(amount) & F.col(amount).try_cast(MONEY).isNull(), F.col(amount)))


def total(exact: Column, other: Column) -> Column:
    return F.when(other.isNull(), exact.cast("double")).otherwise(F.coalesce(exact.cast("double"), F.lit(0.0)) + other)


def money_sum(amount: str) -> Column:
    return total(exact_sum(amount), other_sum(amount))


def money_avg(amount: str) -> Column:
    return money_sum(amount) / F.nullif(F.count(amount), F.lit(0))
