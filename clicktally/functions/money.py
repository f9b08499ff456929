"""Exact money sums.

A sum of doubles depends on the order of the additions, so a rerun after a lost
executor may differ in the last cent.  Prices that are a whole number of cents
are therefore added up as whole numbers: each is cut into a high and a low part,
both parts are summed as BIGINT, and a group's two sums are put together once.
Other finite prices below 10^18 are added up as decimals with eight places
(what a price has beyond the eighth place is rounded away).  None of these sums
depends on order, and none can overflow below 2 * 10^11 rows in a group.

What is left (finite prices of 10^18 and more, infinities and NaN) is added up as
doubles: one NaN or infinity decides such a sum whatever the order, and only for
large finite prices may the last digits depend on it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this, price * 100 stays inside the range where doubles hold every integer.
_WHOLE_LIMIT = 1e13
#: Bits of the low part of an amount in cents; the high part then has as many at most.
_LOW_BITS = 25
_AMOUNT, _AMOUNT_LIMIT = "decimal(26,8)", 1e18
_TOTAL = "decimal(36,8)"
_CENTS = "decimal(28,0)"
# Large prices are scaled by this before they are added, so that no sum on the way leaves the range of doubles.
_SCALE = 2.0**-64

#: What is kept of the prices of a group, to be added up further, and the type of each.
PARTS = {"priced": "bigint", "cents": _CENTS, "other": _TOTAL, "beyond": "double"}


def whole_cents(price: Column) -> Column:
    """The price in cents as BIGINT if it is exactly that, else NULL."""
    cents = F.rint(price * 100.0)
    return F.when((F.abs(price) < _WHOLE_LIMIT) & (cents / 100.0 == price), cents.cast("bigint"))


def _sums(price: Column) -> dict[str, Column]:
    """The aggregates of a price column, by the names of ``PARTS``."""
    cents = whole_cents(price)
    high = F.sum(F.shiftright(cents, _LOW_BITS)).cast(_CENTS) * F.lit(1 << _LOW_BITS).cast("decimal(9,0)")
    low = F.sum(cents.bitwiseAND((1 << _LOW_BITS) - 1)).cast(_CENTS)
    amount = F.when(cents.isNull() & (F.abs(price) < _AMOUNT_LIMIT), price.cast(_AMOUNT))
    # Spark orders NaN above every number.
    beyond = F.when(F.abs(price) >= _AMOUNT_LIMIT, price * _SCALE)
    sums = {"priced": F.count(price), "cents": high + low, "other": F.sum(amount), "beyond": F.sum(beyond)}
    return {name: sums[name].cast(kind) for name, kind in PARTS.items()}


def parts(price: Column, prefix: str) -> list[Column]:
    """Aggregates of a price column, each named by the prefix and one of ``PARTS``."""
    return [value.alias(f"{prefix}_{name}") for name, value in _sums(price).items()]


def added_parts(prefix: str) -> list[Column]:
    """Aggregates that add up the parts of several groups."""
    return [value.alias(f"{prefix}_{name}") for name, value in _added(prefix).items()]


def _added(prefix: str) -> dict[str, Column]:
    return {name: F.sum(f"{prefix}_{name}").cast(kind) for name, kind in PARTS.items()}


def totals(price: Column, prefix: str) -> list[Column]:
    """Aggregates of a price column from which ``revenue`` and ``average`` follow."""
    return _totals(_sums(price), prefix)


def added_totals(prefix: str) -> list[Column]:
    """The same from the parts of several groups."""
    return _totals(_added(prefix), prefix)


def _totals(sums: dict[str, Column], prefix: str) -> list[Column]:
    total = total_of(sums["cents"], sums["other"])
    return [
        sums["priced"].alias(f"{prefix}_priced"), sums["beyond"].alias(f"{prefix}_beyond"), total.alias(f"{prefix}_total")
    ]


def total_of(cents: Column, other: Column) -> Column:
    """The exact sum of the prices below 10^18."""
    cents = F.coalesce(cents, F.lit(0)).cast(_CENTS) * F.lit(0.01).cast("decimal(3,2)")
    return (cents + F.coalesce(other, F.lit(0).cast(_TOTAL))).cast(_TOTAL)


def _result(prefix: str, exact: Column, with_beyond: Column) -> Column:
    """The exact value where all prices are amounts, what adding doubles gives elsewhere, NULL without a price."""
    beyond, priced = F.col(f"{prefix}_beyond"), F.col(f"{prefix}_priced")
    return F.when(beyond.isNotNull(), F.round(with_beyond, 2)).when(priced > 0, exact.cast("double"))


def revenue(prefix: str) -> Column:
    """Sum in currency units, rounded half-up to cents; NULL if nothing had a price."""
    total = F.col(f"{prefix}_total")
    return _result(prefix, F.round(total, 2), total.cast("double") + F.col(f"{prefix}_beyond") / _SCALE)


def average(prefix: str) -> Column:
    """Mean in currency units, rounded half-up to cents; NULL if nothing had a price."""
    total, priced = F.col(f"{prefix}_total"), F.nullif(F.col(f"{prefix}_priced"), F.lit(0).cast("bigint"))
    count = priced.cast("decimal(18,0)")
    # The narrower type leaves the quotient 18 places, so rounding it again is safe below 10^15 prices.
    mean = F.coalesce(total.try_cast("decimal(28,8)") / count, total / count)
    beyond = F.col(f"{prefix}_beyond") / priced / _SCALE
    return _result(prefix, F.round(mean, 2), total.cast("double") / priced + beyond)
