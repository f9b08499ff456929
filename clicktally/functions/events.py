"""Derived event columns and the predicates the queries share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from clicktally.schema import PURCHASE


def event_date_text(event_time: str = "event_time") -> Column:
    """The first ten characters of the event time, still text."""
    return F.substring(event_time, 1, 10)


def event_date(event_time: str = "event_time") -> Column:
    """The day of an event as DATE; NULL unless the text starts with a real ``yyyy-MM-dd`` day.

    A cast takes about half the time of ``to_date`` with a pattern, which
    matters when it runs once per event.  It also accepts loose forms such as
    ``2019-1-1`` or ``2019-11``, so the shape is tested first.
    """
    strict = F.col(event_time).rlike(r"^\d{4}-\d\d-\d\d")
    return F.when(strict, event_date_text(event_time).try_cast("date"))


def with_event_date(events: DataFrame) -> DataFrame:
    """Add ``event_date`` unless the table already carries it as a DATE; any other type is derived anew."""
    if "event_date" in events.columns and isinstance(events.schema["event_date"].dataType, DateType):
        return events
    return events.withColumn("event_date", event_date())


def valid_price(price: str = "price") -> Column:
    """The price if it is a positive number, else NULL.  The row itself stays."""
    value = F.col(price)
    # Spark orders NaN above every number, so "> 0" alone would let it through.
    return F.when((value > 0) & ~F.isnan(value), value)


def is_purchase(event_type: str = "event_type") -> Column:
    """Exact, case-sensitive match; a NULL type is not a purchase."""
    return F.col(event_type) == PURCHASE


def has_brand(brand: str = "brand") -> Column:
    """Neither empty nor NULL, as a filter: comparing NULL is not true.  A brand made of spaces passes."""
    return F.col(brand) != ""


def has_nonblank_brand(brand: str = "brand") -> Column:
    """Neither NULL nor whitespace only, as a filter; tabs and newlines count as whitespace."""
    # (?U) makes \s follow Unicode, so a no-break space is blank as well; the
    # four separators are blank to Python's strip but not to Unicode.
    return F.col(brand).rlike(r"(?U)[^\s\x1c-\x1f]")


def percentage(part: Column, total: Column) -> Column:
    return F.round(part * 100.0 / total, 2)
