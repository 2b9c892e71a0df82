"""Date parsers that give NULL, never an error, in both ANSI modes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caremart.functions.ids import as_column


# Month 1-12, day 1-31 and a year of up to four digits; blanks and leading zeros
# allowed, text after a third slash ignored.
_CALENDAR = (
    r"^\s*0*([1-9]|1[0-2])\s*/\s*0*([1-9]|[12][0-9]|3[01])\s*/\s*0*([0-9]{1,4})\s*(?:/.*)?$"
)


def month_day_year(text: Column | str) -> Column:
    """``M/d/yyyy`` text to DATE.

    One pattern puts the fields in year-month-day order for a single tolerant
    cast; years may have leading zeros there. Text that does not match never
    reaches the cast, since casts that fail cost an exception each. A two
    digit year is taken literally (year 20), as ``make_date`` would.
    """
    text = as_column(text)
    iso = F.regexp_replace(text, _CALENDAR, "000$3-$1-$2")
    return F.when(text.rlike(_CALENDAR), iso).try_cast("date")


def cda_timestamp(text: Column | str) -> Column:
    """Clinical document time: exactly 8 or 14 digits, anything else is NULL."""
    text = as_column(text)

    def piece(start: int, length: int) -> Column:
        return F.substring(text, start, length)

    dash, colon = F.lit("-"), F.lit(":")
    day = F.concat(piece(1, 4), dash, piece(5, 2), dash, piece(7, 2))
    clock = F.concat(piece(9, 2), colon, piece(11, 2), colon, piece(13, 2))
    return (
        F.when(text.rlike("^[0-9]{8}$"), day.try_cast("timestamp"))
        .when(text.rlike("^[0-9]{14}$"), F.concat(day, F.lit(" "), clock).try_cast("timestamp"))
    )


def midnight(day: Column | str) -> Column:
    """DATE to the TIMESTAMP at its start in the session time zone."""
    return as_column(day).cast("timestamp")
