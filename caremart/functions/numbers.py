"""Text to number without the price of an exception per bad value.

``try_cast`` of text to a number raises and catches inside, about a hundred
microseconds for each value that is not a number. Feeds are full of those, so
a cheap look at the text decides first. The patterns let through everything
that the cast accepts; what else they let through, the cast turns into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANK = r"[\x00-\x20\x7f]*"
INTEGER_TEXT = f"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
FRACTION_START = rf"(?i)^{_BLANK}[+-]?(\.?[0-9]|inf|nan)"


def text_to_int(text: Column) -> Column:
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("int"))


def text_to_fraction(text: Column, kind: str) -> Column:
    return F.when(text.rlike(FRACTION_START), text.try_cast(kind))
