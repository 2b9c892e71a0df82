"""Data contracts: which tolerant cast each column of a feed goes through."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremart.functions.dates import month_day_year
from caremart.functions.numbers import text_to_fraction, text_to_int

CAST_RULES: dict[str, Callable[[Column], Column]] = {
    "string": lambda c: c,
    "int": text_to_int,
    "float": lambda c: text_to_fraction(c, "float"),
    "double": lambda c: text_to_fraction(c, "double"),
    "money": lambda c: F.round(text_to_fraction(c, "double"), 2),
    "mdy": month_day_year,
}


def apply_contract(
    contract: list[tuple[str, str]], available: list[str]
) -> dict[str, Column]:
    """Typed column per contract entry, in contract order.

    A column that the feed does not carry becomes a typed NULL, so an older
    file layout still yields the full silver schema.
    """
    present = set(available)
    absent = F.lit(None).cast("string")
    # One expression per rule serves all absent columns.
    empty = {rule: CAST_RULES[rule](absent) for _, rule in contract}
    return {
        name: (CAST_RULES[rule](F.col(name)) if name in present else empty[rule]).alias(name)
        for name, rule in contract
    }


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast, order and fill ``df`` to ``schema``; extra columns are dropped.

    String sources use a tolerant cast, so bad text becomes NULL; a narrowing
    between typed columns keeps the session's own cast rules.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    # Types by name and one NULL per type: wide layouts are built quickly.
    names = {f.dataType.simpleString() for f in schema.fields}
    empty = {name: F.lit(None).cast(name) for name in names}

    def fitted(field: T.StructField) -> Column:
        have = kinds.get(field.name)
        if have is None:
            return empty[field.dataType.simpleString()].alias(field.name)
        column = F.col(f"`{field.name}`")
        if have == field.dataType:
            return column
        if isinstance(have, T.StringType):
            if isinstance(field.dataType, T.IntegerType):
                return text_to_int(column).alias(field.name)
            if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
                kind = field.dataType.simpleString()
                return text_to_fraction(column, kind).alias(field.name)
            return column.try_cast(field.dataType.simpleString()).alias(field.name)
        return column.cast(field.dataType.simpleString()).alias(field.name)

    return df.select(*[fitted(f) for f in schema.fields])
