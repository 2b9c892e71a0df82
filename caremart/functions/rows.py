"""Rows made distinct without holding them before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def plain_numbers(df: DataFrame) -> list[Column]:
    """The columns, with minus zero as zero: a distinct shows it so, whichever row it keeps."""
    return [
        (F.col(c) + F.lit(0).cast(kind)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes
    ]


def distinct_within(df: DataFrame, *near: str) -> DataFrame:
    """Distinct rows of ``df``, whose equal rows lie together by the columns ``near``.

    The first of each run of equal rows in a sort. A distinct would group the
    rows of a partition twice, in two hash tables that hold all of them at the
    same time; the sort holds them once.
    """
    rows = df.select(*plain_numbers(df))
    same = Window.partitionBy(*near, *[c for c in rows.columns if c not in near]).orderBy(F.lit(1))
    return rows.withColumn("_nth", F.row_number().over(same)).where("_nth = 1").drop("_nth")


def distinct_near(df: DataFrame, *near: str) -> DataFrame:
    """Distinct rows, brought together by the columns ``near`` first.

    A distinct by itself groups each task's rows before the shuffle as well.
    Where rows seldom repeat that removes nothing, and a task that holds many
    wide rows spills them. Brought together first, a row is shuffled once and
    held once, in partitions of the size of a shuffle's.
    """
    return distinct_within(df.repartition(*near), *near)
