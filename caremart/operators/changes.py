"""Change feeds without a transactional table format.

``snapshot_diff`` derives the row changes between two states of a table,
``version_feed`` chains them over the versions of a table, ``apply_changes``
brings a table up to date with a change feed, and ``change_bounds`` gives the
time range of a feed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.sources.parts import PartTable

CHANGE_TYPE = "_change_type"
DELETE = "delete"
COMMIT_VERSION, COMMIT_TIMESTAMP = "_commit_version", "_commit_timestamp"


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that differ between two states, with their ``_change_type``.

    insert, delete, update_preimage or update_postimage. Both states are
    counted per whole row in one aggregation, which drops unchanged rows on
    the map side as far as it can and spreads a repeated key over its rows.
    Only changed rows reach the per-key step, and that one joins to a single
    summary row per key, so a repeated key cannot multiply. Copies of a row
    count: a row that is there once more than before comes out once.
    """
    keys = list(keys)
    columns = new.columns
    sides = old.select(
        *columns, F.lit(1).cast("long").alias("_old"), F.lit(0).cast("long").alias("_new")
    ).unionByName(
        new.select(*columns, F.lit(0).cast("long").alias("_old"), F.lit(1).cast("long").alias("_new"))
    )
    counted = sides.groupBy(*columns).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    changed = counted.filter(F.col("_old") != F.col("_new"))
    per_key = changed.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.max(F.col("_old") > F.col("_new")).alias("_gone"),
        F.max(F.col("_new") > F.col("_old")).alias("_came"),
    )
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    updated = F.col("_gone") & F.col("_came")
    before = F.when(updated, "update_preimage").otherwise("delete")
    after = F.when(updated, "update_postimage").otherwise("insert")
    was = F.col("_old") > F.col("_new")
    copies = F.abs(F.col("_old") - F.col("_new"))
    return (
        changed.join(per_key, same_key, "inner")
        .withColumn(CHANGE_TYPE, F.when(was, before).otherwise(after))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
        .select(*columns, CHANGE_TYPE)
    )


def version_feed(table: PartTable, keys: Sequence[str], since: int = 0) -> DataFrame:
    """Changes of every version of ``table`` after ``since``, with the version and its time.

    Of each version only the parts that it swapped are read, before and after;
    a row that moves between parts is an update. All versions are compared in
    one pass, the version being part of the key.
    """
    columns = table.schema.fieldNames()
    spark = table.spark
    old, new = [], []
    for before, version, at in table.history(since):
        past, now = table.parts(before) if before else {}, table.parts(version)
        swapped = {p for p in past.keys() | now.keys() if past.get(p) != now.get(p)}
        commit = F.lit(version).cast("long").alias(COMMIT_VERSION), F.lit(at).alias(COMMIT_TIMESTAMP)
        if swapped & past.keys():
            old.append(table.read(swapped & past.keys(), before).select(*columns, *commit))
        if swapped & now.keys():
            new.append(table.read(swapped & now.keys(), version).select(*columns, *commit))
    none = spark.createDataFrame([], table.schema).select(
        *columns, F.lit(0).cast("long").alias(COMMIT_VERSION), F.lit(None).cast("timestamp").alias(COMMIT_TIMESTAMP)
    )
    sides = [reduce(DataFrame.unionByName, side, none) for side in (old, new)]
    return snapshot_diff(*sides, [*keys, COMMIT_VERSION])


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    change_type: str = CHANGE_TYPE,
    deletes: Sequence[str] = (DELETE,),
) -> DataFrame:
    """``base`` after the latest change of each key.

    Keys are non-null. The latest change is a maximum over a struct, which
    combines on the map side, so the history of a busy key is never gathered
    in one place. Equal sequence numbers are settled by the row values.
    Preimages of a diff are passed over.
    """
    keys = list(keys)
    columns = base.columns
    values = [c for c in columns if c not in keys]
    wanted = changes.filter(F.col(change_type) != "update_preimage")
    latest = (
        wanted.groupBy(*keys)
        .agg(
            F.max(
                F.struct(
                    F.col(sequence).alias("_sequence"),
                    (~F.col(change_type).isin(*deletes)).alias("_kept"),
                    *[F.col(c).alias(f"_v_{c}") for c in values],
                )
            ).alias("_last")
        )
    )
    upserts = latest.filter("_last._kept").select(
        *[F.col(c) if c in keys else F.col(f"_last._v_{c}").alias(c) for c in columns]
    )
    untouched = base.join(latest.select(*keys), keys, "left_anti").select(*columns)
    return untouched.unionByName(upserts)


def change_bounds(changes: DataFrame, timestamp: str = "_commit_timestamp") -> DataFrame:
    """First and last time of a feed, in one pass."""
    return changes.agg(
        F.min(timestamp).alias("earliest_commit"), F.max(timestamp).alias("latest_commit")
    )
