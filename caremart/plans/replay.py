"""Rows with rescued data, stored until the contract knows their columns.

Landed batches are split into clean rows and rows set aside. Once a contract
has grown, rows that were set aside for the new columns alone are read anew
and move over to the clean ones. Both sides are parts of one table, so a move
is one swap: a run that dies has moved nothing, and no row is moved twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caremart.plans.incremental import landed_batches
from caremart.sources.delimited import RESCUED
from caremart.sources.parts import PART, PartTable
from caremart.sources.tables import staged

CLEAN, ASIDE, REPLAYED = "clean", "aside", "replayed"
_BY = "~"


def replay_rescued(aside: DataFrame, landed: T.StructType, grown: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows that the grown contract can hold, the rest)``, with the columns of ``aside`` and what is new.

    A row moves if all that was rescued of it belongs to columns that ``grown``
    has and ``landed`` has not, and is of their type; nothing is left rescued
    of it then. Lines rescued whole, and second columns of a name that was
    known already, stay.
    """
    before = set(landed.fieldNames())
    added = [f for f in grown.fields if f.name not in before]
    names = F.array(*[F.lit(f.name) for f in added]).cast("array<string>")
    bag = F.from_json(RESCUED, "map<string,string>")
    fits = F.size(F.array_except(F.map_keys(bag), names)) == 0
    for field in added:
        fits = fits & (bag[field.name].isNull() | bag[field.name].try_cast(field.dataType).isNotNull())
    # A text that is no JSON object, or an empty one, says nothing.
    fits = F.coalesce((F.size(F.map_keys(bag)) > 0) & fits, F.lit(False))
    read = {f.name: bag[f.name].try_cast(f.dataType) for f in added}
    moved = aside.filter(fits).withColumns(read).withColumn(RESCUED, F.lit(None).cast("string"))
    return moved, aside.filter(~fits)


class RescuedRows:
    """Clean rows and rows set aside of one feed, below ``path``.

    ``landed`` is the contract that the feed is read with; ``grown`` the one
    that holds by now, with text or typed columns behind those of ``landed``.
    """

    def __init__(self, spark: SparkSession, path: str, landed: T.StructType, grown: T.StructType | None = None):
        self.landed, self.grown = landed, grown or landed
        layout = T.StructType([*self.grown.fields, T.StructField(RESCUED, T.StringType())])
        self.table = PartTable(spark, path, layout)

    def _parts(self, *states: str) -> list[str]:
        return [p for p in self.table.parts() if p.split(_BY)[0] in states]

    def land(self, target: str) -> int:
        """Take in landed batches that are new; gives their number. Withdrawn ones go, replayed rows too."""
        spark, batches = self.table.spark, landed_batches(self.table.spark, target)
        known = {p.split(_BY)[1] for p in self.table.parts()}
        gone = known - batches.keys()
        if gone:
            self.table.swap(None, [p for p in self.table.parts() if p.split(_BY)[1] in gone])
        new = sorted(batches.keys() - known)
        for batch in new:
            rows = spark.read.schema(T.StructType([*self.landed.fields, T.StructField(RESCUED, T.StringType())]))
            state = F.when(F.col(RESCUED).isNull(), CLEAN).otherwise(ASIDE)
            later = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.grown.fields[len(self.landed.fields):]]
            rows = rows.parquet(batches[batch]).select("*", *later, F.concat(state, F.lit(_BY + batch)).alias(PART))
            self.table.swap(rows, [f"{CLEAN}{_BY}{batch}", f"{ASIDE}{_BY}{batch}"])
        return len(new)

    def replay(self) -> int:
        """Move the rows that the grown contract can hold; gives their number.

        Parts without such a row are not written again, and rows that are
        clean already are not read.
        """
        # Where a row lies tells its batch.
        batch = F.regexp_extract(F.input_file_name(), rf"{PART}={ASIDE}{_BY}([^/]*)/", 1)
        aside = staged(self.table.read(self._parts(ASIDE)).withColumn("_batch", batch), "aside")
        moved, still = replay_rescued(aside, self.landed, self.grown)
        touched = sorted(r[0] for r in moved.select("_batch").distinct().collect())
        if not touched:
            return 0
        number = self.table.version + 1
        rest = still.filter(F.col("_batch").isin(touched))
        rows = moved.withColumn(PART, F.concat(F.lit(f"{REPLAYED}{_BY}"), "_batch", F.lit(f"{_BY}{number}"))).unionByName(
            rest.withColumn(PART, F.concat(F.lit(f"{ASIDE}{_BY}"), "_batch"))
        )
        count = moved.count()
        names = [f"{ASIDE}{_BY}{b}" for b in touched] + [f"{REPLAYED}{_BY}{b}{_BY}{number}" for b in touched]
        self.table.swap(rows.drop("_batch"), names)
        return count

    def read(self, *states: str) -> DataFrame:
        """Rows in these states, all that are usable by default, with the grown contract's columns."""
        rows = self.table.read(self._parts(*(states or (CLEAN, REPLAYED))))
        return rows if ASIDE in states else rows.drop(RESCUED)
