"""Catalog tables: creation, versioned overwrite, recovery, retention, append, staging."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from caremart.functions.ids import packed_ids, unpacked_ids
from caremart.schemas import LAYERS
from caremart.session import fresh_folder


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_tables(
    spark: SparkSession, layer: str, database: str, location: str | None = None
) -> list[str]:
    """Create the database and the empty tables of a layer where missing.

    A table whose layout was being changed by a run that died is not missing:
    it is brought back first.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    recover_tables(spark, database)
    names = []
    for table, schema in LAYERS[layer].items():
        name = f"{database}.{table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING PARQUET")
        names.append(name)
    return names


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a key close together, so that lookups by key skip row groups.

    A rebalance rather than a repartition: it co-locates a key as well, but
    the adaptive planner splits a key that holds too large a share. Ids, most
    of what a row of the model is long, are moved and sorted as bytes.
    """
    ids = [c for c, kind in df.dtypes if kind == "string" and c.endswith("_id") and c not in keys]
    rows = packed_ids(df, *ids).hint("rebalance", *keys).sortWithinPartitions(*keys)
    return unpacked_ids(rows, *ids)


def _files(spark: SparkSession, folder: str):
    """A folder and the file system that it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _base(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def _create(spark: SparkSession, name: str, schema: T.StructType, version: str) -> None:
    spark.sql(f"CREATE TABLE {name} ({_columns(schema)}) USING PARQUET LOCATION '{version}'")


def overwrite_table(df: DataFrame, name: str, cluster_by: Sequence[str] = ()) -> None:
    """Replace a table's rows, also where ``df`` reads that very table.

    The rows go to a new folder and the catalog entry is pointed there at the
    end: nothing is copied, readers of the old version are not disturbed, and
    a job that dies on the way leaves the table as it was. A new layout needs
    a new catalog entry. Where the new rows are is noted before the old entry
    goes, so ``recover_tables`` brings back a table that was caught in between.
    Old versions stay until ``tidy_table``; what the write shuffled goes.
    """
    spark = df.sparkSession
    database, table = name.split(".")
    base = _base(spark, database)
    version = f"{base}/_versions/{table}/{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        (clustered(df, cluster_by) if cluster_by else df).write.parquet(version, compression="zstd")
    if not spark.catalog.tableExists(name):
        _create(spark, name, df.schema, version)
        return
    same = [(f.name, f.dataType) for f in spark.table(name).schema.fields] == [
        (f.name, f.dataType) for f in df.schema.fields
    ]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
        return
    note = f"{base}/_layouts/{table}"
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(note)
    spark.sql(f"DROP TABLE {name}")
    _create(spark, name, df.schema, version)
    files, place = _files(spark, note)
    files.delete(place, True)


def recover_tables(spark: SparkSession, database: str) -> list[str]:
    """Bring back tables that a run left without a catalog entry while it changed their layout."""
    base = _base(spark, database)
    files, place = _files(spark, f"{base}/_layouts")
    back = []
    for status in files.listStatus(place) if files.exists(place) else []:
        note = status.getPath()
        name = f"{database}.{note.getName()}"
        whole = files.exists(spark._jvm.org.apache.hadoop.fs.Path(note, "_SUCCESS"))
        if whole and not spark.catalog.tableExists(name):
            version = spark.read.text(note.toString()).first()[0]
            _create(spark, name, spark.read.parquet(version).schema, version)
            back.append(name)
        files.delete(note, True)
    return back


def tidy_table(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` versions of a table's rows; gives the removed folders.

    The version that the catalog points to always stays. To be called when no
    reader is left that opened an older one.
    """
    database, table = name.split(".")
    files, place = _files(spark, f"{_base(spark, database)}/_versions/{table}")
    if not files.exists(place):
        return []
    detail = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
    current = detail["data_type"].rstrip("/").split("/")[-1]
    versions = sorted(files.listStatus(place), key=lambda s: (s.getPath().getName() == current, s.getModificationTime()))
    removed = [s.getPath() for s in versions[: max(0, len(versions) - max(keep, 1))]]
    for folder in removed:
        files.delete(folder, True)
    return [folder.toString() for folder in removed]


def append_table(df: DataFrame, name: str) -> None:
    """Add rows, columns matched by name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        overwrite_table(df, name)
        return
    df.select(*spark.table(name).columns).write.mode("append").insertInto(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside removes its shuffle files when it is done.

    Otherwise they stay on the executors' disks until the driver collects
    garbage, next to the result that nobody needs them for any more.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a costly result with several readers: they scan only the columns they
    need, and a lost executor costs no recomputation. Its shuffle files go.
    """
    path = fresh_folder(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
