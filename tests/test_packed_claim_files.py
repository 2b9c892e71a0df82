"""Claim files are packed, land by their headers, and tables leave nothing of what their write shuffled."""

import glob

from pyspark.sql import functions as F

from caremart import schemas
from caremart.plans import posing
from caremart.session import fresh_folder
from caremart.sources import tables
from caremart.streaming import ingest
from tests.test_disk_of_checks import _shuffle_files

LAYOUT = schemas.ddl("ClaimID string, Paid string, MemberID string")


def test_packed_files_land_as_they_were(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(posing, "_LINES_A_FILE", 2)
    rows = [("1", None, "m"), ("2", "a,b", 'say "x"'), ("3", "é", ""), ("4", "5", None), ("5", "", "n")]
    df = spark.createDataFrame(rows, LAYOUT).coalesce(1)
    posing.write_claim_files(df, f"{tmp_path}/raw")
    # Another column order, and a column that is not known.
    odd = spark.createDataFrame([("z", "9", "6")], "MemberID string, other string, ClaimID string")
    posing.write_claim_files(odd, f"{tmp_path}/more")
    assert len(glob.glob(f"{tmp_path}/raw/*.csv.gz")) == 3
    for source in ("raw", "more"):
        assert ingest.ingest_csv(
            spark, f"{tmp_path}/{source}", f"{tmp_path}/bronze", f"{tmp_path}/checkpoint-{source}", LAYOUT,
            glob=posing.CLAIM_FILES, timeout=120)
    landed = spark.read.parquet(f"{tmp_path}/bronze")
    assert all(f.endswith(".zstd.parquet") for f in landed.inputFiles())
    found = {tuple(r) for r in landed.select(*LAYOUT.fieldNames(), "_rescued_data").collect()}
    spark.createDataFrame(rows, LAYOUT).coalesce(1).write.csv(f"{tmp_path}/plain", header=True)
    assert ingest.ingest_csv(spark, f"{tmp_path}/plain", f"{tmp_path}/flat", f"{tmp_path}/checkpoint", LAYOUT, timeout=120)
    plain = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/flat").select(*LAYOUT.fieldNames(), "_rescued_data").collect()}
    assert found - plain == {("6", None, "z", '{"other":"9"}')} and plain < found and len(plain) == 5


def test_an_overwritten_table_leaves_no_shuffle_files(spark):
    folder = fresh_folder(spark, "left")
    name = f"left_{folder[-8:]}.t"
    spark.sql(f"CREATE DATABASE {name.split('.')[0]} LOCATION '{folder}'")
    before = _shuffle_files(spark)
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    tables.overwrite_table(rows, name, ["k"])
    tables.overwrite_table(spark.table(name).distinct(), name)
    assert _shuffle_files(spark) <= before
    assert spark.table(name).count() == 1000 and all(".zstd." in f for f in spark.table(name).inputFiles())
