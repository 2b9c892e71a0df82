"""Checks keep little on disk: digests for ids, no shuffle files that nobody needs."""

import os

from pyspark.sql import functions as F

from caremart.operators import quality
from caremart.sources.tables import staged


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for top in manager.localDirs() for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    grouped = rows.repartition(5, "id").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    table = staged(grouped, "grouped")
    assert _shuffle_files(spark) <= before and table.count() == 7
    assert grouped.count() == 7 and staged(grouped.join(grouped.select("k"), "k"), "again").count() == 7


def test_reports_count_and_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    cost = spark.createDataFrame(
        [("c1", "v1", "visit"), ("c1", "v2", "visit"), ("c2", "v2", "visit"), (None, None, "visit"), ("", "d1", "drug"), ("c4", "v1", "drug")],
        "cost_id string, cost_event_id string, cost_domain_id string",
    )
    gold = {
        "cost": cost,
        "visit_occurrence": spark.createDataFrame([("v1",), ("v1",), ("v3",), (None,)], "visit_occurrence_id string"),
        "drug_exposure": spark.createDataFrame([("d1",)], "drug_exposure_id string"),
    }
    keys = quality.pk_report(gold)
    assert {r["table"]: tuple(r)[2:] for r in keys.collect()} == {
        "cost": (6, 1, 2, 1), "visit_occurrence": (4, 1, 2, 1), "drug_exposure": (1, 0, 0, 0)}
    orphans = quality.polymorphic_fk(cost, gold)
    found = {r["domain"]: (r["orphan_ids"], r["orphan_rows"]) for r in orphans.collect()}
    assert found == {"visit": (1, 2), "drug": (1, 1)}
    assert _shuffle_files(spark) <= before
    # The reports are numbers by now: they read no table again.
    assert all("-report-" in f for report in (keys, orphans) for f in report.inputFiles())


def test_keys_of_numbers_are_counted_as_they_are(spark):
    rows = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, None)], "a long, B double")
    rules = quality.ModelRules({"t": ("a", "b")}, {}, {}, ())
    assert [tuple(r)[2:] for r in quality.pk_report({"t": rows}, rules).collect()] == [(3, 1, 2, 1)]
