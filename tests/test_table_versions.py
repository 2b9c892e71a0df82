"""Versions of catalog tables: a killed change of layout, and retention."""

import os

import pytest

from caremart.sources import tables


def test_killed_layout_change_leaves_the_table(spark, monkeypatch):
    tables.ensure_tables(spark, "gold", "gold_k")
    person = spark.createDataFrame([("p",)], "person_id string")

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_create", dies)
        with pytest.raises(RuntimeError):
            tables.overwrite_table(person, "gold_k.person")
    assert not spark.catalog.tableExists("gold_k.person")
    # Not an empty table in its place, but the new rows.
    tables.ensure_tables(spark, "gold", "gold_k")
    assert [tuple(r) for r in spark.table("gold_k.person").collect()] == [("p",)]
    assert tables.recover_tables(spark, "gold_k") == []
    # One that died before the old entry went changes nothing; a dropped table stays dropped.
    tables.overwrite_table(spark.range(2), "gold_k.cost")
    tables.drop_table(spark, "gold_k.cost")
    assert tables.recover_tables(spark, "gold_k") == []
    assert not spark.catalog.tableExists("gold_k.cost")


def test_old_versions_go(spark):
    tables.ensure_tables(spark, "gold", "gold_v")
    for n in range(4):
        tables.overwrite_table(spark.range(n + 1), "gold_v.numbers")
    removed = tables.tidy_table(spark, "gold_v.numbers", keep=2)
    assert len(removed) == 2 and not any(os.path.exists(f.removeprefix("file:")) for f in removed)
    assert spark.table("gold_v.numbers").count() == 4
    tables.overwrite_table(spark.table("gold_v.numbers").filter("id < 3"), "gold_v.numbers")
    assert len(tables.tidy_table(spark, "gold_v.numbers", keep=1)) == 2
    assert spark.table("gold_v.numbers").count() == 3
    assert tables.tidy_table(spark, "gold_v.person") == []
