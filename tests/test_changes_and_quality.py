from collections import Counter
from datetime import datetime

import pytest

from caremart.operators import changes, quality

ROWS = "id int, name string, n double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def test_snapshot_diff(spark):
    old = frame(spark, (1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, None, None))
    new = frame(spark, (1, "a", 1.0), (2, "b", 2.0), (4, None, None), (5, "e", 5.0))
    got = {(r.id, r._change_type, r.n) for r in changes.snapshot_diff(old, new, ["id"]).collect()}
    assert got == {
        (2, "update_preimage", None), (2, "update_postimage", 2.0), (3, "delete", 3.0),
        (5, "insert", 5.0)}


def test_snapshot_diff_counts_copies(spark):
    old = frame(spark, *[(1, "a", 1.0)] * 3)
    new = frame(spark, *[(1, "a", 1.0)] * 5)
    got = Counter(r._change_type for r in changes.snapshot_diff(old, new, ["id"]).collect())
    assert got == {"insert": 2}
    assert changes.snapshot_diff(new, new, ["id"]).count() == 0


def test_snapshot_diff_of_one_busy_key(spark):
    """A key with many rows on both sides gives a row per change, not a product."""
    old = spark.range(3000).selectExpr("1 as id", "cast(id as string) as name", "0d as n")
    new = spark.range(1000, 4000).selectExpr("1 as id", "cast(id as string) as name", "0d as n")
    got = Counter(r._change_type for r in changes.snapshot_diff(old, new, ["id"]).collect())
    assert got == {"update_preimage": 1000, "update_postimage": 1000}


FEED = "id int, name string, n double, at int, _change_type string"


def test_apply_changes(spark):
    base = frame(spark, (1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0))
    feed = spark.createDataFrame([
        (1, "late", 9.0, 2, "update_postimage"), (1, "early", 8.0, 1, "update_postimage"),
        (2, None, None, 5, "delete"), (2, "b2", 2.0, 4, "update_postimage"),
        (4, "new", 4.0, 1, "insert"), (5, "x", 1.0, 1, "insert"), (5, None, None, 2, "delete"),
        (3, "was", 0.0, 7, "update_preimage"),
    ], FEED)
    got = sorted(tuple(r) for r in changes.apply_changes(base, feed, ["id"], "at").collect())
    assert got == [(1, "late", 9.0), (3, "c", 3.0), (4, "new", 4.0)]


def test_applying_a_diff_gives_the_new_state(spark):
    old = spark.range(200).selectExpr(
        "cast(id as int) as id", "'a' as name", "cast(id % 7 as double) as n")
    new = spark.range(50, 260).selectExpr(
        "cast(id as int) as id", "'a' as name", "cast(id % 5 as double) as n")
    feed = changes.snapshot_diff(old, new, ["id"]).selectExpr("*", "1 as at")
    got = changes.apply_changes(old, feed, ["id"], "at")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, new.collect()))


def test_change_bounds(spark):
    df = spark.createDataFrame([(datetime(2020, 1, d),) for d in (3, 1, 2)], "t timestamp")
    (row,) = changes.change_bounds(df, "t").collect()
    assert tuple(row) == (datetime(2020, 1, 1), datetime(2020, 1, 3))


def test_key_rules():
    assert len(quality.KEYED_TABLES) == 28
    assert quality.primary_key("person") == "person_id"
    assert quality.primary_key("death") is None
    found = {r.column: r.parent for r in quality.references("visit_detail", [
        "visit_detail_id", "person_id", "visit_detail_concept_id", "care_site_id",
        "preceding_visit_detail_id", "parent_visit_detail_id", "visit_occurrence_id",
        "visit_detail_start_date"])}
    assert found == {
        "person_id": "person", "visit_detail_concept_id": "concept", "care_site_id": "care_site",
        "preceding_visit_detail_id": "visit_detail", "parent_visit_detail_id": "visit_detail",
        "visit_occurrence_id": "visit_occurrence"}
    assert not quality.references("cost", ["cost_domain_id", "cost_event_id", "payer_plan_period_id"])
    assert quality.max_length("race_source_value") == 50
    assert quality.max_length("drg_source_value") == 3
    assert quality.max_length("person_id") is None


def test_pk_violations(spark):
    df = frame(spark, (1, "a", 1.0), (1, "b", 1.0), (None, "c", 1.0), (2, "d", 1.0))
    got = {(r.id, r.rows) for r in quality.pk_violations(df, "id").collect()}
    assert got == {(1, 2), (None, 1)}


VISIT = "visit_occurrence_id string, person_id string, preceding_visit_occurrence_id string"


@pytest.fixture
def tables(spark):
    return {
        "person": spark.createDataFrame([("p",), ("p",), (None,)], "person_id string"),
        "visit_occurrence": spark.createDataFrame(
            [("v1", "p", None), ("v2", "x", "v1"), ("v3", "x", "gone")], VISIT),
    }


def test_reports(tables):
    keys = {r["table"]: tuple(r)[2:] for r in quality.pk_report(tables).collect()}
    assert keys == {"person": (3, 1, 2, 1), "visit_occurrence": (3, 0, 0, 0)}
    links = {(r["table"], r["column"]): (r.orphan_ids, r.orphan_rows)
             for r in quality.fk_report(tables).collect()}
    assert links == {
        ("visit_occurrence", "person_id"): (1, 2),
        ("visit_occurrence", "preceding_visit_occurrence_id"): (1, 1)}


def test_polymorphic_fk(spark, tables):
    cost = spark.createDataFrame(
        [("v1", "visit"), ("d1", "visit"), ("d1", "drug"), ("z", "other")],
        "cost_event_id string, cost_domain_id string")
    drugs = spark.createDataFrame([("d1",)], "drug_exposure_id string")
    rows = quality.polymorphic_fk(cost, {**tables, "drug_exposure": drugs}).collect()
    assert {r.domain: r.orphan_rows for r in rows} == {"visit": 1, "drug": 0}


def test_column_reports(spark):
    provider = spark.createDataFrame([("p", "x" * 21), (None, "y")], "provider_id string, npi string")
    nulls = quality.not_null_report({"provider": provider}).collect()
    assert [(r["column"], r.null_rows) for r in nulls] == [("provider_id", 1)]
    long = quality.length_report({"provider": provider}).collect()
    assert [(r["column"], r.too_long_rows) for r in long] == [("npi", 1)]


def test_rules_from_the_published_field_list(spark):
    layout = ("cdmTableName string, cdmFieldName string, isRequired string, cdmDatatype string,"
              " isPrimaryKey string, isForeignKey string, fkTableName string, fkFieldName string")
    fields = spark.createDataFrame([
        ("death", "person_id", "Yes", "integer", "No", "Yes", "PERSON", "PERSON_ID"),
        ("death", "cause_source_value", "No", "varchar(50)", "No", "No", None, None),
        ("NOTE", "note_text", "Yes", "varchar(MAX)", "No", "No", None, None),
        ("note", "note_id", "Yes", "integer", "Yes", "No", None, None),
    ], layout)
    rules = {k: sorted(map(tuple, v.collect())) for k, v in quality.rules_from_fields(fields).items()}
    assert rules["primary_key"] == [("note", "note_id")]
    assert rules["foreign_key"] == [("death", "person_id", "person", "person_id")]
    assert rules["length"] == [("death", "cause_source_value", 50)]
    assert ("note", "note_text") in rules["required"]


def test_missing_files(spark):
    manifest = spark.createDataFrame(
        [("u1", "p", "a.xml"), ("u2", "p", "b.xml")], "url string, patient_id string, file_name string")
    landed = spark.createDataFrame(
        [("p", "a.xml"), ("p", "a.xml")], "patient_id string, file_name string")
    assert [r.url for r in quality.missing_files(manifest, landed).collect()] == ["u2"]


def test_self_reference_in_one_scan(spark):
    rows = [("a", None), ("b", "a"), ("c", "a"), ("d", "gone"), ("e", "gone"), ("f", "f"), (None, "a"), (None, "lost"), ("b", "c")]
    visits = spark.createDataFrame(rows, "id string, before string")
    found = quality.self_orphans(visits, "before", "id")
    assert {tuple(r) for r in found.collect()} == {("gone", 2), ("lost", 1)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert quality.self_orphans(visits.limit(0), "before", "id").count() == 0
