"""Distinct rows by one sort after the shuffle, and what is told apart by it."""

from pyspark.sql import functions as F

from caremart import schemas
from caremart.functions.rows import distinct_near
from caremart.operators import claims, omop
from tests.test_shuffles_of_claims import _lines, _plan, _rows


def test_distinct_near_is_the_distinct_without_hash_tables(spark):
    rows = [(None, "", 0.0, 1.5), (None, None, 0.0, 1.5), (None, "", -0.0, 1.5), ("a", "", float("nan"), None),
            ("a", "", float("nan"), None), ("a", "", None, None), ("a", "b", -0.0, 2.0), ("b", "b", 1.0, 2.0), ("b", "b", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, t string, x double, y float")
    found = distinct_near(df, "k")
    assert _rows(found) == _rows(df.distinct()) and found.columns == df.columns
    plan = _plan(found)
    assert "HashAggregate" not in plan and plan.count("Exchange") == 1


def test_codes_of_claims_are_held_once(spark):
    for make in (claims.claim_diagnoses, claims.claim_procedures, claims.claim_lines):
        assert "HashAggregate" not in _plan(make(_lines(spark, False)))


def test_conditions_of_diagnoses_as_seen(spark):
    problem = spark.createDataFrame([], schemas.SILVER_PROBLEM)
    plain = omop.omop_condition(problem, claims.claim_diagnoses(_lines(spark, False)))
    seen = omop.omop_condition(problem, claims.claim_diagnoses(_lines(spark, False), as_seen=True), as_seen=True)
    assert seen.schema == plain.schema and _rows(seen) == _rows(plain)


def test_flags_are_counted_over_digests(spark):
    typed = _lines(spark, False)
    expected = claims.claim_lines(typed).groupBy("Inpatient_flag").agg(F.count(F.lit(1)).alias("lines"))
    found = claims.flag_counts(typed)
    assert _rows(found) == _rows(expected)
    plan = _plan(found)
    assert "_line#" in plan and "ICDDiag" not in plan[: plan.index("REPARTITION_BY_COL")]
