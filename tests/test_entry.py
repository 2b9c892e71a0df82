import os

import pytest

import __spark_entry__ as driver
from check_queries import compare

SCALE = "/root/testdata/sf0.001"
FAST = [
    "hash_ids", "doc_dates", "claim_dates", "claim_procedures_long", "rx_claims_typed",
    "doc_patients", "doc_medications", "doc_nested_sections", "new_documents_only", "omop_person", "omop_cost",
    "url_manifest", "csv_rescued_ingest", "snapshot_diff", "apply_changes", "pk_violations",
]

needs_data = pytest.mark.skipif(not os.path.isdir(SCALE), reason="no test tables")


def test_every_query_has_a_twin():
    own = set(driver.queries()) - set(driver.llm.queries() if driver.llm else ())
    assert own <= set(driver.oracle_sql()) <= set(driver.queries())


@needs_data
@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, name):
    good, text = compare(spark, name, SCALE)
    assert good, text


@needs_data
def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["person_id", "cost_rows", "total_charge", "total_paid"]
    assert df.count() > 0
