"""Reviews of costs are made of the rows of the persons who are asked for."""

import __spark_entry__ as driver
from caremart import schemas
from caremart.operators import review
from tests.test_claims_and_model import LINE, raw


def test_a_review_reads_the_persons_rows(spark):
    lines = raw(spark, schemas.MEDICAL_CSV, LINE, {**LINE, "MemberID": "other"}, {**LINE, "MemberID": None}, {**LINE, "MemberID": ""})
    who = spark.createDataFrame([(LINE["MemberID"],), ("",), (None,)], "person_id string")
    assert review.rows_of(lines, LINE["MemberID"], "MemberID").count() == 1
    assert sorted(r["MemberID"] or "" for r in review.rows_of(lines, who, "MemberID").collect()) == ["", "", LINE["MemberID"]]
    # NULL and empty members have one id, so both are there for either.
    assert review.rows_of(lines, "", "MemberID").count() == 2


def test_costs_are_made_of_the_persons_lines(spark, tmp_path):
    folder = str(tmp_path)
    day = "timestamp'2020-01-02'"
    spark.sql(f"select id as o_orderkey, id % 4 as o_custkey, 'F' as o_orderstatus, '1-URGENT' as o_orderpriority, {day} as o_orderdate from range(8)").write.parquet(f"{folder}/orders.parquet")
    spark.sql(
        f"select id as l_orderkey, 2L as l_partkey, 3L as l_suppkey, 1 as l_linenumber, 4D as l_quantity, 5D as l_extendedprice, 0.1D as l_discount,"
        f" 0.2D as l_tax, 'R' as l_returnflag, 'O' as l_linestatus, {day} as l_shipdate from range(8)").write.parquet(f"{folder}/lineitem.parquet")
    spark.sql(f"select id as event_id, id % 4 as user_id, 'view' as event_type, {day} as ts, 2D as value, '{{}}' as props from range(8)").write.parquet(f"{folder}/events.parquet")
    spark.sql("select 1L as conv_id, 0L as turn, 'user' as role, 'a line' as text").write.parquet(f"{folder}/conversations.parquet")
    s = driver.Silver(spark, folder, who="1")
    assert s.lines.count() == 2 and s.rx.count() == 2 and s.patient.count() == 1
    found = driver._review_costs(spark, folder, "1").collect()
    assert len(found) == 4 and {r["cost_domain_id"] for r in found} == {"visit", "drug"}
    who = spark.createDataFrame([("1",), ("3",), (None,)], "person_id string")
    several = driver._review_costs(spark, folder, who)
    assert several.count() == 8 and {r["person_id"] for r in several.collect()} == {"1", "3"}
