"""Claim lines that several tables are made of are joined once where the join moves both sides."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from caremart.plans import posing

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def claims_dir(spark, tmp_path):
    spark.sql("select 1L o_orderkey, 7L o_custkey, 'F' o_orderstatus, '1-URGENT' o_orderpriority, timestamp'2020-01-02' o_orderdate"
              " union all select null, 8L, 'O', null, timestamp'2020-01-03' union all select 1L, 9L, 'P', '5-LOW', null"
              ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("select k l_orderkey, 2L l_partkey, 3L l_suppkey, n l_linenumber, 4.0D l_quantity, 5.0D l_extendedprice, 0.1D l_discount,"
              " 0.2D l_tax, 'R' l_returnflag, 'O' l_linestatus, timestamp'2020-02-01' l_shipdate"
              " from values (1L, 1), (1L, 2), (1L, 2), (null, 3), (5L, 1) t(k, n)").write.parquet(f"{tmp_path}/lineitem.parquet")
    pq.write_table(pa.table({"event_id": pa.array([1]), "user_id": pa.array([7]), "event_type": ["view"], "ts": pa.array([0], pa.timestamp("us")),
                             "value": [2.0], "props": ["{}"]}), tmp_path / "events.parquet")
    pq.write_table(pa.table({"conv_id": pa.array([7]), "turn": pa.array([0]), "role": ["user"], "text": ["a"]}), tmp_path / "conversations.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_checks_join_claim_lines_once(spark, claims_dir, threshold):
    before = spark.conf.get(BROADCAST)
    plain = sorted(map(repr, posing.medical_claims(spark, claims_dir).collect()))
    spark.conf.set(BROADCAST, threshold)
    try:
        lines = posing.order_lines(spark, claims_dir)
        assert sorted(map(repr, posing.medical_claims(spark, claims_dir, lines).collect())) == plain and len(plain) == 6
        read = " ".join(entry._gold(spark, claims_dir)["visit_occurrence"].inputFiles())
        assert ("/order-lines-" in read) == (threshold == "-1") == ("lineitem.parquet" not in read)
        s = entry.Silver(spark, claims_dir, stage=True)
        files = [{f for f in df.inputFiles() if "order-lines" in f} for df in (s.lines, s.procedure, s.diagnosis)]
        assert files[0] == files[1] == files[2] and bool(files[0]) == (threshold == "-1")
        assert s.claim.count() == entry.Silver(spark, claims_dir).claim.count() == 4
    finally:
        spark.conf.set(BROADCAST, before)
