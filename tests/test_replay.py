"""Rows set aside that move once the contract has grown."""

import pytest

from caremart.plans.replay import ASIDE, CLEAN, REPLAYED, RescuedRows, replay_rescued
from caremart.schemas import ddl
from caremart.sources.delimited import RESCUED

LANDED, GROWN = ddl("a string, b string"), ddl("a string, b string, n int, xy string")


def test_what_moves(spark):
    rows = spark.createDataFrame([
        ("1", None, '{"n":"7"}'), ("2", "b", '{"xy":"t","n":"8"}'), ("3", None, '{"n":"seven"}'),
        ("4", None, '{"b":"second"}'), ("5", None, '{"n":"1","other":"o"}'), ("6", None, "no json"), ("7", None, "{}"),
        ("8", None, '{"_corrupt_record":"1,2,3,4"}'),
    ], f"a string, b string, {RESCUED} string")
    moved, still = replay_rescued(rows, LANDED, GROWN)
    assert {(r.a, r.b, r.n, r.xy, r[RESCUED]) for r in moved.collect()} == {
        ("1", None, 7, None, None), ("2", "b", 8, "t", None)}
    assert sorted(r.a for r in still.collect()) == list("345678")
    assert still.columns == rows.columns


@pytest.fixture
def bronze(spark, tmp_path):
    def land(batch, rows):
        frame = spark.createDataFrame(rows, f"a string, b string, {RESCUED} string")
        frame.write.parquet(f"{tmp_path}/bronze/ingest_run=r/batch_id={batch}")
        return f"{tmp_path}/bronze"
    return land


def test_rows_move_exactly_once(spark, bronze, tmp_path, monkeypatch):
    target = bronze(0, [("1", "b", None), ("2", "b", '{"n":"7"}'), ("3", "b", '{"z":"7"}')])
    bronze(1, [("4", "b", '{"n":"9"}')])
    assert RescuedRows(spark, f"{tmp_path}/rows", LANDED).land(target) == 2
    rows = RescuedRows(spark, f"{tmp_path}/rows", LANDED, GROWN)
    assert rows.land(target) == 0
    # A run that dies before its manifest has moved nothing.
    with monkeypatch.context() as patch:
        def dies(*args, **kwargs):
            raise RuntimeError("lost")
        patch.setattr(rows.table, "swap", dies)
        with pytest.raises(RuntimeError):
            rows.replay()
    assert [r.a for r in rows.read().collect()] == ["1"]
    assert (rows.replay(), rows.replay()) == (2, 0)
    assert sorted((r.a, r.n) for r in rows.read().collect() if r.n) == [("2", 7), ("4", 9)]
    assert [r.a for r in rows.read(ASIDE).collect()] == ["3"]
    # A later batch with the same column moves beside the earlier rows.
    bronze(2, [("5", "b", '{"n":"1"}'), ("6", None, None)])
    assert rows.land(target) == 1 and rows.replay() == 1
    assert sorted(r.a for r in rows.read(REPLAYED).collect()) == ["2", "4", "5"]
    assert sorted(r.a for r in rows.read(CLEAN).collect()) == ["1", "6"]
    # The contract grows again.
    more = RescuedRows(spark, f"{tmp_path}/rows", LANDED, ddl("a string, b string, n int, xy string, z string"))
    assert more.replay() == 1 and more.read(ASIDE).count() == 0
    assert sorted((r.a, r.z) for r in more.read().collect() if r.z) == [("3", "7")]
