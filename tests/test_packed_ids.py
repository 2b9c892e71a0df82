"""Ids are moved as bytes where rows are brought close together, and come back as they were."""

from caremart.functions.ids import packed_ids, unpacked_ids
from caremart.sources.tables import clustered

HEX = "0123456789abcdef" * 4


def _rows(spark):
    values = [HEX, HEX.upper(), HEX[1:], HEX + "0", "", None, "a,b", " " + HEX[1:], HEX + "\n"]
    return spark.createDataFrame([(v, "p", 1, v) for v in values], "x_id string, person_id string, n_id int, other string")


def test_ids_come_back_as_they_were(spark, both_modes):
    df = _rows(spark)
    packed = packed_ids(df, "x_id")
    assert packed.schema["_packed_x_id"].dataType.simpleString() == "binary"
    assert {len(r["_packed_x_id"]) for r in packed.collect() if r["_packed_x_id"] is not None} == {32}
    for back in (unpacked_ids(packed, "x_id"), clustered(df, ["person_id"])):
        assert back.columns == df.columns and back.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_a_layout_moves_no_id_as_text(spark):
    plan = clustered(_rows(spark).filter("x_id is not null"), ["person_id"])._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RebalancePartitions"):]
    assert "_packed_x_id" in below and "_packed_person_id" not in below and "_packed_other" not in below
