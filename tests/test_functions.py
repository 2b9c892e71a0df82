import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caremart.functions import (
    CAST_RULES,
    apply_contract,
    cda_timestamp,
    claim_visit_key,
    conform,
    document_visit_key,
    hash_id,
    month_day_year,
    provider_key,
)
from caremart.schemas import LAYERS, MEDICAL_CONTRACT, PHARMACY_CONTRACT, ddl


def sha(*parts):
    return hashlib.sha256("||".join(parts).encode()).hexdigest()


def single(df):
    return [r[0] for r in df.collect()]


def test_table_widths():
    widths = {t: len(s.fields) for layer in LAYERS.values() for t, s in layer.items()}
    assert widths == {
        "ccda_docs": 8, "medical_claims": 175, "rx_claims": 73, "ccda_docs_patient": 35,
        "ccda_docs_medication": 19, "ccda_docs_problem": 17, "medical_claims_claim": 115,
        "medical_claims_diagnosis": 11, "medical_claims_procedure": 12,
        "prescription_claim": 72, "person": 18, "provider": 13, "condition_occurrence": 16,
        "drug_exposure": 23, "procedure_occurrence": 16, "visit_occurrence": 17, "cost": 22,
    }


def test_hash_id_text_forms(spark, both_modes):
    df = spark.sql(
        "select 1 as a, cast(null as string) as b, date'2020-01-02' as c, 12.5D as d, '' as e,"
        " cast(0.1 as float) as f"
    )
    got = single(df.select(hash_id("a", "b", "c", "d", "e", None, "f")))
    assert got == [sha("1", "", "2020-01-02", "12.5", "", "", "0.1")]


def test_provider_key_has_ten_slots(spark):
    df = spark.sql("select 'p' as id, 'F' as f, 'L' as l")
    got = single(df.select(provider_key("id", "f", "l")))
    assert got == [sha("p", "F", "L", *[""] * 7)]


def test_visit_keys(spark, both_modes):
    df = spark.sql(
        "select 'm' as medical_claim_id, 'p' as MemberID, 11 as POS, date'2020-01-01' as FromDate,"
        " date'2020-01-05' as ToDate, cast(null as date) as AdmitDate, date'2020-01-04' as"
        " DischDate, 'x' as ProviderID, 'c' as ClaimID, 'a' as AdmitSource, 3 as DischargeStatus"
    )
    provider = sha("x", *[""] * 9)
    want = sha("m", "p", "11", "2020-01-01", "2020-01-04", "CLAIMS", provider, "", "c", "", "",
               "a", "", "3", "")
    assert single(df.select(claim_visit_key())) == [want]
    assert single(df.select(document_visit_key(person_id="MemberID"))) == [sha("p", *[""] * 13)]
    with pytest.raises(ValueError):
        document_visit_key(person="MemberID")


DATES = {
    "1/2/2020": date(2020, 1, 2),
    "01/02/2020": date(2020, 1, 2),
    " 1/2/2020 ": date(2020, 1, 2),
    "12/31/1999": date(1999, 12, 31),
    "1/2/2020/9": date(2020, 1, 2),
    "1/2/20": date(20, 1, 2),
    "2/29/2020": date(2020, 2, 29),
    "2/30/2020": None,
    "13/40/2020": None,
    "0/1/2020": None,
    "1/0/2020": None,
    "2020-01-02": None,
    "1/2/2020 0:00": None,
    "1/2": None,
    "": None,
    "abc": None,
    None: None,
}


def test_month_day_year(spark, both_modes):
    df = spark.createDataFrame([(t,) for t in DATES], "t string")
    got = {r.t: r.d for r in df.select("t", month_day_year("t").alias("d")).collect()}
    assert got == DATES


TIMES = {
    "20200102": datetime(2020, 1, 2),
    "20200102030405": datetime(2020, 1, 2, 3, 4, 5),
    "2020": None,
    "202001020304": None,
    "20200102030405+0000": None,
    "20201340": None,
    "20200102036105": None,
    "2020-1-2": None,
    "": None,
    None: None,
}


def test_cda_timestamp(spark, both_modes):
    df = spark.createDataFrame([(t,) for t in TIMES], "t string")
    got = {r.t: r.d for r in df.select("t", cda_timestamp("t").alias("d")).collect()}
    assert got == TIMES


@pytest.mark.parametrize(
    "rule,cases",
    [
        ("int", {"0450": 450, " 7 ": 7, "+3": 3, "-3": -3, "1.0": None, "1e3": None, "": None,
                 "x1": None, "99999999999": None, None: None}),
        ("money", {"1.005": 1.01, "2.5": 2.5, "abc": None, "": None, " 3 ": 3.0, ".5": 0.5,
                   "1e3": 1000.0, "-1.239": -1.24, "N/A": None, None: None}),
        ("double", {"1.005": 1.005, "x": None, "12a": None, "Infinity": float("inf")}),
        ("float", {"0.5": 0.5, "": None}),
        ("string", {"": "", None: None}),
    ],
)
def test_cast_rules(spark, both_modes, rule, cases):
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r.t: r.v for r in df.select("t", CAST_RULES[rule](F.col("t")).alias("v")).collect()}
    assert got == cases


@pytest.mark.parametrize("kind", ["int", "double"])
def test_guard_passes_all_that_the_cast_takes(spark, kind):
    texts = ["1", "+1", "-1", " 1", "1 ", "\t1\n", "1.", ".1", "-.1", "1e5", "1E-5", "1d", "1f",
             "nan", "NaN", "inf", "-Infinity", "+INF", "0x1p3", "--1", "1 2", "e1", "١"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(
        "t",
        F.col("t").try_cast(kind).cast("string").alias("want"),
        CAST_RULES[kind](F.col("t")).cast("string").alias("got"),
    ).collect()
    assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows]


def test_contracts_differ_per_feed():
    medical, pharmacy = dict(MEDICAL_CONTRACT), dict(PHARMACY_CONTRACT)
    for name in ("UserDefNum3", "MR_Units_Days_PatientPay", "MR_Procs_PatientPay"):
        assert medical[name] != pharmacy[name]


def test_contract_fills_missing_columns(spark):
    df = spark.sql("select '7' as a")
    out = df.select(*apply_contract([("a", "int"), ("b", "mdy")], df.columns).values())
    assert out.dtypes == [("a", "int"), ("b", "date")]
    assert out.collect() == [(7, None)]


def test_conform(spark, both_modes):
    df = spark.sql("select 'x' as extra, '12' as n, date'2020-01-02' as t, 'bad' as f")
    out = conform(df, ddl("t timestamp, n int, missing string, f float"))
    assert out.columns == ["t", "n", "missing", "f"]
    assert out.collect() == [(datetime(2020, 1, 2), 12, None, None)]
