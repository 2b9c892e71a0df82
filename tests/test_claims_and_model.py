from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caremart import schemas
from caremart.functions import conform
from caremart.operators import claims, omop, review


def raw(spark, schema, *rows):
    fields = sorted({k for r in rows for k in r})
    layout = ", ".join(f"`{f}` string" for f in fields)
    df = spark.createDataFrame([tuple(r.get(f) for f in fields) for r in rows], layout)
    return conform(df, schema)


LINE = {
    "ClaimID": "c1", "LineNum": "1", "MemberID": "m1", "ProviderID": "dr", "FromDate": "1/2/2020",
    "ToDate": "1/3/2020", "POS": "11", "Billed": "10.129", "Paid": "4", "COB": "0", "Copay": "1",
    "Coinsurance": "0", "Deductible": "0", "PatientPay": "1", "Allowed": "6", "Units": "0.1",
    "ICDProc1": "P1", "ICDProc3": "P3", "ICDDiag2": "D2", "ICDDiag30": "D30",
}


@pytest.fixture
def medical(spark):
    return raw(
        spark,
        schemas.MEDICAL_CSV,
        LINE,
        LINE,
        {**LINE, "ICDDiag2": "other"},
        {**LINE, "LineNum": "2", "AdmitDate": "13/40/2020", "AdmitDiag": "A", "Days": "3",
         "Modifier2": "m2", "COB": None},
        {**{k: v for k, v in LINE.items() if not k.startswith("ICD")}, "LineNum": "3",
         "ProviderID": None},
    )


def test_claim_lines(medical, both_modes):
    lines = claims.claim_lines(claims.typed_lines(medical))
    assert lines.schema.fieldNames() == schemas.SILVER_CLAIM.fieldNames()
    assert [f.dataType for f in lines.schema] == [f.dataType for f in schemas.SILVER_CLAIM]
    rows = lines.orderBy("LineNum").collect()
    # The copy is gone; the line that differs in a diagnosis stays, twice.
    assert [r.LineNum for r in rows] == [1, 1, 2, 3]
    assert rows[0] == rows[1] and rows[0].Billed == 10.13
    assert [r.Inpatient_flag for r in rows] == [0, 0, 1, 0]
    assert rows[2].AdmitDate is None and rows[0].FromDate == date(2020, 1, 2)


def test_procedures(medical, both_modes):
    px = claims.claim_procedures(claims.typed_lines(medical))
    assert px.schema.fieldNames() == schemas.SILVER_PROCEDURE.fieldNames()
    got = sorted((r.Procedure_Num, r.Procedure_Code, round(r.quantity, 3), r.modifier_concept_id or "")
                 for r in px.collect())
    assert got == [(1, "P1", 0.1, ""), (1, "P1", 3.0, "m2"), (3, "P3", 0.1, ""), (3, "P3", 3.0, "m2")]
    assert px.select("procedure_occurrence_id").distinct().count() == 4


def test_diagnoses(medical, both_modes):
    dx = claims.claim_diagnoses(claims.typed_lines(medical))
    assert dx.schema.fieldNames() == schemas.SILVER_DIAGNOSIS.fieldNames()
    got = sorted((r.Diagnosis_Num, r.Diagnosis_Type, r.Diagnosis_Code) for r in dx.collect())
    assert got == [
        (0, "Primary", "A"), (2, "Secondary", "D2"), (2, "Secondary", "D2"),
        (2, "Secondary", "other"), (30, "Secondary", "D30"), (30, "Secondary", "D30")]


def test_wide_to_long_agrees_with_posexplode(medical):
    columns = claims.numbered_columns(medical, "ICDDiag")
    assert columns == schemas.DIAGNOSIS_COLUMNS
    ours = claims.wide_to_long(medical, columns, ["LineNum"], "n", "code")
    plain = medical.select("LineNum", F.posexplode(F.array(*columns)).alias("n", "code"))
    plain = plain.filter(F.col("code").isNotNull()).withColumn("n", F.col("n") + 1)
    assert sorted(ours.collect()) == sorted(plain.collect())


@pytest.fixture
def rx(spark):
    line = {"SequenceNumber": "1", "ClaimID": "r1", "MemberID": "m1", "FromDate": "2/1/2020",
            "NDC": "n", "ProviderID": "dr", "Billed": "5", "Paid": "1", "COB": "0", "Copay": "0",
            "Coinsurance": "0", "Deductible": "0", "PatientPay": "2", "UserDefNum3": "7",
            "QuantityDispensed": "30.5", "MR_Scripts_30Day": "1"}
    df = raw(spark, schemas.PHARMACY_CSV, line, line, {**line, "Billed": "6"})
    return claims.prescription_claims(df)


def test_prescriptions_share_an_id(rx, both_modes):
    rows = rx.collect()
    assert rx.schema.fieldNames() == schemas.SILVER_PRESCRIPTION.fieldNames()
    assert len(rows) == 2 and len({r.prescription_claim_id for r in rows}) == 1
    assert rows[0].UserDefNum3 == 7 and rows[0].FromDate == date(2020, 2, 1)


def patient_rows(spark, *rows):
    layout = schemas.SILVER_PATIENT
    return spark.createDataFrame([tuple(r.get(f) for f in layout.fieldNames()) for r in rows], layout)


@pytest.fixture
def patient(spark):
    one = {"patient_id": "m1", "document_id": "d1", "birth_date": datetime(1960, 1, 2),
           "gender": "F", "race": "b", "provider_lname": "Q", "effective_time": datetime(2020, 5, 6, 7),
           "provider_zip_code": 123}
    return patient_rows(
        spark, one,
        {**one, "document_id": "d2", "birth_date": datetime(1961, 1, 2), "race": "a",
         "provider_lname": "R"},
        {**one, "document_id": "d3", "birth_date": None, "gender": None},
        {"patient_id": "m2", "document_id": "d4"},
    )


def test_person_consensus(patient, both_modes):
    people = {r.person_id: r for r in omop.omop_person(patient).collect()}
    one, two = people["m1"], people["m2"]
    assert (one.year_of_birth, one.month_of_birth, one.day_of_birth) == (None, 1, 2)
    assert one.birth_datetime is None
    assert (one.gender_source_value, one.race_source_value) == ("F", "a,b")
    assert one.ethnicity_source_value is None
    listed = one.provider_id.split(",")
    assert len(listed) == 2 and listed == sorted(listed)
    assert two.gender_source_value is None and len(two.provider_id) == 64


def gold(spark, medical, rx, patient):
    claim = claims.claim_lines(claims.typed_lines(medical))
    problem = spark.createDataFrame([], schemas.SILVER_PROBLEM)
    medication = spark.createDataFrame([], schemas.SILVER_MEDICATION)
    px = claims.claim_procedures(claims.typed_lines(medical))
    dx = claims.claim_diagnoses(claims.typed_lines(medical))
    return {
        "person": omop.omop_person(patient),
        "visit_occurrence": omop.omop_visit(claim, patient),
        "cost": omop.omop_cost(claim, rx),
        "drug_exposure": omop.omop_drug_exposure(medication, rx),
        "condition_occurrence": omop.omop_condition(problem, dx),
        "procedure_occurrence": omop.omop_procedure(px),
        "provider": omop.omop_provider(patient, medication, problem, claim, dx, px, rx),
    }


def test_gold_schemas(spark, medical, rx, patient, both_modes):
    for table, df in gold(spark, medical, rx, patient).items():
        want = schemas.LAYERS["gold"][table]
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in want]
        df.collect()


def test_every_cost_finds_its_event(spark, medical, rx, patient, both_modes):
    g = gold(spark, medical, rx, patient)
    cost = g["cost"].collect()
    visits = {r.visit_occurrence_id for r in g["visit_occurrence"].collect()}
    drugs = {r.drug_exposure_id for r in g["drug_exposure"].collect()}
    assert {c.cost_event_id for c in cost if c.cost_domain_id == "visit"} <= visits
    assert {c.cost_event_id for c in cost if c.cost_domain_id == "drug"} <= drugs
    # Three claim visits, and two rows of one prescription with other charges.
    assert sorted(c.cost_domain_id for c in cost) == ["drug"] * 2 + ["visit"] * 3
    totals = sorted((c.total_paid is None, c.total_paid or 0) for c in cost if c.cost_domain_id == "visit")
    assert totals == [(False, 6.0), (False, 6.0), (True, 0)]


def test_null_and_blank_slots_cost_once(spark, rx):
    lines = claims.typed_lines(raw(spark, schemas.MEDICAL_CSV, LINE)).drop("MemberID", "ClaimID", "AdmitSource")
    pairs = spark.createDataFrame(
        [(m, c, a) for m in ("", None) for c in ("", None) for a in ("", None)],
        "MemberID string, ClaimID string, AdmitSource string")
    claim = lines.crossJoin(pairs).select(*claims.typed_lines(raw(spark, schemas.MEDICAL_CSV, LINE)).columns)
    cost = omop.omop_cost(claim, rx.limit(0)).collect()
    assert len(cost) == 1
    # The visit table shows the columns, so it tells NULL from blank.
    no_documents = spark.createDataFrame([], schemas.SILVER_PATIENT)
    visits = omop.omop_visit(claim, no_documents).collect()
    assert len(visits) == 8 and {v.visit_occurrence_id for v in visits} == {cost[0].cost_event_id}


def test_visits(spark, medical, rx, patient):
    rows = gold(spark, medical, rx, patient)["visit_occurrence"].collect()
    kinds = sorted(r.visit_type_concept_id for r in rows)
    assert kinds == ["CCDA"] * 4 + ["CLAIMS"] * 3
    document = next(r for r in rows if r.visit_source_value == "d1")
    assert document.visit_start_date == document.visit_end_date == date(2020, 5, 6)
    assert document.visit_start_datetime == datetime(2020, 5, 6, 7)


def test_providers(spark, medical, rx, patient):
    rows = gold(spark, medical, rx, patient)["provider"].collect()
    # Claims name "dr" and nobody, documents two providers and nobody; nobody
    # is one identity whoever names it.
    assert sorted((r.npi or "", r.provider_name or "") for r in rows) == [
        ("", ""), ("", "Q"), ("", "R"), ("dr", "")]


def test_review(spark, medical, rx, patient):
    g = gold(spark, medical, rx, patient)
    many = spark.createDataFrame([("m1",), ("m1",), ("nobody",)], "person_id string")
    tables = {
        review.review_person: "person", review.review_visits: "visit_occurrence",
        review.review_conditions: "condition_occurrence",
        review.review_procedures: "procedure_occurrence", review.review_drugs: "drug_exposure",
    }
    for function, table in tables.items():
        one = sorted(map(repr, function(g[table], "m1").collect()))
        assert one and one == sorted(map(repr, function(g[table], many).collect()))
        assert function(g[table], "it's").count() == 0
    providers = review.review_providers(g["person"], g["provider"], "m1").collect()
    assert sorted(r.provider_name for r in providers) == ["Q", "R"]
    of_many = review.review_providers(g["person"], g["provider"], many)
    assert of_many.columns[-1] == "person_id" and of_many.count() == 2
    costs = [g["cost"], g["visit_occurrence"], g["drug_exposure"]]
    assert review.review_costs(*costs, "m1").count() == 5
    assert review.review_costs(*costs, many).count() == 5


def test_lookup_filter_reaches_the_scan(spark, tmp_path, medical, patient):
    path = str(tmp_path / "visits")
    claim = claims.claim_lines(claims.typed_lines(medical))
    omop.omop_visit(claim, patient).write.parquet(path)
    plan = review.review_visits(spark.read.parquet(path), "m1")._jdf.queryExecution().toString()
    assert "EqualTo(person_id,m1)" in plan
