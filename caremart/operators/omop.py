"""The seven common data model tables.

Branches of a union are deduplicated on the few columns that determine the
output row, before ids are hashed and constants added: the shuffle carries
short raw values rather than 64-character ids, and each id is computed once.
Where a constant tells the branches apart, the union needs no second distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart import schemas
from caremart.functions.casts import conform
from caremart.functions.dates import midnight
from caremart.functions.ids import (
    claim_provider_key,
    claim_visit_key,
    document_provider_key,
    document_visit_key,
    entry_provider_key,
    hash_id,
    id_text,
    packed_ids,
    unpacked_ids,
)
from caremart.functions.rows import distinct_near
from caremart.operators.claims import claim_id, claim_key

CLAIMS = "CLAIMS"
DOCUMENTS = "CCDA"
# Concept labels given to coded claim data.
DIAGNOSIS_SYSTEM = "2.16.840.1.113883.6.90"
PROCEDURE_SYSTEM = "ICD-10-PCS"
DRUG_SYSTEM = "NDC"

_HEADER_PROVIDER = [
    "provider_fname",
    "provider_lname",
    "provider_org",
    "provider_phone",
    "provider_address",
    "provider_city",
    "provider_state",
    "provider_zip_code",
    "provider_country",
]


def _blank_to_text(*names: str) -> list[Column]:
    """Slots that only feed an id, in the form in which the id sees them."""
    return [F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in names]


def _consensus(value: Column) -> Column:
    """The value all rows agree on, else NULL. Needs no distinct count."""
    return F.when(F.min(value) == F.max(value), F.min(value))


def _value_list(field: str) -> Column:
    """The values of a field as one sorted, comma-separated text; none is NULL."""
    values = F.collect_list(F.when(F.col("field") == field, F.col("value")))
    return F.nullif(F.array_join(F.sort_array(values), ","), F.lit(""))


def omop_person(patient: DataFrame) -> DataFrame:
    """One row per patient over all its documents.

    Documents of a patient mostly repeat the same header. Each field's values
    are made distinct first, on the map side and spread over person, field and
    value, so what is put together per patient is as long as its lists and not
    as its documents are many.
    """
    birth = F.col("birth_date")
    lists = {"provider": document_provider_key(), "gender": F.col("gender"), "race": F.col("race"),
             "ethnicity": F.col("ethnicity")}
    # The first row stands for the patient, with or without any value.
    rows = [F.struct(F.lit("birth").alias("field"), F.lit(None).cast("string").alias("value"), birth.alias("birth"))]
    rows += [
        F.struct(F.lit(field).alias("field"), value.alias("value"), F.lit(None).cast(patient.schema["birth_date"].dataType).alias("birth"))
        for field, value in lists.items()
    ]
    headers = patient.select("patient_id", "birth_date", "gender", "race", "ethnicity", *_blank_to_text(*_HEADER_PROVIDER))
    values = headers.select("patient_id", F.inline(F.array(*rows)))
    values = values.filter((F.col("field") == "birth") | F.col("value").isNotNull()).distinct()
    birth = F.col("birth")
    people = values.groupBy(F.col("patient_id").alias("person_id")).agg(
        _consensus(F.year(birth)).alias("year_of_birth"),
        _consensus(F.month(birth)).alias("month_of_birth"),
        _consensus(F.day(birth)).alias("day_of_birth"),
        _consensus(birth).alias("birth_datetime"),
        _value_list("provider").alias("provider_id"),
        _value_list("gender").alias("gender_source_value"),
        _value_list("race").alias("race_source_value"),
        _value_list("ethnicity").alias("ethnicity_source_value"),
    )
    return conform(people, schemas.PERSON)


def omop_drug_exposure(medication: DataFrame, rx: DataFrame) -> DataFrame:
    """Medications of documents and dispensed prescriptions."""
    from_documents = medication.select(
        F.col("medication_id").alias("drug_exposure_id"),
        F.col("patient_id").alias("person_id"),
        "drug_concept_id",
        F.to_date("drug_exposure_start_date").alias("drug_exposure_start_date"),
        F.col("drug_exposure_start_date").alias("drug_exposure_start_datetime"),
        F.to_date("drug_exposure_end_date").alias("drug_exposure_end_date"),
        F.col("drug_exposure_end_date").alias("drug_exposure_end_datetime"),
        F.col("drug_supply_refill").try_cast("int").alias("refills"),
        F.col("drug_supply_quantity").cast("double").alias("quantity"),
        "route_concept_id",
        entry_provider_key().alias("provider_id"),
        "drug_source_value",
        "drug_source_concept_id",
        "route_source_value",
        "dose_unit_source_value",
    )
    dispensed = rx.select(
        F.col("prescription_claim_id").alias("drug_exposure_id"),
        F.col("MemberID").alias("person_id"),
        F.lit(DRUG_SYSTEM).alias("drug_concept_id"),
        F.col("FromDate").alias("drug_exposure_start_date"),
        midnight("FromDate").alias("drug_exposure_start_datetime"),
        F.col("MR_Scripts_30Day").alias("refills"),
        F.col("QuantityDispensed").alias("quantity"),
        F.col("DaysSupply").alias("days_supply"),
        claim_provider_key().alias("provider_id"),
        F.col("NDC").alias("drug_source_value"),
        F.lit(DRUG_SYSTEM).alias("drug_source_concept_id"),
    )
    # No constant separates the branches, so the distinct covers the union.
    schema = schemas.DRUG_EXPOSURE
    return conform(from_documents, schema).unionByName(conform(dispensed, schema)).distinct()


def omop_condition(problem: DataFrame, diagnosis: DataFrame, as_seen: bool = False) -> DataFrame:
    """Problems of documents and diagnoses of claims.

    The type constant tells the branches apart, so each is made distinct by
    itself, on raw values and before provider ids are hashed: what only feeds
    an id is taken in the form in which the id sees it. Diagnoses made
    ``as_seen`` are distinct in that form already.
    """
    problem = problem.select(
        "problem_id", "patient_id", "condition_concept_id", "condition_start_date", "condition_end_date",
        "condition_type_concept_id", "condition_source_value", "condition_source_concept_id", "problem_status",
        *_blank_to_text("provider_id", "provider_fname", "provider_lname"),
    ).distinct()
    diagnosis = diagnosis.select(
        "condition_occurrence_id", "MemberID", "condition_start_date", "condition_end_date", "Diagnosis_Code",
        "Diagnosis_Type", *_blank_to_text("ProviderID"),
    )
    if not as_seen:
        diagnosis = unpacked_ids(packed_ids(diagnosis, "condition_occurrence_id").distinct(), "condition_occurrence_id")
    from_documents = problem.select(
        F.col("problem_id").alias("condition_occurrence_id"),
        F.col("patient_id").alias("person_id"),
        "condition_concept_id",
        F.to_date("condition_start_date").alias("condition_start_date"),
        F.col("condition_start_date").alias("condition_start_datetime"),
        F.to_date("condition_end_date").alias("condition_end_date"),
        F.col("condition_end_date").alias("condition_end_datetime"),
        "condition_type_concept_id",
        entry_provider_key().alias("provider_id"),
        "condition_source_value",
        "condition_source_concept_id",
        F.col("problem_status").alias("condition_status_source_value"),
    )
    from_claims = diagnosis.select(
        "condition_occurrence_id",
        F.col("MemberID").alias("person_id"),
        F.lit(DIAGNOSIS_SYSTEM).alias("condition_concept_id"),
        "condition_start_date",
        midnight("condition_start_date").alias("condition_start_datetime"),
        "condition_end_date",
        midnight("condition_end_date").alias("condition_end_datetime"),
        F.lit(CLAIMS).alias("condition_type_concept_id"),
        claim_provider_key().alias("provider_id"),
        F.col("Diagnosis_Code").alias("condition_source_value"),
        F.col("Diagnosis_Type").alias("condition_status_source_value"),
    )
    schema = schemas.CONDITION_OCCURRENCE
    return conform(from_documents, schema).unionByName(conform(from_claims, schema))


def omop_provider(
    patient: DataFrame,
    medication: DataFrame,
    problem: DataFrame,
    claim: DataFrame,
    diagnosis: DataFrame,
    procedure: DataFrame,
    rx: DataFrame,
) -> DataFrame:
    """Every provider identity named by the seven silver tables.

    Each kind of source is reduced to distinct raw identities before hashing:
    a handful of rows per provider instead of one per claim line. NULL and
    empty identities stay apart, so an id may repeat; the key check shows it.
    """
    identity = ["provider_id_source", *_HEADER_PROVIDER]

    def slots(df: DataFrame, **named: str) -> DataFrame:
        return df.select(
            *[
                (F.col(named[s]) if s in named else F.lit(None)).cast("string").alias(s)
                for s in identity
            ]
        )

    # Distinct per table before the union: the partial aggregates then work on
    # one narrow column of each claim table.
    headers = slots(patient, **{s: s for s in _HEADER_PROVIDER})
    authors = [
        slots(
            df,
            provider_id_source="provider_id",
            provider_fname="provider_fname",
            provider_lname="provider_lname",
        )
        for df in (medication, problem)
    ]
    claims = [
        slots(df, provider_id_source="ProviderID") for df in (claim, diagnosis, procedure, rx)
    ]
    found = headers
    for branch in [*authors, *claims]:
        found = found.unionByName(branch)
    # The header branch leaves the id slot empty in its id, and its source is
    # NULL, so one key expression serves all branches.
    rows = found.distinct()
    names = F.concat_ws(", ", "provider_lname", "provider_fname")
    provider = rows.select(
        hash_id(*identity).alias("provider_id"),
        F.when(F.col("provider_lname").isNotNull(), names).alias("provider_name"),
        F.col("provider_id_source").alias("npi"),
    )
    return conform(provider, schemas.PROVIDER)


def omop_procedure(procedure: DataFrame) -> DataFrame:
    """Procedure occurrences; a projection, one row per silver procedure."""
    rows = procedure.select(
        "procedure_occurrence_id",
        F.col("MemberID").alias("person_id"),
        F.lit(PROCEDURE_SYSTEM).alias("procedure_concept_id"),
        "procedure_start_date",
        midnight("procedure_start_date").alias("procedure_start_datetime"),
        "procedure_end_date",
        midnight("procedure_end_date").alias("procedure_end_datetime"),
        F.lit(CLAIMS).alias("procedure_type_concept_id"),
        "modifier_concept_id",
        F.col("quantity").try_cast("int").alias("quantity"),
        claim_provider_key().alias("provider_id"),
        F.col("Procedure_Code").alias("procedure_source_value"),
        F.lit(PROCEDURE_SYSTEM).alias("procedure_source_concept_id"),
    )
    return conform(rows, schemas.PROCEDURE_OCCURRENCE)


_PAID_PARTS = ["Paid", "COB", "Copay", "Coinsurance", "Deductible", "PatientPay"]


def _cost_columns(domain: str) -> dict[str, Column]:
    total = F.col(_PAID_PARTS[0])
    for part in _PAID_PARTS[1:]:
        total = total + F.col(part)
    return {
        "cost_domain_id": F.lit(domain),
        "cost_type_concept_id": F.lit(CLAIMS),
        "currency_concept_id": F.lit("USD"),
        "total_charge": F.col("Billed"),
        "total_cost": F.lit(None).cast("double"),
        # NULL as soon as one part is; the parts may count a share twice.
        "total_paid": total,
        "paid_by_payer": F.col("Paid"),
        "paid_by_patient": F.col("PatientPay"),
        "paid_patient_copay": F.col("Copay"),
        "paid_patient_coinsurance": F.col("Coinsurance"),
        "paid_patient_deductible": F.col("Deductible"),
        "paid_by_primary": F.col("Paid"),
        "amount_allowed": F.col("Allowed"),
    }


_COST_ID = [
    "cost_event_id",
    "cost_domain_id",
    "cost_type_concept_id",
    "currency_concept_id",
    "total_charge",
    "total_cost",
    "total_paid",
]

_VISIT_INPUT = ["medical_claim_id", "MemberID", "POS", "ClaimID", "AdmitSource", "DischargeStatus"]


def _visit_lines(claim: DataFrame, *extra: str, id_only: bool = False) -> DataFrame:
    """Distinct claim lines as far as a visit id and ``extra`` can tell them.

    With ``id_only`` no column but those in ``extra`` is shown elsewhere, so
    all the others are taken in the form in which the id sees them: lines that
    differ in NULL against empty text have one id and are one row.
    """
    texts = _VISIT_INPUT[1:]
    slots = _blank_to_text(*texts) if id_only else [F.col(c) for c in texts]
    key = claim_key(claim)
    lines = claim.select(
        key,
        *slots,
        *_blank_to_text("ProviderID"),
        F.coalesce("AdmitDate", "FromDate").alias("AdmitDate"),
        F.coalesce("DischDate", "ToDate").alias("DischDate"),
        *extra,
    )
    rows = distinct_near(lines, key)
    none = F.lit(None).cast("date")
    return rows.select(claim_id(rows), *rows.columns[1:], none.alias("FromDate"), none.alias("ToDate"))


def cost_of_visits(claim: DataFrame, *more: str) -> DataFrame:
    """Cost rows of claim visits; ``more`` may name the episode's ``AdmitDate`` and ``DischDate``."""
    lines = _visit_lines(claim, "Billed", "Allowed", *_PAID_PARTS, id_only=True)
    rows = lines.select(
        "medical_claim_id",
        claim_visit_key().alias("cost_event_id"),
        *[c.alias(n) for n, c in _cost_columns("visit").items()],
        *more,
    )
    return rows.withColumn("cost_id", hash_id("medical_claim_id", *_COST_ID))


def visit_costs(claim: DataFrame) -> DataFrame:
    """Claim visits and the costs that refer to them, a row per pair.

    The rows of ``omop_visit`` and ``omop_cost`` joined on the visit's id, but
    on the text that the id is made of: both sides are made distinct where
    they then meet, so neither is shuffled a second time with its ids.
    """
    texts = _VISIT_INPUT[1:]
    visit = id_text(
        claim_key(claim), *texts, "ProviderID", F.coalesce("AdmitDate", "FromDate"), F.coalesce("DischDate", "ToDate")
    ).alias("_visit")
    # The text does not tell NULL from empty; the visit table does.
    lacks = [F.col(c).isNull().alias(f"_no_{c}") for c in texts if c != "MemberID"]
    visits = distinct_near(claim.select(visit, F.col("MemberID").alias("person_id"), *lacks), "_visit")
    costs = distinct_near(claim.select(visit, "Billed", "Allowed", *_PAID_PARTS), "_visit")
    costs = costs.select("_visit", *[c.alias(n) for n, c in _cost_columns("visit").items()])
    return visits.drop(*[f"_no_{c}" for c in texts]).join(costs, "_visit").drop("_visit")


def cost_of_drugs(rx: DataFrame, *more: str) -> DataFrame:
    """Cost rows of dispensed drugs; ``more`` are columns that the claim's id determines."""
    money = ["Billed", "Allowed", "IngredientCost", "DispensingFee", *_PAID_PARTS]
    rows = rx.select("prescription_claim_id", *money, *more).distinct().select(
        F.col("prescription_claim_id").alias("cost_event_id"),
        *[c.alias(n) for n, c in _cost_columns("drug").items()],
        F.col("IngredientCost").alias("paid_ingredient_cost"),
        F.col("DispensingFee").alias("paid_dispensing_fee"),
        *more,
    )
    return rows.withColumn("cost_id", hash_id(*_COST_ID))


def omop_cost(claim: DataFrame, rx: DataFrame) -> DataFrame:
    """Cost of claim visits and of dispensed drugs."""
    schema = schemas.COST
    visits = conform(cost_of_visits(claim), schema)
    return visits.unionByName(conform(cost_of_drugs(rx), schema))


def _claim_visits(claim: DataFrame) -> DataFrame:
    return _visit_lines(claim).select(
        claim_visit_key().alias("visit_occurrence_id"),
        F.col("MemberID").alias("person_id"),
        F.col("POS").alias("visit_concept_id"),
        F.col("AdmitDate").alias("visit_start_date"),
        midnight("AdmitDate").alias("visit_start_datetime"),
        F.col("DischDate").alias("visit_end_date"),
        midnight("DischDate").alias("visit_end_datetime"),
        F.lit(CLAIMS).alias("visit_type_concept_id"),
        claim_provider_key().alias("provider_id"),
        F.col("ClaimID").alias("visit_source_value"),
        F.col("AdmitSource").alias("admitted_from_source_value"),
        F.col("DischargeStatus").alias("discharged_to_source_value"),
    )


def _document_visits(patient: DataFrame) -> DataFrame:
    headers = patient.select(
        "patient_id", "document_id", "effective_time", *_blank_to_text(*_HEADER_PROVIDER)
    ).distinct()
    visits = headers.select(
        F.col("patient_id").alias("person_id"),
        F.to_date("effective_time").alias("visit_start_date"),
        F.col("effective_time").alias("visit_start_datetime"),
        F.to_date("effective_time").alias("visit_end_date"),
        F.col("effective_time").alias("visit_end_datetime"),
        F.lit(DOCUMENTS).alias("visit_type_concept_id"),
        document_provider_key().alias("provider_id"),
        F.col("document_id").alias("visit_source_value"),
    )
    slots = ["person_id", "visit_start_date", "visit_end_date", "visit_type_concept_id",
             "provider_id", "visit_source_value"]
    key = document_visit_key(**{s: s for s in slots})
    return visits.withColumn("visit_occurrence_id", key)


def omop_visit(claim: DataFrame, patient: DataFrame) -> DataFrame:
    """Visits of claim lines and of documents."""
    schema = schemas.VISIT_OCCURRENCE
    visits = conform(_claim_visits(claim), schema)
    return visits.unionByName(conform(_document_visits(patient), schema))
