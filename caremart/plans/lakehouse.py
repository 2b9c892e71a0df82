"""Bronze to silver to gold, as functions to call in dependency order.

``silver_*`` and ``gold_tables`` are pure: DataFrames in, DataFrames out. The
``refresh_*`` functions read the catalog, call them and write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.operators import cda, claims, omop
from caremart.schemas import LAYERS
from caremart.functions.casts import conform
from caremart.sources.tables import append_table, overwrite_table, staged

# Tables that are looked up by person are laid out by person.
PERSON_TABLES = {
    "person",
    "condition_occurrence",
    "drug_exposure",
    "procedure_occurrence",
    "visit_occurrence",
}


def silver_claims(medical: DataFrame, rx: DataFrame) -> dict[str, DataFrame]:
    """Typed claim tables from the landed claim files."""
    typed = claims.typed_lines(medical, hashed=False)
    return {
        "medical_claims_claim": claims.claim_lines(typed),
        "medical_claims_procedure": claims.claim_procedures(typed),
        "medical_claims_diagnosis": claims.claim_diagnoses(typed),
        "prescription_claim": claims.prescription_claims(rx),
    }


def _unseen(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """New documents without shuffling document text.

    The anti-join runs on ids alone. Its staged result has a known size, by
    which the planner decides whether the ids can be broadcast to the texts.
    """
    ids = staged(cda.only_new(docs.select("document_id").distinct(), seen), "new-documents")
    # Null-safe: a file without a document part in its name comes every time, to be set aside.
    same = docs["document_id"].eqNullSafe(ids["document_id"])
    return docs.join(ids, same, "left_semi")


def silver_documents(
    docs: DataFrame, seen: DataFrame | None = None, provider: str = "performer"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Document tables from new documents, and those that are set aside.

    Documents without an id or without text are not parsed. Parsing is by far
    the most expensive step and feeds four results, so its output is staged
    once.
    """
    new = docs if seen is None else _unseen(docs, seen)
    blank = F.trim(F.coalesce("xml_string", F.lit(""))) == ""
    reason = F.when(F.col("document_id").isNull(), cda.NO_ID).when(blank, cda.NO_TEXT)
    unread = new.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    unread = unread.select(
        "patient_id", "document_id", "reason",
        F.when(F.col("document_id").isNull(), F.col("xml_string")).alias("malformed"),
    )
    parsed, malformed = cda.split_usable(
        staged(cda.parse_documents(new.filter(reason.isNull()), provider), "parsed-documents")
    )
    malformed = malformed.unionByName(unread)
    tables = {
        "ccda_docs_patient": cda.doc_patients(parsed),
        "ccda_docs_problem": cda.doc_problems(parsed),
        "ccda_docs_medication": cda.doc_medications(parsed),
    }
    return tables, malformed


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The seven model tables from the seven silver tables."""
    patient = silver["ccda_docs_patient"]
    problem = silver["ccda_docs_problem"]
    medication = silver["ccda_docs_medication"]
    claim = silver["medical_claims_claim"]
    diagnosis = silver["medical_claims_diagnosis"]
    procedure = silver["medical_claims_procedure"]
    rx = silver["prescription_claim"]
    return {
        "person": omop.omop_person(patient),
        "drug_exposure": omop.omop_drug_exposure(medication, rx),
        "condition_occurrence": omop.omop_condition(problem, diagnosis),
        "provider": omop.omop_provider(
            patient, medication, problem, claim, diagnosis, procedure, rx
        ),
        "procedure_occurrence": omop.omop_procedure(procedure),
        "cost": omop.omop_cost(claim, rx),
        "visit_occurrence": omop.omop_visit(claim, patient),
    }


def refresh_silver_claims(
    spark: SparkSession, medical: DataFrame, rx: DataFrame, database: str
) -> None:
    for table, df in silver_claims(medical, rx).items():
        overwrite_table(conform(df, LAYERS["silver"][table]), f"{database}.{table}")


def refresh_silver_documents(
    spark: SparkSession, docs: DataFrame, database: str, provider: str = "performer"
) -> DataFrame:
    """Add documents that are not in silver yet; returns those that are set aside.

    The latter are stored in ``quarantine_documents`` and not parsed again;
    what has no id is told by its text there.

    The patient table is written last: it says which documents are done, so a
    run that dies before it is repeated in full, and the entry tables are
    cleared of what such a run may have left by their content ids.
    """
    patient = f"{database}.ccda_docs_patient"
    known = spark.catalog.tableExists(patient)
    quarantine = f"{database}.quarantine_documents"
    seen = spark.table(patient).select("document_id") if known else None
    if spark.catalog.tableExists(quarantine):
        aside = spark.table(quarantine).select("document_id").filter(F.col("document_id").isNotNull())
        seen = aside if seen is None else seen.union(aside)
    tables, malformed = silver_documents(docs, seen, provider)
    for table in ("ccda_docs_problem", "ccda_docs_medication", "ccda_docs_patient"):
        name = f"{database}.{table}"
        rows = conform(tables[table], LAYERS["silver"][table])
        if spark.catalog.tableExists(name):
            key = {"ccda_docs_problem": "problem_id", "ccda_docs_medication": "medication_id"}
            if table in key:
                rows = cda.only_new(rows, spark.table(name), key[table])
            append_table(rows, name)
        else:
            overwrite_table(rows, name)
    # Ids keep known documents away from here; texts without id are told apart by a hash.
    rows = malformed.distinct().withColumn("text_hash", F.sha2(F.coalesce("malformed", F.lit("")), 256))
    if spark.catalog.tableExists(quarantine):
        old = spark.table(quarantine).select(
            F.col("document_id").alias("_id"), F.col("text_hash").alias("_hash"))
        same = rows["document_id"].eqNullSafe(old["_id"]) & (rows["text_hash"] == old["_hash"])
        append_table(staged(rows.join(old, same, "left_anti"), "quarantine"), quarantine)
    else:
        overwrite_table(rows, quarantine)
    return malformed


def refresh_gold(spark: SparkSession, silver_database: str, gold_database: str) -> None:
    silver = {t: spark.table(f"{silver_database}.{t}") for t in LAYERS["silver"]}
    for table, df in gold_tables(silver).items():
        keys = ["person_id"] if table in PERSON_TABLES else []
        overwrite_table(conform(df, LAYERS["gold"][table]), f"{gold_database}.{table}", keys)
