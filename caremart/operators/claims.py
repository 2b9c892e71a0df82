"""Typed claim lines and their procedure, diagnosis and pharmacy products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.functions.casts import apply_contract
from caremart.functions.ids import hash_id, id_text
from caremart.functions.rows import distinct_near, distinct_within, plain_numbers
from caremart.schemas import (
    ICD_COLUMNS,
    MEDICAL_CONTRACT,
    PHARMACY_CONTRACT,
    SILVER_CLAIM,
    SILVER_PRESCRIPTION,
)


def _raw(df: DataFrame, *names: str) -> list[Column]:
    """Landed columns as they are; one that the feed lacks is NULL."""
    present = set(df.columns)
    return [F.col(n) if n in present else F.lit(None).cast("string") for n in names]


#: What ``medical_claim_id`` is the hash of.
CLAIM_TEXT = "medical_claim_text"


def claim_key(lines: DataFrame) -> str:
    """The column that tells a claim line: its id or, a fraction as long, the text that the id is hashed of."""
    return CLAIM_TEXT if CLAIM_TEXT in lines.columns else "medical_claim_id"


def claim_id(lines: DataFrame) -> Column:
    """The id of a claim line, of whichever column tells it."""
    key = claim_key(lines)
    return (F.sha2(key, 256) if key == CLAIM_TEXT else F.col(key)).alias("medical_claim_id")


def typed_lines(bronze: DataFrame, hashed: bool = True) -> DataFrame:
    """One typed row per landed claim line, ICD columns included.

    A projection only, so whatever reads a few columns of it scans only those.
    Duplicates are left for the products to remove. Without ``hashed`` the
    text of the id stands in the place of the id: the products shuffle the
    short text and hash what is left.
    """
    typed = apply_contract(MEDICAL_CONTRACT, bronze.columns)
    # The id and the flag look at the landed text, not at the typed values.
    claim, line, admitted, discharged = _raw(
        bronze, "ClaimID", "LineNum", "AdmitDate", "DischDate"
    )
    key = hash_id(claim, line).alias("medical_claim_id") if hashed else id_text(claim, line).alias(CLAIM_TEXT)
    inpatient = F.when(admitted.isNotNull() | discharged.isNotNull(), 1).otherwise(0)
    return bronze.select(
        key,
        *typed.values(),
        inpatient.alias("Inpatient_flag"),
    )


def claim_lines(typed: DataFrame) -> DataFrame:
    """Distinct typed lines, then without their ICD columns.

    The ICD columns leave after the distinct: lines that differ only in codes
    stay as several equal rows, which the key checks make visible. Up to there
    they are one text, which names only those that are there.
    """
    key = claim_key(typed)
    codes = [c for c in typed.columns if c in ICD_COLUMNS]
    kept = [c for c in typed.columns if c not in ICD_COLUMNS]
    lines = distinct_near(typed.select(*kept, F.to_json(F.struct(*codes)).alias("_codes")), key)
    return lines.select(claim_id(lines), *[c for c in SILVER_CLAIM.fieldNames() if c != "medical_claim_id"])


def flag_counts(typed: DataFrame) -> DataFrame:
    """Distinct claim lines by inpatient flag.

    Only their number is asked for, so a line is told by a digest of all its
    values and none of them is shuffled. JSON leaves NULL out and keeps empty text.
    """
    line = F.unhex(F.sha2(F.to_json(F.struct(*plain_numbers(typed))), 256))
    lines = distinct_near(typed.select(line.alias("_line"), "Inpatient_flag"), "_line")
    return lines.groupBy("Inpatient_flag").agg(F.count(F.lit(1)).alias("lines"))


def numbered_columns(df: DataFrame, prefix: str) -> list[str]:
    """Columns ``prefix1 .. prefixN`` present in ``df``, in numeric order."""
    found = [c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()]
    return sorted(found, key=lambda c: int(c[len(prefix):]))


def coded_lines(typed: DataFrame, prefix: str, *more: str) -> DataFrame:
    """Lines with a code in a column of ``prefix`` or one of ``more``.

    They name the values that the rows per code name, for who only looks at
    those and need not have each row once.
    """
    return typed.filter(F.coalesce(*more, *numbered_columns(typed, prefix)).isNotNull())


def filled_slots(columns: list[str], number: str, value: str, first: int = 1) -> Column:
    """The non-null columns as an array: the slot number of each and its value."""
    return F.array_compact(F.array(
        *[
            F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias(number), F.col(c).alias(value)))
            for i, c in enumerate(columns, start=first)
        ]
    ))


def wide_to_long(
    df: DataFrame,
    columns: list[str],
    keep: list[str | Column],
    number: str,
    value: str,
) -> DataFrame:
    """One row per non-null column: its 1-based slot number and its value.

    Slots are dropped inside the array, before rows are made of them, so a
    line with two codes in thirty columns yields two rows and not thirty.
    """
    return df.select(*keep, F.inline(filled_slots(columns, number, value)))


def _code_rows(lines: DataFrame, *near: str) -> DataFrame:
    """Distinct rows, one per code, of lines whose codes are the array ``_codes``.

    Lines are shuffled with their codes inside: those that can have a row in
    common agree on ``near``, so rows made after it need no other shuffle.
    """
    lines = lines.filter(F.size("_codes") > 0).repartition(*near)
    return distinct_within(lines.select(*[c for c in lines.columns if c != "_codes"], F.inline("_codes")), *near)


def _episode(start: str, end: str) -> list[Column]:
    return [
        F.coalesce("AdmitDate", "FromDate").alias(start),
        F.coalesce("DischDate", "ToDate").alias(end),
    ]


def identified(rows: DataFrame, name: str) -> DataFrame:
    """Code rows made without ids, with those that follow from them: the claim line's and, as ``name``, their own."""
    rows = rows.select(claim_id(rows), *rows.columns[1:])
    return rows.select(hash_id(*rows.columns).alias(name), "*")


def claim_procedures(typed: DataFrame, hashed: bool = True) -> DataFrame:
    """Procedure codes of claim lines, one row per code.

    Works from undeduplicated lines: the distinct here runs on the eleven
    columns that matter, which spares shuffling the full-width lines, and the
    id is hashed once per surviving row. Without ``hashed`` the rows are those
    that ``identified`` completes.
    """
    lines = typed.select(
        claim_key(typed),
        "MemberID",
        *_episode("procedure_start_date", "procedure_end_date"),
        F.coalesce("Modifier", "Modifier2").alias("modifier_concept_id"),
        # As float on both sides: widening to double would change the id text.
        F.coalesce(F.col("Days").cast("float"), F.col("Units")).alias("quantity"),
        "ProviderID",
        "ClaimID",
        "ICDVersion",
        filled_slots(numbered_columns(typed, "ICDProc"), "Procedure_Num", "Procedure_Code").alias("_codes"),
    )
    long = _code_rows(lines, "MemberID", "procedure_start_date", "procedure_end_date")
    return identified(long, "procedure_occurrence_id") if hashed else long


def claim_diagnoses(typed: DataFrame, as_seen: bool = False, hashed: bool = True) -> DataFrame:
    """Diagnosis codes of claim lines: numbered ones and the admitting one.

    The admitting diagnosis joins the numbered ones as slot 0 of the same
    array, so the lines are read once instead of once per union branch. The
    slot tells the type, which is added in the end.

    With ``as_seen`` the claim and the provider are as an id sees them, NULL
    as empty text: a row is then distinct as far as a model table shows it.
    Without ``hashed`` the rows are those that ``identified`` completes.
    """
    columns = ["AdmitDiag", *numbered_columns(typed, "ICDDiag")]
    seen = [F.coalesce(c, F.lit("")).alias(c) if as_seen else F.col(c) for c in ("ClaimID", "ProviderID")]
    lines = typed.select(
        claim_key(typed),
        seen[0],
        "MemberID",
        seen[1],
        *_episode("condition_start_date", "condition_end_date"),
        "ICDVersion",
        filled_slots(columns, "Diagnosis_Num", "Diagnosis_Code", first=0).alias("_codes"),
    )
    long = _code_rows(lines, "MemberID", "condition_start_date", "condition_end_date")
    kind = F.when(F.col("Diagnosis_Num") == 0, "Primary").otherwise("Secondary")
    long = long.select(*long.columns[:-1], kind.alias("Diagnosis_Type"), "Diagnosis_Code")
    return identified(long, "condition_occurrence_id") if hashed else long


def prescription_claims(bronze: DataFrame) -> DataFrame:
    """Distinct typed pharmacy claims with their id."""
    typed = apply_contract(PHARMACY_CONTRACT, bronze.columns)
    # The member counts twice: a fixed property of existing ids.
    parts = ["SequenceNumber", "ClaimID", "MemberID", "MemberID", "FromDate"]
    claim_id = hash_id(*_raw(bronze, *parts))
    rows = bronze.select(claim_id.alias("prescription_claim_id"), *typed.values())
    return rows.select(*SILVER_PRESCRIPTION.fieldNames()).distinct()

