"""DuckDB twins of the registered queries.

Written against the driver's tables, independently of the Spark code: only the
column contracts are shared, to spell out the columns that the posed feeds
leave empty.
"""

from __future__ import annotations

from caremart import schemas as S

_SQL_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT",
    "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP",
}


def _hash(*parts: str) -> str:
    texts = ", ".join("''" if p == "''" else f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"sha256(concat_ws('||', {texts}))"


def _mdy(expr: str) -> str:
    return f"concat(month({expr}), '/', day({expr}), '/', year({expr}))"


_MEDICAL = {
    "SequenceNumber": "l_partkey::VARCHAR",
    "ClaimID": "l_orderkey::VARCHAR",
    "LineNum": "l_linenumber::VARCHAR",
    "ContractID": "concat('C', o_orderstatus)",
    "MemberID": "o_custkey::VARCHAR",
    "FromDate": _mdy("l_shipdate"),
    "ToDate": f"""CASE WHEN l_linenumber = 7 THEN '13/40/2020'
        ELSE {_mdy('(l_shipdate::DATE + l_linenumber)')} END""",
    "AdmitDate": f"CASE WHEN o_orderstatus = 'F' THEN {_mdy('o_orderdate')} END",
    "DischDate": f"""CASE WHEN o_orderstatus = 'F' AND l_linestatus = 'O'
        THEN {_mdy('(o_orderdate::DATE + 5)')} END""",
    "PaidDate": f"""CASE WHEN l_linenumber = 1 THEN '2020-01-02'
        ELSE {_mdy('(l_shipdate::DATE + 30)')} END""",
    "RevCode": "CASE WHEN l_suppkey > 9999 THEN left(l_suppkey::VARCHAR, 4) "
               "ELSE lpad(l_suppkey::VARCHAR, 4, '0') END",
    "HCPCS": "concat('H', l_partkey)",
    "Modifier": "nullif(l_returnflag, 'N')",
    "Modifier2": "l_linestatus",
    "srcPOS": "l_linenumber::VARCHAR",
    "POS": "l_linenumber::VARCHAR",
    "srcSpecialty": "'x1'",
    "ProviderID": "CASE WHEN l_linenumber <> 5 THEN l_suppkey::VARCHAR END",
    "BillType": "''",
    "AdmitSource": "left(o_orderpriority, 1)",
    "AdmitType": "o_orderpriority",
    "Billed": "l_extendedprice::VARCHAR",
    "Allowed": "l_extendedprice::VARCHAR",
    "Paid": "CASE WHEN l_linenumber = 6 THEN 'abc' ELSE l_extendedprice::VARCHAR END",
    "COB": "l_discount::VARCHAR",
    "Copay": "l_tax::VARCHAR",
    "Coinsurance": "'0'",
    "Deductible": "l_quantity::VARCHAR",
    "PatientPay": "CASE WHEN l_linenumber <> 3 THEN l_tax::VARCHAR END",
    "Days": "CASE WHEN l_returnflag = 'R' THEN l_linenumber::VARCHAR END",
    "Units": "'0.1'",
    "ICDVersion": "'10'",
    "DischargeStatus": "CASE WHEN o_orderstatus = 'F' THEN l_linenumber::VARCHAR END",
    "AdmitDiag": "CASE WHEN o_orderstatus = 'F' THEN concat('A', l_returnflag) END",
    "ICDDiag1": "concat('D', l_returnflag, l_linestatus)",
    "ICDDiag3": "CASE WHEN l_linenumber > 3 THEN o_orderstatus END",
    "ICDDiag30": "CASE WHEN l_linenumber > 5 THEN 'Z99' END",
    "ICDProc1": "CASE WHEN o_orderstatus = 'F' THEN concat('P', l_linestatus) END",
    "ICDProc2": "CASE WHEN l_linenumber = 2 THEN l_returnflag END",
    "ICDProc10": "CASE WHEN l_linenumber > 4 THEN '0XYZ' END",
    "UserDefNum3": "l_tax::VARCHAR",
    "YearMo": "strftime(l_shipdate, '%Y%m')",
    "MR_Units_Days": "l_quantity::VARCHAR",
    "LOB": "l_linestatus",
    "Year": "year(l_shipdate)::VARCHAR",
}

_PHARMACY = {
    "SequenceNumber": "event_id::VARCHAR",
    "ClaimID": "event_id::VARCHAR",
    "ContractID": "event_type",
    "MemberID": "user_id::VARCHAR",
    "FromDate": _mdy("ts"),
    "PaidDate": f"CASE WHEN event_type <> 'error' THEN {_mdy('(ts::DATE + 10)')} END",
    "NDC": "concat('N', user_id)",
    "ProviderID": "CASE WHEN event_type <> 'view' THEN user_id::VARCHAR END",
    "IngredientCost": "value::VARCHAR",
    "DispensingFee": "'1.5'",
    "Billed": "value::VARCHAR",
    "Allowed": "value::VARCHAR",
    "Paid": "value::VARCHAR",
    "COB": "'0'",
    "Copay": "CASE WHEN event_type <> 'click' THEN '2.25' END",
    "Coinsurance": "'0.5'",
    "MR_Paid": "'n/a'",
    "Deductible": "'0'",
    "PatientPay": "'3'",
    "Units": "'1.5'",
    "DaysSupply": "day(ts)::VARCHAR",
    "QuantityDispensed": "'30.5'",
    "MR_Scripts_30Day": "json_extract_string(props, '$.k')",
    "YearMo": "strftime(ts, '%Y%m')",
    "UserDefNum3": "'7'",
}

_RULES = {
    "string": "{}",
    "int": "TRY_CAST({} AS INTEGER)",
    "float": "TRY_CAST({} AS FLOAT)",
    "double": "TRY_CAST({} AS DOUBLE)",
    "money": "round(TRY_CAST({} AS DOUBLE), 2)",
    "mdy": "TRY_CAST(try_strptime({}, '%m/%d/%Y') AS DATE)",
}
_EMPTY = {
    "string": "VARCHAR", "int": "INTEGER", "float": "FLOAT", "double": "DOUBLE",
    "money": "DOUBLE", "mdy": "DATE",
}


def _raw(columns: dict[str, str], contract, source: str) -> str:
    picked = ",\n ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"SELECT {picked} FROM {source}"


def _typed(columns: dict[str, str], contract) -> str:
    return ",\n ".join(
        f"{_RULES[rule].format(name)} AS {name}"
        if name in columns
        else f"CAST(NULL AS {_EMPTY[rule]}) AS {name}"
        for name, rule in contract
    )


_RAW_MEDICAL = f"""raw_medical AS (
{_raw(_MEDICAL, S.MEDICAL_CONTRACT, 'lineitem JOIN orders ON l_orderkey = o_orderkey')})"""
_RAW_RX = f"raw_rx AS ({_raw(_PHARMACY, S.PHARMACY_CONTRACT, 'events')})"

_LINES = f"""{_RAW_MEDICAL}, lines AS (SELECT DISTINCT
 {_hash('ClaimID', 'LineNum')} AS medical_claim_id,
 CASE WHEN AdmitDate IS NOT NULL OR DischDate IS NOT NULL THEN 1 ELSE 0 END AS Inpatient_flag,
 {_typed(_MEDICAL, S.MEDICAL_CONTRACT)}
 FROM raw_medical)"""

_CLAIM = f"""{_LINES}, claim AS (
 SELECT {', '.join(S.SILVER_CLAIM.fieldNames())} FROM lines)"""

_EPISODE = "coalesce(AdmitDate, FromDate), coalesce(DischDate, ToDate)"


def _codes(prefix: str) -> list[tuple[int, str]]:
    return [
        (int(name.removeprefix(prefix)), name) for name in _MEDICAL if name.startswith(prefix)
    ]


_PX_COLUMNS = ["medical_claim_id", "MemberID", "procedure_start_date", "procedure_end_date",
               "modifier_concept_id", "quantity", "ProviderID", "ClaimID", "ICDVersion",
               "Procedure_Num", "Procedure_Code"]
_PX = _LINES + ", px_long AS (" + " UNION ".join(
    f"""SELECT medical_claim_id, MemberID, coalesce(AdmitDate, FromDate) AS procedure_start_date,
 coalesce(DischDate, ToDate) AS procedure_end_date,
 coalesce(Modifier, Modifier2) AS modifier_concept_id,
 coalesce(CAST(Days AS FLOAT), Units) AS quantity, ProviderID, ClaimID, ICDVersion,
 {number} AS Procedure_Num, {name} AS Procedure_Code FROM lines WHERE {name} IS NOT NULL"""
    for number, name in _codes("ICDProc")
) + f"), px AS (SELECT {_hash(*_PX_COLUMNS)} AS procedure_occurrence_id, * FROM px_long)"

_DX_COLUMNS = ["medical_claim_id", "ClaimID", "MemberID", "ProviderID", "condition_start_date",
               "condition_end_date", "ICDVersion", "Diagnosis_Num", "Diagnosis_Type",
               "Diagnosis_Code"]
_DX_TEXT = ", dx_long AS (" + " UNION ".join(
    f"""SELECT medical_claim_id, ClaimID, MemberID, ProviderID,
 coalesce(AdmitDate, FromDate) AS condition_start_date,
 coalesce(DischDate, ToDate) AS condition_end_date, ICDVersion, {number} AS Diagnosis_Num,
 '{kind}' AS Diagnosis_Type, {name} AS Diagnosis_Code FROM lines WHERE {name} IS NOT NULL"""
    for number, name, kind in [(0, "AdmitDiag", "Primary")]
    + [(i, n, "Secondary") for i, n in _codes("ICDDiag")]
) + f"), dx AS (SELECT {_hash(*_DX_COLUMNS)} AS condition_occurrence_id, * FROM dx_long)"
_DX = _LINES + _DX_TEXT

_RX_ID = _hash("SequenceNumber", "ClaimID", "MemberID", "MemberID", "FromDate")
_RX = f"""{_RAW_RX}, rx AS (SELECT DISTINCT {_RX_ID} AS prescription_claim_id,
 {_typed(_PHARMACY, S.PHARMACY_CONTRACT)} FROM raw_rx)"""

_ENTRIES = """turns AS (
 SELECT conv_id, turn, role, conv_id::VARCHAR AS patient_id,
  concat(conv_id, '-', turn) AS document_id, string_split(text, chr(10)) AS entry_lines
 FROM conversations),
entries AS (
 SELECT *, entry_lines[i + 1] AS line FROM (
  SELECT *, unnest(range(0, len(entry_lines))) AS i FROM turns))"""

_PROBLEM_COLUMNS = ["patient_id", "document_id", *S.PROBLEM_FIELDS.fieldNames()]
_PROBLEM_TEXT = f""", problem_rows AS (
 SELECT DISTINCT patient_id, document_id, 'CONC' AS concern_type_code,
  'Concern' AS concern_type_name, 'active' AS problem_status,
  '2.16.840.1' AS condition_concept_id, 'SYS' AS condition_concept_value,
  TIMESTAMP '2019-01-01 00:00:00' AS condition_start_date,
  CAST(NULL AS TIMESTAMP) AS condition_end_date,
  'CCDA_XML_DOCS' AS condition_type_concept_id, concat('c', i) AS condition_source_value,
  line AS condition_source_concept_id, concat('npi', i) AS provider_id,
  'Dr' AS provider_fname, concat('Fam', i) AS provider_lname,
  TIMESTAMP '2021-02-03 00:00:00' AS provider_entry_date
 FROM entries WHERE role = 'user'),
problem AS (SELECT {_hash(*_PROBLEM_COLUMNS)} AS problem_id, * FROM problem_rows)"""
_PROBLEM = _ENTRIES + _PROBLEM_TEXT

_MEDICATION_COLUMNS = ["patient_id", "document_id", *S.MEDICATION_FIELDS.fieldNames()]
_MEDICATION_TEXT = f""", medication_rows AS (
 SELECT DISTINCT patient_id, document_id, '2.16.840.1.113883.6.88' AS drug_concept_id,
  CAST(NULL AS VARCHAR) AS drug_concept_value, nullif(line, '') AS drug_source_value,
  concat('rx', i) AS drug_source_concept_id,
  TIMESTAMP '2020-01-02 00:00:00' AS drug_exposure_start_date,
  TIMESTAMP '2020-01-03 04:05:06' AS drug_exposure_end_date,
  'mg' AS dose_unit_concept_id, CAST(1.5 AS FLOAT) AS dose_unit_source_value,
  'PO' AS route_concept_id, 'Oral' AS route_source_value,
  CAST(30 AS FLOAT) AS drug_supply_quantity, CAST(2 AS FLOAT) AS drug_supply_refill,
  CAST(NULL AS VARCHAR) AS provider_id, CAST(NULL AS VARCHAR) AS provider_fname,
  CAST(NULL AS VARCHAR) AS provider_lname, CAST(NULL AS TIMESTAMP) AS provider_entry_date
 FROM entries WHERE role <> 'user'),
medication AS (SELECT {_hash(*_MEDICATION_COLUMNS)} AS medication_id, * FROM medication_rows)"""
_MEDICATION = _ENTRIES + _MEDICATION_TEXT


def _patient(fname: str, lname: str) -> str:
    return f""", patient AS (
 SELECT DISTINCT patient_id, document_id, 'Summary' AS document_type,
  TIMESTAMP '2020-01-01 03:04:05' + to_days((turn % 28)::INTEGER) AS effective_time,
  concat('Turn ', turn) AS document_title, 'Pat' AS patient_fname,
  concat('F', conv_id) AS patient_lname, 'F' AS gender_code,
  CASE WHEN conv_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  concat('Race', turn % 3) AS race, CAST(NULL AS VARCHAR) AS ethnicity,
  CASE WHEN turn % 7 = 6 THEN '19610203' ELSE '19600102' END AS birth_time,
  CASE WHEN turn % 7 = 6 THEN TIMESTAMP '1961-02-03' ELSE TIMESTAMP '1960-01-02' END
   AS birth_date,
  CAST(NULL AS VARCHAR) AS street_address, concat('City', conv_id % 5) AS city,
  CAST(NULL AS VARCHAR) AS state, CASE WHEN turn % 2 = 0 THEN 1234 END AS zip_code,
  CAST(NULL AS VARCHAR) AS country, concat('tel:', conv_id) AS home_phone,
  CAST(NULL AS VARCHAR) AS mobile_phone, CAST(NULL AS VARCHAR) AS marital_code,
  CAST(NULL AS VARCHAR) AS marital_status, CAST(NULL AS VARCHAR) AS religion,
  'en' AS language, {fname} AS provider_fname, {lname} AS provider_lname,
  concat('Org', conv_id % 4) AS provider_org, CAST(NULL AS VARCHAR) AS provider_phone,
  CAST(NULL AS VARCHAR) AS provider_address, CAST(NULL AS VARCHAR) AS provider_city,
  CAST(NULL AS VARCHAR) AS provider_state, 2345 AS provider_zip_code,
  CAST(NULL AS VARCHAR) AS provider_country,
  CASE WHEN role = 'user' THEN len(entry_lines) ELSE 0 END AS problem_count,
  CASE WHEN role <> 'user' THEN len(entry_lines) ELSE 0 END AS medication_count
 FROM turns)"""


_PATIENT_TEXT = _patient("'P'", "concat('Q', turn % 4)")
_PATIENT = _ENTRIES + _PATIENT_TEXT
_DOCS = _ENTRIES + _PROBLEM_TEXT + _MEDICATION_TEXT + _PATIENT_TEXT

_NULL_SLOTS = ["''"] * 9
_CLAIM_PROVIDER = _hash("ProviderID", *_NULL_SLOTS)
_ENTRY_PROVIDER = _hash("provider_id", "provider_fname", "provider_lname", *["''"] * 7)
_HEADER_SLOTS = ["provider_fname", "provider_lname", "provider_org", "provider_phone",
                 "provider_address", "provider_city", "provider_state", "provider_zip_code",
                 "provider_country"]
_HEADER_PROVIDER = _hash("''", *_HEADER_SLOTS)


def _table(schema, columns: dict[str, str], source: str, distinct: str = "DISTINCT") -> str:
    picked = ", ".join(
        f"CAST({columns.get(f.name, 'NULL')} AS {_SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in schema.fields
    )
    return f"SELECT {distinct} {picked} FROM {source}"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _listed(value: str) -> str:
    return f"nullif(string_agg(DISTINCT {value}, ',' ORDER BY {value}), '')"


def _agreed(value: str) -> str:
    return f"CASE WHEN count(DISTINCT {value}) = 1 THEN min({value}) END"


_PERSON_TEXT = ", person AS (" + _table(S.PERSON, {
    "person_id": "patient_id",
    "year_of_birth": _agreed("year(birth_date)"),
    "month_of_birth": _agreed("month(birth_date)"),
    "day_of_birth": _agreed("day(birth_date)"),
    "birth_datetime": _agreed("birth_date"),
    "provider_id": _listed("header_provider"),
    "gender_source_value": _listed("gender"),
    "race_source_value": _listed("race"),
    "ethnicity_source_value": _listed("ethnicity"),
}, f"(SELECT *, {_HEADER_PROVIDER} AS header_provider FROM patient) GROUP BY patient_id", "") + ")"

_DRUG_TEXT = ", drug AS (" + _table(S.DRUG_EXPOSURE, {
    "drug_exposure_id": "medication_id", "person_id": "patient_id",
    "drug_exposure_start_date": "drug_exposure_start_date::DATE",
    "drug_exposure_start_datetime": "drug_exposure_start_date",
    "drug_exposure_end_date": "drug_exposure_end_date::DATE",
    "drug_exposure_end_datetime": "drug_exposure_end_date",
    "refills": "drug_supply_refill", "quantity": "drug_supply_quantity",
    "provider_id": _ENTRY_PROVIDER,
    **_same("drug_concept_id", "route_concept_id", "drug_source_value",
            "drug_source_concept_id", "route_source_value", "dose_unit_source_value"),
}, "medication") + " UNION " + _table(S.DRUG_EXPOSURE, {
    "drug_exposure_id": "prescription_claim_id", "person_id": "MemberID",
    "drug_concept_id": "'NDC'", "drug_exposure_start_date": "FromDate",
    "drug_exposure_start_datetime": "FromDate", "refills": "MR_Scripts_30Day",
    "quantity": "QuantityDispensed", "days_supply": "DaysSupply",
    "provider_id": _CLAIM_PROVIDER, "drug_source_value": "NDC",
    "drug_source_concept_id": "'NDC'",
}, "rx") + ")"

_CONDITION_TEXT = ", condition AS (" + _table(S.CONDITION_OCCURRENCE, {
    "condition_occurrence_id": "problem_id", "person_id": "patient_id",
    "condition_start_date": "condition_start_date::DATE",
    "condition_start_datetime": "condition_start_date",
    "condition_end_date": "condition_end_date::DATE",
    "condition_end_datetime": "condition_end_date",
    "provider_id": _ENTRY_PROVIDER, "condition_status_source_value": "problem_status",
    **_same("condition_concept_id", "condition_type_concept_id", "condition_source_value",
            "condition_source_concept_id"),
}, "problem") + " UNION " + _table(S.CONDITION_OCCURRENCE, {
    "person_id": "MemberID", "condition_concept_id": "'2.16.840.1.113883.6.90'",
    "condition_start_datetime": "condition_start_date",
    "condition_end_datetime": "condition_end_date",
    "condition_type_concept_id": "'CLAIMS'", "provider_id": _CLAIM_PROVIDER,
    "condition_source_value": "Diagnosis_Code",
    "condition_status_source_value": "Diagnosis_Type",
    **_same("condition_occurrence_id", "condition_start_date", "condition_end_date"),
}, "dx") + ")"


def _identity(source: str, key: str, names: list[str], table: str) -> str:
    slots = ", ".join(
        f"CAST({s if s in names else 'NULL'} AS VARCHAR) AS {s}" for s in _HEADER_SLOTS
    )
    return f"SELECT {key} AS provider_id, CAST({source} AS VARCHAR) AS npi, {slots} FROM {table}"


_PROVIDER_TEXT = ", identities AS (" + " UNION ".join(
    [_identity("NULL", _HEADER_PROVIDER, _HEADER_SLOTS, "patient")]
    + [
        _identity("provider_id", _ENTRY_PROVIDER, ["provider_fname", "provider_lname"], t)
        for t in ("medication", "problem")
    ]
    + [_identity("ProviderID", _CLAIM_PROVIDER, [], t) for t in ("claim", "dx", "px", "rx")]
) + "), provider AS (" + _table(S.PROVIDER, {
    "provider_name": "CASE WHEN provider_lname IS NOT NULL "
                     "THEN concat_ws(', ', provider_lname, provider_fname) END",
    **_same("provider_id", "npi"),
}, "identities", "") + ")"

_PROCEDURE_TEXT = ", procedures AS (" + _table(S.PROCEDURE_OCCURRENCE, {
    "person_id": "MemberID", "procedure_concept_id": "'ICD-10-PCS'",
    "procedure_start_datetime": "procedure_start_date",
    "procedure_end_datetime": "procedure_end_date", "procedure_type_concept_id": "'CLAIMS'",
    "quantity": "trunc(quantity)", "provider_id": _CLAIM_PROVIDER,
    "procedure_source_value": "Procedure_Code", "procedure_source_concept_id": "'ICD-10-PCS'",
    **_same("procedure_occurrence_id", "procedure_start_date", "procedure_end_date",
            "modifier_concept_id"),
}, "px", "") + ")"

_VISIT_ID = _hash(
    "medical_claim_id", "MemberID", "POS", "coalesce(AdmitDate, FromDate)",
    "coalesce(DischDate, ToDate)", "'CLAIMS'", _CLAIM_PROVIDER, "''", "ClaimID", "''", "''",
    "AdmitSource", "''", "DischargeStatus", "''",
)
_DOC_VISIT_ID = _hash(
    "patient_id", "''", "effective_time::DATE", "effective_time::DATE", "'CCDA'",
    _HEADER_PROVIDER, "''", "document_id", *["''"] * 6,
)
_CLAIM_VISIT = _table(S.VISIT_OCCURRENCE, {
    "visit_occurrence_id": _VISIT_ID, "person_id": "MemberID", "visit_concept_id": "POS",
    "visit_start_date": "coalesce(AdmitDate, FromDate)",
    "visit_start_datetime": "coalesce(AdmitDate, FromDate)",
    "visit_end_date": "coalesce(DischDate, ToDate)",
    "visit_end_datetime": "coalesce(DischDate, ToDate)",
    "visit_type_concept_id": "'CLAIMS'", "provider_id": _CLAIM_PROVIDER,
    "visit_source_value": "ClaimID", "admitted_from_source_value": "AdmitSource",
    "discharged_to_source_value": "DischargeStatus",
}, "claim")
_VISIT_TEXT = f", visit AS ({_CLAIM_VISIT} UNION " + _table(S.VISIT_OCCURRENCE, {
    "visit_occurrence_id": _DOC_VISIT_ID, "person_id": "patient_id",
    "visit_start_date": "effective_time::DATE", "visit_start_datetime": "effective_time",
    "visit_end_date": "effective_time::DATE", "visit_end_datetime": "effective_time",
    "visit_type_concept_id": "'CCDA'", "provider_id": _HEADER_PROVIDER,
    "visit_source_value": "document_id",
}, "patient") + ")"

_PAID = "(Paid + COB + Copay + Coinsurance + Deductible + PatientPay)"
_COST_SHARED = {
    "cost_type_concept_id": "'CLAIMS'", "currency_concept_id": "'USD'",
    "total_charge": "Billed", "total_paid": _PAID, "paid_by_payer": "Paid",
    "paid_by_patient": "PatientPay", "paid_patient_copay": "Copay",
    "paid_patient_coinsurance": "Coinsurance", "paid_patient_deductible": "Deductible",
    "paid_by_primary": "Paid", "amount_allowed": "Allowed",
}
_VISIT_COST = _table(S.COST, {
    "cost_id": _hash("medical_claim_id", _VISIT_ID, "'visit'", "'CLAIMS'", "'USD'", "Billed",
                     "''", _PAID),
    "cost_event_id": _VISIT_ID, "cost_domain_id": "'visit'", **_COST_SHARED,
}, "claim")
_COST_TEXT = f", cost AS ({_VISIT_COST} UNION " + _table(S.COST, {
    "cost_id": _hash("prescription_claim_id", "'drug'", "'CLAIMS'", "'USD'", "Billed", "''", _PAID),
    "cost_event_id": "prescription_claim_id", "cost_domain_id": "'drug'",
    "paid_ingredient_cost": "IngredientCost", "paid_dispensing_fee": "DispensingFee",
    **_COST_SHARED,
}, "rx") + ")"



def _with(*parts: str) -> str:
    """CTE list from fragments that either stand alone or start with a comma."""
    text = parts[0]
    for part in parts[1:]:
        text += part if part.startswith(",") else ", " + part
    return "WITH " + text


_WHO = """, who AS (SELECT c_custkey::VARCHAR AS person_id FROM customer
 WHERE c_mktsegment = 'BUILDING')"""
_PX_TEXT = _PX.removeprefix(_LINES)
_ALL_GOLD = _with(
    _CLAIM, _PX_TEXT, _DX_TEXT, _RX, _DOCS, _PERSON_TEXT, _DRUG_TEXT, _CONDITION_TEXT,
    _PROVIDER_TEXT, _PROCEDURE_TEXT, _VISIT_TEXT, _COST_TEXT,
)


def _select(names: list[str], table: str) -> str:
    return f" SELECT {', '.join(names)} FROM {table}"


def _review(cte: str, table: str) -> str:
    return f"{cte}{_WHO} SELECT t.* FROM {table} t WHERE person_id IN (SELECT person_id FROM who)"


_GOLD_KEYS = {
    "person": ("person", "person_id"),
    "provider": ("provider", "provider_id"),
    "condition_occurrence": ("condition", "condition_occurrence_id"),
    "drug_exposure": ("drug", "drug_exposure_id"),
    "procedure_occurrence": ("procedures", "procedure_occurrence_id"),
    "visit_occurrence": ("visit", "visit_occurrence_id"),
    "cost": ("cost", "cost_id"),
}


def _pk_report() -> str:
    parts = []
    for name, (cte, key) in _GOLD_KEYS.items():
        parts.append(f"""SELECT '{name}' AS "table", '{key}' AS key,
 coalesce(sum(n), 0)::BIGINT AS rows,
 count(*) FILTER (k IS NOT NULL AND n > 1) AS duplicate_keys,
 coalesce(sum(n) FILTER (k IS NOT NULL AND n > 1), 0)::BIGINT AS duplicate_rows,
 coalesce(sum(n) FILTER (k IS NULL), 0)::BIGINT AS null_rows
 FROM (SELECT {key} AS k, count(*) AS n FROM {cte} GROUP BY 1)""")
    return _ALL_GOLD + " " + " UNION ALL ".join(parts)


def _fk_report() -> str:
    links = [
        ("person", "person", "provider_id", "provider"),
        ("condition_occurrence", "condition", "person_id", "person"),
        ("condition_occurrence", "condition", "provider_id", "provider"),
        ("condition_occurrence", "condition", "visit_occurrence_id", "visit_occurrence"),
        ("drug_exposure", "drug", "person_id", "person"),
        ("drug_exposure", "drug", "provider_id", "provider"),
        ("drug_exposure", "drug", "visit_occurrence_id", "visit_occurrence"),
        ("procedure_occurrence", "procedures", "person_id", "person"),
        ("procedure_occurrence", "procedures", "provider_id", "provider"),
        ("procedure_occurrence", "procedures", "visit_occurrence_id", "visit_occurrence"),
        ("visit_occurrence", "visit", "person_id", "person"),
        ("visit_occurrence", "visit", "provider_id", "provider"),
        ("visit_occurrence", "visit", "preceding_visit_occurrence_id", "visit_occurrence"),
    ]
    parts = [
        f"""SELECT '{name}' AS "table", '{column}' AS "column", '{parent}' AS parent,
 count(DISTINCT {column}) AS orphan_ids, count(*) AS orphan_rows
 FROM {cte} WHERE {column} IS NOT NULL AND {column} NOT IN
 (SELECT {_GOLD_KEYS[parent][1]} FROM {_GOLD_KEYS[parent][0]})"""
        for name, cte, column, parent in links
    ]
    return _ALL_GOLD + " " + " UNION ALL ".join(parts)


_REQUIRED = {
    "person": ["person_id", "gender_concept_id", "year_of_birth", "race_concept_id",
               "ethnicity_concept_id"],
    "provider": ["provider_id"],
    "condition_occurrence": ["condition_occurrence_id", "person_id", "condition_concept_id",
                             "condition_start_date", "condition_type_concept_id"],
    "drug_exposure": ["drug_exposure_id", "person_id", "drug_concept_id",
                      "drug_exposure_start_date", "drug_exposure_end_date",
                      "drug_type_concept_id"],
    "procedure_occurrence": ["procedure_occurrence_id", "person_id", "procedure_concept_id",
                             "procedure_start_date", "procedure_type_concept_id"],
    "visit_occurrence": ["visit_occurrence_id", "person_id", "visit_concept_id",
                         "visit_start_date", "visit_end_date", "visit_type_concept_id"],
    "cost": ["cost_id", "cost_event_id", "cost_domain_id", "cost_type_concept_id"],
}


def _not_null_report() -> str:
    parts = [
        f"""SELECT '{name}' AS "table", '{c}' AS "column",
 count(*) FILTER ({c} IS NULL) AS null_rows FROM {_GOLD_KEYS[name][0]}"""
        for name, columns in _REQUIRED.items()
        for c in columns
    ]
    return _ALL_GOLD + " " + " UNION ALL ".join(parts)


_LIMITS = {
    "person": {"gender_source_value": 50, "race_source_value": 50, "ethnicity_source_value": 50,
               "person_source_value": 50},
    "provider": {"provider_name": 255, "npi": 20, "dea": 20, "provider_source_value": 50,
                 "specialty_source_value": 50, "gender_source_value": 50},
    "condition_occurrence": {"stop_reason": 20, "condition_source_value": 50,
                             "condition_status_source_value": 50},
    "drug_exposure": {"stop_reason": 20, "lot_number": 50, "drug_source_value": 50,
                      "route_source_value": 50},
    "procedure_occurrence": {"procedure_source_value": 50, "modifier_source_value": 50},
    "visit_occurrence": {"visit_source_value": 50, "admitted_from_source_value": 50},
    "cost": {"cost_domain_id": 20, "revenue_code_source_value": 50, "drg_source_value": 3},
}


def _length_report() -> str:
    parts = [
        f"""SELECT '{name}' AS "table", '{c}' AS "column",
 count(*) FILTER (length({c}::VARCHAR) > {n}) AS too_long_rows FROM {_GOLD_KEYS[name][0]}"""
        for name, limits in _LIMITS.items()
        for c, n in limits.items()
    ]
    return _ALL_GOLD + " " + " UNION ALL ".join(parts)


_MANIFEST = """manifest AS (
 SELECT url, nullif(part[4], '') AS p4, part[4] AS patient_id, part[5] AS file_name FROM (
  SELECT url, string_split(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+', ''),
   '[?#].*$', ''), '/') AS part
  FROM (SELECT regexp_replace(url, '^(https?://[^/?#]+)', '\\1/raw/ccda') AS url FROM pages)))"""

def _field_list_checks() -> str:
    rows = []
    for table, keys in (("lineitem", ["l_linenumber", "l_orderkey"]), ("orders", ["o_orderkey"]), ("customer", ["c_custkey"]),
                        ("supplier", ["s_suppkey"]), ("events", ["event_id"]), ("conversations", ["conv_id"])):
        same = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        rows.append((table, ",".join(keys), "key", f"""coalesce(sum(n) FILTER (WHERE n > 1 OR NOT ({same})), 0)
 FROM (SELECT {", ".join(keys)}, count(*) AS n FROM {table} GROUP BY ALL)"""))
    for table, column, parent, key in (
        ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey"), ("events", "user_id", "conversations", "conv_id"),
    ):
        rows.append((table, column, "reference", f"""count(*) FROM {table} WHERE {column} IS NOT NULL
 AND NOT EXISTS (SELECT 1 FROM {parent} WHERE {key} = {column})"""))
    for table, columns in (
        ("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey", "o_custkey"]), ("customer", ["c_custkey"]),
        ("supplier", ["s_suppkey"]), ("events", ["event_id", "user_id"]), ("conversations", ["conv_id", "text"]),
        ("documents", ["text", "lang"]),
    ):
        rows += [(table, c, "required", f"count(*) FROM {table} WHERE {c} IS NULL") for c in columns]
    for table, column, longest in (
        ("lineitem", "l_returnflag", 1), ("orders", "o_orderpriority", 6), ("events", "event_type", 5),
        ("conversations", "text", 40), ("documents", "text", 1000), ("documents", "lang", 2),
    ):
        rows.append((table, column, "length", f"count(*) FROM {table} WHERE len({column}) > {longest}"))
    return "\nUNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", '{rule}' AS rule, {rest.replace(" FROM ", " AS rows FROM ", 1)
            if not rest.startswith("coalesce") else rest.replace("0)", "0) AS rows", 1)}""" for t, c, rule, rest in rows
    )


_CUSTOMER_NEXT = """state_old AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment
 FROM customer),
state_new AS (
 SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN concat(c_name, '*')
  ELSE c_name END AS name, c_mktsegment AS segment
 FROM customer WHERE c_mktsegment <> 'BUILDING'
 UNION ALL SELECT -1 - s_suppkey, s_name, 'SUPPLIER' FROM supplier)"""

_ORDER_TEXT = """SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
 CASE WHEN o_orderstatus = 'O' THEN concat('{"status":"', o_orderstatus, '"}') END
  AS _rescued_data
 FROM orders"""

# A CSV file does not tell an empty text from a missing one.
_RAW_SELECT = ", ".join(
    f"nullif({n}, '') AS {n}" if n in _MEDICAL else f'CAST(NULL AS VARCHAR) AS "{n}"'
    for n in S.MEDICAL_CSV.fieldNames()
)


_SAME_AS_FULL = {
    "two_runs_claims": "claim_lines_typed",
    "two_runs_procedures": "claim_procedures_long",
    "two_runs_diagnoses": "claim_diagnoses_long",
    "two_runs_person": "omop_person",
    "two_runs_visit": "omop_visit",
    "two_runs_cost": "omop_cost",
}


def oracles() -> dict[str, str]:
    claim_cte, px_cte, dx_cte, rx_cte = _with(_CLAIM), _with(_PX), _with(_DX), _with(_RX)
    drug_cte = _with(_RX, _MEDICATION, _DRUG_TEXT)
    condition_cte = _with(_DX, _PROBLEM, _CONDITION_TEXT)
    visit_cte = _with(_CLAIM, _PATIENT, _VISIT_TEXT)
    person_cte = _with(_PATIENT, _PERSON_TEXT)
    sql = {
        "claim_lines_typed": f"{claim_cte} SELECT * FROM claim",
        "claim_inpatient_flag": f"""{claim_cte} SELECT Inpatient_flag, count(*) AS lines
 FROM claim GROUP BY Inpatient_flag""",
        "claim_procedures_long": f"{px_cte} SELECT * FROM px",
        "claim_diagnoses_long": f"{dx_cte} SELECT * FROM dx",
        "rx_claims_typed": f"{rx_cte} SELECT * FROM rx",
        "hash_ids": f"""SELECT l_orderkey, l_linenumber,
 {_hash('l_orderkey', 'l_linenumber', "nullif(l_returnflag, 'N')", 'l_shipdate::DATE')} AS row_id,
 {_hash('l_suppkey', *_NULL_SLOTS)} AS provider_id FROM lineitem""",
        "doc_dates": """SELECT o_orderkey, CASE
 WHEN regexp_full_match(t, '[0-9]{8}') THEN try_strptime(t, '%Y%m%d')
 WHEN regexp_full_match(t, '[0-9]{14}') THEN try_strptime(t, '%Y%m%d%H%M%S') END AS parsed
 FROM (SELECT o_orderkey, CASE left(o_orderpriority, 1)
  WHEN '1' THEN strftime(o_orderdate, '%Y%m%d')
  WHEN '2' THEN strftime(o_orderdate, '%Y%m%d123456')
  WHEN '3' THEN strftime(o_orderdate, '%Y%m')
  WHEN '4' THEN strftime(o_orderdate, '%Y-%m-%d')
  ELSE strftime(o_orderdate, '%Y1340') END AS t FROM orders)""",
        "claim_dates": """SELECT o_orderkey, TRY_CAST(try_strptime(t, '%m/%d/%Y') AS DATE) AS parsed
 FROM (SELECT o_orderkey, CASE left(o_orderpriority, 1)
  WHEN '1' THEN concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))
  WHEN '2' THEN strftime(o_orderdate, '%m/%d/%Y')
  WHEN '3' THEN strftime(o_orderdate, '2/30/%Y')
  WHEN '4' THEN strftime(o_orderdate, '%Y-%m-%d') END AS t FROM orders)""",
        "doc_patients": f"{_with(_PATIENT)} SELECT * FROM patient",
        "doc_patients_last_author": _with(
            _ENTRIES,
            _patient(
                "CASE WHEN role = 'user' THEN 'Dr' END",
                "CASE WHEN role = 'user' THEN concat('Fam', len(entry_lines) - 1) END",
            ),
        ) + " SELECT * FROM patient",
        "doc_problems": f"{_with(_PROBLEM)} SELECT * FROM problem",
        "doc_medications": f"{_with(_MEDICATION)} SELECT * FROM medication",
        "doc_nested_sections": f"{_with(_PROBLEM)} SELECT * FROM problem",
        "self_reference_orphans": """WITH v AS (
 SELECT concat(conv_id, '-', turn) AS id, CASE WHEN role = 'system' THEN concat(conv_id, '-', turn + 1000)
  WHEN turn > 0 THEN concat(conv_id, '-', turn - 1) WHEN conv_id % 3 = 0 THEN 'before all' END AS before FROM conversations)
 SELECT before AS id, count(*) AS rows FROM v WHERE before NOT IN (SELECT id FROM v WHERE id IS NOT NULL) GROUP BY before""",
        "doc_first_anywhere": f"{_with(_PATIENT)} SELECT * FROM patient",
        "doc_unclosed_sections": f"""{_with(_PATIENT)} SELECT document_id, problem_count, medication_count FROM patient
 WHERE CAST(split_part(document_id, '-', 2) AS BIGINT) % 3 <> 1""",
        "doc_material_children": f"{_with(_PATIENT)} SELECT * FROM patient",
        "doc_problem_codes": f"""{_with(_ENTRIES)} SELECT DISTINCT document_id,
 CASE WHEN i = 1 THEN 'ts' ELSE '2.16.840.1' END AS condition_concept_id,
 CASE WHEN i = 1 THEN 'tn' ELSE 'SYS' END AS condition_concept_value,
 CASE WHEN i = 1 THEN 't' ELSE concat('c', i) END AS condition_source_value,
 CASE WHEN i = 1 THEN 'td' ELSE line END AS condition_source_concept_id, concat('npi', i) AS provider_id
 FROM entries WHERE role = 'user' AND i > 0""",
        "doc_prefixes": f"{_with(_PATIENT)} SELECT * FROM patient",
        "malformed_documents": """SELECT conv_id::VARCHAR AS patient_id,
 concat(conv_id, '-', turn) AS document_id FROM conversations WHERE role = 'system'""",
        "quarantine_documents": """SELECT conv_id::VARCHAR AS patient_id,
 concat(conv_id, '-', turn) AS document_id, CASE turn % 5 WHEN 1 THEN 'malformed'
 WHEN 2 THEN 'not a clinical document' ELSE 'empty' END AS reason
 FROM conversations WHERE turn % 5 IN (1, 2, 3)""",
        "new_documents_only": """SELECT o_orderkey AS document_id, o_orderstatus AS status
 FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem
 WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
        "omop_person": f"{person_cte} SELECT * FROM person",
        "omop_drug_exposure": f"{drug_cte} SELECT * FROM drug",
        "omop_condition": f"{condition_cte} SELECT * FROM condition",
        "omop_provider": f"{_ALL_GOLD} SELECT * FROM provider",
        "omop_procedure": f"{_with(_PX, _PROCEDURE_TEXT)} SELECT * FROM procedures",
        "omop_cost": f"{_with(_CLAIM, _RX, _COST_TEXT)} SELECT * FROM cost",
        "omop_visit": f"{visit_cte} SELECT * FROM visit",
        "visit_cost_per_person": f"""{_with(_CLAIM)}, v AS ({_CLAIM_VISIT}), c AS ({_VISIT_COST})
 SELECT person_id, count(*) AS cost_rows, sum(total_charge) AS total_charge,
  sum(total_paid) AS total_paid
 FROM v JOIN c ON cost_event_id = visit_occurrence_id GROUP BY person_id""",
        "review_person": _review(person_cte, "person"),
        "review_visits": _review(visit_cte, "visit"),
        "review_conditions": _review(condition_cte, "condition"),
        "review_procedures": _review(_with(_PX, _PROCEDURE_TEXT), "procedures"),
        "review_drugs": _review(drug_cte, "drug"),
        "review_providers": f"""{_ALL_GOLD}{_WHO} SELECT pr.*, providers, person_id FROM (
  SELECT person_id, unnest(string_split(provider_id, ',')) AS providers FROM person
  WHERE person_id IN (SELECT person_id FROM who)) l
 JOIN provider pr ON pr.provider_id = l.providers""",
        "review_costs": f"""{_ALL_GOLD}{_WHO}
 SELECT DISTINCT c.*, e.event AS visit_occurrence_id, person_id FROM cost c JOIN (
  SELECT 'visit' AS domain, visit_occurrence_id AS event, person_id FROM visit
  UNION SELECT 'drug', drug_exposure_id, person_id FROM drug) e
 ON c.cost_event_id = e.event AND c.cost_domain_id = e.domain
 WHERE person_id IN (SELECT person_id FROM who)""",
        "review_costs_one_person": f"""{_ALL_GOLD}
 SELECT c.*, visit_occurrence_id FROM cost c JOIN visit ON cost_event_id = visit_occurrence_id
  AND cost_domain_id = 'visit' WHERE person_id = '8'
 UNION SELECT c.*, drug_exposure_id FROM cost c JOIN drug ON cost_event_id = drug_exposure_id
  AND cost_domain_id = 'drug' WHERE person_id = '8'""",
        "review_providers_one_person": f"""{_ALL_GOLD} SELECT pr.*, providers FROM (
  SELECT unnest(string_split(provider_id, ',')) AS providers FROM person WHERE person_id = '8') l
 JOIN provider pr ON pr.provider_id = l.providers""",
        **{
            f"review_{name}_one_person": f"{cte} SELECT * FROM {source} WHERE person_id = '8'"
            for name, cte, source in (
                ("person", person_cte, "person"), ("visits", visit_cte, "visit"),
                ("conditions", condition_cte, "condition"),
                ("procedures", _with(_PX, _PROCEDURE_TEXT), "procedures"), ("drugs", drug_cte, "drug"),
            )
        },
        "url_manifest": f"WITH {_MANIFEST} SELECT url, patient_id, file_name FROM manifest",
        "missing_files": f"""WITH {_MANIFEST} SELECT url, patient_id, file_name FROM manifest m
 WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.lang = m.patient_id
  AND d.doc_id::VARCHAR = m.file_name)""",
        "csv_rescued_ingest": _ORDER_TEXT,
        "csv_clean_rows": f"SELECT * FROM ({_ORDER_TEXT}) WHERE _rescued_data IS NULL",
        "csv_audit_rows": f"SELECT * FROM ({_ORDER_TEXT}) WHERE _rescued_data IS NOT NULL",
        "quarantine_replay": """SELECT o_orderkey::VARCHAR AS order_id, o_custkey::VARCHAR AS customer,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
 CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END AS status,
 CASE WHEN o_orderstatus = 'O' THEN 'replayed' ELSE 'clean' END AS state FROM orders
 UNION ALL SELECT o_orderkey::VARCHAR, NULL, NULL, NULL, 'aside' FROM orders WHERE o_orderstatus = 'P'""",
        "csv_evolved_schema": """SELECT o_orderkey::VARCHAR AS order_id,
 o_custkey::VARCHAR AS customer,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
 CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END AS status FROM orders""",
        "stream_bronze_claims": f"""WITH {_RAW_MEDICAL} SELECT {_RAW_SELECT},
 CAST(NULL AS VARCHAR) AS _rescued_data FROM raw_medical""",
        "stream_bronze_documents": """SELECT conv_id::VARCHAR AS lname, turn,
 CASE WHEN role = 'user' THEN len(string_split(text, chr(10))) ELSE 0 END AS problem_count,
 CASE WHEN role <> 'user' THEN len(string_split(text, chr(10))) ELSE 0 END AS medication_count
 FROM conversations""",
        "bronze_document_files": """SELECT conv_id::VARCHAR AS patient_id, concat(conv_id, '-', turn) AS document_id,
 concat(conv_id, '_', conv_id, '-', turn, '_ccda.xml') AS file_name, true AS path_ends_in_name,
 true AS size_as_written, true AS text_as_written, true AS landed_after_written FROM conversations""",
        "stream_batch_sizes": """SELECT batch, least(200, n - 200 * batch) AS files FROM
 (SELECT count(*) AS n FROM conversations) t, range((n + 199) // 200) r(batch)""",
        "stream_reset_reads_again": """SELECT o_orderkey::VARCHAR AS order_id, 2 * count(*) AS times,
 2 AS streams FROM orders GROUP BY o_orderkey""",
        "manifest_from_csv": f"WITH {_MANIFEST} SELECT url, patient_id, file_name FROM manifest",
        "two_batch_equals_one_batch": """SELECT o_orderkey::VARCHAR AS order_id,
 o_custkey::VARCHAR AS customer, o_orderpriority AS priority,
 CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS batch_id FROM orders""",
        "snapshot_diff": f"""WITH {_CUSTOMER_NEXT},
 gone AS (SELECT * FROM state_old EXCEPT SELECT * FROM state_new),
 came AS (SELECT * FROM state_new EXCEPT SELECT * FROM state_old)
 SELECT *, CASE WHEN id IN (SELECT id FROM came) THEN 'update_preimage' ELSE 'delete' END
  AS _change_type FROM gone
 UNION ALL SELECT *, CASE WHEN id IN (SELECT id FROM gone) THEN 'update_postimage'
  ELSE 'insert' END FROM came""",
        "diff_then_apply": f"WITH {_CUSTOMER_NEXT} SELECT * FROM state_new",
        "feed_from_version": f"""WITH {_CUSTOMER_NEXT},
 gone AS (SELECT * FROM state_old EXCEPT SELECT * FROM state_new),
 came AS (SELECT * FROM state_new EXCEPT SELECT * FROM state_old)
 SELECT *, CASE WHEN id IN (SELECT id FROM came) THEN 'update_preimage' ELSE 'delete' END
  AS _change_type, 1 AS _commit_version FROM gone
 UNION ALL SELECT *, CASE WHEN id IN (SELECT id FROM gone) THEN 'update_postimage'
  ELSE 'insert' END, 1 FROM came
 UNION ALL SELECT *, 'delete', 2 FROM state_new WHERE segment = 'HOUSEHOLD' AND id % 2 <> 0""",
        "field_list_checks": _field_list_checks(),
        "apply_changes": """WITH last AS (SELECT * FROM events QUALIFY
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
 SELECT user_id, event_type AS last_event, value AS last_value FROM last
 WHERE event_type <> 'error'
 UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
 WHERE c_custkey NOT IN (SELECT user_id FROM last)""",
        "change_bounds": """SELECT min(ts) AS earliest_commit, max(ts) AS latest_commit
 FROM events""",
        "pk_violations": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
 GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "pk_report": _pk_report(),
        "fk_orphans": """SELECT user_id AS id, count(*) AS rows FROM events
 WHERE user_id NOT IN (SELECT conv_id FROM conversations) GROUP BY user_id""",
        "fk_report": _fk_report(),
        "polymorphic_fk": f"""{_ALL_GOLD}
 SELECT 'visit' AS domain, 'cost' AS "table", 'cost_event_id' AS "column",
  'visit_occurrence' AS parent, count(DISTINCT cost_event_id) AS orphan_ids,
  count(*) AS orphan_rows FROM cost WHERE cost_domain_id = 'visit'
  AND cost_event_id NOT IN (SELECT visit_occurrence_id FROM visit)
 UNION ALL SELECT 'drug', 'cost', 'cost_event_id', 'drug_exposure',
  count(DISTINCT cost_event_id), count(*) FROM cost WHERE cost_domain_id = 'drug'
  AND cost_event_id NOT IN (SELECT drug_exposure_id FROM drug)""",
        "not_null_report": _not_null_report(),
        "length_report": _length_report(),
        "conform_schema": """SELECT CAST(o_orderkey AS INTEGER) AS order_number,
 o_totalprice::VARCHAR AS price, CAST(o_orderdate AS DATE) AS day,
 CAST(NULL AS VARCHAR) AS note FROM orders""",
        "table_overwrite_swap": """SELECT o_orderkey, o_custkey FROM orders
 WHERE o_orderstatus <> 'P'""",
        "person_layout": f"{visit_cte} SELECT * FROM visit",
        "lakehouse_end_to_end": f"""{_with(_CLAIM, _RX, _PATIENT, _COST_TEXT, _VISIT_TEXT)}
 SELECT person_id, visit_type_concept_id, count(*) AS rows, sum(total_charge) AS total_charge
 FROM visit LEFT JOIN cost ON cost_event_id = visit_occurrence_id AND cost_domain_id = 'visit'
 GROUP BY person_id, visit_type_concept_id""",
    }
    # Batches that came and went leave what one run over all rows gives.
    for name, full in _SAME_AS_FULL.items():
        sql[name] = sql[full]
    return sql
