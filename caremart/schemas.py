"""Table layouts: landing (bronze), typed (silver) and common data model (gold).

The column names, types and rules below are fixed values of the data feeds
and of the target model; everything else in the package is derived from them.
"""

from __future__ import annotations

from pyspark.sql import types as T

ICD_SLOTS = 30
DIAGNOSIS_COLUMNS = [f"ICDDiag{i}" for i in range(1, ICD_SLOTS + 1)]
PROCEDURE_COLUMNS = [f"ICDProc{i}" for i in range(1, ICD_SLOTS + 1)]
ICD_COLUMNS = DIAGNOSIS_COLUMNS + PROCEDURE_COLUMNS

# The medical claim feed, one "column rule" per entry, in file
# order. "@icd" stands for the numbered diagnosis and procedure columns.
_MEDICAL = """
SequenceNumber int, ClaimID string, LineNum int, ContractID string, MemberID string,
FromDate mdy, ToDate mdy, AdmitDate mdy, DischDate mdy, PaidDate mdy,
RevCode int, HCPCS string, Modifier string, Modifier2 string, srcPOS int, POS int,
srcSpecialty int, Specialty string, EncounterFlag string, ProviderID string,
BillType int, AdmitSource string, AdmitType string,
Billed money, Allowed money, Paid money, COB money, Copay money, Coinsurance money,
Deductible money, PatientPay money, Days int, Units float, ICDVersion int,
DischargeStatus int, AdmitDiag string, @icd, ICD9Diags string, ICD9Procs string,
OON string, srcLOB string, LOB string, srcProduct int, Product string, GroupID string,
UserDefNum2 double, UserDefNum3 double, YearMo int, PaidMo int, MSA int,
ExclusionCode string, PartialYearGroup int, MedicareCovered int, HCGIndicator string,
Industry string, HCG_DRG string, HCG_ErrorCode string, CaseAdmitID string,
MR_Line string, MR_Line_Det string, MR_Line_Case string, PBP_Line string,
MA_Line string, MA_Line_Det string, Spec_Type string, FacilityCaseID string,
TelehealthFlag string, MR_Cases_Admits int, MR_Units_Days float, MR_Procs int,
MR_Cases_Admits_PatientPay int, MR_Units_Days_PatientPay int, MR_Procs_PatientPay float,
MR_Billed money, MR_Allowed money, MR_Paid money, MR_Copay money, MR_Coinsurance money,
MR_Deductible money, MR_PatientPay money, PBP_Cases_Admits int,
PBP_Cases_Admits_PatientPay int, ServiceType string, RVUAdjustedUnits float,
MedicareInclude money, MedicareAllowedNtnwd money, MedicareAllowedArea money,
MedicareAllowedFull money, MedicareFeeSchedule string, MedicareAPC_DRG_HCPCS string,
MedicareStatusLookup string, MedicareAdjustedUnits float, MedicareAdjudicated int,
MedicareOutlier money, MedicareDSH_UCP money, MedicareCapIME money, MedicareOpIME money,
RVUInclude int, RVUFinalRVUs double, RVUAdjudicated int, RVUUnitCost money,
RVUImputeBasis string, RVUFinalRVUStep int, WorkRVUs double, PracticeRVUs double,
MalpracticeRVUs double, MedicareHCGInclude int, ContributorID string,
HCG_GRVU_Include int, HCG_Quality_Indicator int, DRG_Quality_Indicator int,
Specialty_Quality_Indicator int, Year int, part int
"""

# The pharmacy claim feed.
_PHARMACY = """
SequenceNumber int, ClaimID string, ContractID string, MemberID string,
FromDate mdy, PaidDate mdy, NDC string, EncounterFlag string, MedicalCovered string,
ProviderID string, MailOrder string, IngredientCost money, DispensingFee money,
Billed money, Allowed money, Paid money, COB money, Copay money, Coinsurance money,
Deductible money, PatientPay money, Units float, DaysSupply int, QuantityDispensed float,
OON string, srcLOB string, LOB string, srcProduct int, Product string, GroupID string,
UserDefNum3 int, YearMo int, PaidMo int, MSA int, ExclusionCode string,
PartialYearGroup int, MedicareCovered int, HCGIndicator string, Industry string,
CaseAdmitID string, MR_Line string, MR_Line_Det string, MR_Line_Case string,
PBP_Line string, MA_Line string, MA_Line_Det string, MR_Units_Days float, MR_Procs int,
MR_Scripts_30Day int, MR_Units_Days_PatientPay float, MR_Procs_PatientPay int,
MR_Billed money, MR_Allowed money, MR_Paid money, MR_Copay money, MR_Coinsurance money,
MR_Deductible money, MR_PatientPay money, RVUInclude int, RVUFinalRVUs double,
RVUAdjudicated int, RVUImputeBasis string, RVUFinalRVUStep int, RVUAdjustedUnits float,
ContributorID string, HCG_GRVU_Include int, HCG_Quality_Indicator int,
DRG_Quality_Indicator int, Specialty_Quality_Indicator int, Year int, part int
"""

_RULE_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "money": T.DoubleType(),
    "mdy": T.DateType(),
}


def _contract(text: str) -> list[tuple[str, str]]:
    """``[(column, rule), ...]`` in file order."""
    rules: list[tuple[str, str]] = []
    for entry in text.replace("\n", " ").split(","):
        if entry.strip() == "@icd":
            rules += [(name, "string") for name in ICD_COLUMNS]
        else:
            name, rule = entry.split()
            rules.append((name, rule))
    return rules


MEDICAL_CONTRACT = _contract(_MEDICAL)
PHARMACY_CONTRACT = _contract(_PHARMACY)


def _landing(contract: list[tuple[str, str]]) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name, _ in contract]
    return T.StructType(fields)


MEDICAL_CSV = _landing(MEDICAL_CONTRACT)
PHARMACY_CSV = _landing(PHARMACY_CONTRACT)

_LANDED = [
    T.StructField("_rescued_data", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
]


def _typed(contract: list[tuple[str, str]], skip=()) -> list[T.StructField]:
    return [
        T.StructField(name, _RULE_TYPES[rule])
        for name, rule in contract
        if name not in skip
    ]


_DDL = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def ddl(text: str) -> T.StructType:
    """A schema written as ``name type, name type``."""
    fields = []
    for entry in text.replace("\n", " ").split(","):
        name, kind = entry.split()
        fields.append(T.StructField(name, _DDL[kind]))
    return T.StructType(fields)


# Bronze documents and the three silver document tables.
BRONZE_DOCUMENTS = ddl("""
patient_id string, document_id string, file_modification_time timestamp,
file_size_bytes long, file_path string, file_name string, xml_string string,
created_at timestamp
""")

DOCUMENT_FIELDS = ddl("""
document_type string, effective_time timestamp, document_title string,
patient_fname string, patient_lname string, gender_code string, gender string,
race string, ethnicity string, birth_time string, birth_date timestamp,
street_address string, city string, state string, zip_code int, country string,
home_phone string, mobile_phone string, marital_code string, marital_status string,
religion string, language string, provider_fname string, provider_lname string,
provider_org string, provider_phone string, provider_address string,
provider_city string, provider_state string, provider_zip_code int,
provider_country string
""")

PROBLEM_FIELDS = ddl("""
concern_type_code string, concern_type_name string, problem_status string,
condition_concept_id string, condition_concept_value string,
condition_start_date timestamp, condition_end_date timestamp,
condition_type_concept_id string, condition_source_value string,
condition_source_concept_id string, provider_id string, provider_fname string,
provider_lname string, provider_entry_date timestamp
""")

MEDICATION_FIELDS = ddl("""
drug_concept_id string, drug_concept_value string, drug_source_value string,
drug_source_concept_id string, drug_exposure_start_date timestamp,
drug_exposure_end_date timestamp, dose_unit_concept_id string,
dose_unit_source_value float, route_concept_id string, route_source_value string,
drug_supply_quantity float, drug_supply_refill float, provider_id string,
provider_fname string, provider_lname string, provider_entry_date timestamp
""")

_DOCUMENT_KEY = ddl("patient_id string, document_id string").fields

SILVER_PATIENT = T.StructType(
    _DOCUMENT_KEY
    + DOCUMENT_FIELDS.fields
    + ddl("problem_count int, medication_count int").fields
)
SILVER_PROBLEM = T.StructType(
    ddl("problem_id string").fields + _DOCUMENT_KEY + PROBLEM_FIELDS.fields
)
SILVER_MEDICATION = T.StructType(
    ddl("medication_id string").fields + _DOCUMENT_KEY + MEDICATION_FIELDS.fields
)


def _claim_schema() -> T.StructType:
    fields = ddl("medical_claim_id string").fields
    for field in _typed(MEDICAL_CONTRACT, skip=ICD_COLUMNS):
        fields.append(field)
        if field.name == "DischDate":
            fields.append(T.StructField("Inpatient_flag", T.IntegerType()))
    return T.StructType(fields)


SILVER_CLAIM = _claim_schema()
SILVER_PRESCRIPTION = T.StructType(
    ddl("prescription_claim_id string").fields + _typed(PHARMACY_CONTRACT)
)
SILVER_PROCEDURE = ddl("""
procedure_occurrence_id string, medical_claim_id string, MemberID string,
procedure_start_date date, procedure_end_date date, modifier_concept_id string,
quantity float, ProviderID string, ClaimID string, ICDVersion int,
Procedure_Num int, Procedure_Code string
""")
SILVER_DIAGNOSIS = ddl("""
condition_occurrence_id string, medical_claim_id string, ClaimID string,
MemberID string, ProviderID string, condition_start_date date,
condition_end_date date, ICDVersion int, Diagnosis_Num int, Diagnosis_Type string,
Diagnosis_Code string
""")

# The seven common data model tables.
PERSON = ddl("""
person_id string, gender_concept_id string, year_of_birth int, month_of_birth int,
day_of_birth int, birth_datetime timestamp, race_concept_id string,
ethnicity_concept_id string, location_id string, provider_id string,
care_site_id string, person_source_value string, gender_source_value string,
gender_source_concept_id string, race_source_value string,
race_source_concept_id string, ethnicity_source_value string,
ethnicity_source_concept_id string
""")

PROVIDER = ddl("""
provider_id string, provider_name string, npi string, dea string,
specialty_concept_id string, care_site_id string, year_of_birth int,
gender_concept_id string, provider_source_value string,
specialty_source_value string, specialty_source_concept_id string,
gender_source_value string, gender_source_concept_id string
""")

CONDITION_OCCURRENCE = ddl("""
condition_occurrence_id string, person_id string, condition_concept_id string,
condition_start_date date, condition_start_datetime timestamp,
condition_end_date date, condition_end_datetime timestamp,
condition_type_concept_id string, condition_status_concept_id string,
stop_reason string, provider_id string, visit_occurrence_id string,
visit_detail_id string, condition_source_value string,
condition_source_concept_id string, condition_status_source_value string
""")

DRUG_EXPOSURE = ddl("""
drug_exposure_id string, person_id string, drug_concept_id string,
drug_exposure_start_date date, drug_exposure_start_datetime timestamp,
drug_exposure_end_date date, drug_exposure_end_datetime timestamp,
verbatim_end_date date, drug_type_concept_id string, stop_reason string,
refills int, quantity double, days_supply int, sig string, route_concept_id string,
lot_number string, provider_id string, visit_occurrence_id string,
visit_detail_id string, drug_source_value string, drug_source_concept_id string,
route_source_value string, dose_unit_source_value float
""")

PROCEDURE_OCCURRENCE = ddl("""
procedure_occurrence_id string, person_id string, procedure_concept_id string,
procedure_start_date date, procedure_start_datetime timestamp,
procedure_end_date date, procedure_end_datetime timestamp,
procedure_type_concept_id string, modifier_concept_id string, quantity int,
provider_id string, visit_occurrence_id string, visit_detail_id string,
procedure_source_value string, procedure_source_concept_id string,
modifier_source_value string
""")

VISIT_OCCURRENCE = ddl("""
visit_occurrence_id string, person_id string, visit_concept_id int,
visit_start_date date, visit_start_datetime timestamp, visit_end_date date,
visit_end_datetime timestamp, visit_type_concept_id string, provider_id string,
care_site_id string, visit_source_value string, visit_source_concept_id string,
admitted_from_concept_id string, admitted_from_source_value string,
discharged_to_concept_id string, discharged_to_source_value int,
preceding_visit_occurrence_id string
""")

COST = ddl("""
cost_id string, cost_event_id string, cost_domain_id string,
cost_type_concept_id string, currency_concept_id string, total_charge double,
total_cost double, total_paid double, paid_by_payer double, paid_by_patient double,
paid_patient_copay double, paid_patient_coinsurance double,
paid_patient_deductible double, paid_by_primary double, paid_ingredient_cost double,
paid_dispensing_fee double, payer_plan_period_id string, amount_allowed double,
revenue_code_concept_id string, revenue_code_source_value string,
drg_concept_id string, drg_source_value string
""")

LAYERS: dict[str, dict[str, T.StructType]] = {
    "bronze": {
        "ccda_docs": BRONZE_DOCUMENTS,
        "medical_claims": T.StructType(MEDICAL_CSV.fields + _LANDED),
        "rx_claims": T.StructType(PHARMACY_CSV.fields + _LANDED),
    },
    "silver": {
        "ccda_docs_patient": SILVER_PATIENT,
        "ccda_docs_medication": SILVER_MEDICATION,
        "ccda_docs_problem": SILVER_PROBLEM,
        "medical_claims_claim": SILVER_CLAIM,
        "medical_claims_diagnosis": SILVER_DIAGNOSIS,
        "medical_claims_procedure": SILVER_PROCEDURE,
        "prescription_claim": SILVER_PRESCRIPTION,
    },
    "gold": {
        "person": PERSON,
        "provider": PROVIDER,
        "condition_occurrence": CONDITION_OCCURRENCE,
        "drug_exposure": DRUG_EXPOSURE,
        "procedure_occurrence": PROCEDURE_OCCURRENCE,
        "visit_occurrence": VISIT_OCCURRENCE,
        "cost": COST,
    },
}
