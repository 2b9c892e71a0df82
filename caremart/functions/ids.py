"""Content-hash identifiers.

Every id of the model is the SHA-256 of its parts as text, joined by two
pipes, NULL counting as the empty string. Parts are cast to text before the
``coalesce``: mixing a number or a date with ``''`` raises under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the separator between the parts of an id.
SEPARATOR = "||"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def id_text(*parts: Column | str | None) -> Column:
    """What an id is the hash of; ``None`` is a slot that is always empty."""
    blank = F.lit("")
    texts = [
        blank if p is None else F.coalesce(as_column(p).cast("string"), blank)
        for p in parts
    ]
    return F.concat_ws(SEPARATOR, *texts)


def hash_id(*parts: Column | str | None) -> Column:
    """Id over the parts in order; ``None`` is a slot that is always empty."""
    return F.sha2(id_text(*parts), 256)


# The end as such: a dollar sign would let a line break through.
_HASHED = r"^[0-9a-f]{64}\z"


def packed_ids(df: DataFrame, *names: str) -> DataFrame:
    """Rows with the ids in the columns ``names`` as 32 bytes, half of their text; other texts stay beside them."""
    ids = [F.when(F.col(n).rlike(_HASHED), F.unhex(n)).alias(f"_packed_{n}") for n in names]
    texts = [F.when(~F.col(n).rlike(_HASHED), F.col(n)).alias(n) if n in names else F.col(n) for n in df.columns]
    return df.select(*texts, *ids)


def unpacked_ids(df: DataFrame, *names: str) -> DataFrame:
    """The rows that ``packed_ids`` was given."""
    ids = {n: F.coalesce(F.lower(F.hex(f"_packed_{n}")), F.col(n)).alias(n) for n in names}
    return df.select(*[ids.get(c, F.col(c)) for c in df.columns if not c.startswith("_packed_")])


def provider_key(
    source_id: Column | str | None = None,
    fname: Column | str | None = None,
    lname: Column | str | None = None,
    org: Column | str | None = None,
    phone: Column | str | None = None,
    address: Column | str | None = None,
    city: Column | str | None = None,
    state: Column | str | None = None,
    zip_code: Column | str | None = None,
    country: Column | str | None = None,
) -> Column:
    """Provider id: ten slots, each source filling the ones it knows."""
    return hash_id(
        source_id, fname, lname, org, phone, address, city, state, zip_code, country
    )


def claim_provider_key(provider: Column | str = "ProviderID") -> Column:
    return provider_key(source_id=provider)


def document_provider_key() -> Column:
    """Provider named in a document header."""
    return provider_key(
        fname="provider_fname",
        lname="provider_lname",
        org="provider_org",
        phone="provider_phone",
        address="provider_address",
        city="provider_city",
        state="provider_state",
        zip_code="provider_zip_code",
        country="provider_country",
    )


def entry_provider_key() -> Column:
    """Author of a problem or medication entry."""
    return provider_key("provider_id", "provider_fname", "provider_lname")


# The visit slots that follow the claim id, in order.
VISIT_SLOTS = [
    "person_id",
    "visit_concept_id",
    "visit_start_date",
    "visit_end_date",
    "visit_type_concept_id",
    "provider_id",
    "care_site_id",
    "visit_source_value",
    "visit_source_concept_id",
    "admitted_from_concept_id",
    "admitted_from_source_value",
    "discharged_to_concept_id",
    "discharged_to_source_value",
    "preceding_visit_occurrence_id",
]


def document_visit_key(**slots: Column | str) -> Column:
    """Visit id of a document; slots not named stay empty."""
    unknown = set(slots) - set(VISIT_SLOTS)
    if unknown:
        raise ValueError(f"not visit slots: {sorted(unknown)}")
    return hash_id(*[slots.get(name) for name in VISIT_SLOTS])


def claim_visit_key() -> Column:
    """Visit id of a silver claim line.

    The one definition behind both the visit table and the event id of the
    cost table, so a cost always finds its visit.
    """
    parts = {
        "person_id": "MemberID",
        "visit_concept_id": "POS",
        "visit_start_date": F.coalesce("AdmitDate", "FromDate"),
        "visit_end_date": F.coalesce("DischDate", "ToDate"),
        "visit_type_concept_id": F.lit("CLAIMS"),
        "provider_id": claim_provider_key(),
        "visit_source_value": "ClaimID",
        "admitted_from_source_value": "AdmitSource",
        "discharged_to_source_value": "DischargeStatus",
    }
    return hash_id("medical_claim_id", *[parts.get(name) for name in VISIT_SLOTS])
