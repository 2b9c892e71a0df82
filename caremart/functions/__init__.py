"""Column expressions: content-hash ids, tolerant casts and date parsers."""

from caremart.functions.casts import CAST_RULES, apply_contract, conform
from caremart.functions.dates import cda_timestamp, midnight, month_day_year
from caremart.functions.ids import (
    claim_provider_key,
    claim_visit_key,
    document_visit_key,
    hash_id,
    provider_key,
)

__all__ = [
    "CAST_RULES",
    "apply_contract",
    "cda_timestamp",
    "claim_provider_key",
    "claim_visit_key",
    "conform",
    "document_visit_key",
    "hash_id",
    "midnight",
    "month_day_year",
    "provider_key",
]
