"""Plain data of the engine: what columns are, and what is done to them."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import StrEnum


class Action(StrEnum):
    HASH = "hash"
    TOKENIZE = "tokenize"
    REDACT = "redact"
    BIN = "bin"
    SCAN = "scan"


class Category(StrEnum):
    IDENTIFIER = "identifier"
    QUASI_IDENTIFIER = "quasi_identifier"
    FREE_TEXT = "free_text"
    SENSITIVE = "sensitive"


@dataclass(frozen=True)
class ColumnProfile:
    name: str
    categories: frozenset[Category]


@dataclass(frozen=True)
class ColumnPolicy:
    column: str
    entity: str
    action: Action
    source: str  # external, name_pattern, value_vote, name_similarity or fallback
    score: float


@dataclass(frozen=True)
class TableMapping:
    source: str
    target: str
    table: str
    mode: str = "lake"  # or sql
    schema: str = "dbo"


@dataclass
class RunRecord:
    """One table's run, as it goes to the audit."""

    run_id: str
    table_name: str
    source_uri: str
    target_uri: str
    status: str = "running"
    error_msg: str = "the process ended before the run was closed"
    total_rows: int = 0
    total_columns: int = 0
    columns_scanned: int = 0
    columns_hit: list[str] = field(default_factory=list)
    entity_counts: dict[str, int] = field(default_factory=dict)
    unique_entities: dict[str, int] = field(default_factory=dict)
    column_entities: dict[str, dict[str, int]] = field(default_factory=dict)
    free_text_cols: list[str] = field(default_factory=list)
    k_anonymity_k: int | None = None
    quasi_columns: list[str] = field(default_factory=list)
    suppressed_rows: int = 0
    residual_pii: int = 0
    gps_columns: list[str] = field(default_factory=list)
    timestamp_cols_binned: list[str] = field(default_factory=list)
    numeric_cols_binned: list[str] = field(default_factory=list)
    hashed_columns: list[str] = field(default_factory=list)
    stage_seconds: dict[str, float] = field(default_factory=dict)
    catalog_ok: bool = True
    catalog_flagged: list[str] = field(default_factory=list)
    catalog_diffs: list[str] = field(default_factory=list)
    output_type: str = "rows"
    aggregate_cells: int = 0
    skipped_columns: dict[str, str] = field(default_factory=dict)


# Entity groups, the action for each entity, and least scores.
ENTITY_GROUPS = {
    "direct": "PERSON EMAIL_ADDRESS PHONE_NUMBER IP_ADDRESS URL".split(),
    "financial": "CREDIT_CARD IBAN_CODE CRYPTO SWIFT_BIC SALARY INVOICE_NUMBER INSURANCE_POLICY".split(),
    "us_national": "US_SSN US_DRIVER_LICENSE US_PASSPORT US_ITIN US_BANK_NUMBER".split(),
    "eu_national": "LU_CCSS LU_PASSPORT EU_VAT NATIONAL_TAX_ID".split(),
    "medical": "MEDICAL_LICENSE MEDICAL_RECORD HEALTH_CONDITION HEALTH_INSURANCE".split(),
    "location": "LOCATION STREET_ADDRESS POSTAL_CODE".split(),
    "date": ["DATE_OF_BIRTH"],
    "art9": "NRP RELIGION ETHNICITY SEXUAL_ORIENTATION TRADE_UNION".split(),
    "art10": ["CRIMINAL_RECORD"],
    "b2b": "CONTRACT_NUMBER BOOKING_REF CUSTOMER_EMPLOYEE_ID VEHICLE_PLATE COURT_CASE".split(),
}
REGION_GROUPS = {"us": "us_national", "eu": "eu_national"}
HASHED = (
    "IDENTIFIER CUSTOMER_EMPLOYEE_ID US_SSN US_ITIN US_DRIVER_LICENSE US_PASSPORT LU_CCSS LU_PASSPORT NATIONAL_TAX_ID EU_VAT IBAN_CODE "
    "CREDIT_CARD MEDICAL_LICENSE MEDICAL_RECORD HEALTH_INSURANCE SWIFT_BIC INSURANCE_POLICY VEHICLE_PLATE CONTRACT_NUMBER BOOKING_REF COURT_CASE INVOICE_NUMBER"
).split()
TOKENIZED = (
    "PERSON EMAIL_ADDRESS PHONE_NUMBER STREET_ADDRESS LOCATION URL IP_ADDRESS CRYPTO SALARY HEALTH_CONDITION NRP RELIGION ETHNICITY "
    "SEXUAL_ORIENTATION TRADE_UNION CRIMINAL_RECORD"
).split()
BINNED = "DATE_OF_BIRTH DATE_TIME".split()
LEAST_SCORES = {"CREDIT_CARD": 0.0, "IBAN_CODE": 0.0, "EMAIL_ADDRESS": 0.0, "URL": 0.0, "CRYPTO": 0.0, "US_SSN": 0.3}
LEAST_SCORE = 0.4
MUST_ANONYMIZE = "MUST_ANONYMIZE"


def action_of(entity: str) -> Action:
    """What is done to a column of ``entity``; one that has no rule is scanned."""
    if entity == MUST_ANONYMIZE:
        return Action.REDACT
    for names, action in ((HASHED, Action.HASH), (TOKENIZED, Action.TOKENIZE), (BINNED, Action.BIN)):
        if entity in names:
            return action
    return Action.SCAN


def entities_of(regions: tuple[str, ...] = ()) -> list[str]:
    """All entities, without the national groups of regions left out. An unknown region
    counts for nothing, so unknown ones alone leave both groups out."""
    groups = dict(ENTITY_GROUPS)
    if regions:
        for region, group in REGION_GROUPS.items():
            if region not in regions:
                groups.pop(group)
    return [e for names in groups.values() for e in names]
