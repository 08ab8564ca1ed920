"""Settings of a run: control-table rows before environment before defaults."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

_TRUE = {"1", "true", "yes", "on"}


def csv(value: str | None) -> tuple[str, ...]:
    return tuple(x.strip() for x in (value or "").split(",") if x.strip())


def at_least(name: str, value: str, least: int) -> int:
    try:
        number = int(value)
    except ValueError:
        raise ValueError(f"{name} must be an integer") from None
    if number < least:
        raise ValueError(f"{name} must be {least} or more")
    return number


def truthy(value: str) -> bool:
    return value.strip().lower() in _TRUE


def float_or(value: str | None, default: float) -> float:
    try:
        return float(value) if value else default
    except ValueError:
        return default


@dataclass(frozen=True)
class EngineConfig:
    source_base: str = ""
    target_base: str = ""
    k_anonymity_min: int = 5
    k_anonymity_tables: frozenset[str] = frozenset()
    quasi_identifiers: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    identifier_cols: tuple[str, ...] = ()
    gps_precision: int = 1
    max_table_workers: int = 1
    read_lookback_days: int = 365
    enable_key_vault: bool = True
    hash_salt: str = ""
    regions: tuple[str, ...] = ()
    similarity_threshold: float = 0.55
    value_vote: bool = True
    must_anonymize_type: str = ""
    not_pii_type: str = ""
    exclusions: Mapping[str, frozenset[str]] = field(default_factory=dict)
    row_scan: Mapping[str, frozenset[str]] = field(default_factory=dict)
    strict: bool = False

    def k_for(self, table: str) -> int | None:
        """k for the listed tables; an empty list turns k-anonymity off everywhere."""
        return self.k_anonymity_min if table.lower() in self.k_anonymity_tables else None


def load(
    env: Mapping[str, str] | None = None,
    rows: Callable[[], Mapping[str, str]] | None = None,
    exclusions: Callable[[], Mapping[str, set[str]]] | None = None,
    row_scan: Callable[[], Mapping[str, set[str]]] | None = None,
) -> EngineConfig:
    """A config of control rows over ``env`` over defaults. Each loader may fail on its
    own; then what it would give is taken from ``env`` or left empty."""
    env = os.environ if env is None else env

    def loaded(f):
        try:
            return dict(f()) if f else {}
        except Exception:  # noqa: BLE001  a control table out of reach must not stop a run
            return {}

    control = loaded(rows)

    def get(name: str, default: str = "") -> str:
        return control.get(name, env.get(name, default))

    prefix = "QUASI_IDENTIFIER_COLS__"
    quasi = {k[len(prefix) :].lower(): csv(v) for source in (env, control) for k, v in source.items() if k.startswith(prefix)}
    return EngineConfig(
        source_base=get("SOURCE_BASE"),
        target_base=get("TARGET_BASE"),
        k_anonymity_min=at_least("K_ANONYMITY_MIN", get("K_ANONYMITY_MIN", "5"), 1),
        k_anonymity_tables=frozenset(t.lower() for t in csv(get("K_ANONYMITY_TABLES"))),
        quasi_identifiers=quasi,
        identifier_cols=csv(get("IDENTIFIER_COLS")),
        gps_precision=at_least("GPS_PRECISION", get("GPS_PRECISION", "1"), 0),
        max_table_workers=at_least("MAX_TABLE_WORKERS", get("MAX_TABLE_WORKERS", "1"), 1),
        read_lookback_days=at_least("READ_LOOKBACK_DAYS", env.get("READ_LOOKBACK_DAYS", "365"), 0),
        enable_key_vault=truthy(env.get("ENABLE_KEY_VAULT", "1")),
        hash_salt=env.get("HASH_SALT", ""),
        regions=tuple(r.lower() for r in csv(get("ANONYMIZATION_REGIONS"))),
        similarity_threshold=float_or(get("COLUMN_SIMILARITY_THRESHOLD"), 0.55),
        value_vote=truthy(get("ENABLE_VALUE_VOTE", "1")),
        must_anonymize_type=get("CATALOG_MUST_ANONYMIZE_TYPE"),
        not_pii_type=get("CATALOG_NOT_PII_TYPE"),
        exclusions={k.lower(): frozenset(v) for k, v in loaded(exclusions).items()},
        row_scan={k.lower(): frozenset(v) for k, v in loaded(row_scan).items()},
    )
