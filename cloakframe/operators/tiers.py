"""From columns to policies: external labels, names, values, likeness of names, fallback."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions import detect
from ..model import MUST_ANONYMIZE, Action, ColumnPolicy, action_of
from .profile import column_samples, free_text_values, identifier_name

# External label names by entity (the last part of a dotted label).
LABEL_ENTITIES = {
    "NAME": "PERSON", "PERSON_NAME": "PERSON", "EMAIL": "EMAIL_ADDRESS", "PHONE_NUMBER": "PHONE_NUMBER", "PHYSICAL_ADDRESS": "STREET_ADDRESS",
    "DATE_OF_BIRTH": "DATE_OF_BIRTH", "IPADDRESS": "IP_ADDRESS", "CREDIT_CARD_NUMBER": "CREDIT_CARD", "IBAN_CODE": "IBAN_CODE",
    "SOCIAL_SECURITY_NUMBER": "US_SSN", "NATIONAL_ID": "IDENTIFIER", "PERSON_ID": "IDENTIFIER",
}
#: What columns of an entity tend to be called, by language.
PHRASES = {
    "PERSON": {"en": ("first name", "last name", "full name", "surname"), "fr": ("prénom", "nom de famille", "nom complet"), "de": ("vorname", "nachname", "familienname"), "lb": ("virnumm", "familljennumm", "numm")},
    "EMAIL_ADDRESS": {"en": ("email", "mail address"), "fr": ("courriel", "adresse mail"), "de": ("mailadresse",), "lb": ("mailadress",)},
    "PHONE_NUMBER": {"en": ("phone", "telephone", "mobile number"), "fr": ("téléphone", "numéro de portable"), "de": ("telefon", "handynummer"), "lb": ("telefon", "handysnummer")},
    "STREET_ADDRESS": {"en": ("street address", "home address"), "fr": ("rue", "adresse du domicile"), "de": ("straße", "wohnanschrift"), "lb": ("strooss", "wunnadress")},
    "DATE_OF_BIRTH": {"en": ("birth date", "birthday"), "fr": ("né le", "jour de naissance"), "de": ("geburtstag",), "lb": ("gebuertsdag",)},
    "IDENTIFIER": {"en": ("unique key", "record identifier"), "fr": ("identifiant",), "de": ("schlüssel", "kennung"), "lb": ("schlëssel",)},
    "IBAN_CODE": {"en": ("iban", "account number"), "fr": ("numéro de compte",), "de": ("kontonummer",), "lb": ("kontosnummer",)},
    "CREDIT_CARD": {"en": ("card number", "payment card"), "fr": ("carte bancaire",), "de": ("kartennummer",), "lb": ("kaartennummer",)},
    "SALARY": {"en": ("salary", "monthly pay"), "fr": ("salaire",), "de": ("gehalt", "lohn"), "lb": ("salär", "loun")},
    "HEALTH_CONDITION": {"en": ("diagnosis", "illness"), "fr": ("diagnostic", "maladie"), "de": ("diagnose", "erkrankung"), "lb": ("diagnos", "krankheet")},
    "FREE_TEXT": {"en": ("comment", "remarks", "free text"), "fr": ("commentaire", "remarques"), "de": ("kommentar", "bemerkungen"), "lb": ("kommentar", "bemierkungen")},
}
#: Share of a column's non-null samples that must hold the winning entity.
VOTE = 0.5


def policy(column: str, entity: str, source: str, score: float) -> ColumnPolicy:
    return ColumnPolicy(column, entity, action_of(entity), source, score)


def external(labels: dict[str, list[str] | str], must: str = "") -> dict[str, ColumnPolicy]:
    """The MUST type redacts whatever else is said; else the first known type decides."""
    out = {}
    for column, types in labels.items():
        types = [types] if isinstance(types, str) else types
        if must and any(t.lower() == must.lower() for t in types):
            out[column] = policy(column, MUST_ANONYMIZE, "external", 1.0)
            continue
        known = [LABEL_ENTITIES[last] for t in types if (last := t.upper().rsplit(".", 1)[-1]) in LABEL_ENTITIES]
        if known:
            out[column] = policy(column, known[0], "external", 1.0)
    return out


def by_name(columns: list[str]) -> dict[str, ColumnPolicy]:
    return {c: policy(c, "IDENTIFIER", "name_pattern", 1.0) for c in columns if identifier_name(c)}


def by_values(samples: dict[str, list], analyze: Callable[[str], list] | None = None) -> dict[str, ColumnPolicy]:
    """The entity found in most of a column's values, if it is in VOTE of them or more.
    A column whose analysis fails has no vote."""
    find = analyze or (lambda s: detect.resolve(detect.analyze(s)))
    out = {}
    for c, values in samples.items():
        values = [v for v in values if isinstance(v, str) and v.strip()]
        hits: Counter[str] = Counter()
        try:
            for v in values:
                hits.update({f[0] for f in find(v) if 2 * (f[2] - f[1]) >= len(v.strip())})
        except Exception:  # noqa: BLE001
            continue
        if hits:
            entity, n = min(hits.items(), key=lambda x: (-x[1], x[0]))
            if n >= VOTE * len(values):
                out[c] = policy(c, entity, "value_vote", 0.9)
    return out


def _grams(text: str) -> Counter[str]:
    text = f" {' '.join(re.split(r'[^0-9a-zà-ÿ]+', re.sub(r'(?<=[a-zà-ÿ0-9])(?=[A-Z])', ' ', text).lower()))} "
    return Counter(text[i : i + 3] for i in range(len(text) - 2))


def likeness(a: str, b: str) -> float:
    """Cosine of the character trigrams of two phrases, camel case taken apart."""
    x, y = _grams(a), _grams(b)
    dot = sum(n * y[g] for g, n in x.items())
    return dot / math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values())) if dot else 0.0


def by_likeness(columns: list[str], threshold: float = 0.55, like: Callable[[str, str], float] = likeness, languages: tuple[str, ...] = ()) -> dict[str, ColumnPolicy]:
    """The entity whose phrase is likest to the name, in any of ``languages`` (none: in all).
    Word vectors can be given as ``like``; without them it is a likeness of letters."""
    out = {}
    for c in columns:
        said = [(like(c, p), e) for e, by in PHRASES.items() for language, phrases in by.items() if not languages or language in languages for p in phrases]
        score, entity = max(said, default=(0.0, ""))
        if score >= threshold:
            out[c] = policy(c, entity, "name_similarity", round(score, 6))
    return out


def fallback(samples: dict[str, list]) -> dict[str, ColumnPolicy]:
    return {c: ColumnPolicy(c, "FREE_TEXT", Action.SCAN if free_text_values(v) else Action.BIN, "fallback", 0.0) for c, v in samples.items()}


def classify(
    df: DataFrame,
    *,
    labels: dict[str, list[str] | str] | None = None,
    must: str = "",
    analyze: Callable[[str], list] | None = None,
    threshold: float = 0.55,
    value_vote: bool = True,
    samples: dict[str, list] | None = None,
) -> dict[str, ColumnPolicy]:
    """Policies of the text columns, tier by tier: each sees only what those before left."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    samples = column_samples(df, text) if samples is None else {c: samples[c] for c in text}
    out = {c: p for c, p in external(labels or {}, must).items() if c in df.columns}

    def left() -> list[str]:
        return [c for c in text if c not in out]

    out |= by_name(left())
    if value_vote:
        out |= by_values({c: samples[c] for c in left()}, analyze)
    out |= by_likeness(left(), threshold)
    out |= fallback({c: samples[c] for c in left()})
    return {c: out[c] for c in df.columns if c in out}


def with_labels(policies: dict[str, ColumnPolicy], labels: dict[str, list[str] | str], must: str = "") -> dict[str, ColumnPolicy]:
    """Precomputed policies and external labels: MUST displaces, other labels only fill in."""
    got = external(labels, must)
    return policies | {c: p for c, p in got.items() if p.entity == MUST_ANONYMIZE or c not in policies}


def not_pii(labels: dict[str, list[str] | str], type_name: str) -> list[str]:
    """Columns that the catalogue says hold no personal data."""
    return [c for c, t in labels.items() if type_name and any(x.lower() == type_name.lower() for x in ([t] if isinstance(t, str) else t))]
