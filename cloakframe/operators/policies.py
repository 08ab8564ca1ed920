"""Applying policies: all columns in one projection, one aggregate for the counts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr
from ..model import Action, ColumnPolicy
from . import tokens
from .columns import replaced


@dataclass
class Applied:
    columns_processed: list[str] = field(default_factory=list)
    actions: dict[str, str] = field(default_factory=dict)
    entities: dict[str, str] = field(default_factory=dict)
    values_masked: dict[str, int] = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)


def apply(df: DataFrame, policies: dict[str, ColumnPolicy], *, secret: bytes | None, position: Column | None = None, strict: bool = False) -> tuple[DataFrame, Applied]:
    """``df`` with its policies done, and what was done.

    A HASH column without a secret, or a TOKENIZE one without a row order, is skipped and
    said so; with ``strict`` that is an error.
    """
    stats, hashed, redacted, tokened = Applied(), [], [], {}
    here = [c for c in policies if c in df.columns]
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(here)]).first() if here else []
    known = dict(zip(here, counts, strict=True))
    for c, p in policies.items():
        reason = None
        if c not in df.columns:
            reason = "missing_column"
        elif p.action == Action.BIN:
            reason = "deferred_to_binning"
        elif p.action == Action.SCAN:
            reason = "deferred_to_row_scan"
        elif not known[c]:
            reason = "no_non_null_values"
        elif p.action == Action.HASH and secret is None:
            reason = "missing_pseudonymizer"
        elif p.action == Action.TOKENIZE and position is None:
            reason = "missing_registry"
        if reason:
            if strict and reason.startswith("missing_") and reason != "missing_column":
                raise ValueError(f"{c}: {reason}")
            stats.skipped[c] = reason
            continue
        if p.action == Action.HASH:
            hashed.append(c)
        elif p.action == Action.REDACT:
            redacted.append(c)
        else:
            tokened[c] = p.entity
        stats.columns_processed.append(c)
        stats.actions[c], stats.entities[c], stats.values_masked[c] = str(p.action), p.entity, known[c]
    out = tokens.tokenize(df, tokened, position) if tokened else df
    new = {c: expr.pseudonym(F.col(f"`{c}`"), df.schema[c].dataType, secret) for c in hashed}
    new |= {c: expr.redact(F.col(f"`{c}`")) for c in redacted}
    return replaced(out, new), stats
