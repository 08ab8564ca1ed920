"""Column transforms: pseudonyms, GPS rounding, day floors, quantile bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr


def present(df: DataFrame, cols: list[str] | tuple[str, ...]) -> list[str]:
    """Of ``cols`` those that the frame has, in their order and once."""
    return [c for c in dict.fromkeys(cols) if c in df.columns]


def replaced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """All replacements in one projection; order of columns as before."""
    return df.select(*[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def pseudonymize(df: DataFrame, cols: list[str], secret: bytes | None) -> tuple[DataFrame, list[str]]:
    """Keyed pseudonyms in ``cols``, of any type; missing columns are passed over."""
    cols = present(df, cols)
    if cols and secret is None:
        raise ValueError("identifier columns need a secret")
    return replaced(df, {c: expr.pseudonym(F.col(f"`{c}`"), df.schema[c].dataType, secret) for c in cols}), cols


def round_gps(df: DataFrame, cols: list[str], precision: int = 2) -> DataFrame:
    """Numbers rounded; strings of numbers become rounded doubles; else numbers inside the
    strings (WKT) are rounded. Whether a string column holds numbers is one aggregate over
    all of them."""
    cols = present(df, cols)
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    numeric_text: set[str] = set()
    if text:
        bad = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()).alias(c) for c in text]).first()
        numeric_text = {c for c in text if bad[c] == 0}
    new = {}
    for c in cols:
        kind, col = df.schema[c].dataType, F.col(f"`{c}`")
        if c in numeric_text:
            new[c] = expr.round_text(col, precision)
        elif c in text:
            new[c] = expr.round_wkt(col, precision)
        elif isinstance(kind, T.NumericType):
            new[c] = expr.round_number(col, kind, precision)
    return replaced(df, new)


def floor_days(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Timestamps at midnight; dates are listed and stay; other columns are passed over."""
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    cols = [c for c in present(df, cols) if isinstance(df.schema[c].dataType, kinds)]
    return replaced(df, {c: expr.floor_day(F.col(f"`{c}`"), df.schema[c].dataType) for c in cols}), cols


def _label(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else f"{x:.4g}"


def bin_edges(df: DataFrame, cols: list[str], n_bins: int = 5) -> dict[str, list[float]]:
    """Distinct quantiles i / n_bins of each column, all in one job; none for a column of
    fewer than two values."""
    at = [i / n_bins for i in range(n_bins + 1)]
    if not cols:
        return {}
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in cols}
    got = df.agg(*[F.percentile(values[c], at).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        edges = sorted(set(got[f"q{i}"] or []))
        if len(edges) >= 2:
            out[c] = edges
    return out


def bin_numbers(df: DataFrame, cols: list[str], n_bins: int = 5) -> tuple[DataFrame, list[str]]:
    """Numbers as labels of their quantile bin, closed on the right and open at the ends.
    Columns of one value, or whose labels would be the same, stay."""
    cols = [c for c in present(df, cols) if isinstance(df.schema[c].dataType, T.NumericType)]
    new = {}
    for c, edges in bin_edges(df, cols, n_bins).items():
        labels = [f"{_label(a)}–{_label(b)}" for a, b in zip(edges[:-1], edges[1:], strict=True)]
        if len(set(labels)) < len(labels):
            continue
        col, out = F.col(f"`{c}`"), None
        for edge, label in zip(edges[1:-1], labels, strict=False):
            out = F.when(col <= edge, label) if out is None else out.when(col <= edge, label)
        known = ~expr.is_missing(col, df.schema[c].dataType)
        new[c] = F.when(known, F.lit(labels[-1]) if out is None else out.otherwise(labels[-1]))
    return replaced(df, new), list(new)
