"""Column profiles: identifiers, quasi-identifiers, free text, GPS, time and speed columns."""

from __future__ import annotations

import math
import re
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

from dateutil import parser as dates
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import Category, ColumnProfile
from ..sources.recency import name_tokens

SAMPLE_VALUES, FEW_VALUES, SAMPLE_ROWS = 100, 20, 500
# Name tokens.
ID_TOKENS = frozenset("id ids uuid guid identifier identifiers key pk fk".split())
GPS_TOKENS = frozenset("lat latitude lon lng longitude gps coord coords coordinate coordinates geom geometry wkt point".split())
TIME_TOKENS = frozenset("time timestamp datetime date at created updated recorded captured ts dt occurred".split())
SPEED_TOKENS = frozenset("speed velocity kmh mph knots spd".split())
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def tokens(name: str) -> set[str]:
    return set(name_tokens(name, camel=False))


def identifier_name(name: str) -> bool:
    return any(t in ID_TOKENS or (len(t) > 2 and t.endswith("id")) for t in tokens(name))


def missing(v) -> bool:
    return v is None or (isinstance(v, float) and math.isnan(v))


def column_samples(df: DataFrame, cols: list[str] | None = None, n: int = SAMPLE_VALUES) -> dict[str, list]:
    """The first ``n`` values of each column that are not null: from SAMPLE_ROWS rows, and of
    a column that is sparse there from its own non-null rows."""
    cols = df.columns if cols is None else cols
    rows = df.select(*[F.col(f"`{c}`") for c in cols]).limit(SAMPLE_ROWS).collect()
    out = {}
    for i, c in enumerate(cols):
        out[c] = [r[i] for r in rows if not missing(r[i])][:n]
        if len(out[c]) < n and len(rows) == SAMPLE_ROWS:
            out[c] = [r[0] for r in df.select(F.col(f"`{c}`")).where(F.col(f"`{c}`").isNotNull()).limit(n).collect() if not missing(r[0])]
    return out


def unique_ratio(values: list) -> float:
    said = [str(v) for v in values if not missing(v)]
    return len(set(said)) / len(said) if said else 0.0


def identifier_values(values: list) -> bool:
    """Mostly different, shaped like codes, many with letters and digits both."""
    said = [s for s in (str(v).strip() for v in values) if s]
    if not said:
        return False
    shaped = sum(re.fullmatch(r"[A-Za-z0-9_.:@/-]{3,128}", s) is not None for s in said)
    both = sum(re.search("[0-9]", s) is not None and re.search("[A-Za-z]", s) is not None for s in said)
    return unique_ratio(said) >= 0.75 and shaped >= 0.8 * len(said) and both >= 0.5 * len(said)


def quasi_values(values: list, kind: T.DataType) -> bool:
    if isinstance(kind, TEMPORAL):
        return True
    ratio = unique_ratio(values)
    if isinstance(kind, T.NumericType):
        inside = sum(0 <= float(v) <= 130 for v in values)
        return bool(values) and ratio <= 0.4 and inside >= 0.8 * len(values)
    return 0 < ratio <= 0.35


def free_text_values(values: list) -> bool:
    said = [v.strip() for v in values if isinstance(v, str) and v.strip()]
    if not said:
        return False
    n = len(said)
    return sum(map(len, said)) >= 32 * n or sum(len(s.split()) for s in said) >= 5 * n or sum(s[0] in "{[" for s in said) >= 0.5 * n


def entropy(values: list) -> float:
    n = len(values)
    return -sum(m / n * math.log2(m / n) for m in Counter(map(str, values)).values()) if n else 0.0


def sensitive_values(values: list, kind: T.DataType) -> bool:
    n = len(values)
    return not isinstance(kind, T.BooleanType) and n >= 5 and len(set(map(str, values))) <= max(8, 0.2 * n) and entropy(values) > 0


# --- the same measures as aggregates, over a whole column ---------------------------


def unique_share(col: Column) -> Column:
    return F.count_distinct(col) / F.count(col)


def code_share(col: Column) -> Column:
    """Share of values shaped like codes with letters and digits both."""
    ok = F.trim(col).rlike(r"^[A-Za-z0-9_.:@/-]{3,128}$") & col.rlike("[0-9]") & col.rlike("[A-Za-z]")
    return F.avg(ok.cast("double"))


def inside_share(col: Column, low: float, high: float) -> Column:
    """Share of the values that are not null in [low, high]."""
    return F.avg(F.when(col.isNotNull(), col.between(low, high).cast("double")))


def all_inside(col: Column, low: float, high: float) -> Column:
    return (F.min(col) >= low) & (F.max(col) <= high)


def quasi_number(col: Column) -> Column:
    """Whether a numeric column repeats its values, and they are those of an age or the like."""
    return (F.count_distinct(col) <= 0.4 * F.count(col)) & (inside_share(col, 0, 130) >= 0.8)


def text_lengths(col: Column) -> tuple[Column, Column]:
    """Mean characters and words of the values."""
    edge = r"[ \t\n\r\f\x0B]+"
    words = F.size(F.split(F.regexp_replace(col, f"^{edge}|{edge}$", ""), edge))
    return F.avg(F.length(col)), F.avg(words)


def document_share(col: Column) -> Column:
    """Share of values that begin like a JSON object or array."""
    return F.avg(F.substring(F.trim(col), 1, 1).isin("{", "[").cast("double"))


def entropy_of(df: DataFrame, col: str) -> DataFrame:
    """One row: the entropy of a column's values in bits. Only counts of values are shuffled."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    # sum p log p = sum n log n / N - log N
    return counts.agg((F.log2(F.sum("n").cast("double")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("entropy"))


def classify(df: DataFrame, samples: dict[str, list] | None = None) -> list[ColumnProfile]:
    """A profile of every column, in order."""
    samples = column_samples(df) if samples is None else samples
    out = []
    for f in df.schema.fields:
        values, got = samples[f.name], set()
        if identifier_name(f.name) or identifier_values(values):
            got.add(Category.IDENTIFIER)
        elif quasi_values(values, f.dataType):
            got.add(Category.QUASI_IDENTIFIER)
        if isinstance(f.dataType, T.StringType) and free_text_values(values):
            got.add(Category.FREE_TEXT)
        if sensitive_values(values, f.dataType):
            got.add(Category.SENSITIVE)
        out.append(ColumnProfile(f.name, frozenset(got)))
    return out


def columns_of(profiles: list[ColumnProfile], category: Category) -> list[str]:
    return [p.name for p in profiles if category in p.categories]


def chosen(df: DataFrame, explicit: list[str] | tuple[str, ...], profiles: list[ColumnProfile], category: Category) -> list[str]:
    """``explicit`` without the columns that are missing; if it is empty, the profiled ones."""
    return [c for c in explicit if c in df.columns] if explicit else columns_of(profiles, category)


def gps_columns(df: DataFrame) -> list[str]:
    """Columns named like coordinates whose values all lie in [-180, 180] (numbers, and
    strings that all are numbers), or whose samples are WKT points. One aggregate job."""
    named = [f for f in df.schema.fields if tokens(f.name) & GPS_TOKENS]
    numeric = [f.name for f in named if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    named_text = [f.name for f in named if isinstance(f.dataType, T.StringType)]
    found = set()
    if numeric or named_text:
        checks = []
        for c in numeric + named_text:
            v = F.col(f"`{c}`").try_cast("double")
            bad = F.count_if(F.col(f"`{c}`").isNotNull() & (v.isNull() | F.isnan(v) | ~v.between(-180.0, 180.0)))
            checks += [bad.alias(f"bad_{c}"), F.count(F.col(f"`{c}`")).alias(f"n_{c}")]
        got = df.agg(*checks).first()
        found = {c for c in numeric + named_text if got[f"n_{c}"] and not got[f"bad_{c}"]}
    points = column_samples(df, text, FEW_VALUES) if text else {}
    for c, values in points.items():
        if values and sum(re.match(r"\s*POINT\s*\(", v, re.I) is not None for v in values) >= 0.8 * len(values):
            found.add(c)
    return [c for c in df.columns if c in found]


def readable_date(value) -> bool:
    if isinstance(value, (date, datetime)):
        return True
    try:
        dates.parse(str(value))
    except (ValueError, OverflowError, TypeError):
        return False
    return True


def timestamp_columns(df: DataFrame) -> list[str]:
    """Temporal columns, and strings named like times of which 8 in 10 samples parse."""
    named = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and tokens(f.name) & TIME_TOKENS]
    samples = column_samples(df, named, FEW_VALUES) if named else {}
    parsed = {c for c, v in samples.items() if v and sum(map(readable_date, v)) >= 0.8 * len(v)}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TEMPORAL) or f.name in parsed]


def speed_column(df: DataFrame) -> str | None:
    """The first numeric column named like a speed of which 8 in 10 values lie in [0, 300]."""
    named = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and tokens(f.name) & SPEED_TOKENS]
    if not named:
        return None
    got = df.agg(*[inside_share(F.col(f"`{c}`"), 0, 300).alias(c) for c in named]).first()
    return next((c for c in named if (got[c] or 0) >= 0.8), None)


def has_tracking(df: DataFrame) -> bool:
    return bool(gps_columns(df)) or any("ip" in tokens(c) for c in df.columns)


def as_number(v) -> float | None:
    try:
        return float(v) if isinstance(v, (int, float, Decimal, str)) else None
    except ValueError:
        return None
