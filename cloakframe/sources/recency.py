"""The recency filter: rows of which any temporal column is at or after a cutoff."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name tokens that mark a string column as temporal.
TEMPORAL_TOKENS = frozenset("date time timestamp datetime created updated recorded captured occurred ts dt".split())


def name_tokens(name: str, camel: bool = True) -> list[str]:
    """Lower-case pieces of a name, cut at non-alphanumerics and, if ``camel``, before capitals."""
    if camel:
        name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return [t for t in re.split(r"[^A-Za-z0-9]+", name.lower()) if t]


def temporal_columns(schema: T.StructType) -> tuple[list[T.StructField], list[T.StructField]]:
    """(date and timestamp columns, string columns whose name has a temporal token)."""
    typed = [f for f in schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    text = [f for f in schema.fields if isinstance(f.dataType, T.StringType) and TEMPORAL_TOKENS & set(name_tokens(f.name))]
    return typed, text


def cutoff(days: int, now: datetime | None = None) -> datetime:
    return (now or datetime.now(UTC)) - timedelta(days=days)


def _bound(kind: T.DataType, at: datetime) -> Column:
    """A literal of the column's own type, so that the comparison reaches the scan."""
    naive = at.astimezone(UTC).replace(tzinfo=None) if at.tzinfo else at
    if isinstance(kind, T.TimestampType):
        return F.lit(naive.replace(tzinfo=UTC))
    return F.lit(naive.isoformat(sep=" ")).cast("timestamp_ntz")


def predicate(df: DataFrame, at: datetime) -> Column | None:
    """OR over the temporal columns; null counts as old. None if there are none."""
    typed, text = temporal_columns(df.schema)
    parts = [F.col(f"`{f.name}`") >= _bound(f.dataType, at) for f in typed]
    parts += [F.col(f"`{f.name}`").try_cast("timestamp_ntz") >= _bound(T.TimestampNTZType(), at) for f in text]
    return reduce(or_, parts) if parts else None


def recent(df: DataFrame, at: datetime) -> tuple[DataFrame, str]:
    """(rows, 'filtered'); everything and 'no_temporal_column' or 'all_old' where the filter
    can't be made or leaves nothing. One look for a first row decides; nothing is counted."""
    test = predicate(df, at)
    if test is None:
        return df, "no_temporal_column"
    kept = df.where(test)
    return (df, "all_old") if kept.isEmpty() else (kept, "filtered")
