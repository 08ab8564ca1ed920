"""Writing tables: overwrite with checked paths and typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(df: DataFrame) -> DataFrame:
    """Columns of nothing but null become strings; order and the rest stay."""
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def overwrite(df: DataFrame, uri: str, fmt: str = "parquet") -> None:
    """Replace the table at ``uri``; an empty frame leaves an empty table of its schema."""
    if not df.columns:
        raise ValueError("a table needs a column")
    typed(df).write.mode("overwrite").format(fmt).save(uri)


def append(df: DataFrame, uri: str, fmt: str = "parquet") -> None:
    typed(df).write.mode("append").format(fmt).save(uri)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` with the rows of ``changes`` in place of those of equal keys."""
    return current.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes)


def insert_missing(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``current`` and those rows of ``changes`` whose keys it has not."""
    return current.unionByName(changes.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti"))
