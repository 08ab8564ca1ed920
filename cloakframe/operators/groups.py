"""k-anonymity and trajectory aggregates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import present


def k_anonymous(df: DataFrame, quasi: list[str], k: int, how: str = "join") -> DataFrame:
    """Rows whose quasi-identifier values at least ``k`` rows share; nulls are values.

    'join' counts with map-side combining and keeps rows by a null-safe semi-join, so a
    value that a third of all rows have costs one partial row a task; 'window' counts in
    place, for small tables. Without any of the columns, ``df`` as it is.
    """
    quasi = present(df, quasi)
    if not quasi:
        return df
    if how == "window":
        name = "_k_rows"
        counted = df.withColumn(name, F.count("*").over(W.partitionBy(*[F.col(f"`{c}`") for c in quasi])))
        return counted.where(F.col(name) >= k).drop(name)
    groups = df.groupBy(*[F.col(f"`{c}`").alias(f"_k_{i}") for i, c in enumerate(quasi)]).agg(F.count("*").alias("_k_n")).where(F.col("_k_n") >= k)
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(quasi)])
    return df.join(groups, same, "left_semi")


def suppressed(df: DataFrame, quasi: list[str], k: int) -> int:
    """How many rows k_anonymous drops: from the group counts alone."""
    quasi = present(df, quasi)
    if not quasi:
        return 0
    got = df.groupBy(*[F.col(f"`{c}`") for c in quasi]).count().where(F.col("count") < k).agg(F.sum("count")).first()
    return got[0] or 0


def as_timestamp(col: Column, kind: T.DataType) -> Column:
    """A timestamp of a timestamp, date or string; null where the string is none."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return col
    return col.cast("timestamp_ntz") if isinstance(kind, T.DateType) else col.try_cast("timestamp_ntz")


def trajectory_cells(df: DataFrame, gps: list[str], speed: str, ts: str) -> DataFrame:
    """Cells of place, hour and weekday with counts and speeds; before suppression.

    ping_count is of non-null speeds; a timestamp that can't be read has null hour and day.
    """
    at = as_timestamp(F.col(f"`{ts}`"), df.schema[ts].dataType)
    keyed = df.select(*[F.col(f"`{c}`") for c in gps], F.hour(at).alias("hour_of_day"), F.date_format(at, "EEEE").alias("day_of_week"), F.col(f"`{speed}`").cast("double").alias("_speed"))
    return keyed.groupBy(*gps, "hour_of_day", "day_of_week").agg(
        F.count("_speed").alias("ping_count"),
        F.avg("_speed").alias("avg_speed_kmh"),
        F.percentile("_speed", 0.5).alias("p50_speed_kmh"),
        F.percentile("_speed", 0.85).alias("p85_speed_kmh"),
    )


def trajectory(df: DataFrame, gps: list[str], speed: str, ts: str, k: int) -> DataFrame:
    return trajectory_cells(df, gps, speed, ts).where(F.col("ping_count") >= k)


def trajectory_stats(df: DataFrame, gps: list[str], speed: str, ts: str, k: int) -> DataFrame:
    """cells_retained, cells_total, pings_suppressed (rows less kept pings: null speeds too)."""
    at = as_timestamp(F.col(f"`{ts}`"), df.schema[ts].dataType)
    cells = df.groupBy(*[F.col(f"`{c}`") for c in gps], F.hour(at).alias("h"), F.date_format(at, "EEEE").alias("d")).agg(F.count(f"`{speed}`").alias("pings"), F.count("*").alias("rows"))
    kept = F.col("pings") >= k
    return cells.agg(
        F.count_if(kept).alias("cells_retained"),
        F.count("*").alias("cells_total"),
        (F.coalesce(F.sum("rows"), F.lit(0)) - F.coalesce(F.sum(F.when(kept, F.col("pings"))), F.lit(0))).alias("pings_suppressed"),
    )
