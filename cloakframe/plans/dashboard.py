"""Views over the audit tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UUID = r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
MAX_RUNS, MAX_OFFSET, MAX_ALERTS = 200, 10_000, 500
#: Longest name, reason and value of a control row.
NAME_CHARS, REASON_CHARS, VALUE_CHARS = 128, 500, 10_000


def kpis(runs: DataFrame) -> DataFrame:
    """Counts by status (a failed run has status 'failure'), sums and the latest start."""
    return runs.agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failure").alias("failed"),
        F.count_if(F.col("status") == "running").alias("running"),
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("rows_processed"),
        F.coalesce(F.sum("suppressed_rows"), F.lit(0)).alias("rows_suppressed"),
        F.max("started_at").alias("last_run"),
    )


def alerts_since(alerts: DataFrame, now: datetime, hours: int = 24) -> DataFrame:
    return alerts.where(F.col("created_at") > F.lit(now) - F.expr(f"INTERVAL {int(hours)} HOURS")).agg(F.count("*").alias("n_alerts"))


def recent_runs(runs: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id").offset(min(max(offset, 0), MAX_OFFSET)).limit(min(max(limit, 1), MAX_RUNS))


def recent_alerts(alerts: DataFrame, limit: int = 100) -> DataFrame:
    """Newest alerts; a run_id that is no UUID reads as null."""
    known = F.when(F.col("run_id").rlike(UUID), F.col("run_id"))
    return alerts.withColumn("run_id", known).orderBy(F.desc("created_at"), "alert_id").limit(min(max(limit, 1), MAX_ALERTS))


def run_of(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.where((F.col("run_id") == run_id) & F.col("run_id").rlike(UUID))


def stage_totals(runs: DataFrame) -> DataFrame:
    """run_id, total_seconds, stages by seconds, slowest first."""
    entries = F.transform(F.map_entries("stage_seconds"), lambda e: F.struct((-e["value"]).alias("m"), e["key"].alias("stage"), e["value"].alias("seconds")))
    return runs.select(
        "run_id",
        F.aggregate(F.map_values("stage_seconds"), F.lit(0.0), lambda acc, x: acc + x).alias("total_seconds"),
        F.transform(F.array_sort(entries), lambda e: F.struct(e["stage"], e["seconds"])).alias("stages"),
    )


def listed(table: DataFrame, *keys: str) -> DataFrame:
    return table.orderBy(*keys)


def valid_name(col: Column) -> Column:
    """An identifier of at most NAME_CHARS characters."""
    return col.rlike(r"^[A-Za-z_][A-Za-z0-9_.]*$") & (F.length(col) <= NAME_CHARS)


def valid_control(table: Column, column: Column, reason: Column) -> Column:
    return valid_name(table) & valid_name(column) & (F.length(F.coalesce(reason, F.lit(""))) <= REASON_CHARS)
