"""The audit trail: append-only tables, read as their latest versions."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import asdict
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import RunRecord

SCHEMAS = {
    "runs": (
        "run_id string, version int, started_at timestamp, finished_at timestamp, table_name string, source_uri string, target_uri string, status string, error_msg string, "
        "total_rows bigint, total_columns int, columns_scanned int, columns_hit array<string>, entities_total bigint, entity_counts map<string,bigint>, unique_entities map<string,bigint>, "
        "free_text_cols array<string>, k_anonymity_k int, quasi_columns array<string>, suppressed_rows bigint, residual_pii bigint, gps_columns array<string>, timestamp_cols_binned array<string>, "
        "numeric_cols_binned array<string>, hashed_columns array<string>, stage_seconds map<string,double>, catalog_ok boolean, catalog_flagged array<string>, catalog_diffs array<string>, "
        "output_type string, aggregate_cells bigint, skipped_columns map<string,string>"
    ),
    "column_events": "run_id string, column_name string, detections bigint, entity_counts map<string,bigint>, processed_at timestamp",
    "alerts": "alert_id string, run_id string, table_name string, subject string, body string, severity string, created_at timestamp",
    "config": "key string, value string, description string, updated_at timestamp",
    "exclusions": "table_name string, column_name string, reason string, created_at timestamp",
    "targets": "source_uri string, target_uri string, table_name string, enabled boolean",
    "row_scan": "table_name string, column_name string, created_at timestamp",
}


class Audit:
    """Tables under ``base``; one that was never written reads as empty."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self.spark, self.base, self.fmt = spark, base.rstrip("/"), fmt

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def read(self, table: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).format(self.fmt).load(self.path(table))

    def add(self, table: str, rows: list[Mapping]) -> None:
        names = [x.split()[0] for x in _fields(SCHEMAS[table])]
        data = [tuple(r.get(n) for n in names) for r in rows]
        self.spark.createDataFrame(data, SCHEMAS[table]).coalesce(1).write.mode("append").format(self.fmt).save(self.path(table))

    def runs(self) -> DataFrame:
        """Each run as it was last written."""
        latest = F.row_number().over(W.partitionBy("run_id").orderBy(F.desc("version")))
        return self.read("runs").withColumn("_v", latest).where("_v = 1").drop("_v")

    def open_run(self, run: RunRecord) -> None:
        self._write(run, 0, None)

    def close_run(self, run: RunRecord) -> None:
        self._write(run, 1, datetime.now(UTC))

    def _write(self, run: RunRecord, version: int, finished: datetime | None) -> None:
        row = asdict(run) | {"version": version, "started_at": self.started.setdefault(run.run_id, datetime.now(UTC)), "finished_at": finished, "entities_total": sum(run.entity_counts.values())}
        self.add("runs", [row])

    started: dict[str, datetime] = {}

    def column_events(self, run_id: str, counts: Mapping[str, Mapping[str, int]]) -> None:
        now = datetime.now(UTC)
        if counts:
            self.add("column_events", [{"run_id": run_id, "column_name": c, "detections": sum(n.values()), "entity_counts": dict(n), "processed_at": now} for c, n in counts.items()])

    def alert(self, run: RunRecord, subject: str, body: str) -> None:
        self.add("alerts", [{"alert_id": str(uuid.uuid4()), "run_id": run.run_id, "table_name": run.table_name, "subject": subject, "body": body, "severity": "error", "created_at": datetime.now(UTC)}])

    def config_rows(self) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.read("config").collect()}

    def grouped(self, table: str) -> dict[str, set[str]]:
        """{lower-cased table: columns} of exclusions or row_scan."""
        return {r["t"]: set(r["c"]) for r in column_sets(self.read(table)).collect()}


def _fields(schema: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]


def column_sets(rows: DataFrame) -> DataFrame:
    """t (lower-cased table name), c (its columns, sorted)."""
    return rows.groupBy(F.lower("table_name").alias("t")).agg(F.array_sort(F.collect_set("column_name")).alias("c"))
