import subprocess
import sys
import urllib.request
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from cloakframe import config as configs
from cloakframe.health import Probes
from cloakframe.model import TableMapping
from cloakframe.plans import dashboard, run_table
from cloakframe.plans.audit import Audit
from cloakframe.sources import recency, sinks, tables
from cloakframe.streaming import stream
from conftest import ROOT

NOW = datetime(2024, 6, 1, tzinfo=UTC)


def test_recency(spark):
    df = spark.createDataFrame([(1, datetime(2024, 5, 1), "x"), (2, datetime(2001, 1, 1), "2024-05-05"), (3, None, "bad"), (4, datetime(2001, 1, 1), None)], "id int, created_at timestamp_ntz, event_date string")
    kept, how = recency.recent(df, recency.cutoff(365, NOW))
    assert how == "filtered" and sorted(r.id for r in kept.collect()) == [1, 2]
    assert recency.recent(df, datetime(2090, 1, 1))[1] == "all_old" and recency.recent(df.select("id"), NOW)[1] == "no_temporal_column"


def test_recency_reaches_the_scan(spark, small):
    df = spark.read.parquet(f"{small}/orders.parquet")
    plan = recency.recent(df, datetime(1998, 1, 1))[0]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_names():
    assert recency.name_tokens("lastUpdateTime") == ["last", "update", "time"]
    assert tables.quote_tsql("a]b") == "[a]]b]" and tables.quote_ansi('a"b') == '"a""b"'
    assert tables.endpoint_query("t", limit=3) == "SELECT TOP (3) * FROM [dbo].[t]"
    assert tables.parse_uri("abfss://fs@h/a/b") == ("fs", "h", "a/b") == tables.parse_uri("https://h/fs/a/b")
    assert tables.target_of("/x/Tables/dbo/t", "/y/Tables") == "/y/Tables/dbo/t"
    for source, base in (("/x/t", "/y/Tables"), ("/x/Tables/t", "/y/Files/Tables2"), ("/x/Tables/t", "/y/Files/a/Tables")):
        with pytest.raises(ValueError):
            tables.target_of(source, base)
    with pytest.raises(ValueError):
        tables.check_apart("/a/T/", "/A/t")
    assert tables.endpoint_temporal([("a", "datetime2"), ("created_on", "nvarchar"), ("n", "int")]) == ["a", "created_on"]
    with pytest.raises(RuntimeError):
        tables.read(None, TableMapping("a", "b", "t", "odd"))


def test_discovery(spark, tmp_path):
    for name in ("dbo/a", "dbo/b", "other"):
        (tmp_path / "Tables" / name / "_delta_log").mkdir(parents=True)
    found = tables.discover(spark, str(tmp_path / "Tables"), "/out/Tables", endpoint_tables=lambda: [("dbo", "A"), ("dbo", "c")])
    assert sorted((m.table, m.mode) for m in found) == [("a", "lake"), ("b", "lake"), ("c", "sql"), ("other", "lake")] or ("other", "lake") in {(m.table, m.mode) for m in found}
    given = [TableMapping("s", "t", "x")]
    assert tables.discover(spark, "", "", targets=given) == given
    assert tables.catalog_labels(lambda: 1 / 0, ["a"]) == ({}, [])
    assert tables.catalog_labels(lambda: {"a": "X", "z": ["Y"]}, ["a"]) == ({"a": ["X"]}, ["z"])


def test_config():
    c = configs.load({"K_ANONYMITY_MIN": "3", "K_ANONYMITY_TABLES": "A, b", "QUASI_IDENTIFIER_COLS__T": "x,y"}, lambda: {"K_ANONYMITY_MIN": "9"}, lambda: 1 / 0)
    assert c.k_anonymity_min == 9 and c.k_for("B") == 9 and c.k_for("c") is None and c.quasi_identifiers["t"] == ("x", "y")
    with pytest.raises(ValueError):
        configs.load({"GPS_PRECISION": "-1"})


def test_sinks(spark, tmp_path):
    sinks.overwrite(spark.sql("SELECT 1 AS a, NULL AS b WHERE false"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).dtypes == [("a", "int"), ("b", "string")]
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert sorted(map(tuple, sinks.upsert(a, b, ["k"]).collect())) == [(1, "x"), (2, "z"), (3, "w")]
    assert sorted(map(tuple, sinks.insert_missing(a, b, ["k"]).collect())) == [(1, "x"), (2, "y"), (3, "w")]


def test_run_all_isolates_failures_and_audits(spark, tmp_path):
    source = tmp_path / "in" / "people"
    rows = [(f"u{i}", f"p{i % 4}@x.example", 20 + i % 2, f"hello p{i}@y.example from here and there", datetime(2024, 5, 1)) for i in range(12)]
    spark.createDataFrame(rows, "user_id string, email string, age int, notes string, created_at timestamp_ntz").write.parquet(str(source))
    c = configs.EngineConfig(enable_key_vault=False, k_anonymity_min=3, k_anonymity_tables=frozenset({"people"}), quasi_identifiers={"people": ("age",)}, row_scan={"people": frozenset({"notes"})})
    audit = Audit(spark, str(tmp_path / "audit"))
    good, bad = TableMapping(str(source), str(tmp_path / "out"), "people"), TableMapping(str(tmp_path / "none"), str(tmp_path / "o2"), "none")
    done = run_table.run_all(spark, c, [bad, good], audit, now=NOW)
    assert isinstance(done[0], Exception) and done[1].status == "success" and done[1].suppressed_rows == 0
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == ["user_id", "email", "age", "notes", "created_at"] and out.count() == 12
    r = out.first()
    assert len(r.user_id) == 24 and r.email.startswith("EMAIL_ADDRESS_") and "EMAIL_ADDRESS_" in r.notes and "@" not in r.notes
    assert done[1].hashed_columns == ["user_id"] and done[1].residual_pii == 0
    events = {x.column_name: (x.detections, x.entity_counts) for x in audit.read("column_events").collect()}
    assert events == {"email": (12, {"EMAIL_ADDRESS": 12}), "notes": (12, {"EMAIL_ADDRESS": 12})}
    runs = audit.runs()
    assert {(x.table_name, x.status) for x in runs.collect()} == {("people", "success"), ("none", "failure")}
    k = dashboard.kpis(runs).first()
    assert (k.total_runs, k.succeeded, k.failed) == (2, 1, 1)
    assert dashboard.recent_alerts(audit.read("alerts")).count() == 1
    assert dashboard.stage_totals(runs).where("total_seconds > 0").count() >= 1
    assert dashboard.run_of(runs, done[1].run_id).count() == 1


def test_trajectory_run(spark, tmp_path):
    rows = [(50.12 + 0.001 * (i % 2), 6.13, datetime(2024, 5, 1, 8, i), 30.0 + i, "secret") for i in range(10)]
    spark.createDataFrame(rows, "lat double, lon double, ts timestamp_ntz, speed double, driver string").write.parquet(str(tmp_path / "in"))
    run = run_table.run_table(spark, configs.EngineConfig(enable_key_vault=False), TableMapping(str(tmp_path / "in"), str(tmp_path / "out"), "trips"), now=NOW)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert run.output_type == "aggregate" and out.count() == 1 and "driver" not in out.columns and out.first().ping_count == 10


def test_same_source_and_target_is_refused(spark):
    with pytest.raises(ValueError):
        run_table.run_table(spark, configs.EngineConfig(), TableMapping("/a/b", "/A/b/", "t"))


def test_streaming_windows(spark, tmp_path):
    rows = [(1.0, 2.0, datetime(2024, 1, 1, h, m), 10.0) for h, m in ((8, 1), (8, 2), (8, 3), (9, 1), (15, 0))]
    schema = "lat double, lon double, ts timestamp, speed double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    cells = stream.trajectory_windows(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["lat", "lon"], "speed", "ts", 3)
    q = cells.writeStream.format("memory").queryName("cells").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r.ping_count for r in spark.sql("SELECT * FROM cells").collect()] == [3]


def test_probes():
    p = Probes()
    assert (p.answer("/health/live/?x=1"), p.answer("/health/ready"), p.answer("/x")) == (200, 503, 404)
    server = p.serve(0)
    assert urllib.request.urlopen(f"http://127.0.0.1:{server.server_port}/health/live").status == 200
    server.shutdown()


def test_entry_without_the_subpackage(tmp_path):
    """With llm and the pipeline gone, the entry still imports and has the other queries."""
    import shutil

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'kanon_window' in q and not any(x.startswith('op') for x in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True)


_ = F
