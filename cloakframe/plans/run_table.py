"""One table from source to target, stage by stage, and many tables beside each other.

The order of stages matters: each works on what those before made. Projections are
folded by Catalyst; a run costs the profile and count jobs, the dictionary and the
write. What several actions read is persisted once, on disk where memory is short.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EngineConfig
from ..functions import expr
from ..model import Action, Category, ColumnPolicy, RunRecord, TableMapping, entities_of
from ..operators import columns as cols
from ..operators import groups, policies, profile, residual, scan, tiers
from ..sources import recency, sinks, tables
from .audit import Audit

POSITION = "__row_position"


def with_position(df: DataFrame) -> DataFrame:
    """``df`` with a row position that does not depend on how it is partitioned: the row's
    index in its file, files in order of a hash of their path."""
    if not df.inputFiles():
        return df.withColumn(POSITION, F.monotonically_increasing_id())
    file = F.shiftleft(F.xxhash64("_metadata.file_path").bitwiseAND(F.lit((1 << 22) - 1)), 40)
    return df.withColumn(POSITION, file + F.col("_metadata.row_index"))


def secret_of(config: EngineConfig, vault: Callable[[], bytes] | None) -> bytes | None:
    """The vault's secret; the local one if the vault is off; None if it is on but not set up."""
    if not config.enable_key_vault:
        return expr.local_secret(config.hash_salt)
    return vault() if vault else None


def run_table(
    spark: SparkSession,
    config: EngineConfig,
    mapping: TableMapping,
    audit: Audit | None = None,
    *,
    now: datetime | None = None,
    vault: Callable[[], bytes] | None = None,
    labels: Callable[[], dict] | None = None,
    given: dict[str, ColumnPolicy] | None = None,
    fmt: str = "parquet",
    read_options: dict | None = None,
) -> RunRecord:
    """Anonymise one table and write it. A failure is recorded, alerted and raised again."""
    run = RunRecord(str(uuid.uuid4()), mapping.table, mapping.source, mapping.target)
    tables.check_apart(mapping.source, mapping.target)

    def tell(f: Callable[[], None]) -> None:
        try:
            if audit is not None:
                f()
        except Exception:  # noqa: BLE001  an audit out of reach must not stop a run
            if config.strict:
                raise

    @contextmanager
    def stage(name: str):
        began = time.monotonic()
        try:
            yield
        finally:
            run.stage_seconds[name] = round(run.stage_seconds.get(name, 0.0) + time.monotonic() - began, 6)

    tell(lambda: audit.open_run(run))
    held: list[DataFrame] = []
    try:
        with stage("read"):
            source = tables.read(spark, mapping, None, **(read_options or {}), **({} if mapping.mode == "sql" else {"fmt": fmt}))
            source = with_position(source)
            df, _ = recency.recent(source, recency.cutoff(config.read_lookback_days, now))
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(df)
            run.total_rows, run.total_columns = df.count(), len(df.columns) - 1

        def keep(found: DataFrame) -> DataFrame:
            held.append(found.persist(StorageLevel.MEMORY_AND_DISK))
            return found

        out = transform(df, config, mapping.table, run, stage, secret=secret_of(config, vault), labels=labels, given=given, keep=keep)
        with stage("write"):
            sinks.overwrite(out, mapping.target, fmt)
        run.status, run.error_msg = "success", ""
        tell(lambda: audit.column_events(run.run_id, run.column_entities))
        if run.residual_pii:
            tell(lambda: audit.alert(run, "residual personal data", f"{run.residual_pii} findings in {run.table_name}"))
        return run
    except Exception as error:
        run.status, run.error_msg = "failure", str(error)[:2000]
        tell(lambda: audit.alert(run, "run failed", run.error_msg))
        raise
    finally:
        for x in held:
            x.unpersist()
        tell(lambda: audit.close_run(run))


def transform(df: DataFrame, config: EngineConfig, table: str, run: RunRecord, stage, *, secret: bytes | None, labels=None, given: dict[str, ColumnPolicy] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The stages between reading and writing. ``df`` has POSITION, the result has not;
    ``keep`` holds what the text scan finds until the table is written."""
    position = F.col(POSITION)
    samples = None
    with stage("gps_detection_and_transform"):
        run.gps_columns = profile.gps_columns(df.drop(POSITION))
        speed = ts = None
        if run.gps_columns:
            df = cols.round_gps(df, run.gps_columns, config.gps_precision)
            times = profile.timestamp_columns(df.drop(POSITION))
            speed, ts = profile.speed_column(df.drop(POSITION)), (times or [None])[0]
            if not (speed and ts):
                with stage("timestamp_binning"):
                    df, run.timestamp_cols_binned = cols.floor_days(df, times)
    trajectory = bool(run.gps_columns and speed and ts)
    excluded = config.exclusions.get(table.lower(), frozenset())
    with stage("column_classification"):
        plain = df.drop(POSITION)
        samples = profile.column_samples(plain)
        profiles = profile.classify(plain, samples)
    with stage("identifier_pseudonymization"):
        ids = profile.chosen(plain, config.identifier_cols, profiles, Category.IDENTIFIER)
        if config.strict:
            ids = [c for c in ids if c not in excluded]
        key = secret if secret is not None else expr.local_secret(config.hash_salt)
        df, run.hashed_columns = cols.pseudonymize(df, ids, key)
    with stage("catalog_check"):
        known, run.catalog_diffs = tables.catalog_labels(labels, plain.columns) if labels else ({}, [])
        run.catalog_flagged = sorted(known)
    k = config.k_for(table)
    if k is not None and not trajectory:
        with stage("k_anonymity"):
            own = profile.chosen(plain, config.quasi_identifiers.get(table.lower(), ()), profiles, Category.QUASI_IDENTIFIER)
            quasi = list(dict.fromkeys([*run.gps_columns, *run.timestamp_cols_binned, *own]))
            numeric = [c for c in quasi if isinstance(df.schema[c].dataType, T.NumericType)]
            df, run.numeric_cols_binned = cols.bin_numbers(df, numeric)
            run.k_anonymity_k, run.quasi_columns = k, quasi
            run.suppressed_rows = groups.suppressed(df, quasi, k)
            df = groups.k_anonymous(df, quasi, k)
    with stage("column_policy_classification"):
        if given is not None:
            plans = tiers.with_labels(given, known, config.must_anonymize_type)
        else:
            plans = tiers.classify(df.drop(POSITION), labels=known, must=config.must_anonymize_type, threshold=config.similarity_threshold, value_vote=config.value_vote)
        away = set(run.hashed_columns) | excluded | set(tiers.not_pii(known, config.not_pii_type))
        plans = {c: p for c, p in plans.items() if c not in away}
        run.free_text_cols = [c for c, p in plans.items() if p.action == Action.SCAN]
    with stage("column_policy_mask"):
        df, done = policies.apply(df, plans, secret=secret, position=position, strict=config.strict)
        run.columns_hit = list(done.columns_processed)
        run.skipped_columns = dict(done.skipped)
        for c, n in done.values_masked.items():
            run.entity_counts[done.entities[c]] = run.entity_counts.get(done.entities[c], 0) + n
            run.column_entities[c] = {done.entities[c]: n}
    with stage("anonymization"):
        wanted = config.row_scan.get(table.lower(), frozenset())
        opted = [c for c in df.columns if c in wanted and c not in done.columns_processed and c not in run.hashed_columns]
        if config.strict:
            opted = [c for c in opted if c not in excluded]
        run.columns_scanned = len(opted)
        if opted:
            df, counts = scan.anonymize(df, opted, position, entities=entities_of(config.regions), keep=keep)
            for r in counts.collect():  # a row for each column and entity
                run.entity_counts[r["entity"]] = run.entity_counts.get(r["entity"], 0) + r["n"]
                run.column_entities.setdefault(r["column"], {})[r["entity"]] = r["n"]
                if r["column"] not in run.columns_hit:
                    run.columns_hit.append(r["column"])
    df = df.drop(POSITION)
    if trajectory:
        with stage("gps_aggregation"):
            stats = groups.trajectory_stats(df, run.gps_columns, speed, ts, config.k_anonymity_min).first()
            run.output_type, run.aggregate_cells, run.suppressed_rows = "aggregate", stats["cells_retained"], stats["pings_suppressed"]
            return groups.trajectory(df, run.gps_columns, speed, ts, config.k_anonymity_min)
    with stage("residual_validation"):
        if config.strict:
            residual.validate(df)
        run.residual_pii, _ = residual.summary(df)
    return df


def sample_policies(spark: SparkSession, mapping: TableMapping, config: EngineConfig, fmt: str = "parquet") -> dict[str, ColumnPolicy] | None:
    """Policies from the raw sample of a table; None if it can't be read."""
    try:
        return tiers.classify(tables.sample_lake(spark, mapping.source, fmt=fmt), threshold=config.similarity_threshold, value_vote=config.value_vote)
    except Exception:  # noqa: BLE001
        return None


def run_all(spark: SparkSession, config: EngineConfig, mappings: list[TableMapping], audit: Audit | None = None, **options) -> list[RunRecord | Exception]:
    """Every table, a failed one not stopping the others; several at once in a pool of
    driver threads, with policies from the same raw samples either way."""

    def one(m: TableMapping) -> RunRecord | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", m.table)
        try:
            given = sample_policies(spark, m, config, options.get("fmt", "parquet")) if m.mode == "lake" else None
            return run_table(spark, config, m, audit, given=given or {}, **options)
        except Exception as error:  # noqa: BLE001
            return error

    if config.max_table_workers == 1 or len(mappings) < 2:
        return [one(m) for m in mappings]
    with ThreadPoolExecutor(config.max_table_workers) as pool:
        return list(pool.map(one, mappings))


def position_of(df: DataFrame) -> Column:
    return F.col(POSITION) if POSITION in df.columns else F.monotonically_increasing_id()
