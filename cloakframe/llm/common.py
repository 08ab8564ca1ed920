"""What several of the operators share: tables in the shared folder, whole rows by
their digests, draws, and column-name hygiene."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, one of our own if driver and
    executors are one process (tests); on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if not held.isDefined():
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cloakframe-"))
        held = context._jsc.sc().getCheckpointDir()
    return held.get()


class Scratch:
    """Tables written to the shared folder to cut lineage; any executor can reread them.

    Shuffle files of a finished step are let go with the step, so that a chain of
    steps holds the disk of one of them.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.n = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, written once and read again."""
        self.n += 1
        path = f"{self.base}/{self.n}"
        before = self.spark.conf.get(self.CLEANUP, None)
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(self.CLEANUP)
            else:
                self.spark.conf.set(self.CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables of keep() that nothing lazy reads any more."""
        for df in tables:
            self._delete(df._scratch_path)

    def close(self) -> None:
        """Delete all tables of keep()."""
        if self.n:
            self._delete(self.base)

    def _delete(self, where: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, want: str) -> str:
    """``want``, or with underscores before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while want.lower() in taken:
        want = f"_{want}"
    return want


#: Equal rows that one element of an array stands for.
_RUN = 1 << 16


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a whole row: rows that have the same are equal in every column."""
    def plain(name: str, kind: str) -> Column:
        return F.to_json(F.struct(F.col(f"`{name}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{name}`")

    # a null leaves the hash as it was, so its place is told besides
    cols = [x for c, kind in df.dtypes for x in (F.col(f"`{c}`").isNull(), plain(c, kind))]
    return F.xxhash64(*cols), F.xxhash64(F.lit("row"), *cols)


def whole_rows(docs: DataFrame, wanted: DataFrame, times_col: str = "times") -> DataFrame:
    """Rows of ``docs`` by digest, each as often as ``wanted`` (w1, w2, ``times_col``, other
    columns that the result also has) says. Texts are shuffled once and never written;
    equal rows are brought together before the shuffle."""
    a, b = free_name(docs, "w_1"), free_name(docs, "w_2")
    d1, d2 = row_digest(docs)
    first = docs.withColumns({a: d1, b: d2}).groupBy(a, b).agg(*[F.first(f"`{c}`").alias(c) for c in docs.columns])
    renamed = {c: free_name(docs, f"w_{c}") for c in wanted.columns}
    wanted = wanted.select(*[F.col(c).alias(n) for c, n in renamed.items()])
    both = first.join(wanted, (F.col(a) == F.col(renamed["w1"])) & (F.col(b) == F.col(renamed["w2"])))
    extra = {c: renamed[c] for c in renamed if c not in ("w1", "w2", times_col)}
    times, run, at = F.col(renamed[times_col]).cast("bigint"), free_name(both, "w_run"), free_name(both, "w_at")
    both = both.where(times > 0).withColumn(run, F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((times - 1) / F.lit(_RUN)))))
    both = both.withColumn(at, F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(_RUN).cast("bigint"), times - F.col(run) * _RUN))))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(n).alias(free_name(docs, c)) for c, n in extra.items()])


def shuffle_width(spark: SparkSession, rows: int, per_partition: int) -> int:
    """Partitions for a shuffle of ``rows``: the session's number, or more where rows ask for it."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_partition))


def unit_hash(*cols, seed: int):
    """A reproducible uniform draw in (0, 1) for each row, from ``cols`` and ``seed``."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
