"""Streaming forms: stateless transforms on each batch, trajectory cells by event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import columns as cols


def pseudonymized(stream: DataFrame, columns: list[str], secret: bytes) -> DataFrame:
    """Keyed pseudonyms need no state: the batch expressions serve as they are."""
    return cols.pseudonymize(stream, columns, secret)[0]


def trajectory_windows(stream: DataFrame, gps: list[str], speed: str, ts: str, k: int, *, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Cells of place and time window; a cell is given out, once it is past, if it has k pings."""
    marked = stream.withWatermark(ts, late)
    cells = marked.groupBy(F.window(ts, size).alias("w"), *gps).agg(F.count(speed).alias("ping_count"), F.avg(speed).alias("avg_speed_kmh"))
    return cells.where(F.col("ping_count") >= k).select(F.col("w.start").alias("window_start"), *gps, "ping_count", "avg_speed_kmh")


def each_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, fmt: str = "parquet"):
    """Start a query that transforms every micro-batch and appends it to ``target``."""

    def write(batch: DataFrame, _: int) -> None:
        transform(batch).write.mode("append").format(fmt).save(target)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).start()
