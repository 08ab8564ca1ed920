"""Connected components by alternating large and small stars.

Each round rehangs every node to the least node it sees; links are joined and
aggregated as tables, a round's table is written to the shared folder, and only a count
and a checksum of it reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
    joined = down.join(least, F.col("u") == F.col("x")).select("u", "v", "m")
    across = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return across.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """links (a, b: long) -> a kept table (node, root): root is the least node of node's component.

    Nodes of no link are not in the result; links to oneself and repeated ones do not
    matter; an empty table gives an empty one.
    """
    e = scratch.keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        got = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (got["n"], got["s"]) == mark or not got["n"]:
            break
        mark = (got["n"], got["s"])
        done, e = e, scratch.keep(_small_star(_large_star(e)))
        scratch.drop(done)
    else:
        raise RuntimeError("components did not settle")
    out = scratch.keep(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
    scratch.drop(e)
    return out
