"""Entity tokens: ENTITY_n by first appearance, one dictionary for all columns of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expr
from .columns import replaced


def dictionary(df: DataFrame, entities: dict[str, str], position: Column) -> DataFrame:
    """(entity, key, n): n by first appearance, columns in order and then ``position``.

    The least position of a key is combined on the map side; only distinct keys are
    numbered. Numbers of one entity follow one another, so an entity's keys are numbered
    in parts by position: counts of the parts before give each part's start.
    """
    pieces = []
    for i, (column, entity) in enumerate(entities.items()):
        key = expr.token_key(F.col(f"`{column}`"))
        pieces.append(df.select(F.lit(entity).alias("entity"), key.alias("key"), F.struct(F.lit(i).alias("c"), position.alias("p")).alias("at")).where(F.col("key").isNotNull()))
    keys = reduce(DataFrame.unionByName, pieces).groupBy("entity", "key").agg(F.min("at").alias("at"))
    return numbered(keys)


def numbered(keys: DataFrame, parts: int = 64) -> DataFrame:
    """keys (entity, key, at) with n from 0 in order of (at, key) within each entity."""
    bounds = keys.select("entity", "at").groupBy("entity").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("m"))
    span = F.col("hi.p").cast("double") - F.col("lo.p").cast("double") + 1.0
    placed = keys.join(bounds.withColumnRenamed("entity", "e_"), F.col("entity") == F.col("e_"))
    share = (F.col("at.p").cast("double") - F.col("lo.p").cast("double")) / span
    # columns one after the other, and positions of a column in ranges
    part = F.when(F.col("lo.c") == F.col("hi.c"), F.least(F.lit(parts - 1), F.greatest(F.lit(0), F.floor(share * parts)))).otherwise(F.lit(0))
    placed = placed.select("entity", "key", "at", (F.col("at.c") * parts + part).alias("part"))
    counts = placed.groupBy("entity", "part").count()
    start = F.coalesce(F.sum("count").over(W.partitionBy("entity").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("entity").alias("e_"), F.col("part").alias("p_"), start.alias("start"))
    within = F.row_number().over(W.partitionBy("entity", "part").orderBy("at", "key")) - 1
    return placed.withColumn("i", within).join(starts, (F.col("entity") == F.col("e_")) & (F.col("part") == F.col("p_"))).select("entity", "key", (F.col("start") + F.col("i")).alias("n"))


def tokenize(df: DataFrame, entities: dict[str, str], position: Column, known: DataFrame | None = None) -> DataFrame:
    """``df`` with ENTITY_n in the columns of ``entities`` (column: entity); null stays null."""
    table = dictionary(df, entities, position) if known is None else known
    out = df
    for i, (column, entity) in enumerate(entities.items()):
        own = table.where(F.col("entity") == entity).select(F.col("key").alias(f"_k{i}"), F.col("n").alias(f"_n{i}"))
        out = out.join(own, expr.token_key(F.col(f"`{column}`")) == F.col(f"_k{i}"), "left")
    new = {c: F.when(F.col(f"_n{i}").isNotNull(), F.concat(F.lit(f"{e}_"), F.col(f"_n{i}").cast("string"))) for i, (c, e) in enumerate(entities.items())}
    return replaced(out, new).select(*df.columns)


def unique_counts(table: DataFrame) -> DataFrame:
    """Distinct values of each entity."""
    return table.groupBy("entity").agg(F.count("*").alias("n_values"))


def hash_tokens(df: DataFrame, entities: dict[str, str], secret: bytes) -> DataFrame:
    """Tokens from a keyed digest of the key: no dictionary, for tables without an order."""
    def token(c: str, e: str) -> Column:
        return F.concat(F.lit(f"{e}_"), F.substring(expr.hmac_sha256(expr.token_key(F.col(f"`{c}`")), secret), 1, 16))

    return replaced(df, {c: token(c, e) for c, e in entities.items()})
