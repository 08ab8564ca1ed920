"""Free-text scan: findings by an Arrow UDF over distinct values, tokens by a dictionary.

Masking looks at equal strings once; what Python returns is findings, so that numbering and
joins stay with Spark. Every string reaches Python, where a pattern is tried only on texts
that hold a digit or a piece that its matches can't be without.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions import detect, expr

FOUND = "array<struct<entity:string,start:int,end:int,score:double>>"


#: Tasks a core, at least, for text that comes in fewer: a scan costs far more than a shuffle.
TASKS_A_CORE = 4


def spread(source: DataFrame) -> DataFrame:
    """A table as read, dealt over all cores where its files give fewer tasks than those
    could share; one of many files is left as it is."""
    least = TASKS_A_CORE * source.sparkSession.sparkContext.defaultParallelism
    return source if source.rdd.getNumPartitions() >= least else source.repartition(least)


def finder(entities: list[str] | None = None):
    """An Arrow UDF: string -> findings without overlaps, in order of start."""
    wanted = None if entities is None else frozenset(entities)

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("entity", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for b in batches:
            out = []
            for x in b:
                v = x.as_py()
                got = [] if v is None or detect.is_token(v) else detect.resolve(detect.analyze(v, wanted))
                out.append([{"entity": e, "start": s, "end": t, "score": c} for e, s, t, c in got])
            yield pa.array(out, kind)

    return arrow_udf(find, FOUND)


def _strings_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The strings of a document, keys too, in order; else the value itself."""
    for b in batches:
        out = []
        for x in b:
            v = x.as_py()
            document = None if v is None else detect.parse_document(v)
            out.append([] if v is None else [v] if document is None else [s for _, s in detect.strings(document)])
        yield pa.array(out, pa.list_(pa.string()))


def _rebuilt_of(values: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The value with its strings replaced by a map of (string, masked)."""
    for v, changed in values:
        out = []
        for x, pairs in zip(v, changed, strict=True):
            text = x.as_py()
            table = {p["s"]: p["m"] for p in (pairs.as_py() or [])}
            if text is None:
                out.append(None)
                continue
            document = detect.parse_document(text)
            if document is None:
                out.append(table.get(text, text))
            else:
                out.append(detect.json.dumps(detect.mapped(document, lambda s, t=table: t.get(s, s)), ensure_ascii=False))
        yield pa.array(out, pa.string())


def _strings(col: Column) -> Column:
    return arrow_udf(_strings_of, "array<string>")(col)


def _rebuilt(col: Column, changed: Column) -> Column:
    return arrow_udf(_rebuilt_of, "string")(col, changed)


def findings(df: DataFrame, column: str, position: Column, entities: list[str] | None = None) -> DataFrame:
    """(pos, s, found): each row's strings in order, with their findings."""
    rows = df.select(position.alias("pos"), F.posexplode(_strings(F.col(f"`{column}`"))).alias("i", "s"))
    distinct = rows.select("s").distinct().withColumn("found", finder(entities)(F.col("s")))
    return rows.join(distinct.withColumnRenamed("s", "s_"), F.col("s") == F.col("s_")).select("pos", "i", "s", "found")


def anonymize(df: DataFrame, columns: list[str], position: Column, *, entities: list[str] | None = None, keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(df with tokens for what is found in ``columns``, counts: column, entity, n).

    Tokens are numbered by column, then row, then from right to left within a string,
    as replacement goes; documents are masked in keys and strings, numbers stay. Findings
    are read for the numbers, for each column and for the counts: ``keep`` (such as persist)
    spares the scan's being done again for each.
    """
    columns = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    if not columns:
        return df, df.sparkSession.createDataFrame([], "column string, entity string, n bigint")
    held = None
    for at, c in enumerate(columns):
        one = findings(df, c, position, entities).select(F.lit(at).alias("c"), "pos", "i", "s", F.posexplode(F.reverse("found")).alias("j", "f"))
        held = one if held is None else held.unionByName(one)
    said = F.substring(F.col("s"), F.col("f.start") + 1, F.col("f.end") - F.col("f.start"))
    held = held.withColumn("said", said).withColumn("key", expr.token_key(F.col("said")))
    held = held if keep is None else keep(held)
    order = F.struct(F.col("c"), F.struct("pos", "i", "j").alias("p"))
    keys = held.select(F.col("f.entity").alias("entity"), "key", order.alias("at")).groupBy("entity", "key").agg(F.min("at").alias("at"))
    table = _numbered(keys)
    out = df
    for at, c in enumerate(columns):
        named = held.where(F.col("c") == at).join(table.withColumnRenamed("key", "k_").withColumnRenamed("entity", "e_"), (F.col("key") == F.col("k_")) & (F.col("f.entity") == F.col("e_")))
        token = F.concat("e_", F.lit("_"), F.col("n").cast("string"))
        spans = named.groupBy("pos", "s").agg(F.array_sort(F.collect_set(F.struct(F.col("f.start").alias("start"), F.col("f.end").alias("end"), token.alias("t")))).alias("spans"))
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        masked = F.aggregate(
            "spans",
            start,
            lambda acc, x: F.struct(x["end"].alias("at"), F.concat(acc["out"], F.substring(F.col("s"), acc["at"] + 1, x["start"] - acc["at"]), x["t"]).alias("out")),
            lambda acc: F.concat(acc["out"], F.substring(F.col("s"), acc["at"] + 1, F.length("s"))),
        )
        per_row = spans.select("pos", F.struct("s", masked.alias("m")).alias("p")).groupBy(F.col("pos").alias("p_")).agg(F.collect_list("p").alias(f"_m{at}"))
        out = out.join(per_row, position == F.col("p_"), "left").drop("p_")
        # a document is written anew even where nothing is found
        needs = F.col(f"_m{at}").isNotNull() | F.ltrim(F.col(f"`{c}`")).rlike(r"^[{\[]")
        out = out.withColumn(c, F.when(needs, _rebuilt(F.col(f"`{c}`"), F.coalesce(F.col(f"_m{at}"), F.array().cast("array<struct<s:string,m:string>>")))).otherwise(F.col(f"`{c}`"))).drop(f"_m{at}")
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("c") + 1)
    counts = held.groupBy(names.alias("column"), F.col("f.entity").alias("entity")).agg(F.count("*").alias("n"))
    return out.select(*df.columns), counts


def _numbered(keys: DataFrame) -> DataFrame:
    """n by first appearance for positions that are structs: one window over distinct keys of an entity."""
    from pyspark.sql import Window as W

    return keys.withColumn("n", F.row_number().over(W.partitionBy("entity").orderBy("at", "key")) - 1).select("entity", "key", "n")


def majority_language(df: DataFrame, text: str, tell: Column, share: float = 0.8) -> DataFrame:
    """lang and share of the most common language, null if it has less than ``share``."""
    counts = df.where(F.col(f"`{text}`").isNotNull()).groupBy(tell.alias("lang")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    best = counts.orderBy(F.desc("n"), "lang").limit(1)
    part = F.col("n") / F.col("total")
    return best.join(total, F.lit(True)).select(F.when(part >= share, F.col("lang")).alias("lang"), part.alias("share"))

