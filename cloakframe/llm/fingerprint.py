"""Exact digests of canonical text, in SQL expressions only.

Canonical text: compatibility decomposition and composition of Unicode (NFKC), full case
folding, one space for any white space. Two independently seeded 64-bit xxhashes group it;
different texts that meet in a bucket are compared byte by byte with the bucket's first,
and one that differs gets a fingerprint of its own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

#: Of next-document blocks: rows in one.
BLOCK_ROWS = 20_000
#: Parts of a bucket that are compared apart.
SPLITS = 64


def _unicode(kind: str, method: str, text: Column, flag: bool) -> Column:
    """A static method of the Unicode library that Spark itself brings for its collations."""
    return F.call_function("reflect", F.lit(f"com.ibm.icu.{kind}"), F.lit(method), text, F.lit(flag))


def folded(text: Column) -> Column:
    """NFKC of the full case folding; canonically equivalent texts give the same."""
    def fold(t: Column) -> Column:
        return _unicode("lang.UCharacter", "foldCase", t, True)

    def compose(t: Column) -> Column:
        return _unicode("text.Normalizer", "compose", t, True)

    return compose(fold(compose(fold(_unicode("text.Normalizer", "decompose", text, False)))))


def canonical(text: Column) -> Column:
    """Canonical text; null as empty. Of ASCII, lower case is all there is to fold."""
    t = F.coalesce(text, F.lit(""))
    out = F.when(t.rlike(r"[^\x00-\x7F]"), folded(t)).otherwise(F.lower(t))
    return F.trim(F.regexp_replace(out, r"[\s\x{85}\p{Z}]+", " "))


def wide_hash(text: Column) -> tuple[Column, Column]:
    """128 bits: two xxhashes of different seeds."""
    return F.xxhash64(text), F.xxhash64(F.lit("wide"), text)


def raw_hash(text: Column) -> tuple[Column, Column]:
    """128 bits of the text as it is."""
    return F.xxhash64(F.lit("raw"), text), F.xxhash64(F.lit("text"), text)


def _print(h1: Column, h2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(h1), 16, "0"), F.lpad(F.hex(h2), 16, "0")))


def collisions(docs: DataFrame, keyed: DataFrame, scratch: Scratch) -> DataFrame:
    """A kept table (r1, r2, sha) of texts whose canonical bytes are not those of the first
    text that shares their 128 bits.

    docs: id, text; keyed: id, r1, r2 (hashes of the text as it is), h1, h2 of the same
    rows. Copies of one text count once, so only buckets of several different texts bring
    any, one row's for each. They are compared byte by byte with the first of their part
    of the bucket (by hash, SPLITS parts), the parts' firsts with the bucket's; so no task
    holds a whole hot bucket. What differs anywhere is compared with the bucket's first.
    """
    texts = keyed.groupBy("h1", "h2", "r1", "r2").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id")).alias("f"))
    texts = scratch.keep(texts.select("h1", "h2", "r1", "r2", F.col("f.id").alias("_id")))
    several = texts.groupBy("h1", "h2").agg(F.count("*").alias("m")).where("m > 1").select(F.col("h1").alias("_1"), F.col("h2").alias("_2"))
    met = scratch.keep(texts.join(several, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2"))).select("h1", "h2", F.col("r1").alias("_r1"), F.col("r2").alias("_r2"), "_id"))
    scratch.drop(texts)
    r1, r2 = raw_hash(F.col("text"))
    own = docs.withColumn("r1", r1).withColumn("r2", r2)
    rows = own.join(met, F.col("id").eqNullSafe(F.col("_id")) & (F.col("r1") == F.col("_r1")) & (F.col("r2") == F.col("_r2")))
    rows = rows.groupBy("h1", "h2", "r1", "r2").agg(F.first("text").alias("text"))
    rows = scratch.keep(rows.withColumn("part", F.pmod("r1", F.lit(SPLITS))))

    def heads_of(t: DataFrame, *by: str) -> DataFrame:
        return t.groupBy("h1", "h2", *by).agg(F.min(F.struct("r1", "r2", "text")).alias("f")).select("h1", "h2", *by, "f.r1", "f.r2", "f.text")

    def differing(t: DataFrame, heads: DataFrame, *by: str) -> DataFrame:
        named = heads.select(F.col("text").alias("_text"), *[F.col(c).alias(f"_{c}") for c in ("h1", "h2", *by)])
        both = t.join(named, [F.col(c) == F.col(f"_{c}") for c in ("h1", "h2", *by)]).where("text <> _text")
        both = both.withColumn("same", canonical(F.col("text")) == canonical(F.col("_text"))).where("not same")
        return both.select(*t.columns)

    parts = scratch.keep(heads_of(rows, "part"))
    firsts = scratch.keep(heads_of(parts))
    odd_parts = scratch.keep(differing(parts, firsts).select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("part").alias("_p")))
    doubtful = scratch.keep(differing(rows, parts, "part"))
    inside = rows.join(odd_parts, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")) & (F.col("part") == F.col("_p"))).select(*rows.columns)
    odd = differing(doubtful.unionByName(inside), firsts)
    out = scratch.keep(odd.select("r1", "r2", F.sha2(canonical(F.col("text")).cast("binary"), 256).alias("sha")).distinct())
    scratch.drop(met, rows, parts, firsts, odd_parts, doubtful)
    return out


def _marked(rows: DataFrame, odd: DataFrame) -> DataFrame:
    """rows (with r1, r2, h1, h2) and fingerprint: 32 hex digits, and '-' + SHA-256 for odd ones."""
    odd = odd.select(F.col("r1").alias("_r1"), F.col("r2").alias("_r2"), F.col("sha").alias("_sha"))
    mark = F.when(F.col("_sha").isNotNull(), F.concat(F.lit("-"), "_sha")).otherwise("")
    both = rows.join(odd, (F.col("r1") == F.col("_r1")) & (F.col("r2") == F.col("_r2")), "left")
    return both.withColumn("fingerprint", F.concat(_print(F.col("h1"), F.col("h2")), mark)).drop("_r1", "_r2", "_sha")


def fingerprints(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """id, n_chars and fingerprint of each row. Null text counts as empty; equal texts have
    equal fingerprints; an empty table stays empty; repeated rows stay."""
    scratch = scratch or Scratch(docs.sparkSession, "fingerprint")
    base = _base(docs, text_col, id_col)
    out = scratch.keep(_hashed(base).withColumn("n_chars", F.length("text").cast("bigint")).drop("text"))
    return _marked(out, collisions(base, out.drop("n_chars"), scratch)).select(F.col("id").alias(id_col), "n_chars", "fingerprint")


def _base(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def _hashed(base: DataFrame) -> DataFrame:
    h1, h2 = wide_hash(F.col("canon"))
    r1, r2 = raw_hash(F.col("text"))
    return base.withColumn("canon", canonical(F.col("text"))).withColumns({"h1": h1, "h2": h2, "r1": r1, "r2": r2}).drop("canon")


def _bounds(keys: DataFrame, blocks: int, scratch: Scratch) -> DataFrame:
    """keys (key), dealt by Spark's own range partitioner to about ``blocks`` blocks: one row
    that holds each block's greatest key, in order, as a list of lists."""
    dealt = keys.repartitionByRange(max(1, blocks), "key").groupBy(F.spark_partition_id().alias("p")).agg(F.max("key").alias("e"))
    ends = scratch.keep(dealt.select("e").distinct())
    fan = max(1, math.isqrt(ends.count()))
    held = ends.agg(F.array_sort(F.collect_set("e")).alias("ends"))
    rows = F.sequence(F.lit(0), F.floor((F.size("ends") - 1) / fan).cast("int"))
    return held.where(F.size("ends") > 0).select(F.transform(rows, lambda i: F.slice("ends", i * fan + 1, F.lit(fan))).alias("tree"))


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", cols: tuple[str, ...] = (), scratch: Scratch | None = None) -> DataFrame:
    """id, ``cols``, text and next_<col>, next_text: of the next row by descending id (null
    ids last, then by hash of the text), after the last the first.

    Rows are dealt to blocks of neighbouring keys (id, hash); each block also gets a copy
    of the greatest row of the block below it, so one shuffle and a window within each
    block do. The blocks' bounds are a table's one row (an id and a hash for each
    BLOCK_ROWS rows), not part of the plan. Repeated rows of one id and text follow one
    another; ids may be of any type that has an order.
    """
    scratch = scratch or Scratch(docs.sparkSession, "next")
    key = F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.lit("next"), F.col(f"`{text_col}`")).alias("h"))
    keys = docs.select(key.alias("key"))
    bounds = scratch.keep(_bounds(keys, -(-docs.count() // BLOCK_ROWS), scratch))
    rows = docs.select(key.alias("key"), id_col, *cols, text_col).withColumn("tree", bounds.scalar())
    lists = F.size(F.filter(F.transform("tree", lambda x: F.element_at(x, -1)), lambda e: e < F.col("key")))
    rows = rows.withColumn("list", F.get("tree", lists)).withColumn("at", F.size(F.filter("list", lambda e: e < F.col("key"))))
    last = F.element_at(F.element_at("tree", -1), -1)
    fan, total = F.size(F.get("tree", F.lit(0))), F.aggregate("tree", F.lit(0), lambda n, x: n + F.size(x))
    block = lists * fan + F.col("at")
    here = F.struct(block.alias("b"), F.lit(1).alias("own"))
    copy = F.struct(F.pmod(block + 1, total).alias("b"), F.lit(0).alias("own"))
    is_end = F.col("key") == F.get("list", "at")
    at = F.explode(F.when((is_end) | (F.col("key") == last), F.array(here, copy)).otherwise(F.array(here))).alias("at")
    rows = rows.select("key", id_col, *cols, text_col, at).select("key", id_col, *cols, text_col, F.col("at.b").alias("block"), F.col("at.own").alias("own"))
    w = W.partitionBy("block").orderBy("own", "key", F.col(text_col))
    nexts = [F.lag(c).over(w).alias(f"next_{c}") for c in (*cols, text_col)]  # one window for all
    return rows.select(id_col, *cols, text_col, "own", *nexts).where("own = 1").drop("own")


def edited_fingerprints(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", scratch: Scratch | None = None) -> DataFrame:
    """Fingerprints of each text and of its edit: the last half of its characters
    replaced by the first as many (or all) of the next document's.

    Likeness of two fingerprints is 1.0 if they are equal, else 0.0: a digest has no
    nearness between. Null texts count as empty; null ids come last and are ordered by
    their texts' hashes, as are rows of one id; repeated rows stay; an empty table gives
    an empty result; other columns do not matter.
    """
    scratch = scratch or Scratch(docs.sparkSession, "fingerprint")
    base = _base(docs, text_col, id_col)
    rows = with_next(_hashed(base), id_col="id", cols=("r1", "r2", "h1", "h2"), scratch=scratch)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("canon", canonical(F.col("edited")))
    e1, e2 = wide_hash(F.col("canon"))
    rows = rows.withColumn("e1", e1).withColumn("e2", e2)

    def alike(a: tuple[str, str], other: Column) -> Column:
        met = (F.col("h1") == F.col(a[0])) & (F.col("h2") == F.col(a[1]))
        # equal texts need no canonical form
        return F.when(~met, F.lit(False)).when(F.col("text") == other, F.lit(True)).otherwise(canonical(F.col("text")) == canonical(other)).cast("double")

    out = scratch.keep(rows.select(
        "id",
        n.cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "r1",
        "r2",
        "h1",
        "h2",
        _print(F.col("e1"), F.col("e2")).alias("edited_fingerprint"),
        alike(("e1", "e2"), F.col("edited")).alias("near_edited"),
        alike(("next_h1", "next_h2"), F.col("next_text")).alias("near_next"),
    ))
    return _marked(out, collisions(base, out.select("id", "r1", "r2", "h1", "h2"), scratch)).select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
