"""The last look: personal data that is still there. Patterns and checksums only.

Scalar string columns are counted by JVM expressions in one aggregate; columns that
hold documents go through an Arrow UDF that walks them with paths.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions import detect, expr, patterns
from .profile import readable_date, tokens

# Name tokens of columns that are about the data, and that allow an entity.
META = frozenset("dataset file filename key modified path record resource source update updated".split())
ALLOWED = {
    "PHONE_NUMBER": frozenset("cell fax mobile phone tel telephone".split()),
    "CREDIT_CARD": frozenset("card cc creditcard pan".split()),
    "IBAN_CODE": frozenset("account bank iban".split()),
}
SHOWN = 10
#: The residual patterns for Java's engine, with Unicode classes as Python has them.
NATIVE = {
    "EMAIL_ADDRESS": r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "URL": r"(?Ui)\b(?:https?://|www\.)[^\s<>'\"]+",
    "IP_ADDRESS": r"(?U)\b[0-9A-Fa-f:.]{3,}\b",
    "IBAN_CODE": r"(?Ui)\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b",
    "CREDIT_CARD": r"(?U)\b(?:\d[ -]?){13,19}\b",
    "PHONE_NUMBER": r"(?U)(?<!\w)(?:\+?\d[\d .()/-]{6,}\d)(?!\w)",
}
CHECKS = {"IP_ADDRESS": expr.ipv4_ok, "IBAN_CODE": expr.iban_ok, "CREDIT_CARD": expr.luhn, "PHONE_NUMBER": expr.phone_ok}


def code_like(col: Column) -> Column:
    """A number, a date, or one token of code characters."""
    return col.try_cast("double").isNotNull() | col.try_cast("timestamp_ntz").isNotNull() | F.trim(col).rlike(r"^[A-Za-z0-9_.:/\\-]+$")


def scalar_count(column: str, entity: str) -> Column | None:
    """Findings of ``entity`` in one value of a string column; None where the name rules it out."""
    col, names = F.col(f"`{column}`"), tokens(column)
    allowed = bool(names & ALLOWED.get(entity, frozenset()))
    if names & META and not allowed:
        return None
    found = F.regexp_extract_all(col, F.lit(NATIVE[entity]), F.lit(0))
    if entity in CHECKS:
        found = F.filter(found, CHECKS[entity])
    use = col.isNotNull() & ~F.trim(col).rlike(r"^[A-Z][A-Z0-9_]*_\d+$")
    if entity in ALLOWED and not allowed:
        use &= ~code_like(col)
    return F.when(use, F.size(found)).otherwise(0)


def documents_in(df: DataFrame, cols: list[str]) -> list[str]:
    """Of ``cols`` those with a value that looks like a JSON object or array: one aggregate."""
    if not cols:
        return []
    got = df.agg(*[F.max(F.ltrim(F.col(f"`{c}`")).rlike(r"^[{\[]")).alias(c) for c in cols]).first()
    return [c for c in cols if got[c]]


def _walked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("path", pa.string()), ("entity", pa.string()), ("n", pa.int32())]))
    for values, names in batches:
        out = []
        for x, name in zip(values, names, strict=True):
            v, found = x.as_py(), []
            document = None if v is None else detect.parse_document(v)
            inside = document is not None
            for path, s in detect.strings(document) if inside else ([] if v is None else [(None, v)]):
                found += [{"path": path, "entity": e, "n": n} for e, n in count_in(s, name.as_py(), inside).items()]
            out.append(found)
        yield pa.array(out, kind)


def _walk(value: Column, name: Column) -> Column:
    return arrow_udf(_walked, "array<struct<path:string,entity:string,n:int>>")(value, name)


def count_in(text: str, column: str, inside: bool) -> dict[str, int]:
    """Findings by entity in one string, by the rules for its column and place."""
    if detect.is_token(text):
        return {}
    names, out = tokens(column), {}
    meta = bool(names & META) and not inside
    structured = None
    for entity, regex in detect.RESIDUAL.items():
        allowed = bool(names & ALLOWED.get(entity, frozenset()))
        if meta and not allowed:
            continue
        check = {"IBAN_CODE": patterns.iban, "CREDIT_CARD": patterns.luhn, "IP_ADDRESS": patterns.ip_address}.get(entity)
        hits = [m for m in regex.findall(text) if check is None or check(m)]
        if entity == "PHONE_NUMBER":
            hits = [m for m in hits if sum(c.isdigit() for c in m) >= 7 and not any(c.isalpha() for c in m)]
        if hits and entity in ALLOWED and not allowed:
            if structured is None:
                structured = bool(detect.re.fullmatch(r"[A-Za-z0-9_.:/\\-]+", text.strip())) or readable_date(text)
            if structured:
                continue
        if hits:
            out[entity] = len(hits)
    return out


def findings(df: DataFrame) -> DataFrame:
    """(column, path, entity, n), sorted; path is null for scalars."""
    empty = df.sparkSession.createDataFrame([], "column string, path string, entity string, n bigint")
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    walked = documents_in(df, text)
    parts = []
    counts = [(c, e, n) for c in text if c not in walked for e in NATIVE if (n := scalar_count(c, e)) is not None]
    if counts:
        sums = df.agg(*[F.sum(n).alias(f"s{i}") for i, (_, _, n) in enumerate(counts)])
        rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(None).cast("string").alias("path"), F.lit(e).alias("entity"), F.col(f"s{i}").cast("bigint").alias("n")) for i, (c, e, _) in enumerate(counts)]))
        parts.append(sums.select(rows.alias("r")).select("r.*").where("n > 0"))
    for c in walked + nested:
        value = F.to_json(F.col(f"`{c}`")) if c in nested else F.col(f"`{c}`")
        parts.append(df.select(F.explode(_walk(value, F.lit(c))).alias("f")).groupBy(F.lit(c).alias("column"), F.col("f.path").alias("path"), F.col("f.entity").alias("entity")).agg(F.sum("f.n").alias("n")))
    return reduce(DataFrame.unionByName, parts, empty).orderBy("column", F.col("path").asc_nulls_first(), "entity")


def summary(df: DataFrame) -> tuple[int, str]:
    """(total, detail): the first SHOWN findings as column[:path].ENTITY=n; never a value."""
    found = findings(df)
    total = found.agg(F.sum("n")).first()[0] or 0
    shown = found.limit(SHOWN).collect()
    return total, ", ".join(f"{r['column']}{':' + r['path'] if r['path'] else ''}.{r['entity']}={r['n']}" for r in shown)


def validate(df: DataFrame) -> None:
    total, detail = summary(df)
    if total:
        raise ValueError(f"{total} residual findings: {detail}")


def total_of(df: DataFrame, columns: list[str], entity: str) -> Column:
    return reduce(add, [F.coalesce(n, F.lit(0)) for c in columns if (n := scalar_count(c, entity)) is not None], F.lit(0))
