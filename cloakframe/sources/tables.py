"""Reading tables: lake paths, SQL endpoints, discovery and path rules."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from datetime import datetime
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from ..model import TableMapping
from . import recency

#: Rows of a sample; child folders above which discovery searches the whole tree.
SAMPLE_ROWS, MANY_CHILDREN = 500, 20
# Endpoint types that are temporal, and those that hold text.
SQL_TEMPORAL = frozenset("date datetime datetime2 datetimeoffset smalldatetime".split())
SQL_TEXT = frozenset("char nchar varchar nvarchar text ntext".split())


def read_lake(spark: SparkSession, uri: str, at: datetime | None = None, fmt: str = "parquet") -> DataFrame:
    """A table of the lake, cut to recent rows if ``at`` is given."""
    df = spark.read.format(fmt).load(uri)
    return df if at is None else recency.recent(df, at)[0]


def sample_lake(spark: SparkSession, uri: str, n: int = SAMPLE_ROWS, fmt: str = "parquet") -> DataFrame:
    """The first ``n`` rows, without the recency filter."""
    return spark.read.format(fmt).load(uri).limit(n)


def quote_tsql(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"


def quote_ansi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def endpoint_query(table: str, schema: str = "dbo", limit: int | None = None) -> str:
    top = f"TOP ({int(limit)}) " if limit else ""
    return f"SELECT {top}* FROM {quote_tsql(schema)}.{quote_tsql(table)}"


def read_endpoint(spark: SparkSession, url: str, table: str, *, schema: str = "dbo", limit: int | None = None, at: datetime | None = None, token: str | None = None, **options: str) -> DataFrame:
    """A table of a SQL endpoint over JDBC. The filter is on bare columns, which the source
    can push down; the same rule as for the lake holds where it leaves nothing."""
    reader = spark.read.format("jdbc").option("url", url).option("query", endpoint_query(table, schema, limit))
    for key, value in options.items():
        reader = reader.option(key, value)
    if token:
        reader = reader.option("accessToken", token)
    df = reader.load()
    return df if at is None or limit else recency.recent(df, at)[0]


def endpoint_temporal(columns: Iterable[tuple[str, str]]) -> list[str]:
    """Of (name, type) pairs of the endpoint's catalogue, the temporal ones."""
    return [n for n, t in columns if t.lower() in SQL_TEMPORAL or (t.lower() in SQL_TEXT and recency.TEMPORAL_TOKENS & set(recency.name_tokens(n)))]


READERS: dict[str, Callable[..., DataFrame]] = {"lake": read_lake}


def read(spark: SparkSession, mapping: TableMapping, at: datetime | None = None, **options) -> DataFrame:
    """The reader of the mapping's mode; a mode without one is an error."""
    if mapping.mode == "sql":
        return read_endpoint(spark, options.pop("url"), mapping.table, schema=mapping.schema, at=at, **options)
    if mapping.mode not in READERS:
        raise RuntimeError(f"no reader for mode {mapping.mode!r}")
    return READERS[mapping.mode](spark, mapping.source, at, **options)


def parse_uri(uri: str) -> tuple[str, str, str]:
    """(file system, host, path) of abfss://fs@host/path or https://host/fs/path."""
    u = urlparse(uri)
    if u.scheme == "abfss":
        fs, _, host = u.netloc.partition("@")
        return fs, host, u.path.strip("/")
    if u.scheme == "https":
        fs, _, path = u.path.strip("/").partition("/")
        return fs, u.netloc, path
    raise ValueError(f"not a storage address: {uri}")


def format_uri(fs: str, host: str, path: str) -> str:
    return f"abfss://{fs}@{host}/{path.strip('/')}"


def is_uuid(text: str) -> bool:
    return re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", text, re.I) is not None


def check_target_base(base: str) -> None:
    if "/Files/" in f"{base.rstrip('/')}/" or not base.rstrip("/").endswith("/Tables"):
        raise ValueError(f"the target base must end with /Tables and not lie under /Files: {base}")


def target_of(source: str, target_base: str) -> str:
    """The target path of a source path: what follows /Tables/, under the target base."""
    check_target_base(target_base)
    _, found, rest = source.rstrip("/").partition("/Tables/")
    if not found or not rest:
        raise ValueError(f"no /Tables/ in {source}")
    return f"{target_base.rstrip('/')}/{rest}"


def check_apart(source: str, target: str) -> None:
    if source.rstrip("/").lower() == target.rstrip("/").lower():
        raise ValueError("source and target are the same table")


def _children(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(s.getPath()) for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def find_tables(spark: SparkSession, base: str, marker: str = "_delta_log") -> list[str]:
    """Folders that hold ``marker``: children of ``base``; the whole tree where there are more
    than MANY_CHILDREN of them or none is a table."""
    def marked(path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{marker}")
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    children = _children(spark, base)
    found = [c for c in children if marked(c)] if len(children) <= MANY_CHILDREN else []
    if found:
        return sorted(found)
    todo = children
    while todo:
        path = todo.pop()
        if marked(path):
            found.append(path)
        else:
            todo += [c for c in _children(spark, path) if not c.rsplit("/", 1)[-1].startswith("_")]
    return sorted(found)


def discover(
    spark: SparkSession,
    source_base: str,
    target_base: str,
    *,
    endpoint_tables: Callable[[], Iterable[tuple[str, str]]] | None = None,
    targets: Iterable[TableMapping] = (),
) -> list[TableMapping]:
    """Mappings to run: ``targets`` if there are any; else the lake's tables, and those of the
    endpoint's (schema, table) that the lake has not. An endpoint out of reach adds none."""
    if targets := list(targets):
        return targets
    out, known = [], set()
    for path in find_tables(spark, source_base):
        rest = path.partition("/Tables/")[2] or path.rsplit("/", 1)[-1]
        known.add(rest.lower() if "/" in rest else f"dbo/{rest}".lower())
        out.append(TableMapping(path, target_of(path, target_base), rest.rsplit("/", 1)[-1]))
    try:
        extra = list(endpoint_tables()) if endpoint_tables else []
    except Exception:  # noqa: BLE001
        extra = []
    for schema, table in extra:
        if f"{schema}/{table}".lower() not in known:
            out.append(TableMapping(f"{schema}.{table}", f"{target_base.rstrip('/')}/{schema}/{table}", table, "sql", schema))
    return out


def catalog_labels(fetch: Callable[[], dict[str, list[str] | str]], columns: Iterable[str]) -> tuple[dict[str, list[str]], list[str]]:
    """({column: types}, catalogue columns that the table has not); an error gives no labels."""
    try:
        got = {c: [t] if isinstance(t, str) else list(t) for c, t in fetch().items()}
    except Exception:  # noqa: BLE001
        return {}, []
    have = set(columns)
    return {c: t for c, t in got.items() if c in have}, sorted(set(got) - have)


def diagnostics(df: DataFrame) -> dict[str, int]:
    """Files and partitions behind a frame."""
    return {"files": len(df.inputFiles()), "columns": len(df.columns)}
