"""Every query that has SQL gives the same rows as DuckDB."""

import duckdb
import pytest

from cloakframe.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(norm, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    return duckdb.connect()


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows(spark, small, duck, name):
    for t in TABLES:
        duck.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    df = catalogue.queries()[name](spark, small)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    found = duck.execute(catalogue.oracle_sql()[name])
    names = [c[0] for c in found.description]
    want = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=repr)
    assert sorted(names) == cols and got == want
