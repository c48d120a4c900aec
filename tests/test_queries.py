"""Every registered query with SQL gives the same rows as that SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(row):
    return tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in row)


def ordered(found):
    return sorted((comparable(r) for r in found), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, sf, duck, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    kinds = {d[0]: KINDS[str(d[1])] for d in result.description}
    assert dict(df.dtypes) == kinds
    position = [[d[0] for d in result.description].index(c) for c in columns]
    expected = ordered([tuple(r[i] for i in position) for r in result.fetchall()])
    found = ordered([tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()])
    assert len(expected) > 0
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_queries_without_sql_run(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_has_the_wide_schema(spark):
    from demandlake.operators.consolidate import wide_schema

    df = entry.entry(spark)
    assert df.columns == [*wide_schema().fieldNames(), "month_starting"]
    assert len(df.columns) == 124
