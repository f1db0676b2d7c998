"""Every registered query against independent SQL over the same tables."""

import collections
import decimal
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TELEMERE_TEST_SF", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, decimal.Decimal)) and value == int(value):
        return int(value)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(plain(row[i]) for i in order) for row in rows)


def test_only_queries_that_sql_cannot_express_lack_sql():
    # The numbered operators of the training-data package, and its pipeline, are tested by themselves.
    lacking = [name for name in QUERIES if name not in ORACLES and name != "pipeline" and not re.match(r"op\d+_", name)]
    assert lacking == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    got = multiset(result.columns, result.collect())
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(result.columns)
    assert got == multiset(columns, answer.fetchall())
