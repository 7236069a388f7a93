"""Every registered query against its SQL twin on the smallest data."""

import pytest

import __spark_entry__ as entry
from conftest import FOLDER

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def rows(table, columns):
    return sorted(zip(*[table.column(c).to_pylist() for c in columns]), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    mine = frame.toArrow()
    if name not in ORACLES:
        assert mine.num_rows > 0
        return
    relation = duck.sql(ORACLES[name])
    expected = {c: TYPES[str(t)] for c, t in zip(relation.columns, relation.types)}
    assert {f.name: f.dataType.simpleString() for f in frame.schema} == expected
    columns = sorted(expected)
    assert rows(mine, columns) == rows(relation.to_arrow_table(), columns)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
