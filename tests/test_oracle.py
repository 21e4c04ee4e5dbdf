"""Every registered query against its DuckDB SQL at sf0.001 (the driver does the same at sf0.01)."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as ent
from aerostat.plans.catalog import QUERIES
from tests.conftest import SF001
from tools.oracle_check import TABLES, rows_of

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(NAMES) <= set(ent.oracle_sql()) and set(NAMES) <= set(ent.queries())


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "TimestampNTZType()": "TIMESTAMP", "DateType()": "DATE",
                 "BooleanType()": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = ent.queries()[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ent.oracle_sql()[name])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    assert sorted(sdf.columns) == sorted(dcols)
    stypes = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    assert stypes == dict(zip(dcols, dtypes))
    assert Counter(rows_of(sdf.columns, srows)) == Counter(rows_of(dcols, rel.fetchall()))


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "date", "avg_value", "max_value", "min_value"]
