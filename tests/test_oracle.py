"""Every query of the keyspace engine against its SQL, row for row, as multisets."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from kvlens.plans.oracle import ORACLES
from kvlens.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def test_each_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(spark, duck, data, name):
    got = QUERIES[name](spark, data)
    want = duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    ours = Counter(tuple(r) for r in got.select(*columns).collect())
    theirs = Counter(tuple(r[i] for i in at) for r in want.fetchall())
    assert ours == theirs
    assert sum(ours.values()) > 0 or name == "unsupported_commands"
