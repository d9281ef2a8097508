"""Every registered query against its SQL, on the smallest driver tables."""

import math
from pathlib import Path

import duckdb
import pytest

from ledgerleaf import plans

SF = Path("/root/testdata/sf0.001")
CATALOG = plans.load()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)]

    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)) or str(value) == "<NA>":
            return ""
        return repr(float(value)) if isinstance(value, (int, float)) or hasattr(value, "dtype") else str(value)

    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(CATALOG.QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    ours = CATALOG.QUERIES[name](spark, str(SF)).toPandas()
    theirs = duck.execute(CATALOG.ORACLES[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_every_query_has_sql():
    assert set(CATALOG.QUERIES) == set(CATALOG.ORACLES)
