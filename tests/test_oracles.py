"""Every query that SQL can express gives the rows of its SQL in DuckDB; all others give rows."""

from pathlib import Path

import duckdb
import numpy as np
import pytest

from tallyloom import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def cells(frame):
    def plain(x):
        if x is None or (isinstance(x, float) and np.isnan(x)):
            return ""
        if isinstance(x, (list, tuple, np.ndarray)):
            return str([plain(y) for y in x])
        if isinstance(x, (bool, np.bool_)):
            return str(bool(x))
        if isinstance(x, (int, np.integer)):
            return repr(float(x))
        if isinstance(x, (float, np.floating)):
            return repr(round(float(x), 7) + 0.0)
        return str(x).removesuffix("+00:00")

    names = sorted(frame.columns)
    return names, sorted(tuple(plain(x) for x in row) for row in frame[names].astype(object).where(frame[names].notna(), None).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_rows(spark, db, name):
    assert cells(catalogue.QUERIES[name](spark, DIR).toPandas()) == cells(db.execute(catalogue.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, DIR).limit(5).count() > 0
