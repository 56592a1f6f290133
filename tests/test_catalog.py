"""Every registered query of the engine's own operators against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tessera.plans import catalog
from tessera.plans.views import TABLES

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")


def plain(frame):
    cols = sorted(frame.columns)
    return cols, sorted(map(tuple, frame[cols].astype(str).replace({"None": "NULL", "nan": "NULL", "<NA>": "NULL", "NaT": "NULL"}).values.tolist()))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    got = catalog.QUERIES[name](spark, DIR).toPandas()
    if name in catalog.SQL:
        db = duckdb.connect()
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
        assert plain(got) == plain(db.sql(catalog.SQL[name]).df())


def test_importing_needs_no_session():
    import subprocess
    import sys

    subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
