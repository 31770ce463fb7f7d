"""Every registered query on the smallest tables; those with check SQL must give its rows."""

import duckdb
import pytest
from check_queries import compare

from tabloom.plans.registry import ORACLES, QUERIES, TABLES, load_all

load_all()


@pytest.fixture(scope="module")
def con(folder):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, folder, name):
    state, note, _ = compare(spark, con, folder, name)
    assert state in ("ok", "rows"), f"{state}: {note}"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
