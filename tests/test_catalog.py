"""Every query against its oracle on the smallest driver tables."""

import duckdb
import pytest

from check_oracles import shape
from depotkit.catalog import QUERIES
from depotkit.catalog.views import BASE

CHECKED = sorted(n for n, q in QUERIES.items() if q.sql)
FITTED = sorted(n for n, q in QUERIES.items() if not q.sql)


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for b in BASE:
        con.execute(f"create view {b} as select * from '{folder}/{b}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_oracle(spark, folder, duck, name):
    got, want = shape(QUERIES[name].run(spark, folder).toPandas()), shape(duck.execute(QUERIES[name].sql).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("name", ["m_train_delay", "m_native_importance", "i_score_supplier"])
def test_model_query_gives_rows(spark, folder, name):
    assert name in FITTED
    assert QUERIES[name].run(spark, folder).count() > 0
