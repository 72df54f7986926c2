"""Every registered query against its DuckDB oracle on the smallest tables,
plus the entry smoke check."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

from tierflow.plans import registry  # noqa: E402

from data_dirs import SF001  # noqa: E402

SQL = E.oracle_sql()
#: The reference's operators; queries of the optional subpackage are tested beside it.
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_id", "goal_type", "food_name", "serving_description", "recommendation_score",
                          "recommendation_reason", "recommendation_rank"]


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    rel = duck.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    drows = [dict(zip(dcols, r)) for r in rel.fetchall()]
    assert cols == sorted(dcols)
    assert len(srows) == len(drows)
    hs, ls = digest(srows, cols)
    hd, ld = digest(drows, cols)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])
