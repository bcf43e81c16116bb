"""Every registered query against its SQL, and plan rules for all of them."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from stagetally.checks.base import CHECKS

FOLDER = "/root/testdata/sf0.001"
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(frame):
    frame = frame[sorted(frame.columns)]
    rows = frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted(map(repr, (tuple(float(v) if isinstance(v, int) and not isinstance(v, bool) else v for v in r) for r in rows)))


@pytest.mark.parametrize("name", list(CHECKS))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", plan)
    assert "NestedLoopJoin" not in plan
    sql = entry.oracle_sql()[name]
    assert plain(df.toPandas()) == plain(duck.execute(sql).df())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "score_change_percent" in df.columns


def test_every_survey_row_has_a_query():
    done = {c.survey_id for c in CHECKS.values()}
    wanted = (
        [f"S{i:02}" for i in (1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 17, 18, 19, 20)]
        + [f"F{i:02}" for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 14)]
        + [f"J{i:02}" for i in range(1, 13)]
        + [f"A{i:02}" for i in range(1, 26) if i != 24]
        + [f"W{i:02}" for i in range(1, 6)]
        + [f"O{i:02}" for i in range(1, 10)]
        + ["U02", "U03", "U04"]
        + [f"C{i:02}" for i in range(1, 22)]
        + [f"G{i:02}" for i in (1, 2, 4, 5, 6, 7)]
        + ["T01", "T02", "T03"]
        + [f"K{i:02}" for i in range(1, 8)]
    )
    assert set(wanted) == done
