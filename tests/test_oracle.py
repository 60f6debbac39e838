"""Every registered query equals its DuckDB twin on the smallest fixture."""

import pytest

from tests.oracle_compare import compare, duck_connection

SF = "/root/testdata/sf0.001"


def _names():
    import __spark_entry__ as E

    own = E.llm_queries.queries() if E.llm_queries else {}  # tested in tests/llm
    return [n for n in E.queries() if n not in own and n != "pipeline"]


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.fixture(scope="module")
def sql():
    import __spark_entry__ as E

    return E.oracle_sql()


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, sql, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan, "row or vectorised Python UDF in the plan"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, "cross join in the plan"
    rows = [tuple(r) for r in df.collect()]
    assert name in sql, f"{name} has no oracle SQL"
    cur = duck.execute(sql[name])
    res = compare(rows, df.columns, cur.fetchall(), [c[0] for c in cur.description])
    assert res["cols_match"], res
    assert res["rows_spark"] == res["rows_duck"], res
    assert res["exact"], res


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["distance_band", "items", "avg_km", "pct_late"]
    assert len(rows) > 0
