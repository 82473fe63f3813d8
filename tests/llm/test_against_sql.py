"""Every corpus query that SQL can express, against DuckDB on the same tables."""

import pytest

from holdfast.llm.queries import ORACLES, QUERIES


def plain(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, con, name):
    if name not in QUERIES:
        pytest.skip("registered elsewhere")
    df = QUERIES[name](spark, folder)
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert plain(df.columns, df.collect()) == plain(names, result.fetchall())


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))


NATIVE = ("op5_quality_ledger", "op6_line_chunks", "op7_linked_secrets")


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_run_no_python(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
