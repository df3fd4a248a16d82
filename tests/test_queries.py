"""Every query against its oracle, and the plans of the heavy ones."""

import pytest
from oracle import duck, duck_rows, spark_rows

import __spark_entry__
from spindlewatch.plans.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, connection, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == duck_rows(connection, ORACLES[name])


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_known_counts(spark):
    assert QUERIES["label_changes"](spark, SMALL).count() == 1829
    assert QUERIES["stream_label_changes"](spark, SMALL).count() == 1763


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_") and n != "parse_with_shared_decoder"])
def test_plans_have_no_cross_joins_and_no_python(spark, capsys, name):
    plan = plan_of(QUERIES[name](spark, SMALL), capsys)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "TakeOrdered"):
        assert operator not in plan


def test_scans_read_only_what_they_need(spark, capsys):
    plan = plan_of(QUERIES["tumbling_avg"](spark, SMALL), capsys)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    plan = plan_of(QUERIES["profile_lookup"](spark, SMALL), capsys)
    assert "EqualTo(c_custkey,42)" in plan
    plan = plan_of(QUERIES["location_block_keys"](spark, SMALL), capsys)
    assert "EqualTo(c_mktsegment,MACHINERY)" in plan and "EqualTo(n_name,NATION_11)" in plan
