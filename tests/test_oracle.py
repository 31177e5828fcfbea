import pytest

import __spark_entry__ as entry
from roomweave.plans.sql import ORACLE
from tests.oracle import connect, rows


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, small, duck, name):
    got = entry.queries()[name](spark, small)
    want = duck.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows(got.columns, got.collect()) == rows(columns, want.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_no_cross_joins_or_python_in_scene_plans(spark, small):
    for name in ("q_pair_distance", "pairs_valid_capped", "wall_occlusion_ratio", "position_valid_anti", "p3_found"):
        plan = entry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInArrow")), name
