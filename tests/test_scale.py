"""Plans and kernels that have to hold when the tables grow; the rows themselves are held against SQL in test_queries."""

import os

import pytest

from kerbstone import plans

FOLDER = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@tables
def test_components_broadcast_nothing(spark):
    plan = plan_of(plans.queries()["components"](spark, FOLDER))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    # one call of the kernel for many streets, not one for each
    assert "hashpartitioning(lot" in plan


def test_coverage_compares_copies_once(spark, monkeypatch):
    from kerbstone.operators import coverage

    # 40 lines of one shape and one across, over 50 pieces of one street, each there twice, and a slanted one
    lines = [(k, 0, 0.0, 5.0, 100.0, 5.0) for k in range(40)] + [(99, 0, 30.0, -40.0, 30.0, 60.0)]
    pieces = [("t", 2.0 * k, 0.0, 2.0 * k + 2, 0.0) for k in range(30, 45)] * 2 + [("t", 2.0 * k + 3, 0.0, 2.0 * k, 0.0) for k in range(10)] + [("t", 0.0, 200.0, 50.0, 250.0)]
    met = []
    near = coverage.with_near_interval
    monkeypatch.setattr(coverage, "with_near_interval", lambda pairs, radius: met.append(pairs) or near(pairs, radius))
    found = coverage.covered(spark.createDataFrame(lines, "id int, seg int, ax double, ay double, bx double, by double"), spark.createDataFrame(pieces, "tier string, ax double, ay double, bx double, by double"), 12.0, ["tier"])
    rows = {(r.id, r.tier): r.covered for r in found.collect()}
    side = (144 - 25) ** 0.5
    assert {k: round(v, 6) for k, v in rows.items()} == {**{(k, "t"): round(21 + side + 100 - (60 - side), 6) for k in range(40)}, (99, "t"): round(2 * ((144 - 81) ** 0.5), 6)}
    assert met[0].count() <= 20  # 1,000 and more while every line met every piece


@tables
def test_lengths_are_not_broadcast(spark):
    assert "Broadcast" not in plan_of(plans.queries()["coverage_tag"](spark, FOLDER))


@tables
@pytest.mark.parametrize("name", ["linref_match", "linref_two_pass", "city_sections", "moratorium_placed", "plan_placed"])
def test_placing_joins_without_broadcasts(spark, name):
    assert "BroadcastHashJoin" not in plan_of(plans.queries()[name](spark, FOLDER))  # one row of counts may be
