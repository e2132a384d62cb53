"""Every registered query against its SQL, and the shape of the plans."""

import pytest

import __spark_entry__ as entry_module
from checks.compare import difference, duck
from checks.queries import all_queries
from checks.oracles import all_oracles
from pulsetide.operators.episodes import alert_episodes
from pulsetide.operators.windows import window_vitals
from pulsetide.operators.clean import clean_readings, dedupe_readings
from pulsetide.plans.file_run import windows_of
from pulsetide.sources import warehouse as w
from pulsetide.sources.readings import decode_readings


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert entry_module.queries().keys() >= all_queries().keys()
    assert entry_module.oracle_sql().keys() >= all_oracles().keys()


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, sf, name):
    """Same rows, and no plan that multiplies two tables or calls Python per row."""
    result = all_queries()[name](spark, sf)
    plan = physical(result)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    assert difference(con, name, result) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_windows_combine_before_the_shuffle(spark, sf):
    plan = physical(window_vitals(clean_readings(w.vitals_raw(spark, sf))))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_avg" in plan and "SortAggregate" not in plan


def test_dedupe_combines_before_the_shuffle(spark, sf):
    plan = physical(dedupe_readings(clean_readings(w.vitals_raw(spark, sf))))
    assert plan.count("Exchange") == 1 and "partial_min" in plan


def test_episodes_order_a_day_of_one_patient_at_most(spark, sf):
    """Every ordered step is dealt by day, but for the first and last rows of days."""
    plan = alert_episodes(windows_of(w.vitals_raw(spark, sf)))._jdf.queryExecution().optimizedPlan().toString()
    ordered = [line for line in plan.splitlines() if "+- Window [" in line or line.startswith("Window [")]
    assert len(ordered) == 4
    # Spark gives the borders' key a name of its own (_w0).
    assert all("day#" in line.split("windowspecdefinition")[1] or "_w0" in line for line in ordered)
