"""Plan checks: everything stays in the JVM, filters reach the scan,
projections prune the scan, the report needs a single exchange."""

import pytest

import __spark_entry__ as E
from tripflow.plans import catalog, catalog_rides

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")
BATCH = sorted(set(catalog._queries()) | {k for k in catalog_rides.QUERIES if not k.endswith(("_stream", "_update", "_complete", "_append"))})


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def long_plan_strings(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_plan(spark, sf_small, name):
    plan = plan_text(E.queries()[name](spark, sf_small))
    assert not any(node in plan for node in PYTHON_NODES), plan


def test_report_prunes_and_pushes(spark, sf_small):
    plan = plan_text(E.queries()["zone_month_report"](spark, sf_small))
    assert "EqualTo(l_returnflag,R)" in plan and "EqualTo(l_returnflag,A)" in plan
    assert "In(l_linenumber, [1,2,6])" in plan and "In(l_linenumber, [1,2,6,7])" in plan
    for line in plan.splitlines():
        if "ReadSchema" in line or "FileScan" in line:
            assert "l_linestatus" not in line and "l_partkey" not in line
    # one hash exchange for the aggregate, and a buffer for each sum
    assert plan.count("Exchange") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("partial_sum") == 8


def test_single_month_bounds_are_pushed(spark, sf_small):
    plan = plan_text(E.queries()["clean_green_month"](spark, sf_small))
    assert "GreaterThanOrEqual(l_shipdate,1996-02-01T00:00)" in plan


def test_stream_plans_stay_in_the_jvm(spark, sf_small):
    import contextlib
    import io

    from tripflow.operators import metrics as M
    from tripflow.operators.wire import decode_rides
    from tripflow.plans.adapters import rides_from_events
    from tripflow.sources.stream import table_stream

    rides = rides_from_events(table_stream(spark, sf_small, "events"))
    plans = [
        M.running_totals(rides),
        M.window_metrics(rides),
        M.anomalies(rides),
        M.surcharged_trips(rides),
        M.peak_windows(rides),
        decode_rides(rides.selectExpr("CAST(VendorID AS STRING) AS value")),
    ]
    for plan in plans:
        assert plan.isStreaming
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            plan.explain(True)
        text = buf.getvalue()
        assert not any(node in text for node in PYTHON_NODES), text
