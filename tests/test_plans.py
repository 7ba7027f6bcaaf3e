"""Plan guards: the batch catalogue stays JVM-side, filters reach the scan."""

from pulse.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_batch_plans(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF))
        used = [n for n in PYTHON_NODES if n in plan]
        if name == "plugin_sentiment":
            assert used == ["ArrowEvalPython"], name   # the plug-in point, Arrow-batched
        else:
            assert not used, (name, used)


def test_cutoff_pushed_to_scan(spark):
    plan = _plan(QUERIES["skip_seen"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
