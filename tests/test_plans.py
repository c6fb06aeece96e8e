"""Plan regressions: the physical shapes the scale design relies on."""

from encore.plans import registry

from .conftest import SF_SMALL


def _plan(spark, name, aqe=False):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", str(aqe).lower())
    try:
        return registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_song_features_hash_aggregates_two_shuffles(spark):
    plan = _plan(spark, "song_features")
    assert "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2


def test_top30_uses_partial_group_limit(spark):
    for name in ("song_rsi_top30", "singer_rsi_top30", "hot_songs"):
        plan = _plan(spark, name)
        assert plan.count("WindowGroupLimit") >= 2, name  # partial before and final after the shuffle


def test_small_lookups_are_broadcast(spark):
    plan = _plan(spark, "machine_profile")
    assert plan.count("BroadcastExchange") >= 4


def test_sliding_windows_are_summed_from_panes(spark):
    """Records are counted per pane (one row each, no expansion to windows)
    before the first of two shuffles; windows are built from the panes."""
    plan = _plan(spark, "pv_sliding")
    assert plan.count("Exchange hashpartitioning") == 2
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "Expand" in plan and "Expand" not in below and "partial_count" in below
