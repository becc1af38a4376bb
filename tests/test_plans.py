"""Plan shape: one shuffle per windowed result, keyed on (key, window), partial
aggregation before it, JSON parsed once, nothing broadcast that grows unchecked."""

import re

from sessionrate.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_kill_rate_one_shuffle_on_session_and_window(spark):
    plan = _plan(QUERIES["kill_rate"](spark, SF))
    ex = _hash_exchanges(plan)
    assert len(ex) == 1
    assert "session" in ex[0] and "window_start_ms" in ex[0]
    assert "partial_count" in plan                  # map-side combine before the shuffle
    assert plan.count("from_json") == 1            # parsed once
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_windowed_rates_never_shuffle_on_key_alone(spark):
    for name in ["kill_rate_fine", "session_activity", "action_rate", "activity_span",
                 "move_count", "window_summary"]:
        for keys in _hash_exchanges(_plan(QUERIES[name](spark, SF))):
            assert "window_start_ms" in keys or "__bucket" in keys, (name, keys)


def test_auto_plan_follows_the_widths(spark):
    fine, direct, wide = (_hash_exchanges(_plan(QUERIES[n](spark, SF)))
                          for n in ("kill_rate_fine", "kill_rate_fine_direct", "kill_rate_fine_scaled"))
    assert "__bucket" in fine[0] and "window_start_ms" in direct[0] and "window_start_ms" in wide[0]


def test_grouped_lists_take_one_scan_and_one_wide_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["windowed_group"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    ex = _hash_exchanges(plan)
    assert len(ex) == 1 and "part" in ex[0] and "window_start_ms" in ex[0]
    assert plan.count("from_json") == 1 and plan.count("FileScan") == 1 and "Join" not in plan


def test_bucketed_plan_takes_one_shuffle_on_session_and_bucket(spark):
    ex = _hash_exchanges(_plan(QUERIES["kill_rate_fine_bucketed"](spark, SF)))
    assert len(ex) == 1 and "__bucket" in ex[0] and "window_start_ms" not in ex[0]


def test_feedback_parses_once(spark):
    plan = _plan(QUERIES["metric_feedback"](spark, SF))
    assert plan.count("parseJson") == 1
