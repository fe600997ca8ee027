"""Plan assertions for scale: what the physical plans must (not) contain."""

import re

from feedlens.operators import metrics as M
from feedlens.plans.catalog import scored_messages
from feedlens.plans.registry import queries

from .conftest import SF001


def _plan(df) -> str:
    df.collect()  # let AQE settle
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan: str) -> list[str]:
    return [ln for ln in plan.splitlines() if re.search(r"\bExchange\b", ln)
            and "BroadcastExchange" not in ln]


def test_lexicon_path_has_no_python(spark):
    plan = _plan(queries()["metrics_by_city"](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF"):
        assert node not in plan


def test_grouping_sets_use_one_expand_and_one_aggregate_exchange(spark):
    s = scored_messages(spark, SF001)
    df = M.multi_segment_metrics(s, ts_col=None, emotions=False)
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert opt.count("Expand") == 1 and opt.count("Aggregate") == 1
    phys = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in phys or "PartialMerge" in phys or "Partial" in phys


def test_text_is_not_shuffled_by_rollups(spark):
    """No shuffle of a rollup carries the message text (the scorer runs before
    the join). AQE is switched off here only to walk the static plan."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = queries()["multi_segment_metrics"](spark, SF001)
        phys = df._jdf.queryExecution().executedPlan()
        outputs = []

        spreads = []

        def walk(node):
            if "Exchange" in node.nodeName() and "Broadcast" not in node.nodeName():
                part = node.outputPartitioning().toString()
                if part.startswith("RoundRobinPartitioning"):
                    spreads.append(part)  # spread_for_cpu on an under-split scan
                else:
                    outputs.append(node.output().toString())
            it = node.children().iterator()
            while it.hasNext():
                walk(it.next())

        walk(phys)
        assert outputs, "expected shuffle exchanges"
        # no join / aggregation shuffle carries the text
        assert all("text#" not in o for o in outputs), outputs
        # the only text-carrying exchange is the spread of a scan that has
        # fewer splits than cores (absent when the input is large)
        assert len(spreads) <= 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = queries()["contains_any"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    docs_scan = [ln for ln in plan.splitlines() if "documents.parquet" in ln or "ReadSchema" in ln]
    assert not any("embedding" in ln for ln in docs_scan)
    s = queries()["new_only"](spark, SF001)
    p2 = s._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint>" in p2 or "struct<event_id:bigint>" in p2


def test_spine_report_scores_only_the_spine(spark):
    """The event side is cut to the spine's values before documents are scored."""
    df = queries()["segment_report_event_channels"](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and re.search(r"event_type#\d+ IN \(click", plan)


def test_metric_keys_score_nothing(spark):
    plan = queries()["metric_keys"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower()


def test_top_n_is_limited_before_the_shuffle(spark):
    plan = queries()["top_turns"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and len(_exchanges(plan.split("Initial Plan")[0])) <= 1
