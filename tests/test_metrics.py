"""Rollups, reports, rankings and statistics on hand-made rows."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from feedlens.operators import metrics as M
from feedlens.operators import reports as R
from feedlens.operators import stats as ST
from feedlens.operators import trends as T

PROC = ("id string, city string, product string, channel string, platform string, "
        "sentiment_score double, sentiment_label string, churn_risk double, toxicity double, "
        "emotion string, timestamp timestamp")
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _rows():
    return [
        ("1", "Dubai", "Mortgage", "Branch", "twitter", 0.5, "positive", 0.7, 0.1, "joy", T0),
        ("2", "Dubai", "Mortgage", "Website", "twitter", None, None, None, None, None, T0),
        ("3", None, "Investment", "Branch", "reddit", -0.8, "negative", 0.9, 0.5, "anger",
         T0 + dt.timedelta(seconds=30)),
        ("4", None, None, None, "reddit", 0.1, "mixed", 0.71, None, "", T0 + dt.timedelta(seconds=90)),
    ]


def test_segment_metrics_null_semantics(spark):
    df = spark.createDataFrame(_rows(), PROC)
    r = M.segment_metrics(df, None, ts_col="timestamp").first()
    assert r["count"] == 4
    assert r.avg_sentiment == pytest.approx((0.5 + 0 - 0.8 + 0.1) / 4)  # NULL counts as 0
    assert (r.positive_count, r.negative_count, r.neutral_count) == (1, 1, 2)
    assert r.high_churn_count == 2  # 0.7 is not high, 0.9 and 0.71 are
    assert r.avg_toxicity == pytest.approx(0.6 / 4)
    assert r.emotion_distribution == {"joy": 1, "anger": 1}  # NULL and "" skipped
    assert r.last_updated == T0 + dt.timedelta(seconds=90)


def test_grouping_sets_tell_null_key_from_total(spark):
    df = spark.createDataFrame(_rows(), PROC)
    a = {(r.dim, r.key): r["count"] for r in M.multi_segment_metrics(df).collect()}
    b = {(r.dim, r.key): r["count"] for r in M.exploded_segment_metrics(df).collect()}
    assert a == b
    assert a[("geo", "null")] == 2 and a[("overall", None)] == 4
    assert a[("product", "null")] == 1 and a[("platform", "reddit")] == 2
    # property: overall equals the sum over any one dimension
    for d in ("geo", "product", "channel", "platform"):
        assert sum(v for (dd, _), v in a.items() if dd == d) == a[("overall", None)]


def test_metric_key_names(spark):
    df = spark.createDataFrame([("geo", "Dubai"), ("overall", None), ("geo", None)], "dim string, key string")
    got = [r[0] for r in df.select(M.metric_key("dim", "key")).collect()]
    assert got == ["sentiment:geo:Dubai", "sentiment:overall", "sentiment:geo:null"]


def test_segment_report_spine_zero_fill(spark):
    df = spark.createDataFrame(_rows(), PROC)
    seg = M.multi_segment_metrics(df, ts_col="timestamp")
    rep = {r.key: r for r in R.segment_report(spark, seg, "geo", ["Dubai", "Ajman"]).collect()}
    assert rep["Dubai"]["count"] == 2
    z = rep["Ajman"]
    assert (z["count"], z.avg_sentiment, z.high_churn_count, z.spine_pos) == (0, 0.0, 0, 1)
    one = R.get_metrics_or_zero(spark, seg, "overall", None).first()
    assert one["count"] == 4


def test_rank_and_best_product_ties(spark):
    rep = spark.createDataFrame([("A", 0, 0.5), ("B", 1, 0.7), ("C", 2, 0.7), ("D", 3, 0.1)],
                                "key string, spine_pos int, avg_sentiment double")
    ranks = {r.key: r["rank"] for r in T.rank_products(rep).collect()}
    assert ranks == {"B": 1, "C": 2, "A": 3, "D": 4}
    assert T.best_product(rep).first().best_product == "C"  # later one wins a tie


def test_emotion_shares_and_channel_axis(spark):
    df = spark.createDataFrame(_rows(), PROC)
    sh = {r.emotion: r.share for r in M.emotion_shares(df).collect()}
    assert sh == {"joy": 0.5, "anger": 0.5}
    cp = M.channel_performance(df).collect()
    assert {r.axis_max for r in cp} == {2}


def test_latency_stats_exclusive_quantiles(spark):
    vals = [float(v) for v in range(1, 101)]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 7.0)], "k string, v double")
    got = {r.k: r for r in ST.latency_stats(df, "v", ["k"]).collect()}
    a = got["a"]
    assert a.p95 == pytest.approx(95.95) and a.p99 == pytest.approx(99.99)
    assert a.median == 50.5 and a.min == 1.0 and a.max == 100.0
    assert a.stdev == pytest.approx(statistics.stdev(vals))
    assert got["b"].p95 == 7.0 and got["b"].median == 7.0
    assert statistics.quantiles(vals, n=20)[18] == pytest.approx(a.p95)


def test_latency_stats_match_python_on_skewed_keys(spark):
    import random
    rnd = random.Random(7)
    data = [("hot", round(rnd.random() * 100, 2)) for _ in range(3000)] + \
           [("cold", round(rnd.random() * 10, 2)) for _ in range(5)] + [("two", 1.0), ("two", 3.0)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r for r in ST.latency_stats(df, "v", ["k"]).collect()}
    for k in ("hot", "cold", "two"):
        xs = sorted(v for kk, v in data if kk == k)
        assert got[k].p95 == pytest.approx(statistics.quantiles(xs, n=20)[18])
        assert got[k].p99 == pytest.approx(statistics.quantiles(xs, n=100)[98])
        assert got[k].median == pytest.approx(statistics.median(xs))


def test_inference_histogram_cumulative(spark):
    df = spark.createDataFrame([(4.0,), (9.0,), (60.0,), (2000.0,)], "ms double")
    r = M.inference_histogram(df, "ms", [0.005, 0.01, 0.1, 1.0], scale=0.001).first()
    assert (r.le_0_005, r.le_0_01, r.le_0_1, r.le_1, r.le_inf) == (1, 2, 3, 3, 4)


def test_recent_trend_and_top_n_per_key(spark):
    rows = [(f"{i:03d}", T0 + dt.timedelta(minutes=i), (-1) ** i * 0.1, "k" if i < 90 else "j")
            for i in range(100)]
    df = spark.createDataFrame(rows, "id string, timestamp timestamp, sentiment_score double, ch string")
    rt = T.recent_trend(df, 5).orderBy("position").collect()
    assert [r.id for r in rt] == ["095", "096", "097", "098", "099"]
    assert [r.position for r in rt] == [1, 2, 3, 4, 5]
    assert rt[0].non_negative is False and rt[1].non_negative is True
    per = T.recent_trend(df, 3, keys=["ch"]).collect()
    assert sorted(r.id for r in per if r.ch == "k") == ["087", "088", "089"]
    top = T.top_n_per_key(df, ["ch"], [F.col("id")], 2).collect()
    assert sorted(r.id for r in top) == ["000", "001", "090", "091"]


def test_windowed_latest_live_velocity(spark):
    df = spark.createDataFrame(_rows(), PROC)
    w = T.windowed_metrics(df, "timestamp", "60 seconds", emotions=False)
    ov = {r.window_start: r["count"] for r in w.filter("dim = 'overall'").collect()}
    assert ov == {T0: 3, T0 + dt.timedelta(seconds=60): 1}
    latest = T.latest_metrics(w).filter("dim = 'overall'").first()
    assert latest.window_start == T0 + dt.timedelta(seconds=60)
    live = T.live_metrics(T.latest_metrics(w), T0 + dt.timedelta(hours=25), 24)
    assert live.filter("dim = 'overall'").count() == 0
    vel = T.trend_velocity(w).filter("dim = 'overall'").orderBy("window_start").collect()
    assert vel[0].velocity is None and vel[1].elapsed_sec == 60.0


def test_label_confusion_and_progress(spark):
    df = spark.createDataFrame([("a", "positive", 1), ("b", "negative", 1), ("c", "positive", 1)],
                               "id string, sentiment_label string, toxic int")
    got = {(r.expected, r.predicted): r.n for r in M.label_confusion(df, "sentiment_label", "toxic").collect()}
    assert got == {(1, "positive"): 2, (1, "negative"): 1}
    ev = spark.createDataFrame([(T0,), (T0 + dt.timedelta(seconds=10),)], "ts timestamp")
    p = M.progress(ev, "ts", total=4).first()
    assert (p.processed, p.span_sec, p.rate_per_sec, p.percent, p.remaining) == (2, 10.0, 0.2, 50.0, 2)


def test_latency_stats_approx_and_throughput(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(1, 101)], "k string, v double")
    r = ST.latency_stats(df, "v", ["k"], method="approx").first()
    assert abs(r.p95 - 95.95) <= 1.0 and r["count"] == 100
    t = ST.throughput(ST.latency_stats(df, "v", ["k"]), batch_size=10).first()
    assert t.throughput_per_sec == pytest.approx(10 * 1000.0 / 50.5)


def test_broadcast_only_with_proven_bound(spark):
    from feedlens.operators.joins import broadcast_if_small
    small = spark.range(10)
    big_for_bound = spark.range(1000)
    j1 = spark.range(5).join(broadcast_if_small(small, 800), "id")
    j2 = spark.range(5).join(broadcast_if_small(big_for_bound, 800), "id")
    p1 = j1._jdf.queryExecution().optimizedPlan().toString()
    p2 = j2._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in p1.lower()      # 10 rows of 8 bytes <= bound: hinted
    assert "broadcast" not in p2.lower()  # 1000 rows > bound: left to the planner


def test_a_grown_side_is_not_broadcast_any_more(spark, tmp_path):
    """Neither scans nor verdicts are remembered: appended rows are seen."""
    from feedlens.operators.joins import broadcast_if_small
    from feedlens.sources.tables import read_table
    path = str(tmp_path / "part.parquet")
    spark.range(5).write.parquet(path)
    size = lambda: "broadcast" in spark.range(5).join(
        broadcast_if_small(read_table(spark, str(tmp_path), "part"), 20_000), "id")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert read_table(spark, str(tmp_path), "part").count() == 5 and size()
    spark.range(50_000).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "part").count() == 50_005 and not size()


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_latency_ranks_with_ties_and_null_keys(spark, reuse):
    """A value that holds two thirds of a key's rows, a key of null, one row."""
    import statistics
    rows = [("a", 5.0)] * 4000 + [("a", float(v)) for v in range(2000)] + [(None, 1.0), (None, 3.0)] + [("b", 7.0)]
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = {r.k: r for r in ST.latency_stats(spark.createDataFrame(rows, "k string, v double"), "v", ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    vs = sorted(v for k, v in rows if k == "a")
    assert got["a"].p95 == pytest.approx(statistics.quantiles(vs, n=20)[18])
    assert got["a"].p99 == pytest.approx(statistics.quantiles(vs, n=100)[98])
    assert got["a"].median == statistics.median(vs) and got[None].median == 2.0 and got["b"].p99 == 7.0
