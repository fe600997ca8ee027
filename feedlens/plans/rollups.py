"""Registered rollup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import metrics as M
from feedlens.operators.filters import clean
from feedlens.plans.catalog import register, rounded, scored_messages
from feedlens.plans.oracle_sql import METRIC_SQL, with_scored
from feedlens.sources.tables import document_columns, message_base

METRIC_COLS = ["count", "avg_sentiment", "positive_count", "negative_count", "neutral_count",
               "avg_churn_risk", "high_churn_count", "avg_toxicity"]


def _by(col: str, alias: str):
    def q(spark, sf_dir):
        s = scored_messages(spark, sf_dir)
        out = M.segment_metrics(s, [col], ts_col=None, emotions=False)
        return rounded(out.withColumnRenamed(col, alias))
    sql = with_scored(f"SELECT {col} AS {alias}, {METRIC_SQL}\nFROM scored GROUP BY {col}")
    return q, sql


for _name, _col in [("metrics_by_city", "city"), ("metrics_by_product", "product"),
                    ("metrics_by_channel", "channel"), ("metrics_by_platform", "platform")]:
    _q, _sql = _by(_col, _col)
    register(_name, _sql, bench=_name == "metrics_by_city")(_q)


@register("overall_metrics", with_scored(f"SELECT {METRIC_SQL}\nFROM scored"))
def overall_metrics(spark, sf_dir):
    """A5: label counts and means with no keys (gauge)."""
    return rounded(M.segment_metrics(scored_messages(spark, sf_dir), None, ts_col=None,
                                     emotions=False))


_MULTI_SQL = with_scored(f"""
SELECT CASE GROUPING(city, product, channel, platform)
         WHEN 7 THEN 'geo' WHEN 11 THEN 'product' WHEN 13 THEN 'channel'
         WHEN 14 THEN 'platform' ELSE 'overall' END AS dim,
       CASE GROUPING(city, product, channel, platform)
         WHEN 7 THEN coalesce(city, 'null') WHEN 11 THEN coalesce(product, 'null')
         WHEN 13 THEN coalesce(channel, 'null') WHEN 14 THEN coalesce(platform, 'null')
       END AS key,
       {METRIC_SQL}
FROM scored
GROUP BY GROUPING SETS ((city), (product), (channel), (platform), ())""")


@register("multi_segment_metrics", _MULTI_SQL, bench=True)
def multi_segment_metrics(spark, sf_dir):
    """A2 + P11 by GROUPING SETS."""
    return rounded(M.multi_segment_metrics(scored_messages(spark, sf_dir), ts_col=None,
                                           emotions=False))


@register("multi_segment_metrics_explode", _MULTI_SQL)
def multi_segment_metrics_explode(spark, sf_dir):
    """A2 + P11 by explicit fan-out (the streaming form)."""
    return rounded(M.exploded_segment_metrics(scored_messages(spark, sf_dir), ts_col=None,
                                              emotions=False))


@register("metric_keys", with_scored("""
SELECT DISTINCT 'sentiment:geo:' || coalesce(city, 'null') AS metric_key FROM scored
UNION SELECT DISTINCT 'sentiment:product:' || coalesce(product, 'null') FROM scored
UNION SELECT DISTINCT 'sentiment:channel:' || coalesce(channel, 'null') FROM scored
UNION SELECT DISTINCT 'sentiment:platform:' || coalesce(platform, 'null') FROM scored
UNION SELECT 'sentiment:overall'"""))
def metric_keys(spark, sf_dir):
    """Storage keys of every segment present in the data; no text is scored."""
    texts = clean(document_columns(spark, sf_dir)).select("doc_id")
    s = message_base(spark, sf_dir).join(texts, "doc_id", "left_semi") \
        .select("city", "product", "channel", "platform")
    return M.explode_segments(s).select(M.metric_key("dim", "key").alias("metric_key")).distinct()


_EMO_SQL = with_scored("""
SELECT dim, key, emotion, count(*) AS n FROM (
  SELECT 'geo' AS dim, coalesce(city, 'null') AS key, emotion FROM scored
  UNION ALL SELECT 'product', coalesce(product, 'null'), emotion FROM scored
  UNION ALL SELECT 'channel', coalesce(channel, 'null'), emotion FROM scored
  UNION ALL SELECT 'platform', coalesce(platform, 'null'), emotion FROM scored
  UNION ALL SELECT 'overall', NULL, emotion FROM scored
) WHERE emotion IS NOT NULL AND emotion <> '' GROUP BY dim, key, emotion""")


@register("emotion_distribution", _EMO_SQL)
def emotion_distribution(spark, sf_dir):
    """A3: per-segment emotion histogram, as rows (dim, key, emotion, n)."""
    seg = M.multi_segment_metrics(scored_messages(spark, sf_dir), ts_col=None, emotions=True)
    return seg.select("dim", "key", F.explode("emotion_distribution").alias("emotion", "n"))


@register("emotion_distribution_open", _EMO_SQL)
def emotion_distribution_open(spark, sf_dir):
    """A3 open-list form: two-level aggregate over the exploded segments."""
    s = M.explode_segments(scored_messages(spark, sf_dir).select(
        "city", "product", "channel", "platform", "emotion"))
    return M.open_emotion_distribution(s, ["dim", "key"])


@register("emotion_shares", with_scored("""
SELECT emotion, n, total, round(n / total, 6) AS share FROM (
  SELECT emotion, n, sum(n) OVER () AS total FROM (
    SELECT emotion, count(*) AS n FROM scored
    WHERE emotion IS NOT NULL AND emotion <> '' GROUP BY emotion) WHERE n > 0)"""))
def emotion_shares(spark, sf_dir):
    """A4 + F7: emotion pie, share of the overall total."""
    return rounded(M.emotion_shares(scored_messages(spark, sf_dir)))


@register("sentiment_gauge", with_scored("""
SELECT count(*) FILTER (WHERE sentiment_label = 'positive') AS positive_count,
       count(*) FILTER (WHERE sentiment_label = 'negative') AS negative_count,
       count(*) - count(*) FILTER (WHERE sentiment_label = 'positive')
                - count(*) FILTER (WHERE sentiment_label = 'negative') AS neutral_count,
       round(sum(coalesce(sentiment_score, 0.0)) / count(*), 6) AS avg_sentiment
FROM scored"""))
def sentiment_gauge(spark, sf_dir):
    """A5: gauge = label counts with the mean."""
    m = M.segment_metrics(scored_messages(spark, sf_dir), None, ts_col=None, emotions=False)
    return rounded(m.select("positive_count", "negative_count", "neutral_count", "avg_sentiment"))


@register("channel_performance", with_scored("""
SELECT channel, count, avg_sentiment,
       coalesce(nullif(max(count) OVER (), 0), 100) AS axis_max FROM (
  SELECT channel, count(*) AS count,
         round(sum(coalesce(sentiment_score, 0.0)) / count(*), 6) AS avg_sentiment
  FROM scored GROUP BY channel)"""))
def channel_performance(spark, sf_dir):
    """Channel volume, mean, and the chart axis maximum."""
    return rounded(M.channel_performance(scored_messages(spark, sf_dir)))


@register("label_confusion", with_scored("""
SELECT CAST(l.toxic AS BIGINT) AS expected, s.sentiment_label AS predicted, count(*) AS n
FROM scored s JOIN labels l ON s.doc_id = l.doc_id
GROUP BY l.toxic, s.sentiment_label"""))
def label_confusion(spark, sf_dir):
    """Predicted label against the toxic flag of ``labels``."""
    from feedlens.sources.tables import read_table
    lab = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.col("toxic").cast("bigint").alias("expected"))
    s = scored_messages(spark, sf_dir).select("doc_id", "sentiment_label")
    return M.label_confusion(s.join(lab, "doc_id"), "sentiment_label", "expected")

