"""Segment rollups.

Every aggregate here is algebraic (count / sum / count_if / max), so Spark
runs a partial aggregation before the shuffle and a hot segment (the grand
total, or one city holding a third of the rows) arrives at its reducer as one
partial row per map task. No ``collect_list`` anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.constants import (CHANNEL_AXIS_DEFAULT, EMOTION_LABELS, HIGH_CHURN_THRESHOLD, METRIC_KEY_PREFIX,
                                OVERALL_DIM, SEGMENT_DIMS)
from feedlens.schemas import METRIC_VALUE_FIELDS

# Columns the rollups read; projecting to these first keeps the Expand of the
# grouping sets narrow.
ROLLUP_INPUTS = ["sentiment_score", "sentiment_label", "churn_risk", "toxicity", "emotion"]
NULL_KEY = "null"


def metric_aggs(ts_col: str | None = "processing_timestamp", emotions: bool = True,
                emotion_labels=EMOTION_LABELS) -> list[Column]:
    """A1: the metrics of one group, in one pass.

    * means treat NULL as 0 and keep it in the denominator: sum(coalesce(x,0))/count(*);
    * any label other than positive / negative (NULL included) is neutral;
    * high churn is strictly > threshold, NULL is not high;
    * the emotion histogram skips NULL and empty emotions (closed label list).
    """
    n = F.count(F.lit(1))
    pos = F.count_if(F.col("sentiment_label") == "positive")
    neg = F.count_if(F.col("sentiment_label") == "negative")
    aggs = [
        n.alias("count"),
        (F.sum(F.coalesce(F.col("sentiment_score"), F.lit(0.0))) / n).alias("avg_sentiment"),
        pos.alias("positive_count"),
        neg.alias("negative_count"),
        (n - F.coalesce(pos, F.lit(0)) - F.coalesce(neg, F.lit(0))).alias("neutral_count"),
        (F.sum(F.coalesce(F.col("churn_risk"), F.lit(0.0))) / n).alias("avg_churn_risk"),
        F.count_if(F.coalesce(F.col("churn_risk"), F.lit(0.0)) > HIGH_CHURN_THRESHOLD)
        .alias("high_churn_count"),
        (F.sum(F.coalesce(F.col("toxicity"), F.lit(0.0))) / n).alias("avg_toxicity"),
    ]
    if ts_col:
        aggs.append(F.max(ts_col).alias("last_updated"))
    if emotions:
        aggs.append(emotion_histogram(emotion_labels).alias("emotion_distribution"))
    return aggs


def emotion_histogram(labels=EMOTION_LABELS) -> Column:
    """A3 (closed list): map emotion -> count with zero entries removed."""
    counts = [F.count_if(F.col("emotion") == lab) for lab in labels]
    m = F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), F.array(*counts))
    return F.map_filter(m, lambda k, v: v > 0)


def _rollup_input(df: DataFrame, extra: list[str]) -> DataFrame:
    cols = [c for c in ROLLUP_INPUTS if c in df.columns] + [c for c in extra if c in df.columns]
    return df.select(*dict.fromkeys(cols))


def segment_metrics(df: DataFrame, keys: list[str] | str | None = None,
                    ts_col: str | None = "processing_timestamp", emotions: bool = True) -> DataFrame:
    """A1/A5: metrics grouped by ``keys`` (no keys: one overall row)."""
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    ts_col = ts_col if ts_col in df.columns else None
    src = _rollup_input(df, keys + ([ts_col] if ts_col else []))
    g = src.groupBy(*keys) if keys else src.groupBy()
    return g.agg(*metric_aggs(ts_col, emotions))


def _dim_key_from_grouping(gid: Column, dims=SEGMENT_DIMS) -> tuple[Column, Column]:
    """Tell the dimension of a grouping-sets row by grouping_id(); the NULL-city
    group and the grand total are both NULL in the key columns (trap T2)."""
    n = len(dims)
    dim = F.lit(OVERALL_DIM)
    key = F.lit(None).cast("string")
    for i, (dname, col) in enumerate(dims):
        # grouping_id bit for column i is set when the column is aggregated away.
        only_i = (1 << n) - 1 - (1 << (n - 1 - i))
        dim = F.when(gid == only_i, F.lit(dname)).otherwise(dim)
        key = F.when(gid == only_i, F.coalesce(F.col(col).cast("string"), F.lit(NULL_KEY))) \
            .otherwise(key)
    return dim, key


def multi_segment_metrics(df: DataFrame, ts_col: str | None = "processing_timestamp",
                          emotions: bool = True, dims=SEGMENT_DIMS,
                          window_col: str | None = None) -> DataFrame:
    """A2: geo, product, channel, platform and overall in one aggregation
    (GROUPING SETS -> one Expand + one partial/final HashAggregate, one shuffle)."""
    cols = [c for _, c in dims]
    ts_col = ts_col if ts_col in df.columns else None
    extra = cols + ([ts_col] if ts_col else []) + ([window_col] if window_col else [])
    src = _rollup_input(df, extra)
    lead = [window_col] if window_col else []
    sets = [lead + [c] for c in cols] + [lead]
    # grouping_id() must name every grouping column; the lead (window) column
    # is in every set, so its bit is always 0 and the dimension codes stay.
    agg = src.groupingSets(sets, *lead, *cols).agg(
        *metric_aggs(ts_col, emotions), F.grouping_id(*lead, *cols).alias("_gid"))
    dim, key = _dim_key_from_grouping(F.col("_gid"), dims)
    return agg.select(*lead, dim.alias("dim"), key.alias("key"),
                      *[c for c in agg.columns if c not in cols + lead + ["_gid"]])


def explode_segments(df: DataFrame, dims=SEGMENT_DIMS) -> DataFrame:
    """One row fans out to one (dim, key) row per grouping plus overall.
    Used on streams, where the key must be an explicit column (trap T5)."""
    entries = [F.struct(F.lit(d).alias("dim"),
                        F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY)).alias("key"))
               for d, c in dims]
    entries.append(F.struct(F.lit(OVERALL_DIM).alias("dim"),
                            F.lit(None).cast("string").alias("key")))
    return df.withColumn("_seg", F.explode(F.array(*entries))) \
        .withColumn("dim", F.col("_seg.dim")).withColumn("key", F.col("_seg.key")).drop("_seg")


def exploded_segment_metrics(df: DataFrame, ts_col: str | None = "processing_timestamp",
                             emotions: bool = True, dims=SEGMENT_DIMS) -> DataFrame:
    """A2 by explicit fan-out; same rows as ``multi_segment_metrics``."""
    ts_col = ts_col if ts_col in df.columns else None
    src = _rollup_input(df, [c for _, c in dims] + ([ts_col] if ts_col else []))
    return explode_segments(src, dims).groupBy("dim", "key").agg(*metric_aggs(ts_col, emotions))


def metric_key(dim, key) -> Column:
    """Storage key ``sentiment:<dim>:<key>``, ``sentiment:overall``."""
    d = F.col(dim) if isinstance(dim, str) else dim
    k = F.col(key) if isinstance(key, str) else key
    return F.when(d == OVERALL_DIM, F.lit(f"{METRIC_KEY_PREFIX}:{OVERALL_DIM}")) \
        .otherwise(F.concat_ws(":", F.lit(METRIC_KEY_PREFIX), d, F.coalesce(k, F.lit(NULL_KEY))))


def zero_metrics_values() -> dict:
    """The zero row of an empty group."""
    return {c: (0.0 if c.startswith("avg_") else 0) for c in METRIC_VALUE_FIELDS}


def fill_zero_metrics(df: DataFrame) -> DataFrame:
    """Coalesce every metric of a missing group to zero; empty histogram."""
    zeros = zero_metrics_values()
    cols = []
    for c in df.columns:
        if c in zeros:
            cols.append(F.coalesce(F.col(c), F.lit(zeros[c])).alias(c))
        elif c == "emotion_distribution":
            cols.append(F.coalesce(F.col(c), F.create_map().cast("map<string,bigint>")).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def open_emotion_distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3 (open list, batch): (keys, emotion, n) for any non-empty emotion."""
    return df.filter(F.col("emotion").isNotNull() & (F.col("emotion") != "")) \
        .groupBy(*keys, "emotion").agg(F.count(F.lit(1)).alias("n"))


def emotion_shares(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Emotion count over the group's total, zero entries removed.

    The total is a window sum over the already aggregated counts, which hold
    one row per (keys, emotion): the window never sees raw rows."""
    keys = keys or []
    counts = open_emotion_distribution(df, keys).filter(F.col("n") > 0)
    total = F.sum("n").over(Window.partitionBy(*keys)) if keys else F.sum("n").over(Window.partitionBy())
    return counts.withColumn("total", total).withColumn("share", F.col("n") / F.col("total"))


def histogram_shares(df: DataFrame, keys: list[str], hist_col: str = "emotion_distribution") -> DataFrame:
    """A4/F7 from stored histograms (maps of emotion to count): (keys, emotion, n, total,
    share), without the entries that are zero."""
    total = F.aggregate(F.map_values(hist_col), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.select(*keys, total.alias("total"), F.explode(hist_col).alias("emotion", "n")).where("n > 0") \
        .select(*keys, "emotion", "n", "total", (F.col("n") / F.col("total")).alias("share"))


def channel_performance(df: DataFrame, channel_col: str = "channel") -> DataFrame:
    """Per-channel volume and mean, plus the chart axis maximum
    ``max(count)`` or 100 when there is no data or every count is 0."""
    per = df.groupBy(channel_col).agg(
        F.count(F.lit(1)).alias("count"),
        (F.sum(F.coalesce(F.col("sentiment_score"), F.lit(0.0))) / F.count(F.lit(1)))
        .alias("avg_sentiment"))
    # The window runs over the per-channel aggregate (one row per channel).
    axis = F.coalesce(F.nullif(F.max("count").over(Window.partitionBy()), F.lit(0)),
                      F.lit(CHANNEL_AXIS_DEFAULT))
    return per.withColumn("axis_max", axis)


def inference_histogram(df: DataFrame, col: str, bounds: list[float],
                        keys: list[str] | None = None, scale: float = 1.0) -> DataFrame:
    """A10: total count, sum and cumulative bucket counts ``count_if(col <= b)``
    per bound (plus +Inf), like a Prometheus histogram. ``scale`` converts the
    column to the bounds' unit (e.g. ms -> s is 0.001)."""
    keys = keys or []
    v = F.col(col) * F.lit(scale)
    aggs = [F.count(F.lit(1)).alias("total"), F.sum(v).alias("sum")]
    for b in bounds:
        aggs.append(F.count_if(v <= F.lit(b)).alias(f"le_{b:g}".replace(".", "_")))
    aggs.append(F.count(F.lit(1)).alias("le_inf"))
    g = df.groupBy(*keys) if keys else df.groupBy()
    return g.agg(*aggs)


def label_confusion(df: DataFrame, predicted: str, expected: str) -> DataFrame:
    """Agreement table of expected vs predicted labels."""
    return df.groupBy(F.col(expected).alias("expected"), F.col(predicted).alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("n"))


def progress(df: DataFrame, ts_col: str, total: int | None = None) -> DataFrame:
    """A11 (batch): processed count, time span, rate per second, percent and
    remaining against an expected total."""
    out = df.agg(F.count(F.lit(1)).alias("processed"),
                 F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"))
    span = F.timestamp_diff("MICROSECOND", F.col("first_ts"), F.col("last_ts")) / F.lit(1e6)
    out = out.withColumn("span_sec", span) \
        .withColumn("rate_per_sec", F.when(span > 0, F.try_divide(F.col("processed"), span)))
    if total is not None:
        out = out.withColumn("percent", F.col("processed") * 100.0 / F.lit(total)) \
            .withColumn("remaining", F.greatest(F.lit(total) - F.col("processed"), F.lit(0)))
    return out
