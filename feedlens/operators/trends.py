"""Windows, rankings, series and top-k (W1-W6, K1-K4, T-1 batch form)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.constants import RECENT_POINTS
from feedlens.operators import metrics as M

def _order(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n_per_key(df: DataFrame, keys: list[str], order: list, n: int,
                  rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows per key under ``order``, exact.

    Spark limits the rank below the shuffle (WindowGroupLimit): every task
    hands on at most n rows of a key, so a key with a third of all rows sends
    n rows per task. The order must be total (break ties with a unique
    column) for a deterministic result."""
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def recent_trend(df: DataFrame, n: int = RECENT_POINTS, ts_col: str = "timestamp",
                 id_col: str = "id", score_col: str = "sentiment_score",
                 keys: list[str] | None = None) -> DataFrame:
    """The last ``n`` points by arrival, returned in ascending order with a
    sign flag (score >= 0) and the time extent of the kept points.

    Without keys this is a global top-k (TakeOrderedAndProject: each task keeps
    its own n best, the driver merges n x tasks rows); with keys it is the
    per-key top-n."""
    if keys:
        ranked = top_n_per_key(df, keys, [F.col(ts_col).desc(), F.col(id_col).desc()], n,
                               rank_col="recency")
        w = Window.partitionBy(*keys)
    else:
        top = df.orderBy(F.col(ts_col).desc(), F.col(id_col).desc()).limit(n)
        # The window below sees at most n rows.
        ranked = top.withColumn("recency", F.row_number().over(
            Window.orderBy(F.col(ts_col).desc(), F.col(id_col).desc())))
        w = Window.partitionBy()
    return ranked.select(
        *(keys or []), F.col(id_col), F.col(ts_col), F.col(score_col),
        (F.count(F.lit(1)).over(w) + 1 - F.col("recency")).alias("position"),
        (F.col(score_col) >= 0).alias("non_negative"),
        F.min(ts_col).over(w).alias("first_ts"), F.max(ts_col).over(w).alias("last_ts"))


def recent_trend_scoring_last(candidates: DataFrame, texts: DataFrame, score, n: int = RECENT_POINTS,
                              ts_col: str = "timestamp", id_col: str = "id",
                              keys: list[str] | None = None, key: str = "doc_id") -> DataFrame:
    """W1 with the limit below the scorer: the last ``n`` points (per key) are
    chosen on narrow columns, joined once to their texts, and only those are
    scored.

    ``candidates`` holds the messages that have a text (no text column, but
    ``key``); ``texts`` holds (key, text, ...); ``score`` maps a text frame
    with ``id_col`` to a frame with ``id_col`` and ``sentiment_score``. Without
    keys the chosen set has n rows, so broadcasting it is bounded by n; with keys
    the join is left to its size at run time."""
    order = [F.col(ts_col).desc(), F.col(id_col).desc()]
    if keys:
        chosen = top_n_per_key(candidates, keys, order, n, rank_col="_r").drop("_r")
    else:
        chosen = F.broadcast(candidates.orderBy(*order).limit(n))
    return recent_trend(score(texts.join(chosen, key)), n, ts_col, id_col, "sentiment_score", keys)


def windowed_metrics(df: DataFrame, ts_col: str = "timestamp", width: str = "60 seconds",
                     emotions: bool = True, last_col: str | None = None) -> DataFrame:
    """T-1: tumbling event-time windows x (dim, key) metrics, batch or stream.

    Batch: GROUPING SETS with the window as a lead column (one Expand, one
    aggregate). Stream: the explicit fan-out (P11), so the state key is a plain
    (window, dim, key). Same rows either way."""
    src = df.select(*[c for c in M.ROLLUP_INPUTS if c in df.columns],
                    *[c for _, c in M.SEGMENT_DIMS], F.col(ts_col).alias("_ts"))
    if not df.isStreaming:
        g = M.multi_segment_metrics(src.withColumn("window", F.window("_ts", width)),
                                    ts_col="_ts", emotions=emotions, window_col="window")
        return g.select(F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"),
                        *[c for c in g.columns if c != "window"])
    seg = M.explode_segments(src)
    out = seg.groupBy(F.window("_ts", width).alias("window"), "dim", "key") \
        .agg(*M.metric_aggs("_ts", emotions))
    return out.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"),
                      *[c for c in out.columns if c != "window"])


def trend_series(df: DataFrame, ts_col: str = "timestamp", width: str = "1 day",
                 emotions: bool = False) -> DataFrame:
    """Overall metrics per tumbling window, keyed ``trend:<window start>``."""
    src = df.select(*[c for c in M.ROLLUP_INPUTS if c in df.columns], F.col(ts_col).alias("_ts"))
    out = src.groupBy(F.window("_ts", width).alias("window")).agg(*M.metric_aggs(None, emotions))
    return out.select(
        F.concat(F.lit("trend:"), F.date_format("window.start", "yyyy-MM-dd'T'HH:mm:ss")).alias(
            "trend_key"),
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[c for c in out.columns if c != "window"])


def trend_velocity(windowed: DataFrame, keys: list[str] | None = None,
                   value_col: str = "avg_sentiment") -> DataFrame:
    """Change of the windowed mean against the previous window of the same
    key, per second elapsed between window starts. Input has one row per
    (key, window), so each window partition holds one key's windows only."""
    keys = keys if keys is not None else ["dim", "key"]
    w = Window.partitionBy(*keys).orderBy("window_start")
    prev_v = F.lag(value_col).over(w)
    prev_t = F.lag("window_start").over(w)
    elapsed = F.timestamp_diff("MICROSECOND", prev_t, F.col("window_start")) / F.lit(1e6)
    return windowed.select(*keys, "window_start", value_col,
                           (F.col(value_col) - prev_v).alias("delta"),
                           elapsed.alias("elapsed_sec"),
                           F.try_divide(F.col(value_col) - prev_v, elapsed).alias("velocity"))


def latest_metrics(windowed: DataFrame, keys: list[str] | None = None,
                   order_col: str | list[str] = "window_end") -> DataFrame:
    """Per key the row of the latest window (``max_by`` over a struct, an
    algebraic aggregate with partial aggregation; no per-key sort). Several
    order columns break ties left to right (e.g. window_end, then batch_id for
    a window re-emitted by an update-mode stream)."""
    keys = keys or ["dim", "key"]
    rest = [c for c in windowed.columns if c not in keys]
    orders = [order_col] if isinstance(order_col, str) else list(order_col)
    order = F.col(orders[0]) if len(orders) == 1 else F.struct(*[F.col(c) for c in orders])
    agg = windowed.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def live_metrics(df: DataFrame, as_of, ttl_hours: int = 24,
                 ts_col: str = "last_updated") -> DataFrame:
    """Keys written within ``ttl_hours`` before ``as_of`` are live."""
    cutoff = F.lit(as_of).cast(df.schema[ts_col].dataType) - F.expr(f"INTERVAL {ttl_hours} HOURS")
    return df.filter(F.col(ts_col) > cutoff)


def rank_products(report: DataFrame, value_col: str = "avg_sentiment") -> DataFrame:
    """K1: by mean descending; ties keep spine order. The input is a spine
    report (one row per listed product), so the global window is bounded by
    the spine's length."""
    w = Window.orderBy(F.col(value_col).desc(), F.col("spine_pos").asc())
    return report.withColumn("rank", F.row_number().over(w))


def best_product(report: DataFrame, value_col: str = "avg_sentiment",
                 key_col: str = "key") -> DataFrame:
    """K2: the product with the highest mean; on a tie the later one in the
    spine wins (max_by over (mean, position))."""
    return report.agg(F.max_by(F.col(key_col), F.struct(F.col(value_col), F.col("spine_pos")))
                      .alias("best_product"),
                      F.max(value_col).alias(value_col))


def take(df: DataFrame, n: int, order: list | None = None) -> DataFrame:
    """K4: page limit (ordered when an order is given)."""
    return (df.orderBy(*_order(order)) if order else df).limit(n)


def listing(df: DataFrame, group_col: str, by: list, n: int = 25,
            name: str = "listing") -> DataFrame:
    """First ``n`` rows per group under an ordering (e.g. newest, hottest)."""
    return top_n_per_key(df, [group_col], by, n, rank_col=f"{name}_rank") \
        .withColumn(name, F.lit(name))


def first_n_per_parent(df: DataFrame, parent_col: str, position_col: str,
                       n: int = 10) -> DataFrame:
    """First ``n`` children per parent in listing order."""
    return top_n_per_key(df, [parent_col], [F.col(position_col).asc()], n, rank_col="rank")
