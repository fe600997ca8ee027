"""Row filters and predicates (F1-F10). All are Column predicates, so Catalyst
pushes the column-only ones into the Parquet scan and they run unchanged on
streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.constants import HIGH_CHURN_THRESHOLD, MAX_SCORABLE_CHARS, REMOVED_BODIES
from feedlens.operators.enrich import scorable


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(df: DataFrame, text_col: str = "text") -> DataFrame:
    """text is non-null and non-empty; whitespace-only text passes (no trim)."""
    t = F.col(text_col)
    return df.filter(t.isNotNull() & (t != ""))


def contains_any_col(col, words: list[str]) -> Column:
    """F2 predicate: case-insensitive substring match of any word."""
    low = F.lower(_c(col))
    pred = F.lit(False)
    for w in words:
        pred = pred | low.contains(w.lower())
    return F.coalesce(pred, F.lit(False))


def contains_any(df: DataFrame, col: str, words: list[str]) -> DataFrame:
    """keep rows whose column contains any of the words (any case)."""
    return df.filter(contains_any_col(col, words))


def search_filter(df: DataFrame, keywords: list[str], langs: list[str] | None = None,
                  text_col: str = "text", lang_col: str = "language",
                  repost_col: str | None = "is_retweet") -> DataFrame:
    """(k1 OR k2 ...) AND lang IN (...) AND not a repost."""
    pred = contains_any_col(text_col, keywords)
    if langs:
        pred = pred & F.col(lang_col).isin(*langs)
    if repost_col and repost_col in df.columns:
        pred = pred & ~F.coalesce(F.col(repost_col), F.lit(False))
    return df.filter(pred)


def drop_removed(df: DataFrame, body_col: str = "body") -> DataFrame:
    """drop NULL, empty, ``[deleted]`` and ``[removed]`` bodies."""
    b = F.col(body_col)
    return df.filter(b.isNotNull() & ~b.isin(*REMOVED_BODIES))


def churn_alerts(df: DataFrame, threshold: float = HIGH_CHURN_THRESHOLD,
                 alert_at=None) -> DataFrame:
    """rows with churn_risk strictly above the threshold, wrapped as
    (message struct, alert timestamp)."""
    ts = F.current_timestamp() if alert_at is None else F.lit(alert_at).cast("timestamp")
    return df.filter(F.col("churn_risk") > threshold) \
        .select(F.struct(*[F.col(c) for c in df.columns]).alias("message"),
                ts.alias("alert_timestamp"))


def scorable_split(df: DataFrame, text_col: str = "text",
                   max_chars: int = MAX_SCORABLE_CHARS) -> DataFrame:
    """flag rows the scorer accepts (1..max_chars code points)."""
    return df.withColumn("scorable", scorable(text_col, max_chars))


def since(df: DataFrame, id_col: str, last_id) -> DataFrame:
    """F8: only ids above the last seen maximum. ``last_id`` may be a literal or
    a one-row, one-column DataFrame (e.g. ``seen.agg(max(id))``)."""
    if isinstance(last_id, DataFrame):
        # Scalar subquery: evaluated once, no join. No seen rows -> keep all.
        hwm = last_id.scalar()
        return df.filter(hwm.isNull() | (F.col(id_col) > hwm))
    return df.filter(F.col(id_col) > F.lit(last_id))


def search_history(df: DataFrame, date_from=None, date_to=None, words: list[str] | None = None,
                   equals: dict | None = None, date_col: str = "index_date",
                   text_col: str = "text") -> DataFrame:
    """date-range + text + field search of the message history. On a table
    partitioned by ``index_date`` the date predicate prunes partitions."""
    pred = F.lit(True)
    if date_from is not None:
        pred = pred & (F.col(date_col) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        pred = pred & (F.col(date_col) <= F.lit(date_to).cast("date"))
    if words:
        pred = pred & contains_any_col(text_col, words)
    for k, v in (equals or {}).items():
        pred = pred & (F.col(k) == F.lit(v))
    return df.filter(pred)
