"""Report entry points (R1-R8) over a metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.constants import CHANNELS, GEO_REPORT_CITIES, OVERALL_DIM, PRODUCTS
from feedlens.operators import metrics as M
from feedlens.operators.joins import broadcast_if_small, spine
from feedlens.schemas import METRIC_VALUE_FIELDS


def segment_report(spark: SparkSession, metrics: DataFrame, dim: str, values: list[str] | DataFrame,
                   with_histogram: bool = False) -> DataFrame:
    """J3 + A7: every spine value appears, zero metrics when there is no data.

    ``values``: a list, or a frame (key, spine_pos) as read from a dimension table.
    ``metrics`` holds one row per (dim, key) (e.g. ``latest_metrics``). Its
    rows are first cut to the spine's keys by a left semi join, which leaves at most one
    row per spine value for the spine-preserving left join. A list is broadcast, being
    bounded by its length; a frame only while its size estimate allows it."""
    sp = broadcast_if_small(values) if isinstance(values, DataFrame) else spine(spark, values, "key")
    cols = ["key", *[c for c in METRIC_VALUE_FIELDS if c in metrics.columns]]
    for extra in ("last_updated", "emotion_distribution"):
        if extra in metrics.columns and (with_histogram or extra == "last_updated"):
            cols.append(extra)
    m = metrics.filter(F.col("dim") == dim).select(*cols) \
        .join(sp.select("key"), "key", "left_semi")
    out = sp.join(m, "key", "left")
    out = M.fill_zero_metrics(out)
    return out.select(F.lit(dim).alias("dim"), *out.columns)


def get_metrics_or_zero(spark: SparkSession, metrics: DataFrame, dim: str,
                        key: str | None) -> DataFrame:
    """R1/R5 + F9 + A7: one row for (dim, key), zeros if the key is absent."""
    if dim == OVERALL_DIM:
        m = metrics.filter(F.col("dim") == OVERALL_DIM).withColumn("key", F.lit(OVERALL_DIM))
        rep = segment_report(spark, m.withColumn("dim", F.lit(OVERALL_DIM)), OVERALL_DIM,
                             [OVERALL_DIM])
        return rep.withColumn("key", F.lit(None).cast("string"))
    return segment_report(spark, metrics, dim, [key])


def geo_report(spark, metrics, cities=GEO_REPORT_CITIES):
    """R2."""
    return segment_report(spark, metrics, "geo", cities)


def product_report(spark, metrics, products=PRODUCTS):
    """R3."""
    return segment_report(spark, metrics, "product", products)


def channel_report(spark, metrics, channels=CHANNELS):
    """R4."""
    return segment_report(spark, metrics, "channel", channels)


def geo_view(report: DataFrame, digits: int = 2) -> DataFrame:
    """Mean sentiment per city rounded for display."""
    return report.select("key", F.round("avg_sentiment", digits).alias("avg_sentiment_label"))
