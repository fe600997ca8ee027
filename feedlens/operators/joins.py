"""Join helpers: size-checked broadcast, spine joins, semi/anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its size statistics stay within this bound;
# beyond it the join is a shuffle join (sort-merge, AQE may still demote it).
MAX_BROADCAST_BYTES = 32 << 20


ROW_BYTES = 40  # of a row in a broadcast table, besides its values


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when the optimizer's size estimate of its plan is at
    most ``max_bytes``, else ``df``. The estimate knows files as they are packed;
    with the number of ``rows`` their size in the driver's memory counts as well.

    The estimate starts from the files' sizes and grows with every join, so it
    is an upper guess for the narrow projections used here; no job runs, and it is
    made anew for every plan, so a table that has grown is not broadcast any
    more. Streaming frames are returned unchanged."""
    if df.isStreaming:
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    held = (rows or 0) * (df._jdf.schema().defaultSize() + ROW_BYTES)
    return F.broadcast(df) if max(int(str(size)), held) <= max_bytes else df


def spine(spark: SparkSession, values: list, name: str = "key") -> DataFrame:
    """A dimension spine: one row per listed value with its list position.

    Built from literals in the JVM (``inline`` over one row), so no Python
    worker is involved. Size is bounded by the parameter list, so it is
    always safe to broadcast."""
    rows = [F.struct(F.lit(v).cast("string").alias(name), F.lit(i).alias("spine_pos"))
            for i, v in enumerate(values)]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*rows))))


def new_only(df: DataFrame, seen: DataFrame, on="id") -> DataFrame:
    """Rows whose key is not already stored (left anti join)."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(seen.select(*keys), keys, "left_anti")
