"""Set operations and deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Fan-in of several message sources; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_listings(a: DataFrame, b: DataFrame, id_col: str = "id",
                   order: list | None = None) -> DataFrame:
    """Union of two listings, each id processed once. With ``order`` the
    kept copy is the first under that order; otherwise any copy."""
    u = a.unionByName(b, allowMissingColumns=True)
    if order:
        return dedupe(u, id_col, order)
    return u.dropDuplicates([id_col])


def dedupe(df: DataFrame, id_col: str = "id", order: list | None = None,
           watermark_col: str | None = None, delay: str | None = None, slices: int = 1) -> DataFrame:
    """D3 / T-9: keep one row per id.

    * stream: ``dropDuplicatesWithinWatermark`` (state bounded by the delay). With
      ``slices`` over 1 in two steps: rows are dealt to so many slices at random, each lets
      an id through once, and what is left, ``slices`` rows of an id at most, is
      deduplicated for good. A hot id's rows are spread over as many tasks;
    * batch, no order: ``dropDuplicates`` (hash aggregate with partial dedupe
      before the shuffle, so a hot id collapses map-side);
    * batch with order: keep the first row per id by ``min_by`` over a struct,
      which Spark aggregates by sorting, with partial aggregation before the
      shuffle."""
    keys = [id_col] if isinstance(id_col, str) else list(id_col)
    if df.isStreaming:
        if watermark_col and delay:
            df = df.withWatermark(watermark_col, delay)
        if slices > 1:
            dealt = df.withColumn("_slice", F.floor(F.rand(7) * slices).cast("int"))
            df = dealt.dropDuplicatesWithinWatermark([*keys, "_slice"]).drop("_slice")
        return df.dropDuplicatesWithinWatermark(keys)
    if not order:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    ords = [F.col(o) if isinstance(o, str) else o for o in order]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*ords)).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def dedupe_text(df: DataFrame, text_col: str = "text", id_col: str = "id") -> DataFrame:
    """Exact-copy dedupe by content, one way at every size: (id, copies,
    n_chars) of each distinct text, with the smallest id that is not null.

    Texts are the same when their SHA-256 and length are, so no text crosses
    the shuffle; min and count are partially aggregated, so a text copied a
    million times collapses in the tasks that read it. Repeated and null ids
    count as copies, the null text is a text of its own."""
    t = F.col(text_col)
    return df.groupBy(F.unhex(F.sha2(t, 256)).alias("_sha"), F.length(t).alias("n_chars")) \
        .agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies")) \
        .select(id_col, "copies", "n_chars")
