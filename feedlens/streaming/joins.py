"""J2 on streams: comments that come before or after their post."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def comments_of_posts(comments: DataFrame, posts: DataFrame, before: str = "10 minutes", after: str = "7 days",
                      delay: str = "10 minutes", slices: int = 8) -> DataFrame:
    """The rows of ``comments`` whose post is among ``posts``, both streams: a stream-stream
    left semi join that keeps a comment until its post comes, or can come no more.

    ``comments`` needs post_id and created_utc (epoch seconds), ``posts`` id and created_utc.
    A comment belongs to a post created no more than ``after`` before it and no more than
    ``before`` after it (clocks differ); ``delay`` is how late rows of either stream may
    come. The bounds and the delay limit the state of both sides. A comment is dealt to one
    of ``slices`` by its id and a post goes to all of them, so the comments of one busy
    post are not one task. A post that comes twice lets its comments through once; a
    comment without post_id, or without a time, has no post."""
    timed = lambda df: df.withColumn("_at", F.timestamp_micros((F.col("created_utc") * 1_000_000).cast("long")))
    c = timed(comments).withColumn("_slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")) \
        .withWatermark("_at", delay).alias("c")
    p = timed(posts).select(F.col("id").alias("_post"), F.col("_at").alias("_posted")) \
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))) \
        .withWatermark("_posted", delay).alias("p")
    near = F.expr(f"p._posted >= c._at - INTERVAL {after} AND p._posted <= c._at + INTERVAL {before}")
    on = (F.col("c.post_id") == F.col("p._post")) & (F.col("c._slice") == F.col("p._part")) & near
    return c.join(p, on, "left_semi").select(*comments.columns)
