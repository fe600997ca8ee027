"""Platform payloads to the standard message row.

Landed tweets / posts / comments are Spark tables or JSON files; every
normaliser is a projection (plus one join for authors or parents)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.constants import DELETED_AUTHOR
from feedlens.operators.joins import MAX_BROADCAST_BYTES, broadcast_if_small

REDDIT_BASE = "https://reddit.com"
TWEET_COUNTERS = ["retweet_count", "reply_count", "like_count", "quote_count",
                  "impression_count"]


def epoch_to_ts(col) -> Column:
    """Epoch seconds (double) to a UTC timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros((c * 1_000_000).cast("long"))


def absolute_url(col, base: str = REDDIT_BASE) -> Column:
    """Permalink to absolute URL."""
    return F.concat(F.lit(base), F.col(col))


def lower_platform(col) -> Column:
    """P8."""
    return F.lower(F.col(col) if isinstance(col, str) else col)


def iso(col) -> Column:
    """ISO-8601 text of a timestamp (UTC session zone)."""
    return F.date_format(F.col(col) if isinstance(col, str) else col,
                         "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def normalize_tweets(tweets: DataFrame, users: DataFrame | None = None,
                     source: str = "twitter_api", ingested_at=None,
                     max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """P1 + P4 + J1: tweet rows to the standard row.

    Authors join on author_id (left; misses get defaults). The users side is
    broadcast only while its size estimate stays within the bound, else shuffle join."""
    t = tweets
    if users is not None:
        u = users.select(F.col("id").alias("_uid"), F.col("username").alias("_username"),
                         F.col("verified").alias("_verified"),
                         F.col("public_metrics.followers_count").alias("_followers"))
        t = t.join(broadcast_if_small(u, max_broadcast_bytes), t.author_id == F.col("_uid"), "left")
    else:
        t = t.select("*", F.lit(None).cast("string").alias("_username"),
                     F.lit(None).cast("boolean").alias("_verified"),
                     F.lit(None).cast("int").alias("_followers"))
    ts = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    pm = "public_metrics"
    metrics = F.create_map(*[x for c in TWEET_COUNTERS for x in
                             (F.lit(c), F.coalesce(F.col(f"{pm}.{c}"), F.lit(0)).cast("double"))])
    hashtags = F.coalesce(F.transform("entities.hashtags", lambda x: x["tag"]),
                          F.array().cast("array<string>"))
    mentions = F.coalesce(F.transform("entities.mentions", lambda x: x["username"]),
                          F.array().cast("array<string>"))
    return t.select(
        F.col("id").cast("string").alias("id"),
        F.col("text"),
        F.lit("twitter").alias("platform"),
        F.coalesce(F.col("_username"), F.lit("unknown")).alias("author"),
        F.col("author_id").cast("string").alias("author_id"),
        iso("created_at").alias("timestamp"),
        F.col("geo.place_id").alias("location"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("string").alias("product"),
        F.lit(None).cast("string").alias("channel"),
        F.lit(None).cast("string").alias("device"),
        F.coalesce(F.col("lang"), F.lit("en")).alias("language"),
        metrics.alias("metrics"),
        F.struct(hashtags.alias("hashtags"), mentions.alias("mentions"),
                 F.lit(None).cast("string").alias("flair")).alias("entities"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
        F.lit(source).alias("source"),
        iso(ts).alias("ingestion_timestamp"),
        F.coalesce(F.col("_verified"), F.lit(False)).alias("verified"),
        F.col("_followers").alias("followers_count"),
    )


def post_text(title, body) -> Column:
    """Title, or title + blank line + body when the body is non-empty."""
    t, b = F.col(title), F.col(body)
    return F.when(b.isNotNull() & (b != ""), F.concat(t, F.lit("\n\n"), b)).otherwise(t)


def normalize_posts(posts: DataFrame, source: str = "reddit_api", ingested_at=None) -> DataFrame:
    """P2 + P5-P7: posts to the standard row, id ``reddit_post_<id>``."""
    ts = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return posts.select(
        F.concat(F.lit("reddit_post_"), F.col("id")).alias("id"),
        post_text("title", "selftext").alias("text"),
        F.lit("reddit").alias("platform"),
        F.coalesce(F.col("author"), F.lit(DELETED_AUTHOR)).alias("author"),
        F.col("author_id"),
        iso(epoch_to_ts("created_utc")).alias("timestamp"),
        F.create_map(F.lit("score"), F.col("score").cast("double"),
                     F.lit("upvote_ratio"), F.col("upvote_ratio").cast("double"),
                     F.lit("num_comments"), F.col("num_comments").cast("double"),
                     F.lit("awards"), F.col("total_awards_received").cast("double"))
        .alias("metrics"),
        F.struct(F.lit(None).cast("array<string>").alias("hashtags"),
                 F.lit(None).cast("array<string>").alias("mentions"),
                 F.col("link_flair_text").alias("flair")).alias("entities"),
        F.lit(source).alias("source"),
        iso(ts).alias("ingestion_timestamp"),
        F.col("subreddit"),
        absolute_url("permalink").alias("url"),
        F.lit("post").alias("content_type"),
    )


def normalize_comments(comments: DataFrame, matched_posts: DataFrame | None = None,
                       source: str = "reddit_api", ingested_at=None) -> DataFrame:
    """P3 + J2: comments to the standard row, id ``reddit_comment_<id>``.

    Only comments of posts in ``matched_posts`` (a frame with a post ``id``
    column, e.g. the keyword-matched posts) are kept: a left semi join."""
    c = comments
    if matched_posts is not None:
        c = c.join(matched_posts.select(F.col("id").alias("post_id")), "post_id", "left_semi")
    ts = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return c.select(
        F.concat(F.lit("reddit_comment_"), F.col("id")).alias("id"),
        F.col("body").alias("text"),
        F.lit("reddit").alias("platform"),
        F.coalesce(F.col("author"), F.lit(DELETED_AUTHOR)).alias("author"),
        F.col("author_id"),
        iso(epoch_to_ts("created_utc")).alias("timestamp"),
        F.create_map(F.lit("score"), F.col("score").cast("double"),
                     F.lit("awards"), F.col("total_awards_received").cast("double"),
                     F.lit("is_submitter"), F.col("is_submitter").cast("double"))
        .alias("metrics"),
        F.lit(source).alias("source"),
        iso(ts).alias("ingestion_timestamp"),
        F.col("subreddit"),
        absolute_url("permalink").alias("url"),
        F.lit("comment").alias("content_type"),
        F.col("post_id").alias("parent_post_id"),
    )


def to_raw_row(df: DataFrame) -> DataFrame:
    """Projection onto RAW_SCHEMA's fields (connector-only fields dropped,
    missing ones NULL), e.g. before publishing."""
    from feedlens.schemas import RAW_SCHEMA
    cols = []
    for f in RAW_SCHEMA.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
