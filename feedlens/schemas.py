"""Declared schemas. Streams are never schema-inferred."""

from pyspark.sql import types as T

S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

ENTITIES = T.StructType([
    T.StructField("hashtags", T.ArrayType(S)),
    T.StructField("mentions", T.ArrayType(S)),
    T.StructField("flair", S),
])

# Raw message as it arrives on the wire; timestamps are ISO strings there.
RAW_SCHEMA = T.StructType([
    T.StructField("id", S), T.StructField("text", S), T.StructField("platform", S),
    T.StructField("author", S), T.StructField("author_id", S),
    T.StructField("timestamp", S), T.StructField("location", S),
    T.StructField("city", S), T.StructField("product", S), T.StructField("channel", S),
    T.StructField("device", S), T.StructField("language", S),
    T.StructField("metrics", T.MapType(S, D)),
    T.StructField("entities", ENTITIES),
    T.StructField("metadata", T.MapType(S, S)),
    T.StructField("source", S), T.StructField("ingestion_timestamp", S),
])

RAW_FIELDS = [f.name for f in RAW_SCHEMA.fields]

# Scored message.
PROCESSED_SCHEMA = T.StructType([
    T.StructField("id", S), T.StructField("text", S), T.StructField("platform", S),
    T.StructField("author", S), T.StructField("timestamp", TS),
    T.StructField("city", S), T.StructField("product", S), T.StructField("channel", S),
    T.StructField("device", S), T.StructField("language", S),
    T.StructField("sentiment_score", D), T.StructField("sentiment_label", S),
    T.StructField("confidence", D), T.StructField("emotion", S),
    T.StructField("emotion_scores", T.MapType(S, D)),
    T.StructField("toxicity", D), T.StructField("churn_risk", D),
    T.StructField("inference_time_ms", D), T.StructField("source", S),
    T.StructField("processing_timestamp", TS),
    T.StructField("metrics", T.MapType(S, D)),
])

PROCESSED_FIELDS = [f.name for f in PROCESSED_SCHEMA.fields]

# Fields copied from the raw row into the scored row.
BASE_FIELDS = ["id", "text", "platform", "author", "timestamp", "city", "product",
               "channel", "device", "language", "source", "metrics"]

# One row per (window, dimension, key).
METRICS_SCHEMA = T.StructType([
    T.StructField("window_start", TS), T.StructField("window_end", TS),
    T.StructField("dim", S, False), T.StructField("key", S),
    T.StructField("count", L), T.StructField("avg_sentiment", D),
    T.StructField("positive_count", L), T.StructField("negative_count", L),
    T.StructField("neutral_count", L), T.StructField("avg_churn_risk", D),
    T.StructField("high_churn_count", L), T.StructField("avg_toxicity", D),
    T.StructField("last_updated", TS),
    T.StructField("emotion_distribution", T.MapType(S, L)),
])

METRIC_VALUE_FIELDS = ["count", "avg_sentiment", "positive_count", "negative_count",
                       "neutral_count", "avg_churn_risk", "high_churn_count", "avg_toxicity"]

# History projection: keyword / text / float / date typing.
HISTORY_KEYWORDS = ["id", "platform", "city", "product", "channel", "sentiment_label",
                    "emotion", "language"]
HISTORY_TEXT = ["text"]
HISTORY_FLOATS = ["sentiment_score", "toxicity", "churn_risk"]
HISTORY_DATES = ["timestamp"]

# Landed platform payloads (tests and re-aimed sources).
TWEET_SCHEMA = T.StructType([
    T.StructField("id", L), T.StructField("text", S), T.StructField("author_id", L),
    T.StructField("created_at", TS), T.StructField("lang", S),
    T.StructField("is_retweet", T.BooleanType()),
    T.StructField("geo", T.StructType([T.StructField("place_id", S)])),
    T.StructField("public_metrics", T.StructType([
        T.StructField(n, T.IntegerType()) for n in
        ["retweet_count", "reply_count", "like_count", "quote_count", "impression_count"]])),
    T.StructField("entities", T.StructType([
        T.StructField("hashtags", T.ArrayType(T.StructType([T.StructField("tag", S)]))),
        T.StructField("mentions", T.ArrayType(T.StructType([T.StructField("username", S)]))),
    ])),
])

USER_SCHEMA = T.StructType([
    T.StructField("id", L), T.StructField("username", S),
    T.StructField("verified", T.BooleanType()),
    T.StructField("public_metrics", T.StructType([
        T.StructField("followers_count", T.IntegerType())])),
])

POST_SCHEMA = T.StructType([
    T.StructField("id", S), T.StructField("title", S), T.StructField("selftext", S),
    T.StructField("author", S), T.StructField("author_id", S),
    T.StructField("created_utc", D), T.StructField("subreddit", S),
    T.StructField("permalink", S), T.StructField("score", T.IntegerType()),
    T.StructField("upvote_ratio", D), T.StructField("num_comments", T.IntegerType()),
    T.StructField("total_awards_received", T.IntegerType()),
    T.StructField("link_flair_text", S), T.StructField("listing", S),
    T.StructField("listing_rank", T.IntegerType()),
])

COMMENT_SCHEMA = T.StructType([
    T.StructField("id", S), T.StructField("post_id", S), T.StructField("body", S),
    T.StructField("author", S), T.StructField("author_id", S),
    T.StructField("created_utc", D), T.StructField("subreddit", S),
    T.StructField("permalink", S), T.StructField("score", T.IntegerType()),
    T.StructField("total_awards_received", T.IntegerType()),
    T.StructField("is_submitter", T.BooleanType()), T.StructField("position", T.IntegerType()),
])
