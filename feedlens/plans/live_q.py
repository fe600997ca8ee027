"""Registered queries of what runs while messages come in: arrival-anchored windows (T-1),
comments joined to posts (J2), velocity and newest points (W5, W1), the versioned store
(S9) and the search of a stored history (F10). Streams take several micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.operators import filters as FL
from feedlens.operators import normalize as N
from feedlens.operators import trends as T
from feedlens.operators.arrival import arrival_metrics
from feedlens.plans.catalog import DEFAULT_SCORER, register, rounded, scored_messages
from feedlens.plans.oracle_sql import METRIC_SQL, scored_ctes, with_scored
from feedlens.plans.reports_q import ORACLES
from feedlens.plans.rows_q import _posts_comments
from feedlens.plans.stream_inputs import BATCHES, deal, run_dir, stream_scored
from feedlens.sinks import search as SE
from feedlens.sinks.store import VersionedStore
from feedlens.sources.landed import read_landed
from feedlens.sources.tables import messages
from feedlens.streaming import jobs as J
from feedlens.streaming import stateful as SF
from feedlens.streaming.joins import comments_of_posts

ARRIVAL_SQL = "WITH RECURSIVE " + scored_ctes().lstrip() + f""",
chain AS (
  SELECT channel, min(timestamp) AS t, 0 AS k FROM scored GROUP BY channel
  UNION ALL
  SELECT c.channel, min(m.timestamp) AS t, any_value(c.k) + 1 AS k
  FROM chain c JOIN scored m ON m.channel = c.channel AND m.timestamp >= c.t + INTERVAL 1 HOUR
  GROUP BY c.channel),
opened AS (
  SELECT c.channel, c.t, c.k, min(m.id) AS first_id
  FROM chain c JOIN scored m ON m.channel = c.channel AND m.timestamp = c.t GROUP BY ALL),
bounds AS (
  SELECT channel, t, k, first_id, lead(t) OVER w AS next_t, lead(first_id) OVER w AS next_id
  FROM opened WINDOW w AS (PARTITION BY channel ORDER BY t))
SELECT m.channel AS channel, b.t AS window_start, b.next_t AS window_end, {METRIC_SQL}
FROM scored m JOIN bounds b ON b.channel = m.channel AND m.timestamp BETWEEN b.t AND b.next_t
WHERE NOT (b.k > 0 AND m.timestamp = b.t AND m.id <= b.first_id)
  AND NOT (m.timestamp = b.next_t AND m.id > b.next_id)
GROUP BY m.channel, b.t, b.next_t"""

WINDOW = ["window_start", "window_end"]


def _ntz(df, *cols):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


@register("arrival_windows", ARRIVAL_SQL)
def arrival_windows(spark, sf_dir):
    """T-1 as the reference cuts it: per channel, a window opens with a message and closes
    with the first one an hour or more later, that one included."""
    return rounded(_ntz(arrival_metrics(scored_messages(spark, sf_dir), 3600, ["channel"]), *WINDOW))


@register("stream_arrival_windows", ARRIVAL_SQL)
def stream_arrival_windows(spark, sf_dir):
    """The same windows as a stream closes them: rows wait for the watermark, and a timer
    wakes the channel that has rows to take."""
    run = run_dir(spark, "stream_arrival")
    closed = SF.arrival_metrics_stream(stream_scored(spark, sf_dir, run, "1 hour"), 3600, "channel", delay=None)
    q = J.start(closed, f"arrival_{run[-8:]}", path=f"{run}/out", trigger={"availableNow": True},
                checkpoint_location=f"{run}/checkpoint")
    q.awaitTermination()
    return rounded(_ntz(spark.read.parquet(f"{run}/out"), *WINDOW))


@register("stream_comments", """
SELECT 'reddit_comment_' || CAST(c.conv_id AS VARCHAR) || '_' || CAST(c.turn AS VARCHAR) AS id,
       CAST(c.conv_id AS VARCHAR) AS parent_post_id, c.role AS author
FROM conversations c
WHERE c.turn BETWEEN 1 AND 4 AND EXISTS (
  SELECT 1 FROM conversations p WHERE p.turn = 0 AND p.conv_id = c.conv_id
    AND (contains(lower(p.text), 'the') OR contains(lower(p.text), 'la')))""")
def stream_comments(spark, sf_dir):
    """J2 on streams: comments of keyword-matched posts, made no later than 4 seconds after
    their post. A third of the posts come 20 minutes before their comments and a third 20
    minutes after them, so many meet across micro-batches."""
    run = run_dir(spark, "stream_comments")
    posts, comments = _posts_comments(spark, sf_dir)
    matched = FL.contains_any(posts.withColumn("_t", F.concat_ws("\n", "title", "selftext")), "_t", ["the", "la"]).drop("_t")
    shift = F.expr("INTERVAL 20 MINUTES") * (F.col("id").cast("long") % 3 - 1)
    at = F.timestamp_seconds("created_utc")
    n_posts = deal(matched.withColumn("arrival", at + shift), "arrival", f"{run}/posts")
    n_comments = deal(comments.withColumn("arrival", at), "arrival", f"{run}/comments")

    def stream(df, name, files):
        return spark.readStream.schema(df.withColumn("arrival", at).schema).option("maxFilesPerTrigger", files) \
            .parquet(f"{run}/{name}").drop("arrival")
    kept = comments_of_posts(stream(comments, "comments", n_comments), stream(matched, "posts", n_posts),
                             before="0 seconds", after="4 seconds", delay="1 day")
    out = N.normalize_comments(kept, None, ingested_at="2024-02-01 00:00:00").select("id", "parent_post_id", "author")
    q = J.start(out, f"comments_{run[-8:]}", path=f"{run}/out", trigger={"availableNow": True},
                checkpoint_location=f"{run}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{run}/out")


@register("stream_trend_velocity", ORACLES["trend_velocity"])
def stream_trend_velocity(spark, sf_dir):
    """W5 while the stream runs: the daily windows as they close, and behind them, chained,
    the change of each against the one before."""
    run = run_dir(spark, "stream_velocity")
    daily = T.windowed_metrics(stream_scored(spark, sf_dir, run, "1 hour"), "timestamp", "1 day", emotions=False)
    published = daily.withColumn("avg_sentiment", F.round("avg_sentiment", 6))
    q = J.start(SF.velocity_stream(published), f"velocity_{run[-8:]}", path=f"{run}/out", trigger={"availableNow": True},
                checkpoint_location=f"{run}/checkpoint")
    q.awaitTermination()
    return rounded(_ntz(spark.read.parquet(f"{run}/out"), "window_start"))


@register("stream_recent_points", ORACLES["recent_trend_by_channel"])
def stream_recent_points(spark, sf_dir):
    """W1 while the stream runs: the newest 50 points of every channel in state, handed on
    whenever they change; the newest version of each is read."""
    run = run_dir(spark, "stream_points")
    points = SF.recent_points_stream(stream_scored(spark, sf_dir, run, "1 hour"), "channel", 50, ttl_hours=24 * 31, delay=None)
    q = J.start(points, f"points_{run[-8:]}", mode="update", trigger={"availableNow": True}, checkpoint_location=f"{run}/checkpoint",
                foreach_batch=lambda b, i: b.withColumn("batch_id", F.lit(i).cast("long")).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{run}/out"))
    q.awaitTermination()
    out = SF.merge_points(spark.read.parquet(f"{run}/out"), "channel", 50)
    return rounded(_ntz(out, "timestamp", "first_ts", "last_ts"))


@register("store_versions", "WITH " + scored_ctes().lstrip() + f""",
edge AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
part AS (
  SELECT s.*, floor({BATCHES} * (epoch_us(s.timestamp) - epoch_us(lo)) / (epoch_us(hi) - epoch_us(lo) + 1)) AS p
  FROM scored s, edge),
seen AS (SELECT v.version, part.* FROM part JOIN range(1, {BATCHES + 1}) v(version) ON part.p < v.version),
day AS (
  SELECT version, coalesce(channel, 'null') AS key, date_trunc('day', timestamp) AS window_start,
         count(*) AS count, round(sum(coalesce(sentiment_score, 0.0)) / count(*), 6) AS avg_sentiment
  FROM seen GROUP BY ALL)
SELECT version, key, window_start, count, avg_sentiment FROM day
QUALIFY row_number() OVER (PARTITION BY version, key ORDER BY window_start DESC) = 1""")
def store_versions(spark, sf_dir):
    """Every version of the store, read after all are written. A version has the latest
    daily window of each channel as of its micro-batch, whatever was put in or compacted
    since."""
    run = run_dir(spark, "store_versions")
    store = VersionedStore(spark, f"{run}/metrics")
    versions = []

    def put(batch, i):
        versions.append(store.upsert(batch.where("dim = 'channel'"), i))
        if i == 1:
            store.compact()
    win = J.windowed_stream(stream_scored(spark, sf_dir, run), "timestamp", "1 day", "31 days", emotions=False)
    q = J.start(win, f"versions_{run[-8:]}", mode="update", foreach_batch=put, trigger={"availableNow": True},
                checkpoint_location=f"{run}/checkpoint")
    q.awaitTermination()
    out = None
    for n, v in enumerate(sorted(versions)[:BATCHES], 1):  # the last micro-batch may be one without rows
        rows = store.read(v).select(F.lit(n).cast("long").alias("version"), "key", "window_start", "count", "avg_sentiment")
        out = rows if out is None else out.unionByName(rows)
    return rounded(_ntz(out, "window_start"))


_TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


@register("search_stored_history", with_scored(f"""
SELECT id, platform, CAST(timestamp AS DATE) AS index_date FROM scored
WHERE CAST(timestamp AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AND channel = 'view'
  AND list_has_all({_TOKENS}, ['estion', 'the'])"""))
def search_stored_history(spark, sf_dir):
    """a history that a stream wrote, by date and micro-batch, searched through its
    index: both words, a range of dates, one channel."""
    run = run_dir(spark, "search")
    q = J.start(stream_scored(spark, sf_dir, run), f"search_{run[-8:]}", trigger={"availableNow": True},
                foreach_batch=lambda b, i: SE.write_indexed_history(b, f"{run}/history", i, "timestamp"),
                checkpoint_location=f"{run}/checkpoint")
    q.awaitTermination()
    return SE.search(spark, f"{run}/history", ["The", "estion"], "2024-01-03", "2024-01-20", {"channel": "view"}) \
        .select("id", "platform", "index_date")


_WIRE = ["id", "platform", "channel", "timestamp", "sentiment_label", "emotion"]


@register("stream_scoring", with_scored(f"""
SELECT {", ".join(_WIRE)}, round(sentiment_score, 6) AS sentiment_score, round(churn_risk, 6) AS churn_risk, length(text) AS n_chars
FROM scored"""))
def stream_scoring(spark, sf_dir):
    """S1, S6, T-4, T-8, S5, S3: raw messages produced as JSON values, read as a stream, parsed,
    cleaned and scored, handed on as wire JSON while they come, and read back from there."""
    run = run_dir(spark, "scoring")
    m = messages(spark, sf_dir, with_value=False).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    for k in range(2):  # two deliveries, a micro-batch each at least
        J.publish_raw(m.where(F.pmod(F.xxhash64("id"), F.lit(2)) == k), "json", f"{run}/raw", **J.PACKED)
    files = len(spark.read.schema("key string, value string").json(f"{run}/raw").inputFiles())
    raw = spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", max(1, files // 2)).json(f"{run}/raw")
    feed = J.message_feed(J.score_stream(raw.select("value"), DEFAULT_SCORER, processed_at="2024-02-01 00:00:00"))
    q = J.start(feed, f"scoring_{run[-8:]}", sink="json", path=f"{run}/scored", options=J.PACKED, trigger={"availableNow": True},
                checkpoint_location=f"{run}/checkpoint")
    q.awaitTermination()
    back = J.parse_processed(spark.read.schema("key string, value string").json(f"{run}/scored"))
    return rounded(_ntz(back.select(*_WIRE, "sentiment_score", "churn_risk", F.length("text").alias("n_chars")), "timestamp"))


@register("landed_comments", """
SELECT 'reddit_comment_' || CAST(c.conv_id AS VARCHAR) || '_' || CAST(c.turn AS VARCHAR) AS id,
       CAST(c.conv_id AS VARCHAR) AS parent_post_id, CASE WHEN c.role = 'user' THEN 1.0 ELSE 0.0 END AS is_submitter, length(c.text) AS n_chars
FROM conversations c
WHERE c.turn > 0 AND EXISTS (
  SELECT 1 FROM conversations p WHERE p.turn = 0 AND p.conv_id = c.conv_id
    AND (contains(lower(p.text), 'the') OR contains(lower(p.text), 'la')))""")
def landed_comments(spark, sf_dir):
    """Posts and comments landed as JSON files, read by their declared schemas, joined and
    normalised."""
    run = run_dir(spark, "landed")
    for kind, df in zip(("post", "comment"), _posts_comments(spark, sf_dir)):
        df.write.json(f"{run}/{kind}")
    posts, comments = (read_landed(spark, f"{run}/{kind}", kind) for kind in ("post", "comment"))
    matched = FL.contains_any(posts.withColumn("_t", F.concat_ws("\n", "title", "selftext")), "_t", ["the", "la"])
    return N.normalize_comments(comments, matched, ingested_at="2024-02-01 00:00:00").select(
        "id", "parent_post_id", F.col("metrics")["is_submitter"].alias("is_submitter"), F.length("text").alias("n_chars"))
