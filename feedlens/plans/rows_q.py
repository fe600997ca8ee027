"""Registered row-level queries: filters, scores, dedupe, joins, statistics,
normalisers (F1-F8, X1-X9, U1-U3, D1-D3, J2, J4, W2, W3, S8, A8-A11, P2, P3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.constants import EMOTION_LABELS, LATENCY_BOUNDS_SEC, MAX_SCORABLE_CHARS, TOXIC_KEYWORDS
from feedlens.functions import scores as X
from feedlens.operators import dedupe as D
from feedlens.operators import filters as FL
from feedlens.operators import metrics as M
from feedlens.operators import normalize as N
from feedlens.operators import stats as ST
from feedlens.operators import trends as T
from feedlens.operators.joins import new_only as _new_only
from feedlens.plans.catalog import register, rounded, scored_messages
from feedlens.plans.oracle_sql import with_messages, with_scored
from feedlens.sinks.encode import history_projection as _history_projection
from feedlens.sources.tables import messages, read_table, row_count

_KW_OR = " OR ".join(f"contains(lower(text), '{k}')" for k in TOXIC_KEYWORDS)


@register("clean_messages", with_messages("""
SELECT id, length(text) AS n_chars, platform, channel FROM messages
WHERE text IS NOT NULL AND text <> ''"""))
def clean_messages(spark, sf_dir):
    """rows with non-null, non-empty text."""
    return FL.clean(messages(spark, sf_dir)).select(
        "id", F.length("text").alias("n_chars"), "platform", "channel")


@register("contains_any", with_messages(f"""
SELECT id FROM messages WHERE {_KW_OR}"""))
def contains_any(spark, sf_dir):
    """case-insensitive substring match of any keyword."""
    return FL.contains_any(messages(spark, sf_dir), "text", TOXIC_KEYWORDS).select("id")


@register("search_filter", with_messages(f"""
SELECT id, language FROM messages
WHERE ({' OR '.join(f"contains(lower(text), '{k}')" for k in ['hate', 'with'])})
  AND language IN ('en', 'de')"""))
def search_filter(spark, sf_dir):
    """(k1 OR k2) AND language IN (..) AND not a repost."""
    return FL.search_filter(messages(spark, sf_dir), ["hate", "with"], ["en", "de"]) \
        .select("id", "language")


@register("scorable_split", with_messages("""
SELECT id, length(text) AS n_chars, coalesce(length(text) BETWEEN 1 AND 5000, false) AS scorable
FROM messages WHERE text IS NOT NULL AND text <> ''"""))
def scorable_split(spark, sf_dir):
    """which texts the scorer accepts (1..5000 code points)."""
    return FL.scorable_split(FL.clean(messages(spark, sf_dir))) \
        .select("id", F.length("text").alias("n_chars"), "scorable")


_SCORE_COLS = ", ".join(f"round(p_{c}, 6) AS p_{c}" for c in ["negative", "neutral", "positive"])


@register("lexicon_scores", with_scored(f"""
SELECT id, {_SCORE_COLS}, round(sentiment_score, 6) AS sentiment_score, sentiment_label,
       round(confidence, 6) AS confidence, emotion,
       {', '.join(f'round(emo_{e}, 6) AS emo_{e}' for e in EMOTION_LABELS)}
FROM scored WHERE scored_ok"""), bench=True)
def lexicon_scores(spark, sf_dir):
    """U1(a) + X1-X5 + K3: scorer response for every scorable text: class
    probabilities, polarity, label, confidence, emotion and its scores."""
    from feedlens.plans.catalog import DEFAULT_SCORER
    return _response_report(_scorer_response(spark, sf_dir, DEFAULT_SCORER))


def _response_report(resp):
    es = F.col("emotion_scores")
    raw = X.raw_scores("_sent_scores")
    return rounded(resp.select(
        "id", *[F.element_at(raw, F.lit(c)).alias(f"p_{c}")
                for c in ["negative", "neutral", "positive"]],
        "sentiment_score", "sentiment_label", "confidence", "emotion",
        *[F.element_at(es, F.lit(e)).alias(f"emo_{e}") for e in EMOTION_LABELS]))


def _scorer_response(spark, sf_dir, scorer):
    """Scorer response per message with text: documents are scored right after
    their scan, once each (text is never shuffled), then joined to their
    messages."""
    from feedlens.operators.enrich import response_fields, spread_for_cpu
    from feedlens.sources.tables import document_columns, message_base
    docs = spread_for_cpu(FL.clean(document_columns(spark, sf_dir)).select("doc_id", "text"))
    resp = response_fields(scorer.class_scores(docs, "text")).drop("text")
    return resp.join(message_base(spark, sf_dir).select("id", "doc_id"), "doc_id")


@register("toxicity_churn", with_scored(f"""
SELECT id, round(toxicity, 6) AS toxicity, round(churn_risk, 6) AS churn_risk,
       ({' + '.join(f"(CASE WHEN contains(lower(text), '{k}') THEN 1 ELSE 0 END)" for k in TOXIC_KEYWORDS)}) AS keyword_hits
FROM scored"""))
def toxicity_churn(spark, sf_dir):
    """Keyword hits, toxicity and churn heuristics."""
    s = scored_messages(spark, sf_dir)
    return rounded(s.select("id", "toxicity", "churn_risk",
                            X.keyword_hits("text").alias("keyword_hits")))


@register("enrich_defaults", with_scored("""
SELECT id, sentiment_score, sentiment_label, confidence, emotion, toxicity, churn_risk,
       0.0 AS inference_time_ms
FROM scored WHERE NOT scored_ok""", max_chars=MAX_SCORABLE_CHARS))
def enrich_defaults(spark, sf_dir):
    """U2 + U3 + X13: rows that a service with a length limit refuses keep
    their place with defaults."""
    s = scored_messages(spark, sf_dir, max_chars=MAX_SCORABLE_CHARS)
    return s.filter(~F.col("scored_ok")).select(
        "id", "sentiment_score", "sentiment_label", "confidence", "emotion", "toxicity",
        "churn_risk", "inference_time_ms")


@register("churn_alerts", with_scored("""
SELECT id, round(churn_risk, 6) AS churn_risk, channel FROM scored WHERE churn_risk > 0.7"""))
def churn_alerts(spark, sf_dir):
    """high-churn alerts (message struct flattened for the report)."""
    a = FL.churn_alerts(scored_messages(spark, sf_dir))
    return rounded(a.select("message.id", "message.churn_risk", "message.channel"))


@register("history_projection", with_scored("""
SELECT id, platform, city, product, channel, sentiment_label, emotion, language, text,
       round(CAST(sentiment_score AS FLOAT), 6) AS sentiment_score,
       round(CAST(toxicity AS FLOAT), 6) AS toxicity,
       round(CAST(churn_risk AS FLOAT), 6) AS churn_risk, timestamp
FROM scored"""))
def history_projection(spark, sf_dir):
    """Typed history documents (keyword / text / float / date)."""
    h = _history_projection(scored_messages(spark, sf_dir))
    return h.select(*[F.round(F.col(c).cast("double"), 6).alias(c)
                      if c in ("sentiment_score", "toxicity", "churn_risk") else F.col(c)
                      for c in h.columns])


@register("dedupe_text", """
SELECT min(doc_id) AS doc_id, count(*) AS copies, length(text) AS n_chars
FROM documents GROUP BY text""", bench=True)
def dedupe_text(spark, sf_dir):
    """D3 (content form): one row per distinct text, first id, copy count."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return D.dedupe_text(d, "text", "doc_id")


@register("dedupe_by_id", """
SELECT conv_id, arg_min(turn, turn) AS turn, arg_min(role, turn) AS role
FROM conversations GROUP BY conv_id""")
def dedupe_by_id(spark, sf_dir):
    """D3 (id form): one row per id, the first under an order (turn)."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return D.dedupe(c, "conv_id", order=["turn"])


@register("new_only", """
SELECT e.event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = e.event_id)""")
def new_only(spark, sf_dir):
    """Events with no stored document (left anti join)."""
    e = read_table(spark, sf_dir, "events").select("event_id")
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"))
    return _new_only(e, d, "event_id")


@register("since_last_seen", """
SELECT event_id FROM events WHERE event_id > (SELECT max(doc_id) FROM documents)""")
def since_last_seen(spark, sf_dir):
    """F8: only ids above the highest id already seen (scalar subquery)."""
    e = read_table(spark, sf_dir, "events").select("event_id")
    seen = read_table(spark, sf_dir, "documents").agg(F.max("doc_id"))
    return FL.since(e, "event_id", seen)


@register("top_turns", """
SELECT conv_id, turn, role, rank FROM (
  SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rank
  FROM conversations) WHERE rank <= 3""")
def top_turns(spark, sf_dir):
    """First 3 children per parent in listing order; the longest
    conversations have 8."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return T.first_n_per_parent(c, "conv_id", "turn", 3)


_LISTING_SQL = """
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS r
  FROM documents) WHERE r <= 25
UNION
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r
  FROM documents) WHERE r <= 25"""


@register("listing_union", _LISTING_SQL)
def listing_union(spark, sf_dir):
    """W3 + D1: newest 25 and longest 25 per source, each document once."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    new = T.listing(d, "source", [F.col("doc_id").desc()], 25, "new").select("doc_id", "source")
    hot = T.listing(d, "source", [F.col("n_chars").desc(), F.col("doc_id")], 25, "hot") \
        .select("doc_id", "source")
    return D.union_listings(new, hot, "doc_id")


@register("union_sources", with_messages("""
SELECT platform, count(*) AS n FROM (
  SELECT platform FROM messages WHERE text IS NOT NULL AND text <> ''
  UNION ALL SELECT 'chat' AS platform FROM conversations WHERE text IS NOT NULL AND text <> '')
GROUP BY platform"""))
def union_sources(spark, sf_dir):
    """Fan-in of the message view and conversation turns."""
    m = FL.clean(messages(spark, sf_dir)).select("id", "text", "platform")
    c = FL.clean(read_table(spark, sf_dir, "conversations")).select(
        F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit("_"),
                 F.col("turn").cast("string")).alias("id"),
        "text", F.lit("chat").alias("platform"))
    return D.union_sources(m, c).groupBy("platform").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Statistics over events.value (stands in for inference_time_ms).
# ---------------------------------------------------------------------------

def _stats_sql(keyed: bool) -> str:
    k = "event_type" if keyed else "1"
    sel_k = "event_type, " if keyed else ""
    part = "PARTITION BY event_type" if keyed else ""
    grp = "GROUP BY event_type" if keyed else ""
    return f"""
WITH r AS (
  SELECT {sel_k}value AS v, row_number() OVER ({part} ORDER BY value) AS rk,
         count(*) OVER ({part}) AS n
  FROM events WHERE value IS NOT NULL),
t AS (
  SELECT *, greatest(1, least((n + 1) * 19 // 20, n - 1)) AS j95,
         greatest(1, least((n + 1) * 99 // 100, n - 1)) AS j99 FROM r),
q AS (
  SELECT *, (n + 1) * 19 - j95 * 20 AS d95, (n + 1) * 99 - j99 * 100 AS d99 FROM t)
SELECT {sel_k}count(*) AS count, round(avg(v), 6) AS mean, round(min(v), 6) AS min,
       round(max(v), 6) AS max, round(stddev_samp(v), 6) AS stdev,
       round((max(v) FILTER (WHERE rk = (n + 1) // 2) + max(v) FILTER (WHERE rk = (n + 2) // 2)) / 2, 6) AS median,
       round(CASE WHEN max(n) = 1 THEN max(v) ELSE
         (max(v) FILTER (WHERE rk = j95) * (20 - max(d95)) + max(v) FILTER (WHERE rk = j95 + 1) * max(d95)) / 20 END, 6) AS p95,
       round(CASE WHEN max(n) = 1 THEN max(v) ELSE
         (max(v) FILTER (WHERE rk = j99) * (100 - max(d99)) + max(v) FILTER (WHERE rk = j99 + 1) * max(d99)) / 100 END, 6) AS p99
FROM q {grp}"""


@register("latency_stats", _stats_sql(True), bench=True)
def latency_stats(spark, sf_dir):
    """Mean, median, min, max, sample stdev, exclusive p95 / p99 per type."""
    e = read_table(spark, sf_dir, "events")
    return rounded(ST.latency_stats(e, "value", ["event_type"]))


@register("latency_stats_overall", _stats_sql(False))
def latency_stats_overall(spark, sf_dir):
    """A8 without keys (the whole table is one group, still range-split)."""
    e = read_table(spark, sf_dir, "events")
    return rounded(ST.latency_stats(e, "value"))


@register("throughput", """
SELECT event_type, round(1000.0 / avg(value), 6) AS throughput_per_sec,
       round(10 * 1000.0 / avg(value), 6) AS batch_throughput_per_sec
FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def throughput(spark, sf_dir):
    """Single and 10-text batch throughput from mean latency (ms)."""
    e = read_table(spark, sf_dir, "events").select("event_type", "value") \
        .filter(F.col("value").isNotNull())
    mean = e.groupBy("event_type").agg(F.avg("value").alias("mean"))
    out = ST.throughput(mean, 1).withColumn(
        "batch_throughput_per_sec", F.try_divide(F.lit(10) * F.lit(1000.0), F.col("mean")))
    return rounded(out.drop("mean"))


def _hist_sql() -> str:
    cols = ", ".join(
        f"count(*) FILTER (WHERE value * 0.001 <= {b}) AS le_{f'{b:g}'.replace('.', '_')}"
        for b in LATENCY_BOUNDS_SEC)
    return f"""
SELECT event_type, count(*) AS total, round(sum(value * 0.001), 6) AS sum, {cols},
       count(*) AS le_inf
FROM events GROUP BY event_type"""


@register("inference_histogram", _hist_sql())
def inference_histogram(spark, sf_dir):
    """A10: Prometheus-style cumulative latency histogram (seconds) per type."""
    e = read_table(spark, sf_dir, "events").select("event_type", "value")
    return rounded(M.inference_histogram(e, "value", LATENCY_BOUNDS_SEC, ["event_type"],
                                         scale=0.001))


@register("progress", """
SELECT count(*) AS processed, min(ts) AS first_ts, max(ts) AS last_ts,
       round(epoch(max(ts)) - epoch(min(ts)), 6) AS span_sec,
       round(count(*) / (epoch(max(ts)) - epoch(min(ts))), 6) AS rate_per_sec
FROM events""")
def progress(spark, sf_dir):
    """Processed rows, time span and rate."""
    return rounded(M.progress(read_table(spark, sf_dir, "events"), "ts"))


# ---------------------------------------------------------------------------
# Normalisers on a re-aimed source: each conversation is a post (turn 0) with
# its later turns as comments.
# ---------------------------------------------------------------------------

def _posts_comments(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    first = conv.filter(F.col("turn") == 0)
    title = F.substring_index(F.col("text"), "\n", 1)
    posts = first.select(
        F.col("conv_id").cast("string").alias("id"), title.alias("title"),
        F.expr("substring(text, length(substring_index(text, '\\n', 1)) + 2)").alias("selftext"),
        F.when(F.col("role") == "user", F.concat(F.lit("user_"), F.col("conv_id").cast("string")))
        .alias("author"),
        F.lit(None).cast("string").alias("author_id"),
        (F.lit(1704067200.0) + F.col("conv_id").cast("double") * 60.0).alias("created_utc"),
        F.lit("conversations").alias("subreddit"),
        F.concat(F.lit("/r/conversations/"), F.col("conv_id").cast("string")).alias("permalink"),
        F.lit(0).alias("score"), F.lit(1.0).alias("upvote_ratio"), F.lit(0).alias("num_comments"),
        F.lit(0).alias("total_awards_received"), F.lit(None).cast("string").alias("link_flair_text"))
    comments = conv.filter(F.col("turn") > 0).select(
        F.concat(F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
        .alias("id"),
        F.col("conv_id").cast("string").alias("post_id"), F.col("text").alias("body"),
        F.col("role").alias("author"), F.lit(None).cast("string").alias("author_id"),
        (F.lit(1704067200.0) + F.col("conv_id").cast("double") * 60.0 + F.col("turn"))
        .alias("created_utc"),
        F.lit("conversations").alias("subreddit"),
        F.concat(F.lit("/r/conversations/"), F.col("conv_id").cast("string")).alias("permalink"),
        F.lit(0).alias("score"), F.lit(0).alias("total_awards_received"),
        (F.col("role") == "user").alias("is_submitter"), F.col("turn").cast("int").alias("position"))
    return posts, comments


@register("normalize_posts", """
SELECT 'reddit_post_' || CAST(conv_id AS VARCHAR) AS id,
       CASE WHEN substr(text, length(split_part(text, chr(10), 1)) + 2) <> ''
            THEN split_part(text, chr(10), 1) || chr(10) || chr(10) || substr(text, length(split_part(text, chr(10), 1)) + 2)
            ELSE split_part(text, chr(10), 1) END AS text,
       CASE WHEN role = 'user' THEN 'user_' || CAST(conv_id AS VARCHAR) ELSE '[deleted]' END AS author,
       'https://reddit.com/r/conversations/' || CAST(conv_id AS VARCHAR) AS url
FROM conversations WHERE turn = 0""")
def normalize_posts(spark, sf_dir):
    """P2 + P5 + P7 on posts re-aimed from conversation openers."""
    posts, _ = _posts_comments(spark, sf_dir)
    return N.normalize_posts(posts).select("id", "text", "author", "url")


@register("normalize_comments", """
SELECT 'reddit_comment_' || CAST(c.conv_id AS VARCHAR) || '_' || CAST(c.turn AS VARCHAR) AS id,
       CAST(c.conv_id AS VARCHAR) AS parent_post_id, c.role AS author,
       length(c.text) AS n_chars
FROM conversations c
WHERE c.turn > 0 AND EXISTS (
  SELECT 1 FROM conversations p WHERE p.turn = 0 AND p.conv_id = c.conv_id
    AND (contains(lower(p.text), 'the') OR contains(lower(p.text), 'la')))""")
def normalize_comments(spark, sf_dir):
    """P3 + J2: comments of keyword-matched posts only (left semi join)."""
    posts, comments = _posts_comments(spark, sf_dir)
    matched = FL.contains_any(posts.withColumn("_t", F.concat_ws("\n", "title", "selftext")),
                              "_t", ["the", "la"])
    return N.normalize_comments(comments, matched).select(
        "id", "parent_post_id", "author", F.length("text").alias("n_chars"))


# ---------------------------------------------------------------------------
# Other scorer kinds (U1 b/c, U4, U6).
# ---------------------------------------------------------------------------

@register("score_pandas", with_scored(f"""
SELECT id, {_SCORE_COLS}, round(sentiment_score, 6) AS sentiment_score, sentiment_label,
       round(confidence, 6) AS confidence, emotion,
       {', '.join(f'round(emo_{e}, 6) AS emo_{e}' for e in EMOTION_LABELS)}
FROM scored WHERE scored_ok"""))
def score_pandas(spark, sf_dir):
    """U1(c) + U4: the lexicon as a Python model under mapInPandas, batches of
    100 texts; same response as the Column scorer."""
    from feedlens.scoring.pandas_model import PandasScorer
    return _response_report(_scorer_response(spark, sf_dir, PandasScorer()))


@register("score_mllib")
def score_mllib(spark, sf_dir):
    """U1(b): TF-IDF + multinomial logistic regression trained on ``labels``
    (toxic -> negative, quality -> positive), applied to every scorable
    message. Iterative training: checked on rows only."""
    from feedlens.scoring.mllib import MLlibScorer, labelled_documents
    train = labelled_documents(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "labels"))
    scorer = MLlibScorer(max_iter=20).fit(train)
    resp = _scorer_response(spark, sf_dir, scorer)
    return rounded(resp.select("id", "sentiment_label", "sentiment_score", "confidence"))


@register("toxicity", with_scored(f"""
SELECT id, round(toxicity, 6) AS toxicity,
       ({' + '.join(f"(CASE WHEN contains(lower(text), '{k}') THEN 1 ELSE 0 END)" for k in TOXIC_KEYWORDS)}) AS keyword_hits
FROM scored"""))
def toxicity(spark, sf_dir):
    """X6 + X7: keyword hits and toxicity per message."""
    s = scored_messages(spark, sf_dir)
    return rounded(s.select("id", "toxicity", X.keyword_hits("text").alias("keyword_hits")))


@register("churn_risk", with_scored("""
SELECT id, round(churn_risk, 6) AS churn_risk, churn_risk > 0.7 AS high_churn FROM scored"""))
def churn_risk(spark, sf_dir):
    """Churn risk per message and the high-churn flag."""
    s = scored_messages(spark, sf_dir)
    return rounded(s.select("id", "churn_risk", (F.col("churn_risk") > 0.7).alias("high_churn")))


@register("search_history", with_scored("""
SELECT id, platform, CAST(timestamp AS DATE) AS index_date FROM scored
WHERE CAST(timestamp AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-02'
  AND contains(lower(text), 'with') AND platform = 'twitter'"""))
def search_history(spark, sf_dir):
    """F10 over a history backfilled from the tables (index_date = event
    date): date range, text words and field equality."""
    h = _history_projection(scored_messages(spark, sf_dir)) \
        .withColumn("index_date", F.to_date("timestamp"))
    return FL.search_history(h, "2024-01-01", "2024-01-02", ["with"], {"platform": "twitter"}) \
        .select("id", "platform", "index_date")


@register("normalize_tweets", """
SELECT CAST(e.event_id AS VARCHAR) AS id, 'twitter' AS platform,
       coalesce(c.c_name, 'unknown') AS author, coalesce(c.c_acctbal > 5000, false) AS verified,
       coalesce(d.lang, 'en') AS language, length(d.text) AS n_chars
FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT greatest(1, count(*)) FROM documents)
LEFT JOIN customer c ON c.c_custkey = e.user_id""")
def normalize_tweets(spark, sf_dir):
    """P1 + J1 on tweets re-aimed from the tables: each event with a document
    is a tweet by ``user_id``; customers are the user expansion (verified when
    the account balance is above 5000). Authors join on id, misses default."""
    ev = read_table(spark, sf_dir, "events")
    docs = read_table(spark, sf_dir, "documents")
    tweets = ev.join(docs, ev.event_id % row_count(spark, sf_dir, "documents") == docs.doc_id).select(
        F.col("event_id").alias("id"), "text", F.col("user_id").alias("author_id"),
        F.col("ts").cast("timestamp").alias("created_at"), "lang",
        F.lit(False).alias("is_retweet"),
        F.struct(F.lit(None).cast("string").alias("place_id")).alias("geo"),
        F.lit(None).cast("struct<retweet_count:int,reply_count:int,like_count:int,"
                         "quote_count:int,impression_count:int>").alias("public_metrics"),
        F.lit(None).cast("struct<hashtags:array<struct<tag:string>>,"
                         "mentions:array<struct<username:string>>>").alias("entities"))
    users = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
        (F.col("c_acctbal") > 5000).alias("verified"),
        F.struct(F.col("c_nationkey").alias("followers_count")).alias("public_metrics"))
    out = N.normalize_tweets(tweets, users, ingested_at="2024-02-01 00:00:00")
    return out.select("id", "platform", "author", "verified", "language",
                      F.length("text").alias("n_chars"))


_WIRE_FIELDS = ["id", "platform", "author", "timestamp", "city", "product", "channel", "device", "language", "source",
                "sentiment_label", "emotion", "sentiment_score", "confidence", "toxicity", "churn_risk"]
_WIRE_DOUBLES = {"sentiment_score", "confidence", "toxicity", "churn_risk"}


@register("wire_roundtrip", with_scored(f"""
SELECT {", ".join(f"round({c}, 6) AS {c}" if c in _WIRE_DOUBLES else c for c in _WIRE_FIELDS)},
       length(text) AS n_chars, round(emo_anger, 6) AS anger, round(emo_joy, 6) AS joy FROM scored"""))
def wire_roundtrip(spark, sf_dir):
    """S4 + S3 + T-8: every scored message serialised to its wire JSON (NULL
    fields kept, microseconds kept) and parsed back with the processed schema."""
    from feedlens.sinks.encode import to_wire
    from feedlens.streaming.jobs import parse_processed
    s = scored_messages(spark, sf_dir)
    back = parse_processed(to_wire(s.withColumn("timestamp", F.col("timestamp").cast("timestamp"))))
    return rounded(back.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).select(
        *_WIRE_FIELDS, F.length("text").alias("n_chars"), F.col("emotion_scores")["anger"].alias("anger"),
        F.col("emotion_scores")["joy"].alias("joy")))


@register("raw_roundtrip", with_messages("""
SELECT platform, count(*) AS n, sum(length(text)) AS chars FROM messages
WHERE text IS NOT NULL AND text <> '' GROUP BY platform"""))
def raw_roundtrip(spark, sf_dir):
    """S2 on whole tables: the message view as raw JSON values, parsed with
    RAW_SCHEMA (quarantine mode), cleaned and counted."""
    from feedlens.streaming.jobs import parse_raw
    m = messages(spark, sf_dir).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    raw = m.select(F.to_json(F.struct(*m.columns)).alias("value"))
    parsed = FL.clean(parse_raw(raw).filter(F.col("_corrupt_record").isNull()))
    return parsed.groupBy("platform").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(F.length("text")).alias("chars"))


@register("drop_removed_turns", """
SELECT conv_id, turn FROM conversations
WHERE text IS NOT NULL AND text <> '' AND (conv_id + turn) % 7 > 3""")
def drop_removed_turns(spark, sf_dir):
    """F4 on conversation turns as comment bodies, of which some are removed,
    deleted, empty or missing."""
    body = F.element_at(F.array(F.lit("[removed]"), F.lit("[deleted]"), F.lit(""), F.lit(None).cast("string")),
                        F.least((F.col("conv_id") + F.col("turn")) % 7, F.lit(3)).cast("int") + 1)
    c = read_table(spark, sf_dir, "conversations") \
        .withColumn("text", F.when((F.col("conv_id") + F.col("turn")) % 7 <= 3, body).otherwise(F.col("text")))
    return FL.drop_removed(c, "text").select("conv_id", "turn")


@register("page_of_events", """
SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 100""")
def page_of_events(spark, sf_dir):
    """K4: one page (100 rows) of the newest-first listing, here by id."""
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    return T.take(e, 100, ["event_id"])


@register("message_preview", with_messages("""
SELECT id, substr(text, 1, 50) AS preview FROM messages WHERE text IS NOT NULL AND text <> ''"""))
def message_preview(spark, sf_dir):
    """First 50 characters of every message text."""
    from feedlens.functions.scores import preview
    return FL.clean(messages(spark, sf_dir)).select("id", preview("text").alias("preview"))


def _wire_comments(spark, sf_dir):
    """Comments as a connector sends them, from conversation turns: ``metrics``
    holds numbers and a boolean. Some values are cut off, some have a timestamp that
    is no time."""
    c = read_table(spark, sf_dir, "conversations").where("turn > 0")
    key = F.col("conv_id") * 100 + F.col("turn")
    wire = F.to_json(F.struct(
        F.concat_ws("_", F.lit("c"), F.col("conv_id"), F.col("turn")).alias("id"), "text",
        F.when(key % 11 == 0, "yesterday").otherwise("2024-01-01T00:00:00").alias("timestamp"),
        F.struct(F.col("turn").alias("score"), (F.col("role") == "user").alias("is_submitter")).alias("metrics")))
    return c.withColumn("w", wire).select(
        F.when(key % 13 == 0, F.expr("substring(w, 1, length(w) - 2)")).otherwise(F.col("w")).alias("value"))


@register("raw_comments", """
SELECT 'c_' || conv_id || '_' || turn AS id, CAST(turn AS DOUBLE) AS score,
       CASE WHEN role = 'user' THEN 1.0 ELSE 0.0 END AS is_submitter, length(text) AS n_chars
FROM conversations WHERE turn > 0 AND (conv_id * 100 + turn) % 13 <> 0 AND (conv_id * 100 + turn) % 11 <> 0""")
def raw_comments(spark, sf_dir):
    """S2 / T-4 on connector JSON with a boolean metric: what is kept."""
    from feedlens.streaming.jobs import parse_raw, to_event_time
    ok = to_event_time(parse_raw(_wire_comments(spark, sf_dir), mode="drop")).where("timestamp IS NOT NULL")
    return ok.select("id", F.col("metrics")["score"].alias("score"), F.col("metrics")["is_submitter"].alias("is_submitter"),
                     F.length("text").alias("n_chars"))


@register("raw_dead_letters", """
SELECT CASE WHEN (conv_id * 100 + turn) % 13 = 0 THEN 'malformed' ELSE 'timestamp' END AS reason, count(*) AS n
FROM conversations WHERE turn > 0 AND ((conv_id * 100 + turn) % 13 = 0 OR (conv_id * 100 + turn) % 11 = 0) GROUP BY 1""")
def raw_dead_letters(spark, sf_dir):
    """S2 / T-4: what is quarantined, by reason."""
    from feedlens.streaming.jobs import dead_letters
    return dead_letters(_wire_comments(spark, sf_dir)).groupBy("reason").agg(F.count("*").alias("n"))


BATCH_SIZE_BOUNDS = [1.0, 2.5, 5.0, 7.5, 10.0]

_BATCHES_SQL = ", ".join(f"count(*) FILTER (WHERE n <= {b}) AS le_{f'{b:g}'.replace('.', '_')}" for b in BATCH_SIZE_BOUNDS)


@register("batch_size_histogram", f"""
SELECT event_type, count(*) AS total, sum(n)::DOUBLE AS sum, {_BATCHES_SQL}, count(*) AS le_inf
FROM (SELECT event_type, date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY event_type""")
def batch_size_histogram(spark, sf_dir):
    """A10: inference counter and batch-size histogram; a batch is the requests of
    one type and hour."""
    e = read_table(spark, sf_dir, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("h")) \
        .agg(F.count("*").cast("double").alias("n"))
    return M.inference_histogram(e, "n", BATCH_SIZE_BOUNDS, ["event_type"])


@register("progress_of_total", """
SELECT processed, round(processed * 100.0 / total, 6) AS percent, total - processed AS remaining
FROM (SELECT count(*) AS processed FROM events WHERE event_type <> 'error'), (SELECT count(*) AS total FROM events)""")
def progress_of_total(spark, sf_dir):
    """Percent and remaining against the expected total."""
    e = read_table(spark, sf_dir, "events")
    done = M.progress(e.where("event_type <> 'error'"), "ts", total=e.count())
    return rounded(done.select("processed", "percent", "remaining"))


@register("raw_times", """
SELECT 'reddit_post_' || conv_id AS id, strftime(make_timestamp(1704067200000000 + conv_id * 60000000), '%Y-%m-%dT%H:%M:%S') AS at,
       regexp_extract_all(coalesce(text, ''), '#([A-Za-z0-9_]+)', 1) AS hashtags
FROM conversations WHERE turn = 0""")
def raw_times(spark, sf_dir):
    """Epoch seconds to ISO time, hashtags of the text."""
    posts, _ = _posts_comments(spark, sf_dir)
    out = N.normalize_posts(posts)
    tags = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("#([A-Za-z0-9_]+)"), F.lit(1))
    return out.select("id", F.date_format(F.to_timestamp("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("at"),
                      tags.alias("hashtags"))


@register("message_times", with_scored("""
SELECT id, platform, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at,
       strftime(timestamp, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(timestamp) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS at,
       CAST(timestamp AS DATE) AS day, round(sentiment_score, 2) AS score, sentiment_score >= 0 AS non_negative
FROM scored"""))
def message_times(spark, sf_dir):
    """Lower-case platform, ingestion stamp, ISO time and
    back to a date, fixed decimals, sign."""
    from feedlens.operators.enrich import stamp
    s = scored_messages(spark, sf_dir).select(
        "id", N.lower_platform(F.upper("platform")).alias("platform"), X.iso_text("timestamp").alias("at"),
        X.fixed("sentiment_score", 2).alias("score"), X.sign_flag("sentiment_score").alias("non_negative"))
    return stamp(s, "ingested_at", at="2024-02-01 00:00:00").select(
        "id", "platform", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "at",
        X.utc_date(X.iso_ts("at")).alias("day"), "score", "non_negative")


@register("score_mllib_held_out")
def score_mllib_held_out(spark, sf_dir):
    """U1(b): agreement of labels and predictions on labelled documents that the
    scorer was not trained on (one in four, by the hash of the id)."""
    from feedlens.constants import SENTIMENT_LABELS
    from feedlens.scoring.mllib import MLlibScorer, labelled_documents
    rows = labelled_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    scorer = MLlibScorer(max_iter=20).fit(rows.where(~held))
    out = scorer.class_scores(rows.where(held), "text", emotion=False)
    return M.label_confusion(out.select(
        X.argmax_label("_sent_scores", SENTIMENT_LABELS).alias("predicted"),
        F.element_at(F.array(*map(F.lit, SENTIMENT_LABELS)), F.col("label").cast("int") + 1).alias("expected")),
        "predicted", "expected")
