"""Registered queries: open maps (S2, P1), entities and counters of tweets (P4), many keywords
(F2, X6), latency sketches (A8), running counters and late rows (A10, A11, T-3), hot ids
(D3, T-9), the stored form with histogram and time (S11, S12), shares with empty entries
(F7), rankings with ties (K1, K2), optional response parts (U5, X13)."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from feedlens.constants import EMOTION_LABELS
from feedlens.functions.keywords import keyword_matches
from feedlens.operators import dedupe as D
from feedlens.operators import metrics as M
from feedlens.operators import normalize as N
from feedlens.operators import open_maps as OM
from feedlens.operators import reports as R
from feedlens.operators import stats as ST
from feedlens.operators import trends as T
from feedlens.operators.enrich import enrich, response_fields
from feedlens.operators.filters import clean
from feedlens.plans.catalog import DEFAULT_SCORER, register, rounded, scored_messages
from feedlens.plans.oracle_sql import with_scored
from feedlens.plans.reports_q import SPINE_SQL, _with_seg, dim_table, segment_table, spine_table
from feedlens.plans.rows_q import _wire_comments
from feedlens.plans.stream_inputs import deal, run_dir
from feedlens.scoring.lexicon import LexiconScorer
from feedlens.sinks.encode import decode_metrics, encode_metrics
from feedlens.sources.tables import events_stream, messages, read_table, row_count
from feedlens.streaming import counters as C
from feedlens.streaming import jobs as J

# -- S2 / P1: open maps ----------------------------------------------------


@register("raw_open_maps", """
SELECT 'c_' || conv_id || '_' || turn AS id, CAST(turn AS DOUBLE) AS score, CASE WHEN role = 'user' THEN 1.0 ELSE 0.0 END AS is_submitter,
       role AS flair, CAST(turn AS VARCHAR) AS gold, 'b' AS second_tag,
       CASE WHEN role = 'user' THEN 'true' ELSE 'false' END AS wire_submitter, CAST(turn * 10 AS VARCHAR) AS wire_level,
       length(text) AS n_chars
FROM conversations WHERE turn > 0""")
def raw_open_maps(spark, sf_dir):
    """Comments whose metrics, entities and metadata hold numbers, text, booleans,
    lists and objects: parsed into open columns, read by name, and written back to the wire,
    from which some are read once more."""
    c = read_table(spark, sf_dir, "conversations").where("turn > 0")
    wire = c.select(F.to_json(F.struct(
        F.concat_ws("_", F.lit("c"), "conv_id", "turn").alias("id"), "text",
        F.struct(F.col("turn").alias("score"), (F.col("role") == "user").alias("is_submitter"), F.col("role").alias("flair"),
                 F.struct(F.col("turn").alias("gold")).alias("awards")).alias("metrics"),
        F.struct(F.array(F.lit("a"), F.lit("b")).alias("hashtags")).alias("entities"),
        F.struct(F.struct((F.col("turn") * 10).alias("level")).alias("deep")).alias("metadata"))).alias("value"))
    m = OM.parse_open(wire).where("_corrupt_record IS NULL")
    back = OM.open_wire(m).withColumnRenamed("value", "wire")
    read = m.select("id", OM.number("metrics", "score").alias("score"), OM.number("metrics", "is_submitter").alias("is_submitter"),
                    OM.text("metrics", "flair").alias("flair"), OM.text("metrics", "awards.gold").alias("gold"),
                    OM.text("entities", "hashtags[1]").alias("second_tag"), F.length("text").alias("n_chars"))
    return read.join(back, read.id == back.key).select(
        "id", "score", "is_submitter", "flair", "gold", "second_tag",
        F.get_json_object("wire", "$.metrics.is_submitter").alias("wire_submitter"),
        F.get_json_object("wire", "$.metadata.deep.level").alias("wire_level"), "n_chars")


@register("tweet_entities", """
SELECT CAST(e.event_id AS VARCHAR) AS id, regexp_extract_all(d.text, '#([A-Za-z0-9_]+)', 1) AS hashtags,
       regexp_extract_all(d.text, '@([A-Za-z0-9_]+)', 1) AS mentions,
       CAST(e.event_id % 50 AS DOUBLE) AS likes, CASE WHEN e.event_id % 3 = 0 THEN 0.0 ELSE CAST(e.user_id AS DOUBLE) END AS replies,
       c.c_nationkey AS followers_count
FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT greatest(1, count(*)) FROM documents)
LEFT JOIN customer c ON c.c_custkey = e.user_id""")
def tweet_entities(spark, sf_dir):
    """P1 and P4 with values: hashtags and mentions of the text as the platform lists them,
    counters of which some are missing, the author's followers."""
    ev, docs = read_table(spark, sf_dir, "events"), read_table(spark, sf_dir, "documents")
    found = lambda mark, name: F.transform(
        F.regexp_extract_all("text", F.lit(f"{mark}([A-Za-z0-9_]+)"), F.lit(1)), lambda x: F.struct(x.alias(name)))
    none = F.lit(None).cast("int")
    tweets = ev.join(docs, ev.event_id % row_count(spark, sf_dir, "documents") == docs.doc_id).select(
        F.col("event_id").alias("id"), "text", F.col("user_id").alias("author_id"), F.col("ts").cast("timestamp").alias("created_at"),
        "lang", F.lit(False).alias("is_retweet"), F.struct(F.lit(None).cast("string").alias("place_id")).alias("geo"),
        F.struct(none.alias("retweet_count"), F.when(F.col("event_id") % 3 != 0, F.col("user_id")).cast("int").alias("reply_count"),
                 (F.col("event_id") % 50).cast("int").alias("like_count"), none.alias("quote_count"),
                 none.alias("impression_count")).alias("public_metrics"),
        F.struct(found("#", "tag").alias("hashtags"), found("@", "username").alias("mentions")).alias("entities"))
    users = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"), F.lit(False).alias("verified"),
        F.struct(F.col("c_nationkey").alias("followers_count")).alias("public_metrics"))
    out = N.normalize_tweets(tweets, users, ingested_at="2024-02-01 00:00:00")
    return out.select("id", "entities.hashtags", "entities.mentions", F.col("metrics")["like_count"].alias("likes"),
                      F.col("metrics")["reply_count"].alias("replies"), "followers_count")


# -- F2 / X6: many keywords ------------------------------------------------

# fixed values: every consonant, vowel, consonant
KEYWORDS = ["".join(x) for x in product("bcdfghlmnprst", "aeiou", "bcdfghlmnprst")]


@register("many_keywords", f"""
SELECT d.doc_id, count(*) AS n_keywords, min(k.w) AS first_keyword
FROM documents d JOIN (VALUES {", ".join(f"('{k}')" for k in KEYWORDS)}) k(w) ON contains(lower(d.text), k.w)
GROUP BY d.doc_id""")
def many_keywords(spark, sf_dir):
    """F2 / X6 with a list of 845 keywords, which are looked for in one pass."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", keyword_matches("text", KEYWORDS).alias("found"))
    return d.where(F.size("found") > 0).select("doc_id", F.size("found").cast("long").alias("n_keywords"), F.array_min("found").alias("first_keyword"))


# -- A8: sketches ----------------------------------------------------------

QUANTILES = {"median": 0.5, "p95": 0.95, "p99": 0.99}


@register("latency_sketches", f"""
SELECT event_type, q.name AS quantile, count(*) AS n, true AS within, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max
FROM events, (VALUES {", ".join(f"('{k}')" for k in QUANTILES)}) q(name) WHERE value IS NOT NULL GROUP BY ALL""")
def latency_sketches(spark, sf_dir):
    """A8 over windows: a sketch for each day and type, merged when read. ``within``: the
    estimate's rank, counted over all rows, is as near to the wanted one as stated."""
    ev = read_table(spark, sf_dir, "events")
    days = ST.quantile_sketches(ev, "value", ["event_type"], "ts", "1 day")
    run = run_dir(spark, "sketches")
    days.write.parquet(f"{run}/days")
    est = ST.merge_sketches(spark.read.parquet(f"{run}/days"), ["event_type"], QUANTILES)
    est = est.select("event_type", "n", "mean", "min", "max", F.inline(F.array(*[
        F.struct(F.lit(k).alias("quantile"), F.lit(q).alias("q"), F.col(k).alias("estimate")) for k, q in QUANTILES.items()])))
    e = est.alias("e")
    ranked = ev.where("value IS NOT NULL").select("event_type", "value").join(e, "event_type").groupBy("event_type", "quantile").agg(
        F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto"))
    near = (F.col("below") <= (F.col("q") + ST.RANK_ERROR) * F.col("n")) & (F.col("upto") >= (F.col("q") - ST.RANK_ERROR) * F.col("n"))
    return rounded(est.join(ranked, ["event_type", "quantile"]).select("event_type", "quantile", "n", near.alias("within"), "mean", "min", "max"))


# -- A10 / A11 / T-3: counters ---------------------------------------------

_BAD, _LATER = "(conv_id * 100 + turn) % 13 = 0", "(conv_id * 100 + turn) % 11 = 0"


def _logged(spark, path, start):
    """Run the queries that ``start`` starts, one by one, with a counter log."""
    log = C.CounterLog(spark, path)
    spark.streams.addListener(log)
    try:
        for go in start:
            go().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # reports come after the micro-batch
    finally:
        spark.streams.removeListener(log)


@register("stream_counters", f"""
SELECT name, n FROM (SELECT count(*) AS messages, count(*) FILTER (WHERE {_BAD}) AS malformed,
  count(*) FILTER (WHERE NOT {_BAD} AND {_LATER}) AS timestamp,
  count(*) FILTER (WHERE NOT {_BAD} AND NOT {_LATER} AND coalesce(text, '') = '') AS empty,
  count(*) FILTER (WHERE NOT {_BAD} AND NOT {_LATER} AND coalesce(text, '') <> '') AS scored
  FROM conversations WHERE turn > 0) UNPIVOT (n FOR name IN (messages, malformed, timestamp, empty, scored))""")
def stream_counters(spark, sf_dir):
    """Counters of the scoring stream, from the pass that scores: two micro-batches,
    a restart, two more. The dead letters need no second parse."""
    run = run_dir(spark, "counters")
    wire = _wire_comments(spark, sf_dir)
    name = f"counters_{run[-8:]}"

    def start():
        scored = C.score_stream_counted(J.read_raw_stream(spark, "text", f"{run}/in", max_files=1), LexiconScorer())
        return J.start(scored.drop("emotion_scores", "metrics"), name, path=f"{run}/out", trigger={"availableNow": True},
                       checkpoint_location=f"{run}/checkpoint")

    def after(parts):
        def go():
            for k in parts:
                wire.where(F.pmod(F.xxhash64("value"), F.lit(4)) == k).coalesce(1).write.mode("append").text(f"{run}/in")
            return start()
        return go
    _logged(spark, f"{run}/log", [after([0, 1]), after([2, 3])])
    return C.read_counters(spark, f"{run}/log", name).where("name NOT IN ('input', 'late')")


@register("stream_late_count", """
SELECT (SELECT count(*) FROM events) AS kept, (SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-05') AS late""")
def stream_late_count(spark, sf_dir):
    """T-3: rows that come behind the watermark are dropped and counted: the events in two
    micro-batches, and those to 5 January once more."""
    run = run_dir(spark, "late")
    ev = read_table(spark, sf_dir, "events")
    for part in ("ts < '2024-01-20'", "ts >= '2024-01-20'", "ts < '2024-01-05'"):
        ev.where(part).coalesce(1).write.mode("append").parquet(f"{run}/in/events.parquet")
    once = D.dedupe(J.with_lateness(events_stream(spark, f"{run}/in", max_files=1), "ts", "1 day"), "event_id")
    name = f"late_{run[-8:]}"
    _logged(spark, f"{run}/log", [lambda: J.start(once.select("event_id"), name, path=f"{run}/out", trigger={"availableNow": True},
                                                  checkpoint_location=f"{run}/checkpoint")])
    late = C.read_counters(spark, f"{run}/log", name).where("name = 'late'")
    kept = spark.read.parquet(f"{run}/out").agg(F.count("*")).scalar()
    return late.select(kept.alias("kept"), F.col("n").alias("late"))


# -- D3 / T-9: a hot id ----------------------------------------------------

@register("stream_dedupe_hot", """
SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id END AS id, count(*) AS n FROM (
  SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id END AS event_id FROM events) GROUP BY 1""")
def stream_dedupe_hot(spark, sf_dir):
    """D3 / T-9 on a stream a third of whose rows have one id: dealt to slices, each of which
    lets the id through once, before the last step sees it."""
    run = run_dir(spark, "dedupe_hot")
    ev = read_table(spark, sf_dir, "events").withColumn("event_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("event_id")))
    files = deal(ev, "ts", f"{run}/in/events.parquet")
    src = J.to_event_time(events_stream(spark, f"{run}/in", max_files=files), "ts")
    once = D.dedupe(src.select(F.col("event_id").alias("id"), "ts"), "id", watermark_col="ts", delay="31 days", slices=8)
    J.start(once, f"hot_{run[-8:]}", path=f"{run}/out", trigger={"availableNow": True},
            checkpoint_location=f"{run}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{run}/out").groupBy("id").agg(F.count("*").alias("n"))


# -- S11 / S12, F7, K1 / K2, U5 / X13 --------------------------------------

_SEG_ROWS = """,
seg_rows AS (
  SELECT 'geo' AS dim, coalesce(city, 'null') AS key, emotion, timestamp FROM scored
  UNION ALL SELECT 'product', coalesce(product, 'null'), emotion, timestamp FROM scored
  UNION ALL SELECT 'channel', coalesce(channel, 'null'), emotion, timestamp FROM scored
  UNION ALL SELECT 'platform', coalesce(platform, 'null'), emotion, timestamp FROM scored
  UNION ALL SELECT 'overall', NULL, emotion, timestamp FROM scored)"""


@register("metrics_stored_form", with_scored("").rstrip() + _SEG_ROWS + f"""
SELECT dim, key, strftime(max(timestamp), '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(max(timestamp)) // 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS stored_at,
       date_trunc('millisecond', max(timestamp)) AS read_at,
       {", ".join(f"count(*) FILTER (WHERE emotion = '{e}') AS {e}" for e in EMOTION_LABELS)}
FROM seg_rows GROUP BY dim, key""")
def metrics_stored_form(spark, sf_dir):
    """S11 and S12 with all their conversions: the histogram as JSON and the ISO time of a
    stored row, read back into a map and a time."""
    stored = encode_metrics(segment_table(spark, sf_dir, emotions=True))
    back = decode_metrics(stored.withColumn("stored_at", F.col("last_updated")))
    count = lambda e: F.coalesce(F.try_element_at("emotion_distribution", F.lit(e)), F.lit(0)).cast("long").alias(e)
    return back.select("dim", "key", "stored_at", F.col("last_updated").cast("timestamp_ntz").alias("read_at"),
                       *[count(e) for e in EMOTION_LABELS])


@register("emotion_pie", with_scored("").rstrip() + f""",
label AS (SELECT unnest([{", ".join(f"'{e}'" for e in EMOTION_LABELS)}]) AS emotion),
hist AS (SELECT c.channel, l.emotion, count(s.id) AS n FROM (SELECT DISTINCT channel FROM scored) c CROSS JOIN label l
         LEFT JOIN scored s ON s.channel = c.channel AND s.emotion = l.emotion GROUP BY ALL)
SELECT channel, emotion, n, sum(n) OVER (PARTITION BY channel) AS total, round(n / sum(n) OVER (PARTITION BY channel), 6) AS share
FROM hist QUALIFY n > 0""")
def emotion_pie(spark, sf_dir):
    """Shares from histograms that name all labels; entries of zero are left out."""
    s = scored_messages(spark, sf_dir).groupBy("channel").agg(F.map_from_arrays(
        F.array(*[F.lit(e) for e in EMOTION_LABELS]), F.array(*[F.count_if(F.col("emotion") == e) for e in EMOTION_LABELS])).alias("hist"))
    return rounded(M.histogram_shares(s, ["channel"], "hist"))


_TIED = f"""(SELECT sp.key AS key, sp.spine_pos AS spine_pos, round(coalesce(s.avg_sentiment, 0.0), 0) AS avg_sentiment
  FROM {SPINE_SQL["product"]} LEFT JOIN (SELECT * FROM seg WHERE dim = 'product') s ON s.key = sp.key)"""


@register("rank_tied_products", _with_seg(f"""
SELECT key, spine_pos, abs(avg_sentiment) AS avg_sentiment, row_number() OVER (ORDER BY abs(avg_sentiment) DESC, spine_pos ASC) AS rank,
       (SELECT arg_max(key, spine_pos) FROM {_TIED} WHERE abs(avg_sentiment) = (SELECT max(abs(avg_sentiment)) FROM {_TIED})) AS best_product
FROM {_TIED}"""))
def rank_tied_products(spark, sf_dir):
    """K1 and K2 where means tie, being rounded to whole numbers: the ranking keeps the
    spine's order, the best product is the last of the tied ones."""
    sp = spine_table(spark, sf_dir, "product")
    rep = R.segment_report(spark, dim_table(spark, sf_dir, "product", sp), "product", sp) \
        .select("key", "spine_pos", F.abs(F.round("avg_sentiment", 0)).alias("avg_sentiment"))
    best = T.best_product(rep).select("best_product").scalar()
    return T.rank_products(rep).withColumn("best_product", best)


@register("optional_parts", with_scored("""
SELECT id, round(r_score, 6) AS sentiment_score, CAST(NULL AS VARCHAR) AS emotion, CAST(NULL AS DOUBLE) AS toxicity,
       'neutral' AS enriched_emotion, 0.0 AS enriched_toxicity FROM resp3 WHERE toks IS NOT NULL"""))
def optional_parts(spark, sf_dir):
    """A scorer without emotions and toxicity: NULL in its response, the defaults
    ("neutral", 0) in the enriched message."""
    m = clean(messages(spark, sf_dir))
    part = response_fields(DEFAULT_SCORER.class_scores(m, "text", emotion=False), emotion=False, toxicity=False) \
        .select("id", "sentiment_score", "emotion", "toxicity")
    full = enrich(m, DEFAULT_SCORER, emotion=False, toxicity=False).select(
        "id", F.col("emotion").alias("enriched_emotion"), F.col("toxicity").alias("enriched_toxicity"))
    return rounded(part.join(full, "id"))
