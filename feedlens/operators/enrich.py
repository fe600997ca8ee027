"""Row enrichment: base projection, scoring, derived scores, defaults."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.constants import EMOTION_LABELS, MAX_SCORABLE_CHARS, SENTIMENT_LABELS, TOXIC_KEYWORDS
from feedlens.functions import scores as X
from feedlens.schemas import BASE_FIELDS, PROCESSED_FIELDS


def scorable(text, max_chars: int | None = MAX_SCORABLE_CHARS) -> Column:
    """1 to max_chars characters (code points); without a bound any text
    that is not empty."""
    t = F.col(text) if isinstance(text, str) else text
    n = F.length(t)
    return F.coalesce(n.between(1, max_chars) if max_chars else n >= 1, F.lit(False))


def spread_for_cpu(df: DataFrame) -> DataFrame:
    """Before a CPU-heavy step: if the input has fewer partitions than the
    cluster has cores (e.g. a file with few row groups, or one unsplittable
    file), spread it round-robin over the default parallelism. A large
    input already has many more splits than cores and is left untouched, so
    at scale this adds no shuffle."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def stamp(df: DataFrame, col: str = "processing_timestamp", at=None) -> DataFrame:
    """P10: processing / ingestion time; ``at`` pins it for reproducible runs."""
    value = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn(col, value)


def to_processed_base(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The twelve fields copied from the raw row (absent ones become NULL),
    plus any ``keep`` columns the caller wants carried through."""
    cols = []
    for name in BASE_FIELDS:
        if name in df.columns:
            cols.append(F.col(name))
        elif name == "metrics":
            cols.append(F.lit(None).cast("map<string,double>").alias(name))
        else:
            cols.append(F.lit(None).cast("string").alias(name))
    return df.select(*cols, *[F.col(c) for c in (keep or []) if c not in BASE_FIELDS])


# Column expressions are unresolved trees, independent of any DataFrame, so the
# large scoring expressions are built once per process and reused: each build
# costs thousands of Python->JVM calls.
@functools.lru_cache(maxsize=None)
def _response_cols(emotion: bool, text: str = "text"):
    sent = F.col("_sent_scores")
    cols = [X.polarity(sent).alias("sentiment_score"),
            X.argmax_label(sent, SENTIMENT_LABELS).alias("sentiment_label"),
            X.confidence(sent).alias("confidence")]
    if emotion:
        cols += [X.emotion_map("_emo_scores").alias("emotion_scores"),
                 X.argmax_label("_emo_scores", EMOTION_LABELS).alias("emotion")]
    else:
        cols += [F.lit(None).cast("map<string,double>").alias("emotion_scores"),
                 F.lit(None).cast("string").alias("emotion")]
    return cols


@functools.lru_cache(maxsize=None)
def _tox_col(emotion: bool, toxicity: bool, keywords: tuple, text: str = "text"):
    if not toxicity:
        return F.lit(None).cast("double").alias("toxicity")
    return X.toxicity(F.col("sentiment_score"), F.col("emotion_scores"), F.col(text),
                      list(keywords), has_emotions=emotion).alias("toxicity")


@functools.lru_cache(maxsize=None)
def _churn_col(emotion: bool):
    return X.churn_risk(F.col("sentiment_score"), F.col("emotion_scores"), F.col("toxicity"),
                        has_emotions=emotion).alias("churn_risk")


def response_fields(df: DataFrame, emotion: bool = True, toxicity: bool = True,
                    keywords=TOXIC_KEYWORDS, text: str = "text") -> DataFrame:
    """The scorer's response fields from the class-score columns.
    Optional parts that are switched off come back NULL."""
    out = df.select("*", *_response_cols(emotion))
    out = out.select("*", _tox_col(emotion, toxicity, tuple(keywords), text))
    return out.select("*", _churn_col(emotion), F.col("_latency_ms").alias("inference_time_ms"))


def enrich(df: DataFrame, scorer, emotion: bool = True, toxicity: bool = True,
           keywords=TOXIC_KEYWORDS, processed_at=None, keep: list[str] | None = None,
           max_chars: int | None = None) -> DataFrame:
    """Base projection plus every score field.

    X13: a missing emotion reads as "neutral", missing toxicity / churn as 0.
    Whole texts are scored; ``max_chars`` sets the limit of a service that
    refuses longer ones.
    U3: a row that cannot be scored (empty or longer than the limit) keeps its
    place with defaults (0, "neutral", 0, "neutral", 0, 0, time 0) and NULL
    emotion_scores; ``scored_ok`` tells which rows were scored.

    Built from a handful of wide ``select``s (not one ``withColumn`` per field)
    so the analyser runs a few times, not twenty."""
    keep = [c for c in (keep or []) if c in df.columns]
    base = to_processed_base(df, keep)
    base = base.select("*", F.when(scorable("text", max_chars), F.col("text")).alias("_score_text"))
    scored = scorer.class_scores(base, "_score_text", emotion=emotion)
    resp = response_fields(scored, emotion=emotion, toxicity=toxicity, keywords=keywords,
                           text="_score_text")
    ok = F.col("_scored")
    ts = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    fields = {
        "sentiment_score": F.when(ok, F.col("sentiment_score")).otherwise(F.lit(0.0)),
        "sentiment_label": F.when(ok, F.col("sentiment_label")).otherwise(F.lit("neutral")),
        "confidence": F.when(ok, F.col("confidence")).otherwise(F.lit(0.0)),
        "emotion": F.when(ok, F.coalesce(F.col("emotion"), F.lit("neutral")))
        .otherwise(F.lit("neutral")),
        "emotion_scores": F.when(ok, F.col("emotion_scores")),
        "toxicity": F.when(ok, F.coalesce(F.col("toxicity"), F.lit(0.0))).otherwise(F.lit(0.0)),
        "churn_risk": F.when(ok, F.coalesce(F.col("churn_risk"), F.lit(0.0))).otherwise(F.lit(0.0)),
        "inference_time_ms": F.when(ok, F.col("inference_time_ms")).otherwise(F.lit(0.0)),
        "processing_timestamp": ts,
    }
    # The score fields leave through a one-row ``inline`` (a Generate node): a
    # later filter on a score (``churn_risk > 0.7``) stays above it instead of
    # being pushed down with the whole scoring expression substituted into the
    # filter condition. Filters on pass-through columns still reach the scan.
    scores = F.struct(*[fields[c].alias(c) for c in fields], ok.alias("scored_ok"))
    passthrough = [c for c in PROCESSED_FIELDS if c not in fields] + keep
    out = resp.select(*passthrough, F.inline(F.array(scores)))
    return out.select(*PROCESSED_FIELDS, *keep, "scored_ok")
