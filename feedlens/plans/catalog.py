"""Named queries over the driver tables, each with its DuckDB oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is SQL over the
driver tables registered as views. Every query reads whole tables; computed
columns carry the same alias on both sides and doubles are rounded to 6
decimals so that partition-dependent summation order cannot change a hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators.enrich import enrich, spread_for_cpu
from feedlens.operators.filters import clean
from feedlens.scoring.lexicon import LexiconScorer
from feedlens.schemas import PROCESSED_FIELDS
from feedlens.sources.tables import document_columns, message_base, messages  # noqa: F401

SCORE_FIELDS = ["sentiment_score", "sentiment_label", "confidence", "emotion", "emotion_scores",
                "toxicity", "churn_risk", "inference_time_ms", "processing_timestamp"]

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
BENCH: list[str] = []

DIGITS = 6
DEFAULT_SCORER = LexiconScorer()


def register(name: str, sql: str | None = None, bench: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        if bench:
            BENCH.append(name)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (report edge only)."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def scored_messages(spark: SparkSession, sf_dir: str, scorer=None, processed_at=None,
                    **kw) -> DataFrame:
    """messages -> F1 clean -> enrich (lexicon scorer by default), with
    ``doc_id`` and ``value``.

    Same rows as ``enrich(clean(messages))``, planned for scale: documents
    are cleaned (F1) and scored right after their scan, once each, and only
    then joined to the narrow event-side columns. The text never crosses a
    shuffle unless the query itself selects it; rollups move a few score
    columns per row. ``only`` filters the event side first (a function of its frame); then
    just the documents of the events that are left are scored."""
    only = kw.pop("only", None)
    base = message_base(spark, sf_dir)
    docs = clean(document_columns(spark, sf_dir))
    if only is not None:
        base = only(base)
        docs = spread_for_cpu(docs).join(base.select("doc_id").distinct(), "doc_id", "left_semi")
    else:
        docs = spread_for_cpu(docs)
    scored_docs = enrich(docs, scorer or DEFAULT_SCORER, keep=["doc_id"], processed_at=processed_at, **kw) \
        .select("doc_id", "text", "language", "source", *SCORE_FIELDS, "scored_ok")
    cols = [F.lit(None).cast("map<string,double>").alias(c) if c == "metrics" else F.col(c)
            for c in PROCESSED_FIELDS]
    return base.join(scored_docs, "doc_id").select(*cols, "doc_id", "value", "scored_ok")
