"""What the streamed queries read: tables dealt into several micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators.enrich import enrich
from feedlens.operators.filters import clean
from feedlens.plans.catalog import DEFAULT_SCORER, SCORE_FIELDS
from feedlens.schemas import PROCESSED_FIELDS
from feedlens.session import shared_path
from feedlens.sources.tables import document_columns, events_stream, message_base, read_table
from feedlens.streaming import jobs as J

BATCHES = 4  # micro-batches that a table is dealt into


def run_dir(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "queries", f"{name}_{uuid.uuid4().hex}")


def part_of(ts: str, lo, hi, parts: int = BATCHES):
    """The part of the time from ``lo`` to ``hi`` that a row falls into, from 0."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.floor(parts * (us(F.col(ts)) - us(lo)) / (us(hi) - us(lo) + 1))


def deal(df: DataFrame, ts: str, path: str, parts: int = BATCHES) -> int:
    """Write ``df`` to ``path`` in equal parts of its time, one after the other, each in as
    many files as ``df`` has partitions; returns that number, what a micro-batch takes."""
    files = max(1, df.rdd.getNumPartitions())
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    for i in range(parts):
        df.where(part_of(ts, F.lit(lo), F.lit(hi), parts) == i).repartition(files).write.mode("append").parquet(path)
    return files


def heartbeat(df: DataFrame, ts: str, path: str, **values) -> None:
    """One row more in ``path``, a year after ``df`` ends, that belongs to no message: it moves
    the watermark on so that all before it is closed (T-6)."""
    end = df.agg(F.max(ts).alias("t")).select((F.col("t") + F.expr("INTERVAL 365 DAYS")).alias(ts))
    row = end.select(*[F.col(ts) if c == ts else F.lit(values.get(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    row.write.mode("append").parquet(path)


def stream_scored(spark: SparkSession, sf_dir: str, run: str, delay: str | None = None) -> DataFrame:
    """events as a stream of BATCHES micro-batches in time order, joined to the documents,
    which are scored once into a table keyed by doc_id. With ``delay`` the events carry a
    watermark, and a heartbeat closes what the last of them leaves open."""
    ev = read_table(spark, sf_dir, "events")
    files = deal(ev, "ts", f"{run}/in/events.parquet")
    enrich(clean(document_columns(spark, sf_dir)), DEFAULT_SCORER, keep=["doc_id"]) \
        .select("doc_id", "text", "language", "source", *SCORE_FIELDS).write.parquet(f"{run}/scored")
    src = events_stream(spark, f"{run}/in", max_files=files)
    if delay is not None:
        heartbeat(ev, "ts", f"{run}/in/events.parquet", event_id=-1)  # no document has that number
        src = J.with_lateness(src, "ts", delay)
    base = message_base(spark, sf_dir, src)
    docs = spark.read.parquet(f"{run}/scored")
    return base.join(docs, "doc_id").select(*[c for c in PROCESSED_FIELDS if c != "metrics"])
