"""Structured Streaming jobs (S1-S3, S5, S7, S9, T-1..T-10).

Row-wise operators (parse, clean, enrich, to_wire) are the same functions as in
batch; the rollup is the explicit fan-out (P11) grouped by an event-time window
with a watermark, so state is bounded and closed windows are emitted once.
Checkpoints live below the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.operators import filters as FL
from feedlens.operators.enrich import enrich
from feedlens.operators.trends import windowed_metrics
from feedlens.schemas import PROCESSED_SCHEMA, RAW_SCHEMA
from feedlens.session import shared_path
from feedlens.sinks.encode import to_wire

CHECKPOINT_INTERVAL = "60 seconds"
# messages in files: JSON repeats its field names in every row and its text is whole
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def kafka_options(bootstrap: str, topic: str, group_id: str | None = None,
                  starting: str = "latest", **extra) -> dict:
    """Kafka source options (value only, start at latest, group id)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": "true"}
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update(extra)
    return opts


def kafka_producer_options(bootstrap: str, topic: str, **extra) -> dict:
    """Kafka sink options: all replicas acknowledge, 3 retries, gzip."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all",
            "kafka.retries": "3", "kafka.compression.type": "gzip"}
    opts.update(extra)
    return opts


def read_raw_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                    options: dict | None = None, max_files: int | None = None) -> DataFrame:
    """A stream with a string ``value`` column holding raw JSON.

    ``fmt='kafka'`` reads the topic value; ``'text'`` reads JSON lines files;
    ``'json'``/``'parquet'`` read already-structured rows (then ``value`` is
    rebuilt with ``to_json`` so the parse step is the same)."""
    r = spark.readStream.options(**(options or {}))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if fmt == "kafka":
        return r.format("kafka").load().select(F.col("value").cast("string").alias("value"))
    if fmt == "text":
        return r.format("text").load(path)
    if fmt in ("json", "parquet"):
        df = r.schema(RAW_SCHEMA).format(fmt).load(path)
        return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    raise ValueError(f"unknown format {fmt}")


# On the wire a metric may be a number, a boolean or text.
_WIRE_SCHEMA = T.StructType([
    T.StructField(f.name, T.MapType(T.StringType(), T.StringType())) if f.name == "metrics" else f
    for f in RAW_SCHEMA.fields])


def _numbers(m: Column) -> Column:
    """Numeric view of an open map: booleans as 1 and 0, text that is no number NULL."""
    return F.transform_values(m, lambda k, v: F.when(v == "true", 1.0).when(v == "false", 0.0)
                              .otherwise(v.try_cast("double")))


def parse_raw(df: DataFrame, value_col: str = "value", mode: str = "quarantine") -> DataFrame:
    """JSON to RAW_SCHEMA; unknown fields are ignored, ``metrics`` is read
    as an open map and returned as numbers.

    A malformed value gives a struct of NULLs, not NULL (trap T4), so the raw
    text is kept in ``_corrupt_record`` for those rows. ``mode='quarantine'``
    keeps them flagged, ``'drop'`` removes them, ``'failfast'`` makes the query
    fail on the first one (as the reference's deserializer does)."""
    schema = T.StructType(_WIRE_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    opts = {"columnNameOfCorruptRecord": "_corrupt_record",
            "mode": "FAILFAST" if mode == "failfast" else "PERMISSIVE"}
    parsed = df.filter(F.col(value_col).isNotNull()) \
        .select(F.from_json(F.col(value_col), schema, opts).alias("_m"))
    out = parsed.select("_m.*").withColumn("metrics", _numbers(F.col("metrics")))
    if mode == "drop":
        out = out.filter(F.col("_corrupt_record").isNull())
    return out


def parse_processed(df: DataFrame, value_col: str = "value") -> DataFrame:
    """S3: scored-message JSON. NULL values, JSON ``null`` and malformed JSON are
    skipped; ``dead_letters`` gives the malformed ones."""
    schema = T.StructType(PROCESSED_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())])
    m = df.filter(F.col(value_col).isNotNull()) \
        .select(F.from_json(F.col(value_col), schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("_m"))
    return m.filter("_m IS NOT NULL AND _m._corrupt_record IS NULL").select("_m.*").drop("_corrupt_record")


def dead_letters(df: DataFrame, value_col: str = "value", schema: T.StructType | None = None) -> DataFrame:
    """Values that ``score_stream`` (or, with PROCESSED_SCHEMA, ``parse_processed``)
    leaves out, as (value, reason): "malformed" JSON, or a raw message whose
    "timestamp" is set but no time. On a stream, write them to a sink of their
    own next to the scored messages."""
    full = T.StructType((schema or _WIRE_SCHEMA).fields + [T.StructField("_corrupt_record", T.StringType())])
    m = df.filter(F.col(value_col).isNotNull()).select(
        F.col(value_col).alias("value"),
        F.from_json(F.col(value_col), full, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("_m"))
    reason = F.when(F.col("_m._corrupt_record").isNotNull(), "malformed")
    if schema is None:
        ts = F.col("_m.timestamp")
        reason = reason.when(ts.isNotNull() & F.try_to_timestamp(ts).isNull(), "timestamp")
    return m.select("value", reason.alias("reason")).filter("reason IS NOT NULL")


def to_event_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Trap T1: ISO text or TIMESTAMP_NTZ to TIMESTAMP (UTC session zone),
    the type ``withWatermark`` accepts; text that is no time becomes NULL."""
    t = df.schema[col].dataType.typeName()
    if t == "string":
        return df.withColumn(col, F.try_to_timestamp(F.col(col)))
    if t == "timestamp_ntz":
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def score_stream(raw_values: DataFrame, scorer, processed_at=None) -> DataFrame:
    """T-4: parse -> clean -> enrich, stateless. What cannot be parsed, or has a
    timestamp that is no time, is in ``dead_letters(raw_values)``."""
    parsed = parse_raw(raw_values, mode="drop")
    ts = F.col("timestamp")
    parsed = parsed.filter(ts.isNull() | F.try_to_timestamp(ts).isNotNull())
    return enrich(FL.clean(parsed), scorer, processed_at=processed_at)


def publish_raw(messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Raw messages as key / JSON value rows, to a topic or as files. The
    Kafka package is not part of Spark's own distribution; it must be on the
    class path for ``fmt="kafka"``."""
    fields = [c for c in RAW_SCHEMA.fieldNames() if c in messages.columns]
    out = messages.select(F.col("id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
    w = out.write.format(fmt).options(**options)
    w.save() if path is None else w.mode("append").save(path)


def with_lateness(df: DataFrame, ts_col: str = "timestamp", delay: str = "10 minutes") -> DataFrame:
    """T-2: watermark so window state is bounded; rows later than the delay are
    dropped and counted in ``numRowsDroppedByWatermark`` (T-3)."""
    return to_event_time(df, ts_col).withWatermark(ts_col, delay)


def windowed_stream(scored: DataFrame, ts_col: str = "timestamp", width: str = "60 seconds",
                    delay: str = "10 minutes", emotions: bool = True) -> DataFrame:
    """T-1 on a stream: watermark + window x (dim, key) metrics (append mode
    emits each window once it closes)."""
    return windowed_metrics(with_lateness(scored, ts_col, delay), ts_col, width,
                            emotions=emotions)


def checkpoint(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "streams", name)


def start(df: DataFrame, name: str, sink: str = "parquet", path: str | None = None,
          mode: str = "append", trigger: dict | None = None, options: dict | None = None,
          partition_by: list[str] | None = None, foreach_batch=None,
          checkpoint_location: str | None = None):
    """S5 / T-5 / T-8: start a query with a checkpoint. ``trigger`` defaults to
    a 60 s processing-time trigger; ``{'availableNow': True}`` drains what is
    there and stops (T-6 final flush)."""
    spark = df.sparkSession
    w = df.writeStream.queryName(name).outputMode(mode) \
        .option("checkpointLocation", checkpoint_location or checkpoint(spark, name))
    w = w.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
    if options:
        w = w.options(**options)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if partition_by:
        w = w.partitionBy(*partition_by)
    if sink in ("parquet", "json"):
        return w.format(sink).start(path)
    return w.format(sink).start()


def progress_summary(query) -> dict:
    """A11 on a stream: processed rows, batches, input and processing rates
    from ``StreamingQueryProgress``; rows dropped as late (T-3)."""
    ps = [p for p in query.recentProgress]
    with_rows = [p for p in ps if p["numInputRows"] > 0]
    busy = sum(p["durationMs"].get("triggerExecution", 0) for p in with_rows) / 1000.0
    rows = sum(p["numInputRows"] for p in with_rows)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in ps
                  for op in p.get("stateOperators", []))
    return {"processed": rows, "batches": len(with_rows),
            "rows_per_sec": rows / busy if busy else None, "late_dropped": dropped}


def wire_stream(scored: DataFrame) -> DataFrame:
    """S4 on a stream: key/value JSON rows for a topic sink."""
    return to_wire(scored)


def alert_stream(scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    """T-7: high-churn alerts with alert time."""
    return FL.churn_alerts(scored, threshold)


def message_feed(scored: DataFrame) -> DataFrame:
    """T-8: every scored message onward as it arrives (append)."""
    return to_wire(scored)
