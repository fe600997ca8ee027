"""Driver tables and the ``messages`` view that stands in for raw messages.

The view is defined once here as DataFrame code and once as SQL text (used by
the DuckDB oracle and by ``spark.sql`` users); both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.constants import DEVICES, PLATFORMS
from feedlens.operators.joins import broadcast_if_small

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan of one driver table, listed anew at every call so that
    appended files are seen."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Number of rows of a table (counted from the file footers); at least 1, so
    that it can be a divisor."""
    return max(1, read_table(spark, sf_dir, name).count())


def _pick(values: list[str], idx) -> F.Column:
    """The value at ``idx``, from 0; NULL where there is none, as for the remainder of a negative number."""
    return F.get(F.array(*[F.lit(v) for v in values]), idx.cast("int"))


def message_base(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Every message column except the document ones (text, language, source),
    with ``doc_id``, the document whose text the message carries: event_id
    modulo the number of documents, so every event has one and every document
    is used. The product is the part with key event_id modulo the number of
    parts. Narrow rows: the joins here never move text.

    Customer and part grow with the data: each is broadcast while its size
    statistics, and part's rows in memory, stay within the bound; beyond that it is a shuffle join of narrow
    rows, where batch queries split a hot user by AQE skew-join handling. A
    stream keeps the static side in its own shuffle; its hot users are not
    split. nation has 25 rows.
    """
    ev = (events if events is not None else read_table(spark, sf_dir, "events")) \
        .select("event_id", "ts", "user_id", "event_type", "value")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = broadcast_if_small(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    n_parts, n_docs = row_count(spark, sf_dir, "part"), row_count(spark, sf_dir, "documents")
    parts = broadcast_if_small(read_table(spark, sf_dir, "part").select("p_partkey", "p_type"), rows=n_parts)
    city_of = broadcast_if_small(
        cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
        .select(F.col("c_custkey"), F.col("n_name")))
    j = ev.join(city_of, ev.user_id == city_of.c_custkey, "left") \
        .join(parts, (ev.event_id % F.lit(n_parts)) == parts.p_partkey, "left")
    return j.select(
        F.col("event_id"),
        (F.col("event_id") % F.lit(n_docs)).alias("doc_id"),
        F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("id"),
        _pick(PLATFORMS, F.col("event_id") % 4).alias("platform"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("author"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("user_id") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("n_name")).alias("city"),
        F.col("p_type").alias("product"),
        F.col("event_type").alias("channel"),
        _pick(DEVICES, F.col("user_id") % 5).alias("device"),
        F.col("value"))


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The ``events`` table as a streaming source (file source over the
    table's Parquet file or folder of part files)."""
    schema = read_table(spark, sf_dir, "events").schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{sf_dir}/event[s].parquet")


def document_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message columns that come from ``documents``, keyed by doc_id."""
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("lang").alias("language"), "source")


MESSAGE_COLUMNS = ["id", "text", "platform", "author", "timestamp", "city", "product", "channel",
                   "device", "language", "source"]


def messages(spark: SparkSession, sf_dir: str, with_value: bool = True) -> DataFrame:
    """Raw-message view over events + documents + customer/nation + part.

    The narrow event-side joins come first; the text-carrying documents join
    (doc_id, unique on the documents' side and evenly spread on the events')
    comes last so text is shuffled at most once. When a later filter requires
    text (F1), Catalyst turns this left join into an inner join."""
    base = message_base(spark, sf_dir)
    j = base.join(document_columns(spark, sf_dir), "doc_id", "left")
    return j.select(*MESSAGE_COLUMNS, *(["value"] if with_value else []))


def messages_sql(with_value: bool = True) -> str:
    """The same view as ANSI SQL (runs on Spark SQL and DuckDB alike)."""
    value = ",\n         e.value AS value" if with_value else ""
    return f"""
  SELECT concat('evt_', CAST(e.event_id AS VARCHAR)) AS id, d.doc_id AS doc_id,
         d.text AS text,
         CASE e.event_id % 4 {' '.join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PLATFORMS))} END AS platform,
         concat('user_', CAST(e.user_id AS VARCHAR)) AS author,
         e.ts AS timestamp,
         CASE WHEN e.user_id % 10 = 0 THEN NULL ELSE n.n_name END AS city,
         p.p_type AS product,
         e.event_type AS channel,
         CASE e.user_id % 5 {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(DEVICES))} END AS device,
         d.lang AS language,
         d.source AS source{value}
  FROM events e
  LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT greatest(1, count(*)) FROM documents)
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN part p ON p.p_partkey = e.event_id % (SELECT greatest(1, count(*)) FROM part)"""
