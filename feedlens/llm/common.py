"""Steps shared by the operators: written intermediate tables and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.session import shared_path


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written as Parquet below spark.checkpoint.dir and read back, so
    that later steps neither recompute it nor depend on an executor's disk."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


BATCH_ROWS = 1_000  # rows of an Arrow batch that carries texts


def short_batches(spark: SparkSession) -> None:
    """Let at most BATCH_ROWS texts go to a Python worker at a time. The usual
    10,000 are tens of MB of text, which the JVM and the worker hold several
    times over. A smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session sets it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges(a, b)``: the smallest id that
    can be reached. Null ends and loops are ignored.

    Each round every vertex hooks onto its smallest neighbour, hooks are
    followed once more, and the edges between what is left are taken on, so
    the number of vertices at least halves; a vertex with very many edges is
    only ever aggregated (partially, before the shuffle) or on the side of a
    join that Spark may split. Nothing but row counts reaches the driver.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) \
        .where("a < b").distinct()
    e = written(e, "edges")
    label = None
    while not e.isEmpty():
        # every edge makes its larger end hook onto something smaller
        hook = e.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("up"))
        # follow the hooks of the hooks once
        nxt = hook.select(F.col("id").alias("up"), F.col("up").alias("up2"))
        hook = written(hook.join(nxt, "up", "left")
                       .select("id", F.coalesce("up2", "up").alias("up")), "hooks")
        ha = hook.select(F.col("id").alias("a"), F.col("up").alias("ha"))
        hb = hook.select(F.col("id").alias("b"), F.col("up").alias("hb"))
        moved = e.join(ha, "a", "left").join(hb, "b", "left") \
            .select(F.coalesce("ha", "a").alias("x"), F.coalesce("hb", "b").alias("y"))
        step = hook.select("id", F.col("up").alias("component"))
        if label is None:
            label = step
        else:
            by = hook.select(F.col("id").alias("component"), "up")
            label = label.join(by, "component", "left") \
                .select("id", F.coalesce("up", "component").alias("component")) \
                .unionByName(step.join(label, "id", "left_anti"))
        label = written(label, "labels")
        e = written(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                    .where("a < b").distinct(), "edges")
    if label is None:
        return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return label.unionByName(
        label.select(F.col("component").alias("id"), "component").distinct()
        .join(label, "id", "left_anti"))
