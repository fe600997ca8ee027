"""Landed platform payloads (S13): JSON files written by an external fetcher,
read with declared schemas (never inferred), batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlens.schemas import COMMENT_SCHEMA, POST_SCHEMA, TWEET_SCHEMA, USER_SCHEMA

SCHEMAS = {"tweet": TWEET_SCHEMA, "user": USER_SCHEMA, "post": POST_SCHEMA,
           "comment": COMMENT_SCHEMA}


def read_landed(spark: SparkSession, path: str, kind: str, stream: bool = False,
                max_files: int | None = None) -> DataFrame:
    """Read landed ``kind`` payloads (tweet, user, post, comment) from JSON lines."""
    schema = SCHEMAS[kind]
    if stream:
        r = spark.readStream.schema(schema)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        return r.json(path)
    return spark.read.schema(schema).json(path)
