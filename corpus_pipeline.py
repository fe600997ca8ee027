"""A training-data pipeline over ``documents``: toxic documents go, recurring
lines go, one document of each group of near copies stays, documents with
benchmark questions go, and what is left is packed into token sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the documents that it keeps, with the columns of ``docs``; the last
one returns packed pieces. Between two stages the documents are written as
Parquet below spark.checkpoint.dir and read again.

Rows without doc_id cannot be referred to: the stages that decide by pairs
(near copies, benchmark questions) let them pass, the others treat them like
any row. Null texts are empty texts. Rows alike in doc_id and text are one
document, of which near_duplicates keeps one row; unlike texts under one doc_id
are documents of their own there, and go together in decontamination.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import op10_toxicity as toxic
from feedlens.llm.common import table, written
from feedlens.llm.op2_jaccard import jaccard_classes
from feedlens.llm.op3_decontam import contaminated
from feedlens.llm.op5_lines import drop_recurring
from feedlens.llm.op9_packing import cut_pieces, pack
from feedlens.llm.queries import tokenizer


def _set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns of these names under free ones, and where they are."""
    moved = {}
    for name in names:
        if name in docs.columns:
            free = name
            while free in docs.columns or free in names:
                free = f"_{free}"
            docs, moved[name] = docs.withColumnRenamed(name, free), free
    return docs, moved


def _put_back(out: DataFrame, moved: dict[str, str], columns: list[str]) -> DataFrame:
    return out.select([F.col(moved.get(c, c)).alias(c) for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold."""
    model = toxic.fit(docs, table(spark, sf_dir, "labels"))
    rows, moved = _set_aside(docs, "score")
    return _put_back(model.score(rows).where(F.col("score") < toxic.TOXIC).drop("score"), moved, docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their recurring lines, short ones included, long ones
    from two texts on; n_chars follows the text. A document of which nothing but
    white space is left goes."""
    rows, moved = _set_aside(docs, "n_lines", "n_dropped")
    out = drop_recurring(rows, min_tokens=1, long_docs=2, all_templates=True).where(
        (F.col("n_dropped") == 0) | F.coalesce(F.col("text").rlike(r"[^\s]"), F.lit(True)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return _put_back(out.drop("n_lines", "n_dropped"), moved, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each class of
    documents linked by a similarity of 0.8 or more over five-word shingles."""
    rows, moved = _set_aside(docs, "one")
    # a document is named by the hash of its id and text: one id may have several texts
    rows = rows.withColumn("one", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", F.coalesce("text", F.lit("")))))
    classes = jaccard_classes(rows.select(F.col("one").alias("doc_id"), "text"), words=5, num=4, den=5)
    named = rows.select("doc_id", "one").where("one IS NOT NULL").groupBy("one").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("rows"))
    member = written(named.join(classes.select(F.col("doc_id").alias("one"), F.col("component_id").alias("class")).distinct(), "one"), "classes")
    first = member.groupBy("class").agg(F.min(F.struct("doc_id", "one")).alias("first"))
    gone = member.join(first, "class").where(F.col("one") != F.col("first.one")).select("one")
    repeated = member.where(F.col("rows") > 1).select("one")
    kept = rows.join(gone, "one", "left_anti")
    once = kept.join(repeated, "one", "left_semi").dropDuplicates(["one"])
    out = kept.join(repeated, "one", "left_anti").unionByName(once)
    return _put_back(out.drop("one"), moved, docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question, as it stands or with other values."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack(cut_pieces(docs, tokenizer("byte_bpe_50k.json"), end_id=0, size=2048), size=2048)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# toxicity scores and token ids are not for SQL; tests/llm has a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
