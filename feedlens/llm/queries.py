"""Registered queries of the operators: ``QUERIES`` name -> fn(spark, sf_dir),
``ORACLES`` name -> DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlens.llm import op10_toxicity as toxicity
from feedlens.llm import op8_revisits as revisits
from feedlens.llm import oracles
from feedlens.llm.common import table
from feedlens.llm.op1_embeddings import near_vectors
from feedlens.llm.op2_jaccard import jaccard_classes
from feedlens.llm.op3_decontam import contaminated
from feedlens.llm.op4_pii import digest, find_pii
from feedlens.llm.op5_lines import drop_recurring
from feedlens.llm.op6_ppm import language_scores
from feedlens.llm.op7_tokenfile import read_token_files, write_token_files
from feedlens.llm.op9_packing import cut_pieces, pack
from feedlens.llm.op11_suffix import remove_repeats
from feedlens.llm.op12_spelling import spelling_groups, word_counts
from feedlens.llm.op13_negatives import hard_negatives, quantised


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file; the default of every query here."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embeddings(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_jaccard(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"), words=3, num=9, den=10)


def op3_decontam(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_pii(spark, sf_dir):
    return digest(find_pii(table(spark, sf_dir, "documents")))


def op5_lines(spark, sf_dir):
    return drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"), all_templates=True)


def op6_ppm(spark, sf_dir):
    return language_scores(table(spark, sf_dir, "documents"))


def op7_tokenfile(spark, sf_dir):
    folder, manifest = write_token_files(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, folder, manifest)


def op8_revisits(spark, sf_dir):
    records = revisits.captures(table(spark, sf_dir, "pages"))
    return revisits.digest(revisits.resolve(records), records)


def op9_packing(spark, sf_dir):
    return pack(cut_pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0, size=2048), size=2048)


def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.fit(docs, table(spark, sf_dir, "labels")).score(docs).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


def op11_suffix(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), length=200, digest=True)


def op12_spelling(spark, sf_dir):
    words = word_counts(table(spark, sf_dir, "documents"), least=7, at_least=2, drop_every=31)
    return spelling_groups(words, ratio=10, floor=3)


def op13_negatives(spark, sf_dir):
    rows = quantised(table(spark, sf_dir, "embeddings"), scale=256).withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


QUERIES = {
    "op1_embeddings": op1_embeddings,
    "op2_jaccard": op2_jaccard,
    "op3_decontam": op3_decontam,
    "op4_pii": op4_pii,
    "op5_lines": op5_lines,
    "op6_ppm": op6_ppm,
    "op7_tokenfile": op7_tokenfile,
    "op8_revisits": op8_revisits,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_suffix": op11_suffix,
    "op12_spelling": op12_spelling,
    "op13_negatives": op13_negatives,
}

ORACLES = {
    "op2_jaccard": oracles.OP2,
    "op5_lines": oracles.OP5,
    "op8_revisits": oracles.OP8,
    "op11_suffix": oracles.OP11,
    "op13_negatives": oracles.OP13,
}
