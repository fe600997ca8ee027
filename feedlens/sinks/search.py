"""Full-text search of the stored history (F10): an inverted index beside its files.

The history is Parquet by date and micro-batch (S7). The index has three parts: for every
different text of a micro-batch the numbers of the rows where it stands, (key, date, file,
rows); for every text that the RECENT micro-batches before had not a number, (key, num);
and for every word the numbers of the texts that contain it, (word, num), sorted by word
within shards, where they pack well. So a text is split into words once, however often it
was sent on. All are kept up with each micro-batch from the files just written, and a
replayed micro-batch replaces them. A search reads the texts of its words alone, opens only files that can match, and
in them keeps the rows that the index names. Exact but for collisions of 128 bits.

Words are runs of letters and digits in lower case, as a standard text analyser makes
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.session import stored
from feedlens.sinks.tables import _exists, write_history

SHARDS = 16  # parts of the index that a word can be in
TOLD = 200_000  # blocks of 64 rows of a micro-batch of which every task is told where texts stand first
RECENT = 16  # micro-batches whose texts are not split again; older ones are not read
# numbers in order are kept as differences
PACKED = {"compression": "zstd", "parquet.writer.version": "v2", "parquet.enable.dictionary#num": "false"}
WORD = r"[^\p{L}\p{N}]+"


def words_of(text: str | Column) -> Column:
    """The distinct words of a text; of null none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.array_distinct(F.split(F.lower(F.coalesce(c, F.lit(""))), WORD)), lambda w: w != "")


def _shard(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(SHARDS)).cast("int")


def write_indexed_history(batch: DataFrame, path: str, batch_id: int, ts_col: str = "processing_timestamp") -> None:
    """For ``foreachBatch``: the micro-batch into the history at ``path``/messages, and its
    index into ``path``/texts, ``path``/numbers and ``path``/words."""
    spark = batch.sparkSession
    write_history(batch, f"{path}/messages", ts_col, batch_id)
    # each file's rows are numbered by the reader, so the index is made from what was written
    rows = spark.read.parquet(f"{path}/messages").where(F.col("batch_id") == batch_id).where("text IS NOT NULL") \
        .select("index_date", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), "text",
                F.unhex(F.md5("text")).alias("key"))

    def put(df: DataFrame, name: str, *parts: str) -> DataFrame:
        out = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        out.write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").options(**PACKED).partitionBy("batch_id", *parts).parquet(f"{path}/{name}")
        return spark.read.schema(out.schema).parquet(f"{path}/{name}").where(F.col("batch_id") == batch_id)
    # (key, index_date, file, rows): where a text stands
    texts = put(rows.groupBy("key", "index_date", "file").agg(F.sort_array(F.collect_list("row")).alias("rows")), "texts")
    # (key, num): the number of each text that the micro-batches just before had not, made of the place where it stands first
    files = F.broadcast(stored(texts.agg(F.array_sort(F.collect_set("file")).alias("files"))
                               .select(F.posexplode("files").alias("no", "file")), "files"))
    num = F.shiftleft(F.col("no").cast("long"), 32) + F.col("row")
    first = texts.groupBy("key").agg(F.min(F.struct("file", F.col("rows")[0].alias("row"))).alias("at")).select("key", "at.*")
    if _exists(spark, f"{path}/numbers"):
        known = spark.read.schema("key binary, batch_id long").parquet(f"{path}/numbers")
        first = first.join(known.where((F.col("batch_id") < batch_id) & (F.col("batch_id") >= batch_id - RECENT)).select("key"), "key", "left_anti")
    numbers = put(first.join(files, "file").select("key", num.alias("num")), "numbers")
    # a text is split into words where it stands first, which a bit for each row tells; if there are
    # too many blocks of rows to tell every task, all rows with a new text are split
    block, bit = F.shiftright("num", 6), F.expr("shiftleft(1L, cast(num % 64 AS int))")
    firsts = stored(numbers.groupBy(block.alias("block")).agg(F.bit_or(bit).alias("bits")), "firsts")
    rows = rows.join(files, "file").select(num.alias("num"), "text", "key")
    if firsts.count() <= TOLD:
        rows = rows.withColumn("block", block).join(F.broadcast(firsts), "block").where(F.col("bits").bitwiseAND(bit) != 0)
        words = rows.select("num", F.explode(words_of("text")).alias("word"))
    else:
        words = rows.select("key", F.explode(words_of("text")).alias("word")).distinct().join(numbers.select("key", "num"), "key").select("num", "word")
    # (word, num): the texts that hold a word
    put(words.repartition(_shard(F.col("word"))).withColumn("shard", _shard(F.col("word"))).sortWithinPartitions("shard", "word", "num"),
        "words", "shard")


def _terms(words: list[str]) -> list[str]:
    """Search words as the index has them."""
    import re
    return sorted({t for w in words for t in re.split(r"[\W_]+", w.lower()) if t})


def _found(spark: SparkSession, path: str, words: list[str], date_from=None, date_to=None) -> tuple[DataFrame, DataFrame]:
    """(key, word) of the texts with any of the words, and (key, index_date, file, rows) of
    all texts of the dates."""
    terms = _terms(words)
    w = spark.read.parquet(f"{path}/words")
    # the shards are computed from the words, so only theirs are listed and read
    shards = [r[0] for r in spark.range(1).select(F.explode(F.array(*[_shard(F.lit(t)) for t in terms]))).distinct().collect()]
    w = w.where(F.col("shard").isin(shards) & F.col("word").isin(terms)).select("batch_id", "num", "word") \
        .join(spark.read.parquet(f"{path}/numbers"), ["batch_id", "num"]).select("key", "word").distinct()
    t = spark.read.parquet(f"{path}/texts")
    if date_from is not None:
        t = t.where(F.col("index_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        t = t.where(F.col("index_date") <= F.lit(date_to).cast("date"))
    return w, t.select("key", "index_date", "file", "rows")


def postings(spark: SparkSession, path: str, words: list[str], date_from=None, date_to=None) -> DataFrame:
    """(word, index_date, file, rows) of the given words."""
    w, t = _found(spark, path, words, date_from, date_to)
    return w.join(t, "key").groupBy("word", "index_date", "file") \
        .agg(F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows"))


def search(spark: SparkSession, path: str, words: list[str], date_from=None, date_to=None, equals: dict | None = None,
           every: bool = True) -> DataFrame:
    """The messages that contain every one of ``words`` (or any, with ``every=False``), by
    date range and field equality.

    The names of the files that can match go through the driver, as the listing of any
    scan does; rows and postings do not. Words without a letter or digit are ignored; no
    word at all is an error."""
    terms = _terms(words)
    if not terms:
        raise ValueError("a search needs a word")
    w, t = _found(spark, path, words, date_from, date_to)
    least = len(terms) if every else 1
    keys = w.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    found = t.join(keys, "key", "left_semi")
    files = [r[0] for r in found.select("file").distinct().collect()]
    history = spark.read.parquet(f"{path}/messages")
    if not files:
        return history.where(F.lit(False))
    hits = found.select("file", F.explode("rows").alias("row"))
    out = spark.read.schema(history.schema).option("basePath", f"{path}/messages").parquet(*files) \
        .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    for k, v in (equals or {}).items():
        out = out.where(F.col(k) == F.lit(v))
    h = hits.alias("h")
    return out.join(h, (F.col("_file") == F.col("h.file")) & (F.col("_row") == F.col("h.row")), "left_semi").drop("_file", "_row")
