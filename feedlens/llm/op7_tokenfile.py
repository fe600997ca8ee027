"""Token-id files: flat unsigned integers plus 64-bit document offsets.

Each partition of the documents, range-partitioned by doc_id, becomes
``part-N.ids`` (little-endian unsigned ids, 2 bytes when the vocabulary has at
most 65,536 entries and 4 otherwise) and ``part-N.idx`` (int64: documents n,
the n doc_ids, the n+1 offsets in ids within the part). A part's base, the
number of ids before it, is a prefix sum over the parts' totals and stands in
the manifest, so no part waits for another. Files are written under a name of
the attempt and moved into place, so a task that runs twice leaves one copy.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.llm.common import short_batches, width, written
from feedlens.llm.tokens import encoder, text_batches
from feedlens.session import shared_path

NO_ID = -(1 << 63)  # how a null doc_id is written in the index file


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _writer(folder: str, path: str, keeps_space: bool, end_id: int):
    def run(batches):
        fs, base = _open(folder)
        part = TaskContext.get().partitionId()
        enc = encoder(path, keeps_space)
        end = np.array([end_id], enc.dtype).tobytes()
        tmp = f"{base}/.attempt-{uuid.uuid4().hex}"
        ids, offsets, at = [], [0], 0
        with fs.open_output_stream(f"{tmp}.ids") as out:
            for batch in batches:
                doc = batch.column(0).fill_null(NO_ID).to_numpy()
                for first, texts in text_batches(batch.column(1)):
                    packed = enc.encode(texts)
                    ids.append(doc[first:first + len(texts)])
                    for p in packed:
                        at += len(p) // enc.dtype.itemsize + 1
                        offsets.append(at)
                    out.write(end.join([*packed, b""]))
        docs = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64)
        with fs.open_output_stream(f"{tmp}.idx") as out:
            out.write(np.concatenate([[len(docs)], docs, offsets]).astype("<i8").tobytes())
        for kind in ("ids", "idx"):
            fs.move(f"{tmp}.{kind}", f"{base}/part-{part:06d}.{kind}")
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "n_docs": pa.array([len(docs)], pa.int64()),
            "n_ids": pa.array([at], pa.int64()), "width": pa.array([enc.dtype.itemsize], pa.int32())})
    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, keeps_space: bool = False,
                      folder: str | None = None) -> tuple[str, DataFrame]:
    """Write the ids of every whole text, each with ``end_id`` behind it, in
    ascending doc_id order; return the folder and its manifest
    (part, n_docs, n_ids, width, base).

    Needs ``doc_id`` (integer) and ``text``; other columns are ignored. A null
    text is empty (only the end id is written), a null doc_id comes first,
    repeated doc_ids are ordered by a hash of the text. Without rows the parts are
    empty. The folder must be seen by the driver and all executors.
    """
    spark = docs.sparkSession
    short_batches(spark)
    folder = folder or shared_path(spark, f"tokens-{uuid.uuid4().hex}")
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    tie = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .repartitionByRange(width(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie)
    parts = written(rows.mapInArrow(_writer(folder, tokenizer, keeps_space, end_id),
                                    "part int, n_docs long, n_ids long, width int"), "parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return folder, parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_part(folder: str, part: int, width_: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, offsets, ids) of a part, memory-mapped where the folder is a
    mounted one and read whole otherwise."""
    fs, base = _open(folder)
    name, kind = f"{base}/part-{part:06d}", np.dtype(f"<u{width_}")
    if isinstance(fs, pafs.LocalFileSystem):
        index = np.memmap(f"{name}.idx", "<i8", "r")
        n = int(index[0])
        offsets = index[1 + n:]
        ids = np.memmap(f"{name}.ids", kind, "r") if offsets[-1] else np.zeros(0, kind)
    else:
        index = np.frombuffer(fs.open_input_file(f"{name}.idx").read(), "<i8")
        n = int(index[0])
        offsets = index[1 + n:]
        ids = np.frombuffer(fs.open_input_file(f"{name}.ids").read(), kind)
    return index[1:1 + n], offsets, ids


def _reader(folder: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                docs, offsets, ids = read_part(folder, row["part"], row["width"])
                for lo in range(0, len(docs), 10_000):
                    hi = min(lo + 10_000, len(docs))
                    crc = [zlib.crc32(ids[offsets[i]:offsets[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(docs[lo:hi], pa.int64(), mask=docs[lo:hi] == NO_ID),
                        "start": pa.array(offsets[lo:hi] + row["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(offsets[lo:hi + 1]), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())})
    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    return manifest.select("part", "width", "base").repartition(width(spark), "part") \
        .mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
