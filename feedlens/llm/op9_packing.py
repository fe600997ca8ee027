"""Best-fit packing of token sequences by hierarchical residual rounds.

Documents become pieces of at most ``size`` tokens; full pieces are sequences
of their own. The other pieces are dealt to partitions, which pack them best
fit, longest first. Bins that are nearly full are emitted; the underfull ones
go, as items with their pieces inside, to the next round, dealt anew to
partitions of about BINS. This ends when one partition has taken them all, or
when a round no longer lowers their number. So a task of any round holds a
bounded number of bins and nothing is ever left out.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import short_batches, written
from feedlens.llm.tokens import encoder, text_batches

PIECES = 20_000   # about as many pieces a partition of the first round gets
BINS = 32_000     # about as many underfull bins a partition of a later round gets
FULL = 0.995      # share from which a bin counts as nearly full


def _pieces(path: str, keeps_space: bool, end_id: int, size: int):
    def run(batches):
        enc = encoder(path, keeps_space)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            doc = batch.column(0)
            for first, texts in text_batches(batch.column(1)):
                at, rows = [], []
                for i, packed in enumerate(enc.encode(texts)):
                    ids = np.frombuffer(packed + end, enc.dtype).astype("<u4")
                    head = len(ids) % size or size
                    cuts = [0, *range(min(head, len(ids)), len(ids) + 1, size)]
                    for p, (s, e) in enumerate(zip(cuts, cuts[1:])):
                        at.append(first + i)
                        rows.append((p, s, e - s, zlib.crc32(ids[s:e].tobytes())))
                p, s, n, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [doc.take(pa.array(at, pa.int64())), pa.array(p, pa.int32()), pa.array(s, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, keeps_space: bool = True, size: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each whole text
    with ``end_id`` behind them; those of more than ``size`` ids are cut, with
    the first piece the shorter one. A null text is empty: one piece of one id."""
    short_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(tokenizer, keeps_space, end_id, size),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, longest first into the fullest bin with room."""
    order = np.argsort(-lengths, kind="stable")
    room: list[int] = []                      # free places that occur, ascending
    bins: dict[int, list[int]] = {}           # free places -> bins
    where = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    made = 0
    for i in order.tolist():
        n = int(lengths[i])
        at = bisect_left(room, n)
        if at == len(room):
            b, free = made, size
            made += 1
        else:
            free = room[at]
            b = bins[free].pop()
            if not bins[free]:
                del bins[free], room[at]
        where[i], offset[i] = b, size - free
        free -= n
        if free:
            if free not in bins:
                bins[free] = []
                insort(room, free)
            bins[free].append(b)
    return where, offset


def _round(size: int):
    def run(t: pa.Table) -> pa.Table:
        cols = {c: t[c].to_numpy() for c in ("part", "bin", "length", "offset", "fill")}
        items, first, inverse = np.unique(cols["bin"], return_index=True, return_inverse=True)
        where, offset = best_fit(cols["fill"][first], size)
        fill = np.bincount(where, weights=cols["fill"][first]).astype(np.int64)
        under = fill < FULL * size
        name = items[first_of(where)]  # a bin is named after one of its items
        b = where[inverse]
        return t.select(["doc_id", "piece", "start", "length", "ids_crc32", "part"]).append_column(
            "bin", pa.array(name[b])).append_column(
            "offset", pa.array(cols["offset"] + offset[inverse])).append_column(
            "fill", pa.array(fill[b])).append_column("open", pa.array(under[b]))
    return run


def first_of(where: np.ndarray) -> np.ndarray:
    """Index of one item of each bin, by bin number."""
    return np.unique(where, return_index=True)[1]


SCHEMA = ("doc_id long, piece int, start long, length long, ids_crc32 long, part long, bin long, "
          "offset long, fill long, open boolean")


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and
    offset: a place for every piece in sequences of at most ``size`` tokens,
    without gaps from 0 on. Repeated rows are pieces of their own. An empty
    table gives an empty result; lengths must lie between 1 and ``size``.
    """
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset"]
    # written once, so that the row numbers that name the bins stay as they are
    rows = written(pieces.withColumn("bin", F.monotonically_increasing_id()), "pieces")
    done = rows.where(F.col("length") >= size).withColumn("offset", F.lit(0).cast("long")).select(out)
    count = rows.where(F.col("length") < size).count()
    parts = max(1, math.ceil(count / PIECES))
    todo = rows.where(F.col("length") < size) \
        .withColumn("part", F.pmod(F.xxhash64("bin"), F.lit(parts)).cast("long")) \
        .withColumn("offset", F.lit(0).cast("long")).withColumn("fill", F.col("length"))
    before, turn = count, 0
    while True:
        packed = written(todo.groupBy("part").applyInArrow(_round(size), SCHEMA), "round")
        under = packed.where("open").select("bin").distinct().count() if parts > 1 else 0
        if parts == 1 or not 0 < under < before:
            return done.unionByName(packed.select(out)).withColumnRenamed("bin", "sequence_id")
        done = done.unionByName(packed.where("NOT open").select(out))
        before, turn = under, turn + 1
        parts = math.ceil(under / BINS)
        todo = packed.where("open").withColumn("part", F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(parts)).cast("long"))
