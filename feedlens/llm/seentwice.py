"""Which of very many 64-bit keys occur more than once, to within a fixed size.

A key falls on one of 2**FINE fine slots. Tasks send the fine slots of their keys (about two
bytes a key, by block of slots), tasks that each have some blocks find those hit more than
once, and what comes back is one bit for each of the SLOTS coarser slots: 32 MB, whatever the
input. A key on a fine slot hit once occurs once, so it need not be shuffled to find that out.
Keys that share their fine slot with another one, or their coarser slot with one hit twice,
pass for nothing: few at 60 million keys, a third and more at two thousand million, all of
them in the end. So this saves work, and whoever uses it must still count the keys that pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedlens.llm.common import width

BITS = 28
FINE = 32
SLOTS = 1 << BITS
BLOCK = 1 << 16  # slots of a block
STEP = (1 << 16) - 1  # a gap between fine slots that takes another two bytes
CHUNK = 1 << 21  # keys that a task holds before it sends their slots
SLOT_ROWS = "block int, offsets binary"


def slots_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITS)).astype(np.uint32)


def slot_rows(keys: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Fine slots of a task's keys, sorted, a row for each block that has any: the gaps
    between them, each as STEP so many times as it fits and what is left."""
    held, size = [], 0

    def flush():
        slots = np.sort(np.concatenate(held))
        block = slots // np.uint32(BLOCK << (FINE - BITS))
        start = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1])
        gap = np.diff(slots.astype(np.int64), prepend=0)
        gap[start] = slots[start] % np.uint32(BLOCK << (FINE - BITS))
        end = np.cumsum(gap // STEP + 1)
        offsets = np.full(end[-1], STEP, "<u2")
        offsets[end - 1] = gap % STEP
        cut = np.append(np.append(0, end)[start], end[-1])
        yield pa.record_batch({"block": pa.array(block[start].astype(np.int32)), "offsets": pa.Array.from_buffers(
            pa.binary(), len(start), [None, pa.py_buffer((cut * 2).astype(np.int32)), pa.py_buffer(offsets.tobytes())])})
    for k in keys:
        if len(k):
            held.append((k >> np.uint64(64 - FINE)).astype(np.uint32))
            size += len(k)
        if size >= CHUNK:
            yield from flush()
            held, size = [], 0
    if size:
        yield from flush()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The coarser slots of each block that hold a fine one hit twice; rows of a block
    follow each other."""
    def bits(block: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        slots = np.sort(np.concatenate(parts))
        hit = np.zeros(BLOCK, np.uint8)
        hit[slots[1:][slots[1:] == slots[:-1]] >> (FINE - BITS)] = 1
        return pa.record_batch({"block": pa.array([block], pa.int32()),
                                "offsets": pa.array([np.packbits(hit, bitorder="little").tobytes()], pa.binary())})
    last, parts = -1, []
    for batch in batches:
        for block, offsets in zip(batch["block"].to_pylist(), batch["offsets"]):
            if block != last and parts:
                yield bits(last, parts)
                parts = []
            gap = np.frombuffer(offsets.as_buffer(), "<u2")
            parts.append(np.cumsum(gap, dtype=np.int32)[gap != STEP])
            last = block
    if parts:
        yield bits(last, parts)


def repeated_slots(rows: DataFrame):
    """A broadcast bitmap of the slots with keys that occur more than once, from ``slot_rows`` of all tasks."""
    spark = rows.sparkSession
    folded = rows.repartition(width(spark), "block").sortWithinPartitions("block").mapInArrow(_fold, SLOT_ROWS)
    bits = np.zeros(SLOTS // 8, np.uint8)
    for r in folded.collect():  # at most SLOTS / BLOCK rows of BLOCK / 8 bytes, 32 MB in all
        bits[r.block * BLOCK // 8:(r.block + 1) * BLOCK // 8] = np.frombuffer(r.offsets, np.uint8)
    return spark.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys lie on a slot that is hit more than once."""
    slot = slots_of(keys)
    return (bits[slot >> np.uint32(3)] >> (slot & np.uint32(7)).astype(np.uint8)) & 1 == 1
