"""Removal of repeated byte strings by suffix arrays of shards.

Two places where the same ``length`` bytes start must meet in one array. Every string of
that length (a window) is therefore put under its minimiser: the one among its 64-byte
strings whose hash is smallest. Windows that follow each other and share their minimiser
make a segment; only segments whose minimiser occurs at least twice can hold anything
repeated, and they alone are sent on. Equal segments are one, with a weight. The different
segments of a minimiser go to one shard, where a suffix array is induced over the shard's
bytes and permuted common prefixes tell which windows have company; segments that are the
only one of their minimiser but have a weight repeat as a whole. What a segment has
repeated then goes back to every place where it stands.

A minimiser whose different segments are too many for one array (a common passage in ever
new surroundings) is split by the windows themselves: their 64-bit hashes are counted.

Segments are told apart by hashes (64 bits of the minimiser and 64 of the segment), texts
by 96 bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import short_batches, width, written
from feedlens.llm.suffixes import permuted_prefixes, suffix_array
from feedlens.llm.textbytes import buffers, mix
from feedlens.session import shared_path

GRAM = 64  # bytes of a minimiser
STRETCH = 1 << 20  # window starts handled at a time
SHARD = 1 << 20  # bytes of segments in one array, about
HOT = 1 << 20  # a minimiser with more bytes of different segments is split by windows
KNOWN = 1 << 20  # repeated minimisers up to which they are broadcast (8 bytes each)
ID = ["t1", "t2"]
SEGMENT = "m long, s long, t1 long, t2 long, pos long, len int, weight long"

_STEP = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_AT = np.uint64((1 << 28) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, np.uint64(base))
    p[0] = 1
    return np.multiply.accumulate(p)


_UP = _powers(_STEP, STRETCH + 4096)
_DOWN = _powers(pow(_STEP, -1, 2**64), STRETCH + 4096)


class Hashed:
    """Hashes of the substrings of a stretch of bytes."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        up, self.down = (_UP, _DOWN) if n < len(_UP) else (_powers(_STEP, n + 1), _powers(pow(_STEP, -1, 2**64), n + 1))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[:n], out=self.sums[1:])

    def every(self, k: int) -> np.ndarray:
        """Of all substrings of k bytes."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[:n])

    def some(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start]
                   + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _least(values: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every w neighbouring values."""
    n = len(values)
    rows = np.concatenate([values, np.full(-n % w, np.uint64(2**64 - 1))]).reshape(-1, w)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - w + 1], before[w - 1:n])


def segments(buf: np.ndarray, off: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(minimiser, segment hash, text, start in the text, bytes) of the segments of texts
    that lie one behind the other in ``buf``, stretch by stretch."""
    total = len(buf)
    for a in range(0, max(total - length + 1, 0), STRETCH):
        part = buf[a:a + STRETCH + length - 1]
        hashed = Hashed(part)
        grams = hashed.every(gram)
        # the place decides between equal hashes, and says which one it was
        tagged = (grams & ~_AT) | np.arange(len(grams), dtype=np.uint64)
        at = (_least(tagged, length - gram + 1) & _AT).astype(np.int64)
        start = np.arange(len(at))
        text = np.searchsorted(off, a + start, side="right") - 1
        inside = a + start + length <= off[text + 1]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
        new &= inside
        first = np.flatnonzero(new)
        if not len(first):
            continue
        many = np.add.reduceat(inside, first, dtype=np.int64)  # windows outside belong to none
        end = first + many - 1 + length
        yield grams[at[first]], hashed.some(first, end), text[first], a + first - off[text[first]], end - first


def _segments(length: int, gram: int, named: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = buffers(batch["text"])
            t1, t2, copies = (batch[c].to_numpy() for c in ("t1", "t2", "copies"))
            for m, s, text, pos, size in segments(buf, off, length, gram):
                out = {"m": m.view(np.int64), "weight": copies[text]}
                if named:
                    out = {"m": out["m"], "s": s.view(np.int64), "t1": t1[text], "t2": t2[text], "pos": pos,
                           "len": size.astype(np.int32), "weight": out["weight"]}
                yield pa.record_batch(out)
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        for text, wanted in zip(batch["text"], batch["wanted"].to_pylist()):
            raw = text.as_py().encode()
            for a in range(0, len(wanted), 4096):
                some = wanted[a:a + 4096]
                yield pa.record_batch({
                    "m": pa.array([w["m"] for w in some], pa.int64()), "s": pa.array([w["s"] for w in some], pa.int64()),
                    "weight": pa.array([w["weight"] for w in some], pa.int64()),
                    "bytes": pa.array([raw[w["pos"]:w["pos"] + w["len"]] for w in some], pa.binary())})


def _joined(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    col = col.combine_chunks().cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2] or b"", np.uint8)[off[0]:off[-1]], off - off[0]


def _stretches(flag: np.ndarray, of: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, end) of the bytes that the flagged windows cover; windows are in
    the order of their segments and places."""
    of, at = of[flag], at[flag]
    if not len(of):
        return of, at, at
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (at[1:] > at[:-1] + length)
    first = np.flatnonzero(new)
    return of[first], at[first], at[np.append(first[1:], len(of)) - 1] + length


def repeated_windows(buf: np.ndarray, off: np.ndarray, weight: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, end) of the bytes covered by windows that occur twice or more in
    the segments of a shard, or in one of weight two, by the shard's suffix array."""
    count, n = np.diff(off), len(off) - 1
    text = np.zeros(len(buf) + n + 1, np.uint16)  # 1 closes a segment, 0 the shard
    text[np.arange(len(buf)) + np.repeat(np.arange(n), count)] = buf.astype(np.uint16) + 2
    start = off[:-1] + np.arange(n)
    text[start + count] = 1
    many = np.maximum(count - length + 1, 0)
    of = np.repeat(np.arange(n), many)
    at = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    sa = suffix_array(text)
    common, before = permuted_prefixes(text, sa, start[of] + at, length)
    hit = common >= length
    flag = np.zeros(len(text), bool)
    flag[(start[of] + at)[hit]] = True
    flag[before[hit]] = True
    return _stretches(flag[start[of] + at] | (weight[of] > 1), of, at, length)


def _shard(length: int):
    def run(t: pa.Table) -> pa.Table:
        buf, off = _joined(t["bytes"])
        seg, start, end = repeated_windows(buf, off, t["weight"].to_numpy(), length)
        return pa.table({"m": t["m"].to_numpy()[seg], "s": t["s"].to_numpy()[seg],
                         "start": start.astype(np.int64), "end": end.astype(np.int64)})
    return run


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, s, weight = (batch[c].to_numpy() for c in ("m", "s", "weight"))
            for k, raw in enumerate(batch["bytes"]):
                buf = np.frombuffer(raw.as_py(), np.uint8)
                h = Hashed(buf).every(length)
                yield pa.record_batch({
                    "h": h.view(np.int64), "m": np.full(len(h), m[k]), "s": np.full(len(h), s[k]),
                    "start": np.arange(len(h), dtype=np.int64), "weight": np.full(len(h), weight[k])})
    return run


def distinct_texts(docs: DataFrame, length: int) -> DataFrame:
    """(t1, t2, copies, text) of the texts of ``length`` bytes or more, each once, stored
    in buckets of (t1, t2): joins by these do not move the texts again."""
    spark = docs.sparkSession
    name = f"texts_{uuid.uuid4().hex}"
    docs.where(F.octet_length("text") >= length).select(*_ids(), "text") \
        .groupBy(*ID).agg(F.count("*").alias("copies"), F.first("text").alias("text")) \
        .write.bucketBy(width(spark), *ID).option("path", shared_path(spark, name)) \
        .option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _ids() -> list:
    return [F.xxhash64("text").alias("t1"), F.crc32("text").alias("t2")]


def repeated_spans(texts: DataFrame, length: int = 200, gram: int = GRAM) -> DataFrame:
    """(t1, t2, start, end): bytes of ``texts(t1, t2, copies, text)``, counted from 0, that
    strings of ``length`` bytes cover which also start anywhere else. A text of several
    copies is elsewhere, too. Spans of a text may overlap and come in any order."""
    spark = texts.sparkSession
    short_batches(spark)
    source = texts.select(*ID, "copies", "text")
    twice = written(source.mapInArrow(_segments(length, gram, False), "m long, weight long")
                    .groupBy("m").agg(F.sum("weight").alias("w")).where("w > 1").select("m"), "minimisers")
    if twice.count() <= KNOWN:
        twice = F.broadcast(twice)
    placed = written(source.mapInArrow(_segments(length, gram, True), SEGMENT).join(twice, "m"), "segments")
    kinds = placed.groupBy("m", "s", "len").agg(F.sum("weight").alias("weight"), F.min(F.struct(*ID, "pos")).alias("one"))
    kinds = written(kinds.select("m", "s", "len", "weight", "one.*"), "kinds")
    groups = kinds.groupBy("m").agg(F.count("*").alias("kinds"), F.sum("len").alias("bytes"))
    groups = written(groups.where("kinds > 1"), "groups")
    alone = kinds.join(groups, "m", "left_anti").select("m", "s", F.lit(0).cast("long").alias("start"), F.col("len").cast("long").alias("end"))

    wanted = kinds.join(groups.select("m"), "m", "left_semi").groupBy(*ID) \
        .agg(F.collect_list(F.struct("m", "s", "pos", "len", "weight")).alias("wanted"))
    cut = written(texts.select(*ID, "text").join(wanted, ID).select("text", "wanted")
                  .mapInArrow(_cut, "m long, s long, weight long, bytes binary"), "cut")
    hot = groups.where(F.col("bytes") > HOT).select("m")
    total = groups.where(F.col("bytes") <= HOT).agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    found = cut.join(hot, "m", "left_anti").groupBy(F.pmod(F.xxhash64("m"), F.lit(shards)).alias("shard")) \
        .applyInArrow(_shard(length), "m long, s long, start long, end long")
    found = found.unionByName(alone)
    if not hot.isEmpty():
        each = written(cut.join(hot, "m", "left_semi").mapInArrow(
            _windows(length), "h long, m long, s long, start long, weight long"), "windows")
        again = each.groupBy("h").agg(F.sum("weight").alias("w")).where("w > 1").select("h")
        found = found.unionByName(each.join(again, "h").select("m", "s", "start", (F.col("start") + length).alias("end")))
    return placed.join(found, ["m", "s"]).select(
        *ID, (F.col("pos") + F.col("start")).alias("start"), (F.col("pos") + F.col("end")).alias("end"))


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, runs, kept = [], [], []
        for text, starts, ends in zip(batch["text"], batch["starts"], batch["ends"]):
            raw = text.as_py().encode()
            a, b = starts.values.to_numpy(), ends.values.to_numpy()
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order])
            new = np.ones(len(a), bool)
            new[1:] = a[1:] > b[:-1]  # what touches is one run
            first = np.flatnonzero(new)
            a, b = a[first], b[np.append(first[1:], len(b)) - 1]
            kept.append(b"".join(raw[x:y] for x, y in zip([0, *b], [*a, len(raw)])))
            removed.append(len(raw) - len(kept[-1]))
            runs.append(len(a))
        yield pa.record_batch([batch["t1"], batch["t2"], pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                               pa.array(kept, pa.binary())], names=[*ID, "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = 200, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of ``docs(doc_id, text)``: the UTF-8 bytes
    of each text without those covered by a string of ``length`` bytes that also starts
    anywhere else in the texts, the same one included; n_spans: the runs removed. With
    ``digest``, kept_sha256 (lowercase hex) instead of kept.

    A null text is the empty text. Every row is a document of its own: rows that repeat
    lose all bytes if they have ``length`` of them. A null doc_id stays null. Other columns
    are ignored; an empty table gives an empty result. ``length`` must be over GRAM.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = distinct_texts(docs, length)
    spans = repeated_spans(texts, length).groupBy(*ID).agg(
        F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    kept = texts.select(*ID, "text").join(spans, ID).mapInArrow(
        _keep, "t1 long, t2 long, n_removed long, n_spans long, kept binary")
    whole = F.col("text").cast("binary")
    if digest:
        kept, whole, name = kept.withColumn("kept", F.sha2("kept", 256)), F.sha2(whole, 256), "kept_sha256"
    else:
        name = "kept"
    rows = docs.select("doc_id", *_ids(), F.octet_length("text").cast("long").alias("n_bytes"), whole.alias("whole"))
    return rows.join(written(kept, "kept"), ID, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept", "whole").alias(name))
