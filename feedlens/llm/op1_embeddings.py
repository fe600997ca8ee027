"""Embedding near-duplicates by random-hyperplane sign hashing.

Each table hashes a vector to the signs of its products with BITS random
hyperplanes; vectors of the same bucket are compared exactly, in double precision, and
a pair is counted in the first table in which it meets. The number of bits
follows the number of distinct vectors so that buckets stay small, and the number of
tables follows from the bits so that a pair at the threshold is met with
probability RECALL at least. Links are connected by common.components.

Equal vectors are one entry with a weight. A bucket of more than BUCKET
entries is cut into chunks, dealt as pairs of chunks, so no task holds more
than two; comparisons stay inside tasks, which return one count for each entry and a
spanning link for each entry that has any.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import components, width, written

RECALL = 0.998      # of a pair exactly at the threshold; closer pairs are met more surely
PER_BUCKET = 64     # distinct vectors that an average bucket would hold
BUCKET = 1024       # entries of a bucket that are compared in one piece
TASK_ROWS = 20_000  # bucket entries dealt to a task together


def tables_for(distinct: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for so many distinct vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = max(4, math.ceil(math.log2(max(1, distinct) / PER_BUCKET)) if distinct > PER_BUCKET else 4)
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree ** bits))


def _unit(col) -> np.ndarray:
    """Unit vectors in double precision, by rows."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither the squares nor the norm overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keys(bits: int, tables: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng(int(dim) + 7).standard_normal((int(dim), bits * tables))
                sign = (_unit(part.column(2)) @ planes[dim] > 0).reshape(-1, tables, bits)
                key = sign.astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(
                        pa.array(np.arange(len(key) + 1) * tables, pa.int32()), pa.array(key.reshape(-1)))],
                    names=["id", "keys"])
    return run


def _bucket(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        part = np.stack([t[c].to_numpy() for c in ("dim", "tab", "key", "i", "j")])
        ids, weight, chunk = t["id"].to_numpy(), t["weight"].to_numpy(), t["c"].to_numpy()
        keys = t["keys"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        order = np.lexsort((ids, *part[::-1]))
        part, ids, weight, keys, chunk = part[:, order], ids[order], weight[order], keys[order], chunk[order]
        emb = t["embedding"].combine_chunks().take(pa.array(order))
        cut = np.flatnonzero(np.any(part[:, 1:] != part[:, :-1], axis=0)) + 1
        out_id, out_n, a, b = [], [], [], []
        for lo, hi in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(ids)]])):
            if hi - lo < 2:
                continue
            tab, i, j = part[1, lo], part[3, lo], part[4, lo]
            x, k, c = _unit(emb.slice(lo, hi - lo)), keys[lo:hi], chunk[lo:hi]
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if i != j:  # what lies within a chunk is compared elsewhere
                near &= c[:, None] != c[None, :]
            p, q = np.nonzero(np.triu(near))
            if tab and len(p):  # pairs that meet in an earlier table are counted there
                new = ~np.any(k[p, :tab] == k[q, :tab], axis=1)
                p, q = p[new], q[new]
            if not len(p):
                continue
            n = np.bincount(p, weights=weight[lo:hi][q], minlength=hi - lo) \
                + np.bincount(q, weights=weight[lo:hi][p], minlength=hi - lo)
            some = np.flatnonzero(n)
            out_id.append(ids[lo:hi][some])
            out_n.append(n[some].astype(np.int64))
            # connect what is linked here: smallest label until nothing changes
            label = np.arange(hi - lo)
            while True:
                was = label.copy()
                low = np.minimum(label[p], label[q])
                np.minimum.at(label, p, low)
                np.minimum.at(label, q, low)
                label = label[label]
                if np.array_equal(was, label):
                    break
            a.append(ids[lo:hi][label[some]])
            b.append(ids[lo:hi][some])
        cat = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
        return pa.table({"id": cat(out_id), "n": cat(out_n), "a": cat(a), "b": cat(b)})
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept): how many other vectors each one
    is linked with (cosine >= threshold), the smallest vec_id reachable by
    links, and whether that is the vector itself.

    Needs ``vec_id`` (integer) and ``embedding`` (array of numbers); other
    columns are ignored. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; vectors of different lengths
    do not link. Rows without vec_id are left out. Rows alike in both columns are one vector;
    a vec_id with several vectors gives a row for each, with the links and the
    component of that vector. An empty table gives
    an empty result.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("embedding")) \
        .where("vec_id IS NOT NULL").distinct()
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = F.coalesce(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are the same component
    v = v.withColumn("usable", usable).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0))) \
        .withColumn("h", F.xxhash64("embedding"))
    v = written(v, "vectors")
    good = v.where("usable")
    # an entry is named by a number of its own: a vec_id may have several vectors
    entries = written(good.groupBy("h", "embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"))
                      .select(F.monotonically_increasing_id().alias("id"), "low", "weight", "embedding", "h",
                              F.size("embedding").cast("long").alias("dim")), "entries")
    bits, tables = tables_for(entries.count(), threshold)
    keyed = written(entries.select("id", "dim", "embedding").mapInArrow(_keys(bits, tables), "id long, keys array<long>")
                    .join(entries, "id").select("id", "weight", "dim", "embedding", "keys"), "keyed")
    post = keyed.select("id", "dim", F.posexplode("keys").alias("tab", "key"))
    sizes = post.groupBy("dim", "tab", "key").agg(F.count("*").alias("len")).where("len > 1")
    nb = F.ceil(F.col("len") / BUCKET).cast("int")
    rows = post.join(sizes, ["dim", "tab", "key"]).withColumn("nb", nb) \
        .withColumn("c", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))) \
        .select("id", "dim", "tab", "key", "c", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"))
    deal = max(1, (post.count() // TASK_ROWS)) + width(vectors.sparkSession)
    found = written(
        rows.join(keyed.select("id", "weight", "embedding", "keys"), "id")
        .groupBy(F.pmod(F.xxhash64("dim", "tab", "key", "i", "j"), F.lit(deal)).alias("task"))
        .applyInArrow(_bucket(threshold), "id long, n long, a long, b long"), "found")
    n = found.groupBy("id").agg(F.sum("n").alias("others"))
    comp = written(entries.select("id", "low").join(components(found.select("a", "b")), "id", "left")
                   .select("id", "low", F.coalesce("component", "id").alias("component")), "components")
    least = comp.groupBy("component").agg(F.min("low").alias("c"))
    about = entries.join(n, "id", "left").join(comp.select("id", "component").join(least, "component"), "id") \
        .select("h", F.col("embedding").alias("e"), (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("links"), "c")
    return v.join(about, v.usable & (v.h == about.h) & (v.embedding == about.e), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("c", "vec_id")).alias("kept"))
