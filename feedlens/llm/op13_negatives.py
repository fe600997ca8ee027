"""Hard negatives by Kronecker-packed products.

All rows are compared with a stated set of anchors, block by block. In a block
the candidates' j-th components, biased so that none is negative, lie side by
side in separate fields of one wide integer, one such integer for each j. An
anchor is multiplied with the block by one product of a wide integer and a
component of its own for each j; the sum of the products holds the inner
product with every candidate in that candidate's field. A field is as wide as
the largest sum that the block can give, so nothing carries over and the
scores, once the bias is taken off again, are exact.

Two passes: the first finds each anchor's positives, the second, which knows
their scores, the negatives just below each of them. Blocks hand on their best
few rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import written

BLOCK = 1 << 19  # components of the candidates in a block, about
BLOCK_ROWS = 8_192
CHUNK = 1 << 16  # components of the anchors that meet a block at once, about
CHUNK_ROWS = 512
MOST = 2**63 - 1

POSITIVE = "akey long, anchor_id long, positive_id long, positive_score long"
NEGATIVE = "akey long, place int, anchor_id long, positive_id long, positive_score long, " \
           "negative_id long, negative_score long"


def matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column; shorter ones are continued with zeros."""
    col = col.combine_chunks()
    n = np.asarray(col.value_lengths())
    out = np.zeros((len(n), dims), np.int64)
    out[np.arange(dims) < n[:, None]] = col.flatten().to_numpy()
    return out


class Packed:
    """A block of candidates, one wide integer for each component."""

    def __init__(self, rows: np.ndarray, most: int):
        """``most``: no anchor's absolute components add up to more."""
        self.n = len(rows)
        self.low = int(rows.min(initial=0))
        span = int(rows.max(initial=0)) - self.low
        self.half = span * most  # a sum of products lies in -half .. half
        self.width = max(1, (max(span, 2 * self.half).bit_length() + 7) // 8)  # bytes of a field
        biased = rows.astype(np.uint64) - np.uint64(self.low % 2**64)
        self.words = [self._wide(np.ascontiguousarray(biased[:, j])) for j in range(rows.shape[1])]
        self.halves = self.half * self._wide(np.ones(self.n, np.uint64))

    def _wide(self, x: np.ndarray) -> int:
        field = np.zeros((self.n, max(8, self.width)), np.uint8)
        field[:, :8] = x.astype("<u8").view(np.uint8).reshape(-1, 8)
        return int.from_bytes(field[:, :self.width].tobytes(), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Inner products of the anchor with every candidate, held within a long."""
        total = self.halves
        for a, word in zip(anchor, self.words):
            total += a * word
        field = np.frombuffer(total.to_bytes(self.n * self.width, "little"), np.uint8).reshape(self.n, self.width)
        bias = self.low * sum(anchor) - self.half
        if self.width <= 7 and abs(bias) < 2**62:
            wide = np.zeros((self.n, 8), np.uint8)
            wide[:, :self.width] = field
            return wide.view("<i8").ravel() + bias
        exact = (int.from_bytes(f.tobytes(), "little") + bias for f in field)
        return np.fromiter((max(-MOST, min(MOST, x)) for x in exact), np.int64, self.n)


def _meet(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[int, dict, np.ndarray, np.ndarray, np.ndarray]]:
    """(place of the anchor, row of it, scores, ids, labels) for the anchors of a
    chunk; the candidates are in the order of their ids."""
    if not (rows.num_rows and anchors.num_rows):
        return
    rows = rows.sort_by("vec_id")
    lengths = [*np.asarray(rows["q"].combine_chunks().value_lengths()), *np.asarray(anchors["q"].combine_chunks().value_lengths())]
    dims = max(lengths)
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    own = [[int(x) for x in a] for a in matrix(anchors["q"], dims)]
    block = Packed(matrix(rows["q"], dims), max(sum(map(abs, a)) for a in own))
    for at, about in enumerate(anchors.drop_columns(["q"]).to_pylist()):
        yield at, about, block.scores(own[at]), ids, labels


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split() for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.table({n: pa.array([r[k] for r in rows], kinds[t]) for k, (n, t) in enumerate(names)})


def _best_positives(count: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for _, a, score, ids, labels in _meet(rows, anchors):
            same = np.flatnonzero((labels == a["label"]) & (ids != a["vec_id"]))
            for k in same[np.argsort(-score[same], kind="stable")[:count]]:
                out.append((a["akey"], a["vec_id"], int(ids[k]), int(score[k])))
        return _table(out, POSITIVE)
    return run


def _best_negatives(count: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for _, a, score, ids, labels in _meet(rows, anchors):
            other = np.flatnonzero(labels != a["label"])
            other = other[np.argsort(-score[other], kind="stable")]
            falling = -score[other]
            for p in a["positives"]:
                least = -(-low * p["score"] // high)  # the smallest score that will do
                first = int(np.searchsorted(falling, -p["score"], "left"))
                for k in other[first:first + count]:
                    if score[k] >= least:
                        out.append((a["akey"], p["place"], a["vec_id"], p["id"], p["score"], int(ids[k]), int(score[k])))
        return _table(out, NEGATIVE)
    return run


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, q): q holds floor(scale * x) of each component x. Rows with a
    null in vec_id, label or embedding, or with a null or non-finite component, are left out."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    x = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    return x.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.forall("embedding", finite)) \
        .select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * scale).cast("long")).alias("q"))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over
    ``rows(vec_id, label, q)`` with q an array of integers, as ``quantised`` makes it.

    A row's score is its inner product with the anchor. An anchor's positives are the
    first rows of its label by score, falling, then vec_id, rows with the anchor's own
    vec_id left out; for each of them come the first rows of other labels, in the same
    order, with low * positive <= high * negative <= high * positive.

    Vectors of different lengths count as continued with zeros. Scores beyond a long
    are held at its bounds. Rows that repeat a vec_id are rows of their own: each is a
    candidate, and an anchor that is there twice is mined twice. An anchor without
    positives, or a positive without negatives, has no row; an empty table gives none.
    """
    rows = rows.select("vec_id", "label", "q")
    anchors = written(rows.where(is_anchor).withColumn("akey", F.monotonically_increasing_id()), "anchors")
    total, dims = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    dims = max(1, dims or 1)
    cells = max(1, -(-total // max(1, min(BLOCK_ROWS, BLOCK // dims))))
    chunks = max(1, -(-anchors.count() // max(1, min(CHUNK_ROWS, CHUNK // dims))))
    dealt = rows.withColumn("cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells))) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")))

    def blocks(asked: DataFrame, fn, schema: str) -> DataFrame:
        asked = asked.withColumn("chunk", F.pmod(F.xxhash64("akey"), F.lit(chunks))) \
            .withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)).cast("array<bigint>")))
        return dealt.groupBy("cell", "chunk").cogroup(asked.groupBy("cell", "chunk")).applyInArrow(
            lambda r, a: fn(r.drop_columns(["cell", "chunk"]), a.drop_columns(["cell", "chunk"])), schema)

    def first(df: DataFrame, by: list[str], kind: str, count: int, place: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(F.desc(f"{kind}_score"), f"{kind}_id")
        return df.withColumn(place, F.row_number().over(w)).where(F.col(place) <= count)

    best = first(blocks(anchors, _best_positives(positives), POSITIVE), ["akey"], "positive", positives, "place")
    best = best.groupBy("akey").agg(F.collect_list(F.struct(
        "place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    asked = written(anchors.join(best, "akey"), "positives")
    out = first(blocks(asked, _best_negatives(negatives, low, high), NEGATIVE), ["akey", "place"], "negative", negatives, "rank")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
