"""Language-model scores by prediction by partial matching over bytes.

The model is a byte-context trie of depth ORDER, held as counts of byte
strings of ORDER + 1 symbols (shorter contexts are their suffixes). A symbol's
probability is found in the longest known context: (2 count - 1) / (2 symbols);
an unknown symbol escapes to the next shorter one with the chance (distinct
symbols) / (2 symbols), where symbols of the longer context are excluded. Below the empty
context all symbols are alike. 0xFF, which UTF-8 never holds, stands for the
edge of a text and is coded at its end. A-Z count as a-z.

Nothing that grows with the corpus is broadcast or collected. Texts are dealt
to chunks of about CHUNK_BYTES; a chunk sends its distinct strings and words with
their counts to buckets (by the last two context bytes, or by hash), the
buckets add them up, work out the probabilities, and send each chunk the
values of just its own strings, in the order in which it sent them. Chunks meet
FAN at a time, so no bucket task holds more than FAN chunks' strings besides
the model's own. Only counts of byte pairs (65,536) are shared by all tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm import textbytes as tb
from feedlens.llm.common import written

ORDER = 5                  # bytes of the longest context
CHUNK_BYTES = 12 << 20     # text of a chunk
FAN = 64                   # chunks that meet in one task
EDGE = 0xFF
_U = np.uint64
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_DOC_BITS = 63 - 8 * (ORDER + 1)


def held_out(doc_id: str) -> Column:
    """Documents that are not learned from: crc32 of the id as text mod 5 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


def _strings(buf: np.ndarray, off: np.ndarray):
    """For runs of documents: (first document, strings, documents, counts): how
    often each document holds each string of ORDER + 1 symbols, by string."""
    for d, e in tb.slices(off):
        while True:  # documents are numbered in the low bits
            m = min(e, d + (1 << _DOC_BITS))
            o, b = off[d:m + 1] - off[d], _LOW[buf[off[d]:off[m]]]
            n = m - d
            # every document with ORDER edges before it and one behind
            x = np.full(len(b) + n * (ORDER + 1), EDGE, np.uint8)
            size = np.diff(o)
            first = o[:-1] + np.arange(n) * (ORDER + 1) + ORDER
            x[np.repeat(first - o[:-1], size) + np.arange(len(b))] = b
            g = np.zeros(len(x) - ORDER, np.int64)
            for j in range(ORDER + 1):
                g = (g << 8) | x[j:len(x) - ORDER + j]
            doc = np.repeat(np.arange(n), size + 1 + ORDER)[:len(g)]
            # the positions whose context begins in the next document are dropped
            inside = np.arange(len(g)) - np.repeat(o[:-1] + np.arange(n) * (ORDER + 1), size + 1 + ORDER)[:len(g)]
            g = ((g << _DOC_BITS) | doc)[inside <= np.repeat(size, size + 1 + ORDER)[:len(g)]]
            g.sort()
            at = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            yield d, g[at] >> _DOC_BITS, g[at] & ((1 << _DOC_BITS) - 1), np.diff(np.append(at, len(g)))
            if m == e:
                break
            d = m


def _words(buf: np.ndarray, off: np.ndarray):
    """For runs of documents: (first document, end, words, documents) of all words."""
    for d, e in tb.slices(off):
        o, b = off[d:e + 1] - off[d], buf[off[d]:off[e]]
        s, t, doc = tb.spans(b, o)
        yield d, e, tb.hash_spans(b, s, t), doc


def _add(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k = k[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[at], np.add.reduceat(c[order], at) if len(k) else c


def _bucket(kind: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    by = (keys >> 8) & 0xFFFF if kind == 0 else keys
    return (tb.mix(by.view(np.uint64) + _U(kind + 1)) % _U(buckets)).astype(np.int64)


def _chunk_keys(buf: np.ndarray, off: np.ndarray, train: np.ndarray, buckets: int):
    """(kind, keys, counts of training, bucket bounds) of a chunk, by bucket, then key."""
    for kind in (0, 1):
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if kind == 0:
            for d, g, doc, n in _strings(buf, off):
                at = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
                keys.append(g[at])
                counts.append(np.add.reduceat(n * train[doc + d], at))
        else:
            for d, _, h, doc in _words(buf, off):
                u, inv = np.unique(h.view(np.int64), return_inverse=True)
                keys.append(u)
                counts.append(np.bincount(inv, weights=train[doc + d], minlength=len(u)).astype(np.int64))
        k, c = _add(keys, counts)
        b = _bucket(kind, k, buckets)
        order = np.argsort(b, kind="stable")
        yield kind, k[order], c[order], np.searchsorted(b[order], np.arange(buckets + 1))


def _count(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        buf, off = tb.buffers(t["text"])
        train = t["train"].to_numpy().astype(np.int64)
        chunk = t["chunk"][0].as_py()
        rows = []
        for kind, k, c, cut in _chunk_keys(buf, off, train, buckets):
            rows += [(kind, b, k[x:y].tobytes(), c[x:y].tobytes()) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
        cols = list(zip(*rows))
        return pa.table({"kind": pa.array(cols[0], pa.int32()), "bucket": pa.array(cols[1], pa.int64()),
                         "chunk": pa.array([chunk] * len(rows), pa.int64()),
                         "keys": pa.array(cols[2], pa.binary()), "counts": pa.array(cols[3], pa.binary())})
    return run


PARTS = "kind int, bucket long, chunk long, keys binary, counts binary"


def _ints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64)


def _merge(t: pa.Table) -> pa.Table:
    """Parts of one bucket and FAN chunks as one; only what training holds."""
    k, c = _add([_ints(x) for x in t["keys"].to_pylist()], [_ints(x) for x in t["counts"].to_pylist()])
    k, c = k[c > 0], c[c > 0]
    return pa.table({"kind": t["kind"][:1], "bucket": t["bucket"][:1], "chunk": pa.array([t["chunk"][0].as_py() // FAN]),
                     "keys": pa.array([k.tobytes()], pa.binary()), "counts": pa.array([c.tobytes()], pa.binary())})


def _totals(batches):
    """Byte-pair counts (context byte, symbol) of the model's strings, and of the words their number and sum."""
    pairs = np.zeros(1 << 16, np.int64)
    words = np.zeros(2, np.int64)
    for batch in batches:
        for kind, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
            k, c = _ints(keys), _ints(counts)
            if kind == 0:
                np.add.at(pairs, k & 0xFFFF, c)
            else:
                words += (len(k), c.sum())
    at = np.flatnonzero(pairs)
    yield pa.RecordBatch.from_pydict({"what": pa.array([*at, 1 << 16, 1 << 17], pa.int64()),
                                      "n": pa.array([*pairs[at], *words], pa.int64())})


def log_probabilities(query: np.ndarray, keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last symbol of each string after the
    others. ``keys``, ``counts``: the training strings that share the queries' last two context
    bytes (at least); ``pairs``: counts by (context byte, symbol)."""
    table = {ORDER: (keys, counts)}
    for k in range(ORDER - 1, 1, -1):
        table[k] = _add([keys & ((1 << 8 * (k + 1)) - 1)], [counts])
    table[1] = (np.flatnonzero(pairs), pairs[pairs > 0])
    table[0] = _add([table[1][0] & 0xFF], [table[1][1]])

    def look(k: int, q: np.ndarray) -> np.ndarray:
        have, n = table[k]
        if not len(have):
            return np.zeros(len(q), np.int64)
        at = np.minimum(np.searchsorted(have, q), len(have) - 1)
        return np.where(have[at] == q, n[at], 0)

    # by context: symbols, distinct symbols, and the same of the symbols' counts one order below
    ctx = {}
    for k in range(ORDER, -1, -1):
        have, n = table[k]
        c = have >> 8 if k else np.zeros(len(have), np.int64)
        at = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else np.zeros(0, np.int64)
        if len(c):
            below = look(k - 1, have & ((1 << 8 * k) - 1)) if k else n
            ctx[k] = (c[at], np.add.reduceat(n, at), np.diff(np.append(at, len(c))), np.add.reduceat(below, at))
        else:
            ctx[k] = (c, c, c, c)
    out = np.zeros(len(query))
    todo = np.ones(len(query), bool)
    used = np.zeros((2, len(query)), np.int64)  # counts and number of the excluded symbols, at this order
    for k in range(ORDER, -1, -1):
        q = query & ((1 << 8 * (k + 1)) - 1)
        have, total, distinct, below = ctx[k]
        if not len(have):
            continue
        c = q >> 8 if k else np.zeros(len(q), np.int64)
        at = np.minimum(np.searchsorted(have, c), len(have) - 1)
        known = have[at] == c
        n, u = total[at] - used[0], distinct[at] - used[1]
        live = todo & known & (u > 0)
        s = look(k, q)
        hit = live & (s > 0)
        out[hit] += np.log10((2 * s[hit] - 1) / (2 * n)[hit])
        gone = live & (s == 0)
        out[gone] += np.log10(u[gone] / (2 * n)[gone])
        todo &= ~hit
        used[0] = np.where(known, below[at], 0)
        used[1] = np.where(known, distinct[at], 0)
    out[todo] -= np.log10(256 - used[1][todo])
    return out


def _reply(pairs: np.ndarray):
    """The values of each chunk's keys: log-probabilities of strings, counts of words."""
    def run(t: pa.Table) -> pa.Table:
        kind, bucket = t["kind"][0].as_py(), t["bucket"][0].as_py()
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        asked = []
        for chunk, k, c in zip(t["chunk"].to_pylist(), t["keys"].to_pylist(), t["counts"].to_pylist()):
            if chunk < 0:
                keys, counts = _ints(k), _ints(c)
            else:
                asked.append((chunk, _ints(k)))
        every = np.unique(np.concatenate([np.zeros(0, np.int64), *(k for _, k in asked)]))
        if kind == 0:
            value = log_probabilities(every, keys, counts, pairs)
        else:
            value = np.zeros(len(every), np.int64)
            value[np.searchsorted(every, np.intersect1d(keys, every))] = counts[np.isin(keys, every)]
        return pa.table({
            "kind": pa.array([kind] * len(asked), pa.int32()), "bucket": pa.array([bucket] * len(asked), pa.int64()),
            "chunk": pa.array([c for c, _ in asked], pa.int64()),
            "vals": pa.array([value[np.searchsorted(every, k)].tobytes() for _, k in asked], pa.binary())})
    return run


def _score(buckets: int):
    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        buf, off = tb.buffers(t["text"])
        got = {0: [], 1: []}
        for kind, bucket, vals in sorted(zip(r["kind"].to_pylist(), r["bucket"].to_pylist(), r["vals"].to_pylist())):
            got[kind].append(np.frombuffer(vals, np.float64 if kind == 0 else np.int64))
        n = t.num_rows
        score, base, words, known = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for kind, k, _, _ in _chunk_keys(buf, off, np.zeros(n, np.int64), buckets):
            v = np.concatenate([np.zeros(0), *got[kind]]) if kind == 0 else np.concatenate([np.zeros(0, np.int64), *got[kind]])
            order = np.argsort(k)
            k, v = k[order], v[order]
            if kind == 0:
                for d, g, doc, c in _strings(buf, off):
                    np.add.at(score, doc + d, c * v[np.searchsorted(k, g)])
            else:
                for d, e, h, doc in _words(buf, off):
                    c = v[np.searchsorted(k, h.view(np.int64))]
                    base[d:e] += np.bincount(doc, weights=np.log10(c + 0.5), minlength=e - d)
                    words[d:e] += np.bincount(doc, minlength=e - d)
                    known[d:e] += np.bincount(doc, weights=c > 0, minlength=e - d).astype(np.int64)
        return pa.table({"doc_id": t["doc_id"], "train": t["train"], "words": words, "known": known,
                         "base": base, "score": score})
    return run


def language_scores(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-half unigram model of words) and score (the byte model's
    log10 probability of the text, its end included).

    Needs ``doc_id`` and ``text``; other columns are ignored. A null text is the
    empty text, a null doc_id is learned from. Repeated rows count each time
    and are scored each. Without training rows every symbol is as likely as any
    other. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    chunks = max(1, math.ceil((size or 0) / CHUNK_BYTES))
    buckets = max(1, chunks // 2)
    rows = rows.withColumn("train", ~held_out("doc_id")) \
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    parts = written(rows.groupBy("chunk").applyInArrow(_count(buckets), PARTS), "parts")
    model, groups = parts, chunks
    while True:
        model = written(model.groupBy("kind", "bucket", F.floor(F.col("chunk") / FAN)).applyInArrow(_merge, PARTS), "model")
        groups = math.ceil(groups / FAN)
        if groups == 1:
            break
    pairs, words = np.zeros(1 << 16, np.int64), [0, 0]
    for r in model.select("kind", "keys", "counts").mapInArrow(_totals, "what long, n long") \
            .groupBy("what").agg(F.sum("n").alias("n")).collect():  # 65,538 rows at most
        if r.what < 1 << 16:
            pairs[r.what] = r.n
        else:
            words[r.what >> 17] = r.n
    trained = rows.where("train").count()
    distinct, total = words[0] + (trained > 0), words[1] + trained
    group = F.floor(F.col("chunk") / FAN)
    known = model.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit((chunks - 1) // FAN)))) \
        .withColumn("chunk", F.lit(-1).cast("long"))
    asked = parts.withColumn("g", group.cast("int"))
    replies = written(asked.unionByName(known).groupBy("kind", "bucket", "g")
                      .applyInArrow(_reply(pairs), "kind int, bucket long, chunk long, vals binary"), "replies")
    scored = rows.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        _score(buckets), "doc_id long, train boolean, words long, known long, base double, score double")
    norm = math.log10(total + 0.5 * (distinct + 1)) if total or distinct else math.log10(0.5)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + int(trained > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(trained + 0.5) - (F.col("words") + 1) * norm).alias("base_score"), "score")
