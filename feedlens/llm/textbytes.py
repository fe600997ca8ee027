"""Vectorised word and shingle hashing over the UTF-8 bytes of Arrow text columns.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D (so no multi-byte
character is ever cut); A-Z count as a-z. Words and shingles are represented
by 64-bit hashes; two different ones share a hash with probability about
2**-64 per pair, which is the only way in which these helpers are inexact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # bytes hashed at a time; a longer single text is one slice

_U = np.uint64
_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2**64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        p = np.full(size, _U(base))
        p[0] = 1
        have = np.multiply.accumulate(p)
        if size == SLICE_BYTES + 1:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null is the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of about SLICE_BYTES together."""
    d, n = 0, len(off) - 1
    while d < n:
        e = max(d + 1, int(np.searchsorted(off, off[d] + SLICE_BYTES, "right")) - 1)
        yield d, min(e, n)
        d = min(e, n)


def spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each word."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    space = IS_SPACE[buf]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    before[off[:-1][off[:-1] < n]] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[off[1:][off[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, A-Z as a-z."""
    n = len(buf)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _powers(_BASE, n), out=c[1:])
    h = (c[ends] - c[starts]) * _powers(_INV, n)[starts] if n else np.zeros(0, np.uint64)
    return mix(h + (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


PUNCT = np.zeros(256, bool)
PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def trim(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Move the bounds of words inwards past ASCII punctuation, in place;
    returns which words have anything left."""
    live = np.arange(len(s))
    while len(live):
        live = live[(s[live] < e[live]) & PUNCT[buf[np.minimum(s[live], len(buf) - 1)]]]
        s[live] += 1
    live = np.arange(len(s))
    while len(live):
        live = live[(s[live] < e[live]) & PUNCT[buf[np.maximum(e[live] - 1, 0)]]]
        e[live] -= 1
    return s < e


def member(sorted_keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of ``h`` occur in ``sorted_keys``."""
    if not len(sorted_keys):
        return np.zeros(len(h), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, h), len(sorted_keys) - 1)] == h


def shingles(h: np.ndarray, doc: np.ndarray, k: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles with their documents. A document of
    fewer than k words (but one at least) has its whole sequence as one."""
    w = len(h)
    out, out_doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if w >= k:
        m = w - k + 1
        acc = np.zeros(m, np.uint64)
        for j in range(k):
            acc += mix(h[j:j + m] + _U(j + 1)) * _U((2 * j + 3) * 0x9E3779B97F4A7C15 % 2**64 | 1)
        ok = doc[:m] == doc[k - 1:]
        out, out_doc = mix(acc)[ok], doc[:m][ok]
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(counts)])
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        extra = np.zeros(len(few), np.uint64)
        for j in range(k - 1):
            has = counts[few] > j
            at = np.minimum(first[few] + j, w - 1)
            extra[has] += (mix(h[at] + _U(j + 1)) * _U((2 * j + 3) * 0x9E3779B97F4A7C15 % 2**64 | 1))[has]
        out = np.concatenate([out, mix(extra + counts[few].astype(np.uint64))])
        out_doc = np.concatenate([out_doc, few])
    return out, out_doc


def shingle_sets(col, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of documents: (first document, end, tokens, bounds): the
    distinct shingles of document first+i are tokens[bounds[i]:bounds[i+1]],
    ascending."""
    buf, off = buffers(col)
    for d, e in slices(off):
        o = off[d:e + 1] - off[d]
        b = buf[off[d]:off[e]]
        s, t, doc = spans(b, o)
        sh, sd = shingles(hash_spans(b, s, t), doc, k, e - d)
        order = np.lexsort((sh, sd))
        sh, sd = sh[order], sd[order]
        if len(sh):
            new = np.ones(len(sh), bool)
            new[1:] = (sh[1:] != sh[:-1]) | (sd[1:] != sd[:-1])
            sh, sd = sh[new], sd[new]
        yield d, e, sh, np.searchsorted(sd, np.arange(e - d + 1))
