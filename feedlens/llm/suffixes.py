"""Suffix arrays by induced sorting, in whole-array steps, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than the one after them. The
leftmost-smaller ones (S after L) are sorted first: their substrings by inducing, named,
and where names repeat the string of names is sorted by the same function again. From
their order one sweep upwards places the L suffixes and one downwards the S suffixes.

A sweep reads the array from one end and puts a suffix in front of each one that it
reads. It need not go place by place: as long as nothing that a stretch puts down lands
inside the stretch, the stretch can be taken at once. ``_sweep`` takes the longest such
stretch each time.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last (the sentinel) is."""
    n = len(s)
    step = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    where = np.where(step != 0, np.arange(n - 1), n - 1)
    nxt = np.minimum.accumulate(where[::-1])[::-1]  # the next place where the string changes
    out = np.ones(n, bool)
    out[:-1] = step[np.minimum(nxt, max(n - 2, 0))] > 0
    return out


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of equal values."""
    start = np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])
    return start, np.diff(np.append(start, len(sorted_values)))


def _sweep(sa: np.ndarray, s: np.ndarray, take: np.ndarray, head: np.ndarray) -> None:
    """Read ``sa`` from the front; for each suffix read put the one before it, if ``take``
    has it, at the next free place of its bucket. ``head``: those places, changed here."""
    n, at, wide = len(sa), 0, 1024
    while at < n:
        end = min(at + wide, n)
        before = sa[at:end] - 1
        source = np.flatnonzero((before >= 0) & take[before])
        if not len(source):
            at, wide = end, min(wide * 2, 1 << 18)
            continue
        before = before[source]
        ch = s[before]
        low = np.minimum.accumulate(head[ch])  # nothing so far lands lower than this
        source += at
        late = np.flatnonzero(source[1:] >= low[:-1])
        many = int(late[0]) + 1 if len(late) else len(source)
        stop = min(end, int(low[many - 1]))
        before, ch = before[:many], ch[:many]
        order = np.argsort(ch, kind="stable")
        ch = ch[order]
        start, length = _runs(ch)
        bucket = ch[start]
        sa[np.repeat(head[bucket] - start, length) + np.arange(many)] = before[order]
        head[bucket] += length
        wide = min(wide * 2, 1 << 18) if stop == end else max(256, 2 * (stop - at))
        at = stop


def _induce(s: np.ndarray, small: np.ndarray, ends: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The array that follows from the order of ``lms``, the leftmost-smaller suffixes."""
    n = len(s)
    sa = np.full(n, -1, np.int32)
    order = np.argsort(s[lms], kind="stable")
    ch = s[lms][order]
    start, length = _runs(ch)
    places = np.repeat(ends[ch[start]] - length - start, length) + np.arange(len(lms))
    sa[places] = lms[order]
    _sweep(sa, s, ~small, np.concatenate([[0], ends[:-1]]))
    sa[places[1:]] = -1  # all but the sentinel are put down again
    _sweep(sa[::-1], s, small, n - ends)
    return sa


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """A number for each suffix of ``ordered`` (sorted by their substrings up to the next
    leftmost-smaller one): equal substrings get equal numbers, later ones larger."""
    follow = np.empty(len(lms), np.int64)
    follow[:-1] = lms[1:]
    follow[-1] = lms[-1]
    length = (follow - lms + 1)[np.searchsorted(lms, ordered)]
    new = np.ones(len(ordered), bool)
    new[1:] = length[1:] != length[:-1]
    open_ = np.flatnonzero(~new)
    off = 0
    while len(open_):
        differ = s[ordered[open_] + off] != s[ordered[open_ - 1] + off]
        new[open_[differ]] = True
        off += 1
        open_ = open_[~differ & (length[open_] > off)]
    return np.cumsum(new) - 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``s`` in order. ``s``: whole numbers from 0, the last one
    0 and no other."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ends = np.cumsum(np.bincount(s))
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    rough = _induce(s, small, ends, lms)
    ordered = rough[is_lms[rough]]
    name = _names(s, lms, ordered)
    if name[-1] + 1 < len(lms):
        reduced = np.empty(len(lms), np.int32)
        reduced[np.searchsorted(lms, ordered)] = name
        ordered = lms[suffix_array(reduced)]
    return _induce(s, small, ends, ordered)


def _common(words: np.ndarray, a: np.ndarray, b: np.ndarray, have: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes of the suffixes ``a`` and ``b``, up to ``cap``, of which ``have`` is
    known. words[i]: the four symbols from i on."""
    have = np.minimum(have, cap)
    live = np.flatnonzero(have < cap)
    n = len(words)
    while len(live):
        x = words[np.minimum(a[live] + have[live], n - 1)] ^ words[np.minimum(b[live] + have[live], n - 1)]
        same = x == 0
        low = x & (~x + np.uint64(1))  # the lowest bit in which they differ
        more = np.where(low < 1 << 16, 0, np.where(low < 1 << 32, 1, np.where(low < 1 << 48, 2, 3)))
        have[live] += np.where(same, 4, more)
        live = live[same]
        live = live[have[live] < cap]
    return np.minimum(have, cap)


def permuted_prefixes(text: np.ndarray, sa: np.ndarray, at: np.ndarray, cap: int, every: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(common, before): for each place of ``at`` (ascending) how many symbols its suffix has
    in common with the one before it in the array, ``cap`` at most, and where that one is.

    In the order of the text a common prefix is at most one shorter than that of the place
    before. So every ``every``-th place is measured from nothing, and the others from what
    is left of the last of these. ``text``: uint16 symbols, 0 at the end."""
    phi = np.empty(len(sa), np.int64)
    phi[sa[0]] = len(sa) - 1  # the sentinel has nothing in common with any
    phi[sa[1:]] = sa[:-1]
    padded = np.concatenate([text.astype("<u2"), np.zeros(8, "<u2")])
    words = np.empty(len(text), np.uint64)
    for r in range(4):
        words[r::4] = padded[r:r + (len(text) - r + 3) // 4 * 4].view("<u8")
    base = np.zeros(len(at), np.int64)  # the last place measured from nothing, as an index of at
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1] + 1
    head = np.flatnonzero(first)
    since = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    base = np.arange(len(at)) - since % every
    full = cap + every
    sparse = np.flatnonzero(since % every == 0)
    measured = np.zeros(len(at), np.int64)
    measured[sparse] = _common(words, at[sparse], phi[at[sparse]], np.zeros(len(sparse), np.int64), full)
    have = np.maximum(measured[base] - (since % every), 0)
    return _common(words, at, phi[at], have, cap), phi[at]
