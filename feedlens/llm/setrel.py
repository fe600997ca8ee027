"""Numpy side of the n-gram Jaccard join: position-block index keys and the
exact, incremental comparison of a family of similar sets.

Sets are ascending arrays of 64-bit shingle hashes; the hash value is the
global order. A position block is one of ``m`` equal ranges of that order.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

from feedlens.llm.textbytes import mix

_U = np.uint64


@lru_cache(maxsize=16)
def size_classes(num: int, den: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper set size of each class; the partners of a set (sizes
    within num/den of its own) lie in its own class or a neighbouring one."""
    lo, hi = [], []
    x = 1
    while x <= upto:
        u = max(x, x * den * den // (num * num))
        lo.append(x)
        hi.append(u)
        x = u + 1
    return np.array(lo, np.int64), np.array(hi, np.int64)


def _blocks_for(diff: np.ndarray) -> np.ndarray:
    """Number of position blocks so that sets differing in ``diff`` elements
    agree on a whole block, with some more because blocks may be empty."""
    return diff + 1 + (diff + 9) // 10


def block_keys(tok: np.ndarray, bounds: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of each set, as (keys, bounds).

    Two sets with 100*num/den percent similarity differ in at most ``diff``
    elements, which touch at most ``diff`` of the ``m > diff`` position
    blocks; so they agree on a whole block, and a list per (class, block,
    content of the block) holds them both. Everything else is skipped with
    its block. Pairs within a class and pairs across two neighbouring classes
    use keys of their own, each with the ``m`` for its sizes. A set with no
    more than ``diff`` non-empty blocks also lists its empty ones.
    """
    n = np.diff(bounds)
    d_count = len(n)
    if not len(tok):
        return np.zeros(0, np.uint64), np.zeros(d_count + 1, np.int64)
    lo, hi = size_classes(num, den, 1 << max(4, math.ceil(math.log2(int(n.max()) + 1)) + 1))
    cls = np.searchsorted(hi, n)  # first class whose upper size is >= n
    gap, both = den - num, den + num
    own = gap * 2 * hi // both
    reach = hi * den // num
    across = gap * (hi + reach) // both
    doc = np.repeat(np.arange(d_count), n)
    mixed = mix(tok)
    keys, docs = [], []
    some = n > 0
    prev = np.maximum(cls - 1, 0)
    for kind, of, take, diff in (
        (0, cls, some, own[cls]),
        (1, cls, some & (n * den // num > hi[cls]), across[cls]),
        (1, prev, some & (cls > 0) & (n <= reach[prev]), across[prev]),
    ):
        if not take.any():
            continue
        m = _blocks_for(diff)
        space = mix((of * 2 + kind).astype(np.uint64) + _U(0x51ED270B))
        use = take[doc]
        dd, tt = doc[use], mixed[use]
        block = ((tok[use] >> _U(32)) * m[dd].astype(np.uint64)) >> _U(32)
        new = np.ones(len(dd), bool)
        new[1:] = (dd[1:] != dd[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(new)
        content = np.add.reduceat(tt, at)
        bd = dd[at]
        keys.append(mix(mix(content + block[at] * _U(0x9E3779B97F4A7C15)) + space[bd]))
        docs.append(bd)
        full = np.bincount(bd, minlength=d_count)
        for i in np.flatnonzero(take & (full <= diff)):
            empty = np.setdiff1d(np.arange(m[i], dtype=np.uint64), block[at[bd == i]])
            keys.append(mix(mix(empty * _U(0x9E3779B97F4A7C15)) + space[i]))
            docs.append(np.full(len(empty), i))
    k, d = np.concatenate(keys), np.concatenate(docs)
    order = np.argsort(d, kind="stable")
    return k[order], np.searchsorted(d[order], np.arange(d_count + 1))


HELD = 64  # sets whose answers are kept for those that are to be derived from them


def links(tok: np.ndarray, bounds: np.ndarray, num: int, den: int, group: np.ndarray | None = None,
          read: list[int] | None = None) -> list[tuple[int, int]]:
    """Spanning links of the graph of sets with intersection*den >= num*union.

    A set's answers are its overlaps with all other sets. They are counted from the lists
    of its elements only where no similar set has been answered; the answers of a set
    that a set ``q`` has found are derived from q's: the lists of the elements that only q
    has are taken off, those of the elements that q lacks are added. Sets found are
    reached and asked next, so whole groups of copies cost little more than what they
    differ in. ``group``: sets already known to be connected; they are reached together.
    ``read``: gets the number of list entries read for each set.
    """
    n = np.diff(bounds)
    count = len(n)
    ids, flat = np.unique(tok, return_inverse=True)
    post = np.repeat(np.arange(count), n)[np.argsort(flat, kind="stable")]  # the sets of each element
    at = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=len(ids)))])
    mark = np.zeros(len(ids), bool)
    alive = n > 0
    out: list[tuple[int, int]] = []

    def elements(q: int) -> np.ndarray:
        return flat[bounds[q]:bounds[q + 1]]

    def without(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        mark[y] = True
        rest = x[~mark[x]]
        mark[y] = False
        return rest

    def counted(e: np.ndarray) -> tuple[np.ndarray, int]:
        """How many of the elements each set has."""
        size = at[e + 1] - at[e]
        first = np.cumsum(size) - size
        total = int(size.sum())
        where = np.repeat(at[e] - first, size) + np.arange(total)
        return np.bincount(post[where], minlength=count).astype(np.int32), total

    answers: dict[int, np.ndarray] = {}  # of the sets answered last

    def overlaps(q: int, near: int | None) -> np.ndarray:
        mine = elements(q)
        if near in answers:
            gained, lost = without(mine, elements(near)), without(elements(near), mine)
            if len(gained) + len(lost) < len(mine):
                (more, a), (less, b) = counted(gained), counted(lost)
                if read is not None:
                    read.append(a + b)
                return answers[near] + more - less
        common, total = counted(mine)
        if read is not None:
            read.append(total)
        return common

    for seed in range(count):
        if not alive[seed]:
            continue
        alive[seed] = False
        todo: list[tuple[int, int | None]] = [(seed, None)]
        while todo:
            q, near = todo.pop()
            if not alive.any():
                break
            common = overlaps(q, near)
            found = np.flatnonzero(alive & (common.astype(np.int64) * den >= num * (n + n[q] - common)))
            out.extend((q, i) for i in found.tolist())
            alive[found] = False
            if group is not None:
                kin = np.flatnonzero(alive & np.isin(group, group[np.append(found, q)]))
                alive[kin] = False
                found = np.concatenate([found, kin])
            if len(found):
                answers.pop(q, None)
                answers[q] = common
                if len(answers) > HELD:
                    del answers[next(iter(answers))]
                todo.extend((i, q) for i in found.tolist())
    return out
