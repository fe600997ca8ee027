"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, so a question asked again
with other values has the same template. Names in a row are one name, and so are
numbers spelled in several words. Template windows of the documents
are hash-joined with those of the benchmark; matches on one alignment
(document position minus item position) belong together, and an alignment
counts if the values in its slots are consistent: the same value of the item
always stands where the same value of the document stands. Windows that are
mostly numbers and units have too little of a template; they are matched word
for word, and an alignment of them counts by itself.

Scale: the texts are scanned once. While the benchmark's windows are few
(MAX_KEYS, checked by a count), their hashes go to the tasks and windows that
match none of them are not emitted; beyond that every window is emitted and
the same join finds the matches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import textbytes as tb
from feedlens.llm.common import short_batches, written

WINDOW = 8             # template words of a window; a shorter item is one window
MAX_KEYS = 2_000_000   # benchmark windows whose hashes go to the tasks (16 MB)
COVERED = 0.3          # share of an item's windows that one alignment must match

# fixed values: written numbers and units that become placeholders
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
                "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
                "hundred thousand million billion dozen half").split()
UNIT_WORDS = ("mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
              "kilometers mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l liter "
              "liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks "
              "month months year years dollar dollars cent cents euro euros percent degrees kmh mph").split()

_U = np.uint64
_NUM, _NAME, _UNIT = (_U(0x4E554D), _U(0x4E414D45), _U(0x554E4954))
_NUMERIC = np.zeros(256, bool)
_NUMERIC[[*b"0123456789.,:/%+-"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".!?:;\"'()[]"]] = True


def _hashes(words: list[str]) -> np.ndarray:
    buf = np.frombuffer(" ".join(words).encode(), np.uint8)
    s, e, _ = tb.spans(buf, np.array([0, len(buf)]))
    return np.sort(tb.hash_spans(buf, s, e))


_NUMBER_HASH, _UNIT_HASH = _hashes(NUMBER_WORDS), _hashes(UNIT_WORDS)


def template(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """(template hash, word hash, is a slot, is a name, document, goes on a run) of each word.

    Words lose the punctuation around them; what has none left is no word. A
    number is made of digits and number punctuation or is a written one; a
    unit follows a number; a name begins with A-Z inside a sentence. Names one
    after another, and written numbers behind a number, are runs if no
    punctuation parts them.
    """
    s, e, doc = tb.spans(buf, off)
    raw_last = buf[e - 1] if len(e) else np.zeros(0, np.uint8)
    begin = np.ones(len(s), bool)
    begin[1:] = (doc[1:] != doc[:-1]) | _STOP[raw_last[:-1]]
    if len(s) > 1:  # a line break ends a sentence
        lines = np.concatenate([[0], np.cumsum(buf == 10)])
        begin[1:] |= lines[s[1:]] != lines[s[:-1]]
    raw_s, raw_e = s.copy(), e.copy()
    ok = tb.trim(buf, s, e)
    apart = np.ones(len(s), bool)
    apart[1:] = ~ok[:-1] | (raw_e != e)[:-1] | (raw_s != s)[1:] | begin[1:]
    s, e, doc, begin, apart = s[ok], e[ok], doc[ok], begin[ok], apart[ok]
    h = tb.hash_spans(buf, s, e)
    odd = np.concatenate([[0], np.cumsum(~_NUMERIC[buf])])
    spelled = tb.member(_NUMBER_HASH, h)
    number = ((odd[e] == odd[s]) & _DIGIT[buf[s]]) | spelled if len(s) else np.zeros(0, bool)
    unit = np.zeros(len(s), bool)
    unit[1:] = number[:-1] & (doc[1:] == doc[:-1])
    unit &= tb.member(_UNIT_HASH, h) & ~number
    upper = np.concatenate([[0], np.cumsum(_UPPER[buf])])
    name = _UPPER[buf[s]] & (upper[e] - upper[s] == 1) & ~begin & ~number & ~unit if len(s) else number
    t = np.where(number, _NUM, np.where(unit, _UNIT, np.where(name, _NAME, h)))
    on = np.zeros(len(s), bool)
    on[1:] = ~apart[1:] & (name[1:] & name[:-1] | spelled[1:] & number[:-1])
    return t, h, number | unit | name, name, doc, on


def collapse(t: np.ndarray, h: np.ndarray, slot: np.ndarray, doc: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, ...]:
    """(template hash, value hash, is a slot, document, first word) with each run as one slot."""
    at = np.flatnonzero(~on)
    if len(at) == len(on):
        return t, h, slot, doc, at
    nth = np.arange(len(on)) - np.repeat(at, np.diff(np.append(at, len(on))))
    value = np.add.reduceat(tb.mix(h + nth.astype(np.uint64)) * (_U(2) * nth.astype(np.uint64) + _U(1)), at)
    long = np.diff(np.append(at, len(on))) > 1
    return t[at], np.where(long, tb.mix(value), h[at]), slot[at], doc[at], at


def mix_word(t: np.ndarray, j: int) -> np.ndarray:
    """Share of word ``j`` in the hash of a window."""
    return tb.mix(t + _U(j + 1)) * _U((2 * j + 1) * 0x9E3779B97F4A7C15 % 2**64 | 1)


def windows(t: np.ndarray, slot: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows of ``n`` template words, at least half of them literal."""
    m = len(t) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    acc = np.zeros(m, np.uint64)
    for j in range(n):
        acc += mix_word(t[j:j + m], j)
    slots = np.concatenate([[0], np.cumsum(slot)])
    at = np.flatnonzero((doc[:m] == doc[n - 1:]) & (2 * (slots[n:] - slots[:m]) <= n))
    return at, tb.mix(acc[at] + _U(n))


def literal_windows(h: np.ndarray, slot: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the windows of ``n`` words, more than half of them slots, by their words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    slots = np.concatenate([[0], np.cumsum(slot)])
    at = np.flatnonzero((doc[:m] == doc[n - 1:]) & (2 * (slots[n:] - slots[:m]) > n))
    acc = np.zeros(len(at), np.uint64)
    for j in range(n):
        acc += mix_word(h[at + j], j)
    return at, tb.mix(acc + _U(n + _LITERAL))


LEAST = 2  # words; a single word may stand in any document
_LITERAL = 1 << 20  # keeps the hashes of literal windows apart
_SCHEMA = "id long, row long, key long, pos int, unit int, n int, vals array<long>, literal boolean"


def _emit(lengths: list[int] | None, keys: np.ndarray | None):
    """Windows of each text. ``lengths``: of the windows; None: WINDOW, or the
    whole of a shorter text. ``keys``: only windows with these hashes."""
    def run(batches):
        for batch in batches:
            buf, off = tb.buffers(batch.column(2))
            for d, e in tb.slices(off):
                t, h, slot, name, doc, on = template(buf[off[d]:off[e]], off[d:e + 1] - off[d])
                first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=e - d))])
                # positions are counted in words, and with runs as one
                unit = np.concatenate([[0], np.cumsum(~on)])
                variants = {0: collapse(t, h, slot, doc, on)}
                # texts with names also once with their names as words: a capital may be no name
                as_words = np.zeros(e - d, bool)
                as_words[doc[name]] = True
                again = np.flatnonzero(as_words[doc])  # the words of a text stay together
                if len(again):
                    *of_words, at = collapse(*(x[again] for x in (
                        np.where(name, h, t), h, slot & ~name, doc, on & ~name)))
                    variants[1] = *of_words, again[at]
                # words as they are, for windows that neither way has: mostly numbers and units
                variants[2] = t, h, slot & ~name, doc, np.arange(len(t))
                counts = {w: np.bincount(v[3], minlength=e - d) for w, v in variants.items()}
                for n, which in [(n, w) for n in lengths or range(1, WINDOW + 1) for w in variants]:
                    wt, wh, wslot, wdoc, word = variants[which]
                    if which == 2:
                        at, key = literal_windows(wh, wslot, wdoc, n)
                    else:
                        at, key = windows(wt, wslot, wdoc, n)
                    if n < LEAST or (lengths is None and n < WINDOW):
                        keep = counts[which][wdoc[at]] == n
                        at, key = at[keep], key[keep]
                    if keys is not None:
                        keep = tb.member(keys, key)
                        at, key = at[keep], key[keep]
                    if not len(at):
                        continue
                    grid = at[:, None] + np.arange(n)
                    hit, col = np.nonzero(wslot[grid] & (which < 2))
                    bounds = pa.array(np.searchsorted(hit, np.arange(len(at) + 1)), pa.int32())
                    of, at = wdoc[at], word[at]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(of + d)), batch.column(1).take(pa.array(of + d)),
                        pa.array(key.view(np.int64)), pa.array((at - first[of]).astype(np.int32)),
                        pa.array((unit[at + 1] - 1 - unit[first[of]]).astype(np.int32)), pa.array(np.full(len(at), n, np.int32)),
                        pa.ListArray.from_arrays(bounds, pa.array(wh[grid[hit, col]].view(np.int64))),
                        pa.array(np.full(len(at), which == 2))],
                        names=["id", "row", "key", "pos", "unit", "n", "vals", "literal"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, kind, n_windows, item_windows): the items that a
    document contains, with the best alignment's matched windows. ``kind`` is
    "exact" or, if values in the slots differ, "reparameterised".

    Needs ``doc_id``, ``text`` and ``item_id``, ``text``; other columns are
    ignored. Null, empty and blank texts contain nothing and are contained in
    nothing. Windows of more than half slots match word for word only, and are
    counted apart from the others. An item of one word is found only in
    texts that consist of nothing else.
    Repeated rows give one row; rows of a null id are reported under null.
    """
    short_batches(docs.sparkSession)
    row = F.xxhash64("text")
    d = docs.select(F.col("doc_id").cast("long").alias("id"), row.alias("row"), "text")
    b = benchmark.select(F.col("item_id").cast("long").alias("id"), row.alias("row"), "text").distinct()
    item = written(b.mapInArrow(_emit(None, None), _SCHEMA), "items")
    stats = item.agg(F.count("*").alias("c"), F.sort_array(F.collect_set("n")).alias("n")).first()
    keys = None
    if stats.c <= MAX_KEYS:
        keys = np.sort(np.array([r.key for r in item.select("key").distinct().toLocalIterator()],
                                np.int64).view(np.uint64))
    found = d.mapInArrow(_emit(stats.n or [WINDOW], keys), _SCHEMA)
    total = item.groupBy("id", "row", "literal").agg(
        F.countDistinct("pos").alias("by_words"), F.countDistinct("unit").alias("by_units"))
    i = item.join(total, ["id", "row", "literal"]).select(
        F.col("id").alias("item_id"), F.col("row").alias("item_row"), "key", "literal", F.col("pos").alias("ipos"),
        F.col("unit").alias("iunit"), F.col("vals").alias("ivals"), "by_words", "by_units")
    # an alignment has a fixed shift in words or, where runs differ in length, in units
    ways = F.array(*[F.struct(F.lit(w).alias("way"), F.col(i).alias("ipos"), (F.col(p) - F.col(i)).alias("shift"),
                              F.col(c).alias("item_windows"))
                     for w, p, i, c in ((0, "pos", "ipos", "by_words"), (1, "unit", "iunit", "by_units"))])
    m = written(found.drop("literal").join(i, "key").select(
        F.col("id").alias("doc_id"), "row", "item_id", "item_row", "literal", F.arrays_zip("ivals", "vals").alias("pair"),
        F.explode(ways).alias("w")).select("*", "w.*").drop("w"), "matches")
    by = ["doc_id", "row", "item_id", "item_row", "literal", "way", "shift"]
    cover = m.groupBy(*by, "item_windows").agg(F.countDistinct("ipos").alias("n_windows"))
    values = m.select(*by, F.explode("pair").alias("p")).groupBy(*by, F.col("p.ivals").alias("iv")) \
        .agg(F.min("p.vals").alias("lo"), F.max("p.vals").alias("hi")) \
        .groupBy(*by).agg(F.bool_and(F.col("lo") == F.col("hi")).alias("consistent"),
                          F.bool_and((F.col("lo") == F.col("iv")) & (F.col("hi") == F.col("iv"))).alias("same"))
    null_safe = [F.col(f"c.{k}").eqNullSafe(F.col(f"v.{k}")) for k in by]
    cond = null_safe[0]
    for x in null_safe[1:]:
        cond = cond & x
    return cover.alias("c").join(values.alias("v"), cond, "left") \
        .where((F.col("n_windows") >= COVERED * F.col("item_windows")) & F.coalesce("consistent", F.lit(True))) \
        .groupBy("c.doc_id", "c.item_id").agg(
            # template windows come first
            F.max(F.struct((~F.col("c.literal")).alias("t"), "n_windows", F.coalesce("same", F.lit(True)).alias("same"), "item_windows")).alias("x")) \
        .select("doc_id", "item_id", F.when(F.col("x.same"), "exact").otherwise("reparameterised").alias("kind"),
                F.col("x.n_windows").cast("long").alias("n_windows"), F.col("x.item_windows").cast("long").alias("item_windows"))
