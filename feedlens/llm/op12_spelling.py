"""Spelling variants: words one insertion, deletion or replacement apart, found by
a frontier of states that walks a trie held as a table of edges.

The trie is path-compressed: its nodes are the prefixes after which words go on
differently, and an edge carries all characters up to the next such prefix. It holds
every word twice, forwards and backwards. A state is (word, position, node, edits).
Level by level the states are joined with the edges of their nodes: an edge that the
word goes on with is followed; where another edge leaves the node, the one edit may
be made. (Two words at edit distance one can always be edited right where they part.)
A state that has used its edit follows exact edges only, and one that reaches the end
of a word with one edit has found a neighbour. An edge also holds, as bits of hashes,
what words go on with below it, so most states that later levels would drop are not made.

A word's states start at the first node past half of its length. That loses nothing:
of two words one edit apart, the common prefix or the common suffix is at least that
long, and the suffix is a prefix of the words written backwards. So no state ever
stands at the root, and few share a node.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import short_batches, written
from feedlens.llm.textbytes import mix

END = "\n"  # closes every word of the trie; no letter
MASKS = 4  # 64-bit numbers that say what is below an edge
HELD = 200_000  # words that a task counts before it hands the counts on
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)


def _counts(least: int, drop_every: int):
    run_of = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prefix = zlib.crc32(f"{doc_id}:".encode())
                # bytes.lower() is lower case for A-Z alone
                for word, n in Counter(run_of.findall(text.encode().lower().decode())).items():
                    if drop_every:
                        h = zlib.crc32(word.encode(), prefix)
                        if h % drop_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least:
                                continue
                    held[word] += n
                if len(held) >= HELD:
                    yield _pairs(held)
                    held.clear()
        yield _pairs(held)
    return run


def _pairs(held: Counter) -> pa.RecordBatch:
    return pa.record_batch({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})


def word_counts(docs: DataFrame, least: int = 7, at_least: int = 2, drop_every: int = 0) -> DataFrame:
    """(word, n): the words of ``least`` code points or more, A-Z as a-z, that occur
    ``at_least`` times in the texts of ``docs(doc_id, text)``. A word is a maximal run of
    A-Z, a-z and U+00C0 to U+00FF. With ``drop_every`` a word of a document loses the code
    point h % length where h = crc32 of "<doc_id>:<word>" is divisible by it. Null texts
    have no words; a null doc_id is written as the empty text."""
    short_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").where("text IS NOT NULL") \
        .mapInArrow(_counts(least, drop_every), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)


def _prefixes(floor: int):
    """(way, pos, node, ch) for every prefix of ``floor`` code points or more: the
    prefix as a 64-bit number, and what follows it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1).to_pylist()
            for back in (0, 1):
                text = "".join([(w[::-1] if back else w) + END for w in words])
                code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
                length = np.array([len(w) + 1 for w in words], np.int64)
                start = np.cumsum(length) - length
                c = np.zeros(len(code) + 1, np.uint64)
                np.cumsum((mix(code + np.uint64(1)) | np.uint64(1)) * _powers(_STEP, len(code)), out=c[1:])
                inv = _powers(_BACK, len(code))
                many = np.maximum(length - floor, 0)
                of = np.repeat(np.arange(len(words)), many)
                pos = floor + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                at = start[of] + pos
                h = (c[at] - c[start[of]]) * inv[start[of]]
                node = mix(h + (2 * pos + back).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                way = batch.column(0).to_numpy()[of] * 2 + back
                yield pa.record_batch({"way": way, "pos": pos.astype(np.int32), "node": node.view(np.int64),
                                       "ch": code[at].astype(np.int32)})
    return run


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(max(n, 1), np.uint64(base))
    p[0] = 1
    return np.multiply.accumulate(p)[:n]


def _rest_bit(text, pos, name: str) -> list:
    """What ``text`` has after its first ``pos`` characters, as one of 256 bits: which of
    four numbers, and the bit in it."""
    h = F.xxhash64(F.substring(text, pos + F.lit(1), F.char_length(text)))
    return [F.pmod(F.shiftrightunsigned(h, 32), F.lit(MASKS)).cast("int").alias(f"{name}_of"),
            F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int")).alias(f"{name}_bit")]


def _code(text, pos):
    """The code point after the first ``pos`` characters; of none 0."""
    return F.ascii(F.substring(text, pos + F.lit(1), F.lit(1)))


def trie(words: DataFrame, floor: int) -> tuple[DataFrame, DataFrame]:
    """(edges, starts) of ``words(wid, word, n)``. edges: level, node, child, label, its
    length m and first two code points ch and ch2, below (bits of what is below the child),
    and at the end of a word (child is null) leaf and leaf_n; the level of a node is the number of nodes above it. starts: the
    states without edits, with the level of their node."""
    prefixes = words.select("wid", "word").mapInArrow(_prefixes(floor), "way long, pos int, node long, ch int")
    nodes = prefixes.groupBy("node").agg(F.min("ch").alias("low"), F.max("ch").alias("high")).where("low < high")
    path = prefixes.drop("ch").join(nodes.select("node"), "node").groupBy("way") \
        .agg(F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("path"))
    back = F.col("way") % 2 == 1
    paths = written(path.withColumn("wid", F.floor(F.col("way") / 2)).join(words, "wid").select(
        "wid", "word", "n", F.concat(F.when(back, F.reverse("word")).otherwise(F.col("word")), F.lit(END)).alias("text"),
        "path"), "paths")

    def edge(x, i):
        nxt = F.get("path", i + 1)
        return F.struct(i.alias("level"), x.node.alias("node"), nxt.node.alias("child"), F.substring(
            F.col("text"), x.pos + 1, F.coalesce(nxt.pos, F.char_length("text")) - x.pos).alias("label"))
    every = paths.select("word", "n", F.inline(F.transform("path", edge)))
    every = every.withColumns({"m": F.char_length("label"), "ch": _code(F.col("label"), F.lit(0)), "ch2": _code(F.col("label"), F.lit(1))})
    parts = ["level", "node", "child", "label", "m", "ch", "ch2"]
    leaf = every.where("child IS NULL").select(*parts, F.lit(None).cast("array<long>").alias("below"),
                                               F.col("word").alias("leaf"), F.col("n").alias("leaf_n"))
    bits = paths.select(F.inline(F.transform("path", lambda x: F.struct(
        x.node.alias("child"), *_rest_bit(F.col("text"), x.pos, "rest"))))) \
        .groupBy("child").agg(F.array(*[F.bit_or(F.when(F.col("rest_of") == k, F.col("rest_bit")).otherwise(F.lit(0).cast("long")))
                                        for k in range(MASKS)]).alias("below"))
    inner = every.where("child IS NOT NULL").select(*parts).distinct().join(bits, "child") \
        .withColumns({"leaf": F.lit(None).cast("string"), "leaf_n": F.lit(None).cast("long")}).select(leaf.columns)
    first = F.get(F.filter(F.transform("path", lambda x, i: F.struct(i.alias("level"), x.pos.alias("pos"), x.node.alias("node"))),
                           lambda x: x.pos >= F.floor(F.char_length("word") / 2)), F.lit(0))
    starts = paths.withColumn("s", first).where("s IS NOT NULL").select(
        "wid", "text", F.col("s.level").alias("level"), F.col("s.pos").alias("pos"), F.col("s.node").alias("node"),
        F.lit(0).alias("edits"))
    return written(inner.unionByName(leaf), "edges", "level"), written(starts, "starts", "level")


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States after the edges of their nodes: (wid, text, pos, node, edits, leaf, leaf_n)."""
    at = F.col("pos")
    s = states.withColumns({"c": _code(F.col("text"), at), "c2": _code(F.col("text"), at + 1), "fresh": F.col("edits") == 0}) \
        .select("*", *_rest_bit(F.col("text"), at, "here"), *_rest_bit(F.col("text"), at + 1, "next")).alias("s")
    e = edges.drop("level").alias("e")
    text, label, pos, m, fresh = F.col("s.text"), F.col("e.label"), F.col("s.pos"), F.col("e.m"), F.col("s.fresh")
    ch, ch2, c, c2, end = F.col("e.ch"), F.col("e.ch2"), F.col("s.c"), F.col("s.c2"), ord(END)
    rest = lambda k, n: F.substring(text, pos + F.lit(1 + k), n)  # noqa: E731  n code points from k on
    tail = F.substring(label, F.lit(2), m - 1)

    def below(name):  # for an edge of one character, whose other end is compared by its bits alone
        return F.element_at(F.col("e.below"), F.col(f"s.{name}_of") + 1).bitwiseAND(F.col(f"s.{name}_bit")) != 0

    def leads(by):  # something below the child goes on as the word does after by more characters
        of, bit = _rest_bit(text, pos + by, "x")
        return F.col("e.child").isNull() | (F.element_at(F.col("e.below"), of + 1).bitwiseAND(bit) != 0)
    edit = fresh & (ch != c)
    own, mine = ch != end, c != end  # the edge's first character, and the word's, may be edited
    ways = [(((ch == c) & (label == rest(0, m)) & (fresh | leads(m))), m, 0),
            (edit & own & mine & F.when(m == 1, below("next")).otherwise((ch2 == c2) & (tail == rest(1, m - 1)) & leads(m)), m, 1),
            (edit & own & F.when(m == 1, below("here")).otherwise((ch2 == c) & (tail == rest(0, m - 1)) & leads(m - 1)), m - 1, 1),
            (edit & mine & (ch == c2) & (label == rest(1, m)) & leads(m + 1), m + 1, 1)]
    any_way = ways[0][0] | ways[1][0] | ways[2][0] | ways[3][0]
    found = F.filter(F.array(*[F.struct(ok.alias("ok"), (pos + by).alias("pos"), (F.col("s.edits") + more).alias("edits"))
                               for ok, by, more in ways]), lambda x: x.ok)
    out = s.join(e, (F.col("s.node") == F.col("e.node")) & any_way).select(
        "s.wid", "s.text", F.col("e.child").alias("node"), "e.leaf", "e.leaf_n", F.inline(found))
    return out.drop("ok").where("leaf IS NULL OR edits = 1").select("wid", "text", "pos", "node", "edits", "leaf", "leaf_n")


def neighbours(words: DataFrame, floor: int) -> DataFrame:
    """(wid, leaf, leaf_n): for each of ``words(wid, word, n)`` the words that differ from
    it by exactly one code point inserted, deleted or replaced. ``floor``: no word is
    shorter than twice that. Prefixes are told apart by 64-bit numbers; two with the same
    number only make states that the last comparison drops."""
    spark = words.sparkSession
    edges, starts = trie(words, floor)
    last = edges.agg(F.max("level")).first()[0]
    pairs, live = None, None
    for level in range(0 if last is None else last + 1):
        states = starts.where(F.col("level") == level).drop("level")
        if live is not None:
            states = states.unionByName(live)
        after = written(_step(states, edges.where(F.col("level") == level)), f"level-{level}")
        ends = after.where("leaf IS NOT NULL")
        pairs = ends if pairs is None else pairs.unionByName(ends)
        live = after.where("leaf IS NULL").drop("leaf", "leaf_n")
    if pairs is None:
        return spark.createDataFrame([], "wid long, leaf string, leaf_n long")
    return pairs.select("wid", "leaf", "leaf_n").distinct().join(words.select("wid", "word"), "wid") \
        .where(F.levenshtein("word", "leaf") == 1).drop("word")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms(word, form) followed to the last one. n grows tenfold from a
    word to its form, so there are no circles and the steps double."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        nxt = written(now.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if nxt.where("moved").isEmpty():
            return nxt.drop("moved")
        now = nxt.drop("moved")


def spelling_groups(words: DataFrame, ratio: int = 10, floor: int = 3) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words(word, n)``, each word once.

    Two words are near if they differ by exactly one code point inserted, deleted or
    replaced. form: the near word of largest n (ties: the smallest in code-point order)
    if its n is ``ratio`` times the word's or more, else null; root: where following
    forms ends, the word itself if it has none; n_near: its near words. ``floor``: no word
    is shorter than 2 * floor code points. An empty table gives an empty result.
    """
    words = written(words.select("word", "n").withColumn("wid", F.monotonically_increasing_id()), "words")
    near = neighbours(words, floor).groupBy("wid").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("leaf_n")).alias("less"), "leaf")).alias("best"))
    about = words.join(near, "wid", "left").withColumn(
        "formed", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
    about = written(about.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("formed"), F.col("best.leaf")).alias("form"),
        F.when(F.col("formed"), -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(about.where("form IS NOT NULL"))
    return about.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
