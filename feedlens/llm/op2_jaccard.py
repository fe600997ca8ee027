"""N-gram Jaccard join: classes of documents with similar shingle sets.

Method (set-relation skipping). The 64-bit shingle hashes are the global
order. Index lists are kept by position block of that order: a list holds the
sets that agree on all elements of one block (setrel.block_keys), and all
other blocks are skipped. Sets of one list whose parity sketches do not rule
a link out are tied into families; then the answers inside a family are
computed set by set, those of a set similar to an answered one being derived
from its answers (setrel.links). Equal sets are one entry throughout.

Scale: a shuffle row is a key and an id; sketches meet them when lists with
the same sets have become one. Of the texts that are read last, only those in
a family count. Long lists and large families are cut into
chunks of a bounded size: everything is compared with one leader first, and
only what differs from the leader is compared chunk by chunk, so a group of
copies costs linear work and no pair rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm import seentwice, setrel, textbytes
from feedlens.llm.common import components, short_batches, width, written
from feedlens.operators.joins import broadcast_if_small

LIST_ROWS = 4000          # longest list compared in one piece
FAMILY_TOKENS = 4_000_000  # largest family compared in one piece, in shingles
TASK_ROWS = 100_000       # list rows dealt to a task together
SEEN = 1_000_000          # digests that a task remembers; a set listed twice does no harm
SKETCH = 8                # 64-bit words of the parity sketch
LARGE = 128 * SKETCH      # sets with more elements have a sketch of their own size as well


def _sketch(tok: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Parity of the elements falling on each of 512 bits; two sets differ in
    at least as many elements as their sketches differ in bits."""
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    bit = (textbytes.mix(tok) & np.uint64(64 * SKETCH - 1)).astype(np.int64)
    odd = np.bincount(doc * 64 * SKETCH + bit, minlength=n * 64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, -1), axis=1).view(np.int64)


def _large_sketches(tok: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """Parity sketches with a bit or two for each element, of the sets that are too large
    for the short one to tell apart; empty for the others."""
    out = []
    for i in np.flatnonzero(np.diff(bounds) > LARGE):
        t = tok[bounds[i]:bounds[i + 1]]
        words = 1 << int(np.ceil(np.log2(len(t) / 64)))
        odd = np.bincount((textbytes.mix(t) & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
        out.append((i, np.packbits(odd.astype(np.uint8)).view(np.int64)))
    size = np.zeros(len(bounds), np.int32)
    size[[i + 1 for i, _ in out]] = [len(x) for _, x in out]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(size).astype(np.int32)),
                                    pa.array(np.concatenate([np.zeros(0, np.int64), *(x for _, x in out)])))


def _fold(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch that ``words`` words give, from a longer one (both powers of two)."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)


def _digests(tok: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit digests of each set."""
    some = np.diff(bounds) > 0
    digest = np.zeros((2, len(bounds) - 1), np.uint64)
    if len(tok):
        at = bounds[:-1][some]
        digest[0, some] = np.add.reduceat(textbytes.mix(tok), at)
        digest[1, some] = np.add.reduceat(textbytes.mix(tok ^ np.uint64(0xA5A5A5A5)), at)
    return digest


def _sets(words: int):
    def run(batches):
        for batch in batches:
            for d, e, tok, bounds in textbytes.shingle_sets(batch.column(1), words):
                digest = _digests(tok, bounds).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(d, e - d), pa.array(np.diff(bounds), pa.int64()),
                    pa.array(digest[0]), pa.array(digest[1]),
                    pa.ListArray.from_arrays(pa.array(np.arange(e - d + 1) * SKETCH, pa.int32()),
                                             pa.array(_sketch(tok, bounds).reshape(-1))),
                    _large_sketches(tok, bounds),
                ], names=["doc_id", "n", "h1", "h2", "sketch", "large"])
    return run


def _list_keys(words: int, num: int, den: int, repeated=None):
    """(key, h1): the list keys of each set, once per task for equal sets, without those
    that ``repeated`` (seentwice) knows to be in no other list; the slots of the keys
    where it is not given."""
    def run(batches):
        if repeated is None:
            yield from seentwice.slot_rows(b["key"].to_numpy().view(np.uint64) for b in listed(batches))
            return
        bits = repeated.value
        for b in listed(batches):
            yield b.filter(pa.array(seentwice.passes(bits, b["key"].to_numpy().view(np.uint64))))

    def listed(batches):
        seen: set[int] = set()
        for batch in batches:
            for d, e, tok, bounds in textbytes.shingle_sets(batch.column(1), words):
                digest, n = _digests(tok, bounds)[0], np.diff(bounds)
                fresh = np.zeros(e - d, bool)
                for i, x in enumerate(digest.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                if len(seen) > SEEN:
                    seen.clear()
                own = np.where(fresh, n, 0)
                keys, kb = setrel.block_keys(tok[np.repeat(fresh, n)], np.concatenate([[0], np.cumsum(own)]), num, den)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.repeat(digest, np.diff(kb)).view(np.int64))],
                    names=["key", "h1"])
    return run


def _tokens(words: int):
    def run(batches):
        for batch in batches:
            for d, e, tok, bounds in textbytes.shingle_sets(batch.column(3), words):
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(d, e - d) for c in range(3)),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tok.view(np.int64))),
                ], names=["doc_id", "family", "tokens", "toks"])
    return run


def _may_link(n1: Column, n2: Column, s1: Column, s2: Column, num: int, den: int) -> Column:
    diff = F.aggregate(F.zip_with(s1, s2, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    return diff * (num + den) <= (n1 + n2) * (den - num)


def _ties(num: int, den: int):
    """Spanning ties of each index list, by the sketches."""
    def run(t: pa.Table) -> pa.Table:
        part = np.stack([t["key"].to_numpy(), t["i"].to_numpy(), t["j"].to_numpy()])
        doc, n = t["doc"].to_numpy(), t["n"].to_numpy()
        sk = t["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH)
        large = t["large"].combine_chunks()
        first, last, words = large.offsets.to_numpy()[:-1], large.offsets.to_numpy()[1:], large.values.to_numpy().view(np.uint64)
        order = np.lexsort((doc, part[2], part[1], part[0]))
        part, doc, n, sk, first, last = part[:, order], doc[order], n[order], sk[order], first[order], last[order]
        cut = np.flatnonzero(np.any(part[:, 1:] != part[:, :-1], axis=0)) + 1
        a, b = [], []
        for lo, hi in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(doc)]])):
            left = np.arange(lo, hi)
            todo: list[int] = []
            size = last[lo:hi] - first[lo:hi]
            big, fine = size > 0, None
            if big.sum() > 1:  # brought to the shortest length among them
                least = int(size[big].min())
                fine = np.zeros((hi - lo, least), np.uint64)
                for x in np.flatnonzero(big):
                    fine[x] = _fold(words[first[lo + x]:last[lo + x]], least)
            while len(left) and (len(left) > 1 or todo):
                if not todo:
                    todo, left = [left[0]], left[1:]
                q = todo.pop()
                diff = np.bitwise_count(sk[left] ^ sk[q]).sum(axis=1, dtype=np.int64)
                ok = diff * (num + den) <= (n[left] + n[q]) * (den - num)
                if fine is not None and big[q - lo]:
                    at = np.flatnonzero(ok & big[left - lo])
                    diff = np.bitwise_count(fine[left[at] - lo] ^ fine[q - lo]).sum(axis=1, dtype=np.int64)
                    ok[at] = diff * (num + den) <= (n[left[at]] + n[q]) * (den - num)
                hit = left[ok]
                a.extend([doc[q]] * len(hit))
                b.extend(doc[hit])
                todo.extend(hit)
                left = left[~ok]
        e = np.unique(np.array([a, b], np.int64).reshape(2, -1), axis=1)
        return pa.table({"a": e[0], "b": e[1]})
    return run


def _answers(num: int, den: int):
    """Spanning links of each family (or pair of chunks of one), exactly. Where a group
    has a base row, the other rows hold what they have beyond it and what they miss of it."""
    def lists(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        col = col.combine_chunks()
        return col.offsets.to_numpy()[:-1], col.offsets.to_numpy()[1:], col.values.to_numpy().view(np.uint64)

    def run(t: pa.Table) -> pa.Table:
        part = np.stack([t["family"].to_numpy(), t["i"].to_numpy(), t["j"].to_numpy()])
        doc, known, base = t["doc_id"].to_numpy(), t["grp"].to_numpy(), t["base"].to_numpy()
        (first, last, values), (m_first, m_last, missing) = lists(t["toks"]), lists(t["miss"])
        order = np.lexsort((doc, ~base, part[2], part[1], part[0]))  # a base row comes first
        part, doc, known, base = part[:, order], doc[order], known[order], base[order]
        cut = np.flatnonzero(np.any(part[:, 1:] != part[:, :-1], axis=0)) + 1
        a, b = [], []
        for lo, hi in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(doc)]])):
            sets = [values[first[x]:last[x]] for x in order[lo:hi]]
            if base[lo]:
                whole, sets = sets[0], sets[1:]
                lo += 1
                for k, x in enumerate(order[lo:hi]):
                    stay = np.ones(len(whole), bool)
                    stay[np.searchsorted(whole, missing[m_first[x]:m_last[x]])] = False
                    sets[k] = np.sort(np.concatenate([whole[stay], sets[k]]))
            if hi - lo < 2:
                continue
            tok = np.concatenate(sets)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            for q, r in setrel.links(tok, bounds, num, den, known[lo:hi]):
                a.append(doc[lo + q])
                b.append(doc[lo + r])
        return pa.table({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})
    return run


def _chunk_pairs(rows: DataFrame, part: str, ident: str) -> DataFrame:
    """Rows of groups cut into chunks, dealt to pairs of chunks (i <= j): a
    chunk of rows that are not ``odd`` meets only chunks of odd ones. ``nb``
    is the number of chunks of the group, of which odd rows have a set of
    their own (numbers from nb on)."""
    c = F.pmod(F.xxhash64(ident), F.col("nb")).cast("int")
    all_chunks = F.sequence(F.lit(0), F.col("nb").cast("int") * 2 - 1)
    odd_chunks = F.sequence(F.col("nb").cast("int"), F.col("nb").cast("int") * 2 - 1)
    return rows.withColumn("c", F.when(F.col("odd"), c + F.col("nb").cast("int")).otherwise(c)) \
        .withColumn("other", F.explode(F.when(F.col("odd"), all_chunks).otherwise(odd_chunks))) \
        .withColumn("i", F.least("c", "other")).withColumn("j", F.greatest("c", "other")) \
        .drop("c", "other", "nb", "odd")


def jaccard_classes(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) of documents whose sets of
    ``words``-word shingles are linked when intersection * den >= num * union.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are
    ignored. Null and blank texts have no shingles and no links (component is
    the document itself). Rows without doc_id are left out; repeated doc_ids
    are one document with several texts and get one row per text. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    short_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    sets = written(docs.mapInArrow(
        _sets(words), "doc_id long, n long, h1 long, h2 long, sketch array<long>, large array<long>"), "sets")

    # equal sets are one entry
    member = sets.select("doc_id", "n", "h1", "h2")
    reps = member.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    reps = written(reps, "reps")

    # lists with two sets at least; lists with the same sets are one
    # most keys are in one list only and are left out before the shuffle; of the others there
    # is one shuffle: a window spills the rows of a long list, so no task has to hold one, and
    # copies within a task have listed their keys once. What tells a list from others is found
    # in the same shuffle, and lists with the same sets get the same key, so that they are one
    # before anything wider than a key and a digest is moved
    repeated = seentwice.repeated_slots(docs.mapInArrow(_list_keys(words, num, den), seentwice.SLOT_ROWS))
    by_key = Window.partitionBy("key")
    post = docs.mapInArrow(_list_keys(words, num, den, repeated), "key long, h1 long").repartition("key").distinct() \
        .select("h1", F.count("*").over(by_key).alias("len"), F.min("h1").over(by_key).alias("lead"),
                F.bit_xor(F.xxhash64("h1")).over(by_key).alias("x")).where("len > 1")
    rows = written(post.select(F.xxhash64("len", "lead", "x").alias("key"), "h1", "len",
                               F.when(F.col("len") > LIST_ROWS, F.col("lead")).alias("lead")).distinct(), "postings")

    # the sets that are in a list, with what tells whether a link may be
    used = broadcast_if_small(rows.select("h1").distinct())
    about = written(sets.where("n > 0").join(used, "h1", "left_semi").groupBy("n", "h1", "h2").agg(
        F.min("doc_id").alias("doc"), F.first("sketch").alias("sketch"), F.first("large").alias("large"))
        .select("doc", "n", "h1", "sketch", "large"), "entries")

    short = rows.where("lead IS NULL").join(about, "h1").withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    # long lists are few, so their leaders go to the rows and not the rows to their leaders
    long_rows = rows.where("lead IS NOT NULL")
    first = long_rows.select(F.col("lead").alias("h1")).distinct()
    lead = broadcast_if_small(written(about.join(broadcast_if_small(first), "h1", "left_semi").select(
        F.col("h1").alias("lead"), F.col("doc").alias("ld"), F.col("n").alias("ln"), F.col("sketch").alias("ls"),
        F.col("large").alias("ll")), "leads"))
    apart = (F.size("large") == F.size("ll")) & ~_may_link(F.col("n"), F.col("ln"), F.col("large"), F.col("ll"), num, den)
    marked = written(long_rows.join(about, "h1").join(lead, "lead").select(
        "key", "h1", "doc", "ld", (~_may_link(F.col("n"), F.col("ln"), F.col("sketch"), F.col("ls"), num, den) | apart).alias("odd"),
        F.ceil(F.col("len") * 2 / LIST_ROWS).alias("nb")), "marked")
    long_ties = marked.where(~F.col("odd")).select(F.col("ld").alias("a"), F.col("doc").alias("b"))
    mixed = marked.join(marked.where("odd").select("key").distinct(), "key", "left_semi").drop("doc", "ld")
    pieces = _chunk_pairs(mixed.join(about, "h1"), "key", "doc")
    cols = ["key", "i", "j", "doc", "n", "sketch", "large"]
    work = short.select(cols).unionByName(pieces.select(cols))
    deal = rows.count() // TASK_ROWS + width(spark)
    ties = work.groupBy(F.pmod(F.xxhash64("key", "i", "j"), F.lit(deal)).alias("task")) \
        .applyInArrow(_ties(num, den), "a long, b long")
    family = components(ties.unionByName(long_ties))

    # whole sets, of the families only: few texts, so they are picked where they are read as
    # long as the list of them is small, and by a join that moves all texts beyond that
    fam = written(about.groupBy(F.col("doc").alias("doc_id")).agg(F.sum("n").alias("n")).join(
        family.withColumnRenamed("id", "doc_id"), "doc_id").withColumnRenamed("component", "family"), "families")
    size = fam.groupBy("family").agg(F.sum("n").alias("tokens"))
    listed = written(fam.join(size, "family").select("doc_id", "family", "tokens"), "members")
    toks = written(docs.join(broadcast_if_small(listed), "doc_id")
                   .select("doc_id", "family", "tokens", "text")
                   .mapInArrow(_tokens(words), "doc_id long, family long, tokens long, toks array<long>"), "tokens")
    small = toks.where(F.col("tokens") <= FAMILY_TOKENS).withColumn("i", F.lit(0)).withColumn("j", F.lit(0)) \
        .withColumn("grp", F.col("doc_id"))
    large = toks.where(F.col("tokens") > FAMILY_TOKENS)
    # one leader for a family of FAMILY_TOKENS or more: few, unless the input is very large
    lead = broadcast_if_small(written(large.where("doc_id = family").select("family", F.col("toks").alias("lt")), "leaders"))
    star = large.join(lead, "family")
    common = F.size(F.array_intersect("toks", "lt"))
    star = star.withColumn("odd", common * den < num * (F.size("toks") + F.size("lt") - common)) \
        .withColumn("nb", F.ceil(F.col("tokens") * 2 / FAMILY_TOKENS)) \
        .withColumn("grp", F.when(F.col("odd"), F.col("doc_id")).otherwise(F.col("family")))
    star = written(star.select("doc_id", "family", "odd", "nb", "grp"), "star")
    star_links = star.where(~F.col("odd")).select(F.col("family").alias("a"), F.col("doc_id").alias("b"))
    mixed = star.join(star.where("odd").select("family").distinct(), "family", "left_semi")
    # members of a large family go to several chunk pairs; they are sent as their difference from
    # the leader, which each pair gets once
    near = large.select("doc_id", "family", "toks").join(broadcast_if_small(mixed), ["doc_id", "family"]).join(lead, "family") \
        .withColumns({"miss": F.array_except("lt", "toks"), "toks": F.array_except("toks", "lt")}).drop("lt")
    cols = ["family", "i", "j", "grp", "doc_id", "toks", "miss", "base"]
    none = F.array().cast("array<bigint>")
    pieces = _chunk_pairs(near, "family", "doc_id").withColumn("base", F.lit(False))
    pairs = _chunk_pairs(mixed, "family", "doc_id").select("family", "i", "j").distinct()
    leads = pairs.join(lead, "family").select("*", F.col("family").alias("grp"), F.col("family").alias("doc_id"),
                                              F.col("lt").alias("toks"), none.alias("miss"), F.lit(True).alias("base"))
    deal = (fam.agg(F.sum("n")).first()[0] or 0) // FAMILY_TOKENS * 4 + width(spark)
    links = small.withColumns({"miss": none, "base": F.lit(False)}).select(cols) \
        .unionByName(pieces.select(cols)).unionByName(leads.select(cols)) \
        .groupBy(F.pmod(F.xxhash64("family", "i", "j"), F.lit(deal)).alias("task")) \
        .applyInArrow(_answers(num, den), "a long, b long")
    linked = components(links.unionByName(star_links))

    label = reps.join(linked.withColumnRenamed("id", "rep"), "rep", "left") \
        .select("n", "h1", "h2", F.coalesce("component", "rep").alias("c"))
    return member.join(label, ["n", "h1", "h2"], "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"))
