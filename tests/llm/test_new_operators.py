"""Operators 11 to 13 against brute force and on awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlens.llm import op2_jaccard as op2
from feedlens.llm import op3_decontam as op3
from feedlens.llm import op11_suffix as op11
from feedlens.llm import op12_spelling as op12
from feedlens.llm import op13_negatives as op13
from feedlens.llm import queries, seentwice, setrel
from feedlens.llm.op1_embeddings import near_vectors
from feedlens.llm.suffixes import permuted_prefixes, suffix_array

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, kept string, m long, t1 long, word string, n_spans int"


def docs(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "k", 1, 2, "w", 3) for i, t in rows], DOCS).repartition(3)


# -- suffix arrays ---------------------------------------------------------

def test_suffix_array_and_permuted_prefixes_equal_sorting():
    rng = np.random.default_rng(7)
    for trial in range(400):
        n, k = int(rng.integers(1, 70)), int(rng.integers(1, 5))
        s = np.append(rng.integers(1, k + 1, n - 1), 0)
        if trial % 4 == 0 and n > 4:
            s = np.append(np.tile(s[:3] + 1, n // 3), 0)
        s = s.astype(np.uint16 if trial % 2 else np.int32)
        as_list = s.tolist()
        sa = suffix_array(s)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: as_list[i:])
        at = np.flatnonzero(rng.random(len(s) - 1) < 0.8)
        common, before = permuted_prefixes(s.astype(np.uint16), sa, at, 9, every=3)
        where = np.argsort(sa)
        for i, c, b in zip(at, common, before):
            j, same = int(sa[where[i] - 1]), 0
            while same < 9 and max(i, j) + same < len(s) and s[i + same] == s[j + same]:
                same += 1
            assert (c, b) == (same, j)


def brute11(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for (doc, _), r in zip(rows, raw):
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((doc, len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts_with_repeats(seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    common, other = say(60), say(45)
    out = [(i, say(rng.randrange(0, 80)) + (common if i % 3 == 0 else "") + say(rng.randrange(0, 30)) + (other if i % 5 == 0 else ""))
           for i in range(60)]
    near = say(120)
    out += [(100 + i, near[:150 + i] + "#" + near[150 + i:]) for i in range(8)]  # near copies
    out += [(200, "ab" * 400), (201, "x" * 250), (202, "x" * 199), (203, "x" * 200 + "y"), (204, None), (205, ""), (206, None),
            (207, say(70)), (208, "z" + "ab" * 150), (None, say(50)), (209, common), (209, common), (210, other[:200])]
    return out


@pytest.mark.parametrize("hot, shard", [(1 << 20, 1 << 20), (3000, 4000), (0, 1)])
def test_op11_equals_brute_force(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(op11, "HOT", hot)  # 0: everything goes by windows
    monkeypatch.setattr(op11, "SHARD", shard)
    monkeypatch.setattr(op11, "KNOWN", 0 if hot == 3000 else 1 << 20)
    rows = texts_with_repeats()
    out = op11.remove_repeats(docs(spark, rows), 200, digest=True)
    assert sorted(map(tuple, out.collect()), key=str) == brute11(rows, 200)


def test_op11_stretches_and_kept_bytes(spark, monkeypatch):
    rng = random.Random(4)
    long = "".join(rng.choice("abc ") for _ in range(9000))
    rows = [(1, long), (2, "q" * 10 + long[4000:4400]), (3, "nothing of it")]
    got = [list(op11.segments(*map(np.asarray, (np.frombuffer(long.encode(), np.uint8), [0, 9000])), 200, 64))]
    monkeypatch.setattr(op11, "STRETCH", 1000)  # a text is cut into stretches; windows must not be lost
    cut = list(op11.segments(np.frombuffer(long.encode(), np.uint8), np.array([0, 9000]), 200, 64))
    windows = lambda parts: sorted((int(p + k)) for _, _, _, pos, size in parts for p, s in zip(pos, size) for k in range(s - 199))
    assert windows(cut) == windows(got[0]) == list(range(8801)) and len(cut) == 9
    out = {r.doc_id: r for r in op11.remove_repeats(docs(spark, rows), 200).collect()}
    assert out[1].kept == (long[:4000] + long[4400:]).encode() and out[2].kept == b"q" * 10
    assert out[3].kept == b"nothing of it" and out[3].n_spans == 0


def test_op11_of_nothing(spark):
    assert op11.remove_repeats(docs(spark, []), 200, digest=True).count() == 0
    assert [r.n_removed for r in op11.remove_repeats(docs(spark, [(1, "short"), (2, None)]), 200).collect()] == [0, 0]
    with pytest.raises(ValueError):
        op11.remove_repeats(docs(spark, []), 10)


# -- spelling --------------------------------------------------------------

def brute12(rows, every=31):
    count = collections.Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    near = collections.defaultdict(set)
    holes = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1:]].add(w)
            if (less := w[:i] + w[i + 1:]) in words:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        if near[w] and words[best := min(near[w], key=lambda x: (-words[x], x))] >= 10 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out)


def variants(seed=2):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdèÿ") for _ in range(rng.randrange(7, 12))) for _ in range(25)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa"]
    rows = []
    for i in range(120):
        text = []
        for _ in range(60):
            w = rng.choice(base)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abcdè") + w[k:], w[:k] + rng.choice("abcdè") + w[k + 1:]])
            text.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "-", "9", "\n"]).join(text)))
    long = "".join(rng.choice("abcdefgh") for _ in range(20_000))  # one word
    rows += [(500, None), (501, ""), (None, f"{base[0]} {base[0]}"), (502, long), (503, long), (504, long[:9000] + "é" + long[9001:]),
             (505, long[:9000] + "é" + long[9001:]), (506, "short × ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷")]
    rows += [(600, " ".join([base[1]] * 3000))]
    return rows


@pytest.mark.parametrize("every", [31, 0, 1])
def test_op12_equals_brute_force(spark, every):
    rows = variants()
    counts = op12.word_counts(docs(spark, rows), least=7, at_least=2, drop_every=every)
    out = op12.spelling_groups(counts, ratio=10, floor=3).select("word", "form", "root", "n", "n_near", "form_n")
    want = brute12(rows, every)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == want
    assert any(r[1] for r in want) and any(r[4] > 3 for r in want)


def test_op12_follows_forms_to_the_last(spark):
    chain = [("abcdefg" + "h" * k, 10 ** (k + 1)) for k in range(6)]
    out = {r.word: r for r in op12.spelling_groups(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert {r.root for r in out.values()} == {"abcdefghhhhh"} and out["abcdefghhhhh"].form is None


def test_op12_of_nothing(spark):
    assert op12.spelling_groups(op12.word_counts(docs(spark, [(1, None), (2, "short words")]))).count() == 0
    one = op12.spelling_groups(spark.createDataFrame([("lonely word", 3)], "word string, n long")).collect()
    assert [(r.form, r.root, r.n_near) for r in one] == [(None, "lonely word", 0)]


# -- hard negatives --------------------------------------------------------

def brute13(rows, every, low=80, high=100):
    good = [(i, lab, [int(np.floor(256.0 * x)) for x in v]) for i, lab, v in rows
            if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, lab, v in good:
        if a % every:
            continue
        score = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in good]
        for p, i, m in sorted(s for s in score if s[2] == lab and s[1] != a)[:5]:
            hits = [s for s in sorted(score) if s[2] != lab and low * -p <= high * -s[0] <= high * -p][:5]
            out += [(a, i, k, s[1], -p, -s[0]) for k, s in enumerate(hits, 1)]
    return sorted(out)


VECS = "vec_id long, label int, embedding array<double>, q string, cell int, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, lab, v, "x", 1, "y") for i, lab, v in rows], VECS).repartition(3)


def some_vectors(seed=3, n=300, scale=1.0, dims=6):
    rng = np.random.default_rng(seed)
    out = [(i, int(rng.integers(0, 3)), (np.abs(rng.normal(size=dims)) * scale).round(2).tolist()) for i in range(n)]
    return out + [(n, None, out[0][2]), (n + 1, 1, None), (n + 2, 1, [0.1, None] * 3), (n + 3, 1, [float("nan")] * dims),
                  (n + 4, 1, [float("inf")] + [0.0] * 5), (None, 1, out[0][2]), (20, 1, out[20][2]), (21, 2, out[21][2]), (n + 10, 1, []),
                  (n + 11, 2, [0.0] * dims), (n + 20, 9, out[1][2])]


@pytest.mark.parametrize("scale, rows, chunk", [(1.0, 8192, 512), (0.05, 40, 3), (1e5, 100, 7), (1e6, 8192, 512)])
def test_op13_equals_brute_force(spark, monkeypatch, scale, rows, chunk):
    monkeypatch.setattr(op13, "BLOCK_ROWS", rows)
    monkeypatch.setattr(op13, "CHUNK_ROWS", chunk)
    made = some_vectors(scale=scale)
    got = op13.hard_negatives(op13.quantised(vectors(spark, made)), F.col("vec_id") % 10 == 0)
    want = [r for r in brute13(made, 10)]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


def test_packed_scores_are_exact_at_every_width():
    rng = np.random.default_rng(9)
    for bits in (1, 8, 20, 30, 45, 62):
        rows = rng.integers(-(1 << bits), 1 << bits, (33, 5))
        anchors = rng.integers(-(1 << bits), 1 << bits, (4, 5)).tolist() + [[0] * 5]
        block = op13.Packed(rows, max(sum(map(abs, a)) for a in anchors))
        for a in anchors:
            exact = [sum(int(x) * y for x, y in zip(r, a)) for r in rows]
            assert block.scores(a).tolist() == [max(-op13.MOST, min(op13.MOST, x)) for x in exact]


def test_op13_of_nothing(spark):
    q = op13.quantised(vectors(spark, []))
    assert op13.hard_negatives(q, F.col("vec_id") % 10 == 0).count() == 0
    alone = op13.quantised(vectors(spark, [(0, 1, [1.0]), (1, 2, [1.0])]))
    assert op13.hard_negatives(alone, F.col("vec_id") % 10 == 0).count() == 0


# -- near vectors whose ids repeat ------------------------------------------

def test_near_vectors_of_one_id_are_told_apart(spark):
    rng = np.random.default_rng(5)
    rows = []
    for group in range(6):
        centre = rng.normal(size=16)
        rows += [(int(rng.integers(0, 12)), (centre + rng.normal(size=16) * 0.02).tolist()) for _ in range(12)]
    rows += rows[:3]  # the same row again is the same vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    seen = sorted({(i, tuple(v)) for i, v in rows})
    unit = np.array([np.array(v) / np.linalg.norm(v) for _, v in seen])
    near = unit @ unit.T >= 0.95
    label = np.arange(len(seen))
    for _ in seen:
        label = np.array([min(label[j] for j in np.flatnonzero(r)) for r in near])
    low = {c: min(seen[k][0] for k in np.flatnonzero(label == c)) for c in set(label)}
    want = sorted((i, int(near[k].sum()) - 1, low[label[k]]) for k, (i, _) in enumerate(seen))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect())
    assert got == want and len(got) > len({i for i, _ in seen})


# -- keys seen twice -------------------------------------------------------

def test_keys_that_occur_twice_pass_wherever_they_are(spark, monkeypatch):
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2)
    twice = np.concatenate([keys, keys[:700], keys[:10]])
    rng.shuffle(twice)
    monkeypatch.setattr(seentwice, "CHUNK", 500)
    df = spark.createDataFrame([(int(np.int64(np.uint64(k))),) for k in twice], "key long").repartition(4)
    rows = df.mapInArrow(lambda bs: seentwice.slot_rows(b["key"].to_numpy().view(np.uint64) for b in bs), seentwice.SLOT_ROWS)
    ok = seentwice.passes(seentwice.repeated_slots(rows).value, keys)
    assert ok[:700].all() and ok[700:].mean() < 0.01


def test_new_queries_run(spark):
    for name in ("op11_suffix", "op12_spelling", "op13_negatives"):
        assert queries.QUERIES[name](spark, SF).count() > 0


# -- pipeline stages on awkward rows ---------------------------------------

def test_near_duplicates_keep_unlike_texts_of_one_id(spark):
    say = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(1, say(1)), (5, say(1)), (5, say(2)), (5, say(3)), (7, say(3)), (7, say(3)), (8, None), (8, ""), (9, say(4)), (9, say(4)), (None, say(4)), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, one int, _one string").repartition(3)
    out = corpus_pipeline.near_duplicates(spark, df, SF)
    assert out.columns == df.columns
    got = collections.Counter((r.doc_id, r.text or "") for r in out.collect())
    assert got == {(1, say(1)): 1, (5, say(2)): 1, (5, say(3)): 1, (8, ""): 1, (9, say(4)): 1, (None, say(4)): 1, (None, ""): 1}


def test_stages_set_clashing_columns_aside(spark):
    names = "doc_id long, text string, score double, _score int, __score int, n_lines int, _n_lines int, n_dropped int"
    df = spark.createDataFrame([(1, "a fine text\nof two lines", 0.5, 1, 2, 3, 4, 5), (2, None, None, 1, 2, 3, 4, 5)], names)
    for stage in (corpus_pipeline.toxicity, corpus_pipeline.line_dedup, corpus_pipeline.near_duplicates):
        out = stage(spark, df, SF)
        assert out.columns == df.columns and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_items_of_one_word_are_found_only_as_whole_texts(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "Paris"), (3, "no idea"), (4, "what is the capital of that large country")], "item_id long, text string")
    texts = docs(spark, [(1, "yes"), (2, "oh yes they said in Paris"), (3, "no idea"), (4, "no idea at all"),
                         (5, "tell me what is the capital of that large country please")])
    got = sorted((r.doc_id, r.item_id) for r in op3.contaminated(texts, items).collect())
    assert got == [(1, 1), (3, 3), (4, 3), (5, 4)]


# -- incremental answers of similar sets -----------------------------------

def test_answers_of_similar_sets_are_derived(monkeypatch):
    rng = np.random.default_rng(3)
    base = np.sort(rng.choice(10**9, 400, replace=False)).astype(np.uint64)
    sets = []
    for _ in range(120):  # near copies: a few elements differ
        x = base.copy()
        x[rng.choice(400, 4, replace=False)] = rng.integers(10**9, 2 * 10**9, 4)
        sets.append(np.unique(x))
    sets += [np.sort(rng.choice(10**9, 300, replace=False)).astype(np.uint64) for _ in range(20)] + [np.zeros(0, np.uint64)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    for held in (64, 0):
        monkeypatch.setattr(setrel, "HELD", held)
        read: list[int] = []
        got = setrel.links(np.concatenate(sets), bounds, 4, 5, read=read)
        up = list(range(len(sets)))
        for q, r in got:
            a, b = set(sets[q].tolist()), set(sets[r].tolist())
            assert len(a & b) * 5 >= 4 * len(a | b)
            up = [min(up[q], up[r]) if u in (up[q], up[r]) else u for u in up]
        assert up[:120] == [0] * 120 and up[120:] == list(range(120, 141))
        if held:  # every copy after the first reads the lists of what it differs in
            assert max(read[1:120]) < read[0] / 20


def test_sketches_of_large_sets_never_exceed_the_difference():
    rng = np.random.default_rng(8)
    shared = rng.integers(1, 2**63, 4000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([shared[:keep], rng.integers(1, 2**63, extra, dtype=np.uint64)]))
            for keep, extra in ((4000, 0), (3900, 100), (4000, 900), (1500, 1500), (0, 3000), (900, 0))]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    sketch = op2._large_sketches(np.concatenate(sets), bounds).to_pylist()
    assert sketch[-1] == [] and all(len(s) * 64 >= len(x) for s, x in zip(sketch[:-1], sets))
    for i in range(5):
        for j in range(i):
            w = min(len(sketch[i]), len(sketch[j]))
            a, b = (op2._fold(np.array(sketch[k], np.int64).view(np.uint64), w) for k in (i, j))
            bits = int(np.bitwise_count(a ^ b).sum())
            apart = len(np.setxor1d(sets[i], sets[j]))
            assert bits <= apart
            if apart > 5000:  # unlike sets are told apart: nothing may link at 0.8
                assert bits * 9 > len(sets[i]) + len(sets[j])


# -- what the join moves ---------------------------------------------------

def test_lists_with_the_same_sets_are_one_before_sketches_are_moved(spark, monkeypatch):
    kept = {}

    def written(df, name, *by):
        kept[name] = op2_written(df, name, *by)
        return kept[name]
    op2_written = op2.written
    monkeypatch.setattr(op2, "written", written)
    near = [f"w{i}" for i in range(600)]
    rows = [(1, " ".join(near)), (2, " ".join([*near, "one", "more"])), (3, " ".join(f"a{i}" for i in range(600)))]
    got = sorted(map(tuple, op2.jaccard_classes(docs(spark, rows), 3, 9, 10).collect()))
    assert got == [(1, 598, 1), (2, 600, 1), (3, 598, 3)]
    # the two near copies agree on many blocks, but these are one list of two sets
    assert kept["postings"].count() == 2
    assert not {"sketch", "large"} & set(kept["postings"].columns)
    assert kept["entries"].count() == 2


def test_lists_of_one_document_with_several_texts(spark, monkeypatch):
    say = lambda k, n=60: " ".join(f"w{k}x{i}" for i in range(n))
    rows = [(5, say(1)), (5, say(2)), (5, say(1)), (7, say(1, 61)), (8, say(2, 61)), (9, say(3)), (9, say(3)), (10, None)]
    want = [(5, 58, 5), (5, 58, 5), (5, 58, 5), (7, 59, 5), (8, 59, 5), (9, 58, 9), (9, 58, 9), (10, 0, 10)]
    assert sorted(map(tuple, op2.jaccard_classes(docs(spark, rows), 3, 9, 10).collect())) == want
    monkeypatch.setattr(op2, "LIST_ROWS", 1)
    assert sorted(map(tuple, op2.jaccard_classes(docs(spark, rows), 3, 9, 10).collect())) == want


def test_keys_alone_on_a_fine_slot_do_not_pass(spark):
    high = np.arange(1, 2001, dtype=np.uint64) << np.uint64(50)
    apart = np.concatenate([high, high | np.uint64(1) << np.uint64(35)])  # one slot of the bitmap, two fine ones
    twice = np.array([3, 3 << 62], np.uint64)
    df = spark.createDataFrame([(int(np.int64(np.uint64(k))),) for k in np.concatenate([apart, twice, twice])], "key long").repartition(3)
    rows = df.mapInArrow(lambda bs: seentwice.slot_rows(b["key"].to_numpy().view(np.uint64) for b in bs), seentwice.SLOT_ROWS)
    bits = seentwice.repeated_slots(rows).value
    assert seentwice.passes(bits, twice).all() and not seentwice.passes(bits, apart).any()
