"""The operators against brute force and on awkward rows: nulls, empty and long
texts, ties, repeated rows, empty tables, columns with clashing names."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlens.llm import op3_decontam as op3
from feedlens.llm import op4_pii as op4
from feedlens.llm import op5_lines as op5
from feedlens.llm import op6_ppm as op6
from feedlens.llm import op8_revisits as op8
from feedlens.llm import op9_packing as op9
from feedlens.llm import op10_toxicity as op10
from feedlens.llm import queries, setrel, textbytes, tokens
from feedlens.llm.common import components
from feedlens.llm.op1_embeddings import near_vectors, tables_for
from feedlens.llm.op2_jaccard import jaccard_classes
from feedlens.llm.op7_tokenfile import read_part, read_token_files, write_token_files

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score double, n_lines int, family string, keys int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 0.5, 7, "x", 1) for i, t in rows], DOCS).repartition(3)


def awkward(spark):
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
    return docs(spark, [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (6, "one two"), (6, "one two"),
                        (7, "one two"), (None, "one two three four five six"), (8, "Ünï ß 漢字"), (9, "a\n\nb\n")])


def union_find(ids, pairs):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset([tuple(w[i:i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else []))


def test_components_of_paths_stars_and_loops(spark):
    r = random.Random(4)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (7, 6)] \
        + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(120)]
    got = {x.id: x.component for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = union_find({x for p in pairs for x in p}, pairs)
    assert all(got.get(i, i) == c for i, c in want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- embeddings -------------------------------------------------------------

def test_near_vectors_match_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.standard_normal((40, 16))
    x = np.concatenate([base, base[:20] + 0.06 * r.standard_normal((20, 16)), base[:1], base[:1]])
    rows = [(i, [float(v) for v in x[i]], "label", 3) for i in range(len(x))]
    rows += [(900, None, "", 1), (901, [0.0] * 16, "", 1), (902, [float("nan")] * 16, "", 1), (903, [], "", 1),
             (904, [1.0, None], "", 1), (905, [float("inf"), 1.0], "", 1), (None, rows[0][1], "", 1), rows[3]]
    got = {g.vec_id: g for g in near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, h string, weight int")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    want = union_find(range(len(x)), list(zip(*np.nonzero(near))))
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), want[i], want[i] == i)
    for i in range(900, 906):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert len(got) == len(x) + 6
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_tables_reach_the_stated_recall():
    agree = 1 - math.acos(0.95) / math.pi
    for n in (1, 100, 10**6, 10**12):
        bits, tables = tables_for(n, 0.95)
        assert 1 - (1 - agree ** bits) ** tables >= 0.998


# ---- n-gram join ------------------------------------------------------------

@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5)])
def test_jaccard_classes_match_brute_force(spark, k, num, den):
    r = random.Random(k)
    rows = []
    for g in range(30):
        text = [f"v{r.randrange(400)}" for _ in range(r.choice([1, 2, 4, 9, 30, 120]))]
        for c in range(r.choice([1, 2, 6])):
            copy = [w if r.random() > 0.02 * c else f"u{r.randrange(9)}" for w in text]
            rows.append((len(rows), " ".join(copy).upper() if c % 2 else "  ".join(copy)))
    rows += [(5000, None), (5001, " "), (None, rows[0][1])]
    got = {x.doc_id: x for x in jaccard_classes(docs(spark, rows), k, num, den).collect()}
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and len(sets[a] & sets[b]) * den >= num * len(sets[a] | sets[b])]
    want = union_find(sets, pairs)
    assert {i: (x.n_shingles, x.component_id) for i, x in got.items()} == {i: (len(sets[i]), want[i]) for i in sets}


def test_similar_sets_share_a_block_key():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 5, 9, 12, 40, 333, 2000):
        for num, den in ((9, 10), (4, 5), (1, 2)):
            a = np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            most = n * (den - num) // den  # dropping so many keeps the sets linked
            b = np.delete(a, r.choice(len(a), most, replace=False)) if most else a
            keys, at = setrel.block_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), num, den)
            assert np.intersect1d(keys[:at[1]], keys[at[1]:]).size
            assert setrel.links(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), num, den)


def test_large_groups_are_cut_into_chunks(spark, monkeypatch):
    from feedlens.llm import op2_jaccard as op2
    r = random.Random(9)
    text = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join(w if r.random() > 0.03 else f"u{r.randrange(50)}" for w in text)) for i in range(70)]
    whole = sorted(map(tuple, jaccard_classes(docs(spark, rows), 3, 4, 5).collect()))
    monkeypatch.setattr(op2, "LIST_ROWS", 8)
    monkeypatch.setattr(op2, "FAMILY_TOKENS", 400)
    assert sorted(map(tuple, jaccard_classes(docs(spark, rows), 3, 4, 5).collect())) == whole
    assert len({c for _, _, c in whole}) < 70


def test_jaccard_on_awkward_rows(spark):
    got = collections.Counter((x.doc_id, x.n_shingles, x.component_id) for x in
                              jaccard_classes(awkward(spark), 3, 9, 10).collect())
    assert got[(6, 1, 6)] == 2 and got[(7, 1, 6)] == 1 and got[(1, 0, 1)] == 1 and got[(3, 0, 3)] == 1
    assert [c for d, _, c in got if d == 5] == [4] and sum(got.values()) == 10
    assert jaccard_classes(docs(spark, [])).count() == 0


# ---- decontamination --------------------------------------------------------

def test_contaminated(spark, monkeypatch):
    items = spark.createDataFrame(
        [(1, "Tom walks when Alice has 5 apples and buys 7 more for 3 dollars each, how many apples does Alice have now", "x"),
         (2, "short question", "x"), (3, None, "x"), (4, "", "x"), (2, "short question", "x")],
        "item_id long, text string, doc_id string")
    again = "Tom walks when Peter has 9 apples and buys 11 more for 4 dollars each, how many apples does {} have now"
    rows = docs(spark, [(1, "Foo. " + again.format("Peter") + "? ok"), (2, again.format("Bob")), (3, "x Short, question y"),
                        (4, None), (5, ""), (6, "TOM WALKS when Alice has 5 apples"), (None, "a short question"),
                        (3, "x Short, question y"), (7, "Tom walks when Alice has 5 apples and buys 7 more for 3 dollars "
                                                        "each, how many apples does Alice have now")])
    # "Short" may be a name or a word, so both are looked for
    want = {(1, 1, "reparameterised"), (3, 2, "exact"), (None, 2, "exact"), (7, 1, "exact")}
    for most in (op3.MAX_KEYS, 0):  # with and without the windows in the tasks
        monkeypatch.setattr(op3, "MAX_KEYS", most)
        got = op3.contaminated(rows, items).collect()
        assert {(x.doc_id, x.item_id, x.kind) for x in got} == want and len(got) == len(want)
    assert op3.contaminated(docs(spark, []), items).count() == 0
    assert op3.contaminated(rows, items.limit(0)).count() == 0


def test_items_made_of_numbers_match_word_for_word(spark, monkeypatch):
    items = spark.createDataFrame([(1, "Convert 5 miles 3 yards 2 feet"), (2, "1 1 2 3 5 8 13 21 34 55 89 what is next"),
                                   (3, "twenty plus 7 hours 5 minutes")], "item_id long, text string")
    rows = docs(spark, [(1, "so convert 5 miles 3 yards 2 feet, he said"), (2, "convert 6 miles 3 yards 2 feet"),
                        (3, "x 1 1 2 3 5 8 13 21 34 55 89 what is next y"), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13"),
                        (5, "plus twenty 7 hours 5 minutes"), (6, "Twenty plus 7 hours 5 minutes")])
    for most in (op3.MAX_KEYS, 0):
        monkeypatch.setattr(op3, "MAX_KEYS", most)
        got = op3.contaminated(rows, items).collect()
        assert {(x.doc_id, x.item_id, x.kind) for x in got} == {(1, 1, "exact"), (3, 2, "exact"), (6, 3, "exact")}
        assert len(got) == 3


def test_values_of_several_words(spark, monkeypatch):
    items = spark.createDataFrame([
        (1, "yesterday at noon old Mary sold 25 red apples to her friends"),
        (2, "if Bob pays twenty five coins what is left of it now")], "item_id long, text string")
    rows = docs(spark, [(1, "x yesterday at noon old Mary Ann sold twenty five red apples to her friends"),
                        (2, "well if Tom Lee pays 9 coins what is left of it now"),
                        (3, "if Bob pays twenty five coins what is left of it now"), (4, "old Mary Ann sold 25 apples")])
    for most in (op3.MAX_KEYS, 0):
        monkeypatch.setattr(op3, "MAX_KEYS", most)
        got = op3.contaminated(rows, items).collect()
        assert {(x.doc_id, x.item_id, x.kind) for x in got} == {
            (1, 1, "reparameterised"), (2, 2, "reparameterised"), (3, 2, "exact")}
        assert all(x.n_windows == x.item_windows for x in got) and len(got) == 3


def test_contamination_matches_substring_search(spark):
    d, b = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    clean = lambda t: " ".join(re.sub(r"[^\w\s]", "", t.lower()).split())
    texts = {x.doc_id: clean(x.text) for x in d.collect()}
    want = {(i, x.item_id) for x in b.collect() for i, t in texts.items() if clean(x.text) in t}
    assert want and want <= {(x.doc_id, x.item_id) for x in op3.contaminated(d, b).collect()}


# ---- personal data ----------------------------------------------------------

def brute_spans(text):
    out = []
    for k, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                           r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            n = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 3 and not 9 <= len(n) <= 15 \
                    or k == 2 and not (12 <= len(n) <= 19 and op4.luhn(n)):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_match_the_patterns():
    r = random.Random(2)
    for _ in range(20_000):
        t = "".join(r.choices("ab@@..+-  0123456789()%é", k=r.randint(0, 40)))
        assert op4.base_spans(t) == brute_spans(t)
    assert op4.base_spans("1" * 50_000 + "." + "@" * 50_000 + "+" * 50_000) == []


@pytest.fixture(scope="module")
def lines(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()
    return sorted({x for r in rows for x in r.text.split("\n") if 20 <= len(x) <= 400})


@pytest.fixture(scope="module")
def tagger(lines):
    return op4.train(lines[::2])


def test_tagger_finds_held_out_values(tagger, lines):
    x, y = op4.labelled(lines[1::2], seed=77)
    hit = found = real = 0
    emit = tagger.emissions(x[:400])
    for e, gold in zip(emit, y):
        path, _ = op4._decode(tagger, e)
        a, b = ({(i, t[i]) for i in range(len(t)) if t[i] % 2} for t in (path, gold))
        hit, found, real = hit + len(a & b), found + len(a), real + len(b)
    assert hit / found > 0.85 and hit / real > 0.85


def test_tagger_gradient(tagger):
    x, y = op4.labelled(["some words"], seed=1)
    x, y = x[:2, :12], y[:2, :12]
    model = op4.Tagger(seed=2)

    def loss():
        e = model.emissions(x)
        _, _, z = model.marginals(e)
        return (z.sum() - np.take_along_axis(e, y[:, :, None], 2).sum() - model.p["trans"][y[:, :-1], y[:, 1:]].sum()) / 2
    moments = {}
    before = {k: v.copy() for k, v in model.p.items()}
    model.step(x, y, moments, 0.0, 1)
    for k, at in (("wf", (3, 5)), ("wb", (1, 30)), ("emb", (x[0, 0], 2)), ("out", (4, 1)), ("trans", (0, 0))):
        eps, g = 1e-5, moments[k][0][at] * 10
        model.p[k] = before[k].copy()
        model.p[k][at] += eps
        up = loss()
        model.p[k][at] -= 2 * eps
        real = np.clip((up - loss()) / (2 * eps), -1, 1)  # steps use clipped gradients
        assert abs(real - g) < 1e-4
        model.p[k] = before[k].copy()


def test_pii_rows(spark):
    rows = [(1, "mail bob.x@example.com, call +1 (389) 555-5010, host 10.0.0.255 or 10.0.0.256, pay 4111 1111-1111 1111"),
            (2, None), (3, ""), (4, "1é@b.c.d@e.f 漢字 +12345678"), (None, "a@b.cd"), (4, "1é@b.c.d@e.f 漢字 +12345678")]
    got = op4.digest(op4.find_pii(docs(spark, rows))).collect()
    assert len(got) == 6
    for g in got:
        text = next(t for i, t in rows if i == g.doc_id) or ""
        base = brute_spans(text)
        assert g.base_sha256 == op4.sha_of(base)
        assert set(filter(None, op4.write_spans(base).split(","))) <= set(g.spans.split(","))
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [
            sum(s.startswith(k + ":") for s in g.spans.split(",")) for k in op4.KINDS]
    assert op4.find_pii(docs(spark, [])).count() == 0


# ---- lines ------------------------------------------------------------------

def test_recurring_lines(spark):
    line = "This long line number {} recurs in many of the documents, again and again"
    own = ["apples are red", "rivers run south", "nobody came home", "light fades early", "stones sink fast", "we left at noon"]
    rows = [(i, f"{own[i]} in {own[-i]} today\n{line.format(i)}\nshort one") for i in range(6)]
    rows += [(20, None), (21, ""), (22, line.format(3)), (22, line.format(3)), (None, "x\n" + line.format(1)),
             (23, line.format(4).replace("many", "some")), (24, "This long line number\tis another one entirely, I say so here")]
    got = {(x.doc_id, x.text): x for x in op5.drop_recurring(docs(spark, rows)).collect()}
    assert len(got) == 12 and set(op5.drop_recurring(docs(spark, rows)).columns) == set(DOCS.replace(",", "").split()[::2]) | {"n_dropped"}
    assert got[0, rows[0][1]].n_dropped == 0  # the first document keeps its lines
    for i in range(1, 6):
        assert got[i, rows[i][1].replace(line.format(i) + "\n", "")].n_dropped == 1
    assert got[20, None].n_lines == 0 and got[21, ""].n_lines == 1
    assert op5.drop_recurring(docs(spark, [(i, line.format(5)) for i in range(9)])).agg(F.sum("n_dropped")).first()[0] == 0
    assert got[22, ""].n_dropped == 1 and got[None, "x"].n_dropped == 1 and got[23, ""].n_dropped == 1
    assert got[24, rows[-1][1]].n_dropped == 0
    assert op5.drop_recurring(docs(spark, [])).count() == 0
    assert op5.drop_recurring(awkward(spark)).count() == 11


def test_pipeline_drops_short_recurring_lines(spark):
    rows = [(i, f"All rights reserved.\n \n\npage {i}\nbody number {'abcdefgh'[i]} of this") for i in range(5)]
    rows += [(9, "Seen thrice."), (10, "Seen thrice.\nx"), (11, "y\nSeen thrice.")]
    got = {x.doc_id: x.text for x in corpus_pipeline.line_dedup(spark, docs(spark, rows), SF).collect()}
    assert got == {i: t.replace("All rights reserved.\n", "") if 0 < i < 5 else t for i, t in rows}


def test_pipeline_drops_long_passages_from_two_texts_on(spark):
    passage = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(50))
    shorter, wide = passage[:passage.rindex(" ")], "few words " + " " * 60 + "far apart"
    rows = [(1, f"one\n{passage}"), (2, f"two\n{passage}\nend"), (3, f"three\n{shorter}\n{wide}"), (4, f"{shorter}\n{wide}")]
    got = {x.doc_id: x.text for x in corpus_pipeline.line_dedup(spark, docs(spark, rows), SF).collect()}
    assert got == dict(rows) | {2: "two\nend"}


def test_templates_of_one_leaf(spark):
    fill = ["ash", "birchwood", "cedars", "dogwood", "elm", "firs", "ginkgo", "hazel"]
    kinds = ["the user {} has left the room again today", "the user {} cannot open any of his files",
             "the user {} sends us twelve new long letters"]
    rows = [(0, "the user was here and nobody ever saw him")]  # the earliest line of the leaf is like no other
    rows += [(1 + 8 * k + i, kind.replace("the user", "the user of this").format(f) + f"\nown {f} of {k} here")
             for k, kind in enumerate(kinds) for i, f in enumerate(fill)]
    rows[0] = (0, "the user of this place was here as nobody ever saw")
    got = {x.doc_id: x.n_dropped for x in op5.drop_recurring(docs(spark, rows), all_templates=True).collect()}
    assert got == {i: int(i > 0 and i % 8 != 1) for i, _ in rows}


def test_query_compares_lines_with_all_templates_of_a_leaf(spark, tmp_path):
    fill = ["ash", "birchwood", "cedars", "dogwood", "elm", "firs"]
    kinds = ["the user of this {} has left the room again today", "the user of this {} cannot open any of his files"]
    rows = [(10 * k + i, kind.format(f) + f"\nown {f} of {k} here") for k, kind in enumerate(kinds) for i, f in enumerate(fill)]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x.n_dropped for x in queries.op5_lines(spark, str(tmp_path)).collect()}
    assert got == {i: int(i % 10 > 0) for i, _ in rows}


def test_line_dedup_runs_no_python(spark):
    plan = op5.drop_recurring(docs(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- language model ---------------------------------------------------------

def test_ppm_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op6, "CHUNK_BYTES", 3_000)
    monkeypatch.setattr(op6, "FAN", 3)
    rows = [(x.doc_id, x.text[:700]) for x in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(10**6, None), (10**6 + 1, ""), (None, "Über x"), (10**6 + 2, "the\x00the"), rows[0]]
    got = op6.language_scores(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {i: (t or "").translate(LOWER) for i, t in rows}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i in text}
    tok = {i: WORD.findall(t) + ["\0end"] for i, t in text.items()}
    train = [i for i, _ in rows if not held[i]]
    c = collections.Counter(w for i in train for w in tok[i])
    total, distinct = sum(c.values()), len(c)
    n = op6.ORDER
    ctx = [collections.defaultdict(collections.Counter) for _ in range(n + 1)]
    coded = {i: b"\xff" * n + t.encode() + b"\xff" for i, t in text.items()}
    for i in train:
        for j in range(n, len(coded[i])):
            for k in range(n + 1):
                ctx[k][coded[i][j - k:j]][coded[i][j]] += 1

    def logp(context, s):
        out, gone = 0.0, set()
        for k in range(n, -1, -1):
            m = ctx[k].get(context[n - k:])
            if not m:
                continue
            size, new = sum(v for x, v in m.items() if x not in gone), sum(x not in gone for x in m)
            if new and m.get(s):
                return out + math.log10((2 * m[s] - 1) / (2 * size))
            if new:
                out += math.log10(new / (2 * size))
            gone = set(m)
        return out - math.log10(256 - len(gone))
    for g in got:
        i = g.doc_id
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (
            held[i], len(tok[i]), sum(c[w] > 0 for w in tok[i]), total)
        assert g.base_score == pytest.approx(sum(math.log10((c[w] + .5) / (total + .5 * (distinct + 1))) for w in tok[i]))
        assert g.score == pytest.approx(sum(logp(coded[i][j - n:j], coded[i][j]) for j in range(n, len(coded[i]))))
    # one context's probabilities add up to one
    assert sum(10 ** logp(b"\xff" * n, s) for s in range(256)) == pytest.approx(1)
    assert op6.language_scores(docs(spark, [])).count() == 0


# ---- tokens -----------------------------------------------------------------

@pytest.mark.parametrize("name,keeps", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_equals_the_library(name, keeps):
    from tokenizers import Tokenizer
    r = random.Random(5)
    parts = ["a", "b", "E", "é", "É", "ß", " ", "  ", "\n", "'s", "'", "'re", ".", "!", "%", "1", "²", "<", "<|endoftext|>",
             "\x85", "\xa0", " ", "Σ", "é", "漢", "İ", "\U0001f44d", "_", "-", "ª", "\t", "don't", "\x1c", "\x0b", "×"]
    enc, lib = tokens.Encoder(queries.tokenizer(name), keeps), Tokenizer.from_file(queries.tokenizer(name))
    texts = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(3000)] + [None, "x" * 5000]
    for t, p in zip(texts, enc.encode(texts)):
        assert np.frombuffer(p, enc.dtype).tolist() == lib.encode(t or "", add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
    rows = awkward(spark)
    folder, manifest = write_token_files(rows, queries.tokenizer("word_bpe_49k.json"), end_id=1)
    got = read_token_files(spark, folder, manifest).orderBy("start").collect()
    ids = {(x.doc_id, x.text): [*lib.encode(x.text or "", add_special_tokens=False).ids, 1] for x in rows.collect()}
    assert sorted((g.doc_id or -1, g.n_tokens, g.ids_crc32) for g in got) == sorted(
        (x.doc_id or -1, len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for x in rows.collect()
        for v in [ids[x.doc_id, x.text]])
    assert [g.start for g in got] == [0, *np.cumsum([g.n_tokens for g in got])[:-1].tolist()]
    assert [g.doc_id or -1 for g in got] == sorted(g.doc_id or -1 for g in got)
    flat = [x for m in manifest.orderBy("part").collect() for x in read_part(folder, m.part, m.width)[2].tolist()]
    assert len(flat) == sum(g.n_tokens for g in got)
    folder, manifest = write_token_files(docs(spark, []), queries.tokenizer("word_bpe_49k.json"), end_id=1)
    assert read_token_files(spark, folder, manifest).count() == 0


# ---- revisits ---------------------------------------------------------------

def test_revisits(spark):
    m = lambda **k: {a.replace("_", "-"): b for a, b in k.items()}
    rows = [(1, "http://Ex.org:80/a/?b=2&a=1&utm_x=3#f", 10, "response", 200, m(ETag='"x"', Content_Length="9", X="1")),
            (2, "https://ex.org/a?a=1&b=2", 20, "revisit", 304, m(etag='W/"x"', content_length="0", x="2", Y="3")),
            (3, "http://ex.org/a?a=1&b=2", 20, "response", 404, m(ETag='"z"')),
            (4, "http://ex.org/a?a=1&b=2", 30, "revisit", 304, m(ETag='"y"')),
            (5, "http://ex.org/a?a=1&b=2", 5, "revisit", 304, m(ETag='"x"')),
            (6, "http://ex.org/a?a=1&b=2", 40, "revisit", 304, None), (7, None, 40, "revisit", 304, m(ETag='"x"')),
            (8, "http://ex.org/a?a=1&b=2", 10, "revisit", 304, m(ETag='"x"')), (None, "u", 1, "revisit", 304, None),
            (9, "", None, "revisit", 304, None)]
    schema = "record_id long, url string, ts long, kind string, status int, headers map<string,string>"
    got = {x.record_id: x for x in op8.resolve(spark.createDataFrame(rows, schema).withColumn("part", F.lit(1))).collect()}
    assert {i: (x.refers_to, x.outcome) for i, x in got.items()} == {
        2: (1, "resolved"), 4: (1, "mismatch"), 5: (None, "no response"), 6: (1, "unchecked"),
        7: (None, "no response"), 8: (1, "resolved")}
    assert got[2].headers == {"etag": 'W/"x"', "content-length": "9", "x": "2", "y": "3"}
    assert op8.resolve(spark.createDataFrame([], schema)).count() == 0


def test_revisits_of_one_hot_url(spark):
    rows = [(i, "http://h/", i // 3, "response" if i % 50 == 7 else "revisit", 200, {"etag": "e"}) for i in range(3000)]
    got = op8.resolve(spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, status int, headers map<string,string>"))
    for x in got.collect():
        want = (x.record_id - 7) // 50 * 50 + 7
        assert x.refers_to == (want if want >= 0 else None)


# ---- packing ----------------------------------------------------------------

def test_packing_is_gapless_and_tight(spark, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(op9, "PIECES", 30)
    lib = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    d = docs(spark, [(x.doc_id, x.text) for x in spark.read.parquet(f"{SF}/documents.parquet").collect()] + [(-1, None), (-2, ""), (5, "a")])
    got = op9.pack(op9.cut_pieces(d, queries.tokenizer("byte_bpe_50k.json"), end_id=0)).toPandas()
    ids = {(x.doc_id, x.text): [*lib.encode(x.text or "", add_special_tokens=False).ids, 0] for x in d.collect()}
    assert got.length.sum() == sum(map(len, ids.values()))
    crc = collections.Counter(zlib.crc32(np.array(v[s:s + 2048] if s >= 0 else v[:s + 2048], "<u4").tobytes())
                              for v in ids.values() for s in range((len(v) % 2048 or 2048) - 2048, len(v), 2048))
    assert collections.Counter(got.ids_crc32) == crc
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert (s.offset.to_numpy() == np.concatenate([[0], np.cumsum(s.length)[:-1]])).all() and s.length.sum() <= 2048
    assert got.sequence_id.nunique() <= math.ceil(got.length.sum() / 2048) * 1.05
    assert op9.pack(op9.cut_pieces(docs(spark, []), queries.tokenizer("byte_bpe_50k.json"), end_id=0)).count() == 0


def test_packing_hands_on_every_underfull_bin(spark, monkeypatch):
    monkeypatch.setattr(op9, "PIECES", 1)
    monkeypatch.setattr(op9, "CARRY", 1, raising=False)  # a cap, if there is one, is reached
    rows = [(i, 0, 0, 60 - 20 * (i % 2), 1) for i in range(300)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4)
    count = {}
    for bins in (32_000, 40):
        monkeypatch.setattr(op9, "BINS", bins, raising=False)
        got = op9.pack(pieces, size=100).toPandas()
        assert sorted(got.doc_id) == list(range(len(rows))) and got.groupby("sequence_id").length.sum().max() <= 100
        count[bins] = got.sequence_id.nunique()
    print("COUNT", count)
    # two pieces of 40 that meet in the first round leave no room for one of 60
    assert count[32_000] <= 172, count


# ---- toxicity ---------------------------------------------------------------

def test_noisy_channel_and_scores(spark):
    r = random.Random(1)
    plain = ["the", "day", "was", "good", "and", "then", "rain", "came", "down", "over", "town"]
    bad = ["idiot", "stupid", "worthless"]
    rows, labels = [], []
    for i in range(600):
        w = r.choices(plain, k=30)
        if i % 5 == 0:
            w[3] = r.choice(bad)
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 5 == 0), 1))
    rows += [(1000, "the day was 1d10t and rain"), (1001, "the s t u p i d day"), (1002, "what a worthlesssss town"), (1003, None),
             (1004, ""), (None, "the day"), (1005, "the day was good"), (1005, "the day was good")]
    d = docs(spark, rows)
    model = op10.fit(d, spark.createDataFrame(labels + [(None, 1, 1), (5, None, 1)], "doc_id long, toxic int, text int"))
    got = {x.doc_id: x for x in model.score(d).collect()}
    assert all((got[i].score >= op10.TOXIC) == bool(y) for i, y, _ in labels)
    assert all(got[i].score >= op10.TOXIC for i in (1000, 1001, 1002)) and all(
        got[i].score < op10.TOXIC for i in (1003, 1004, 1005, None))
    assert model.score(d).count() == len(rows) and model.score(docs(spark, [])).count() == 0
    empty = op10.fit(docs(spark, []), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {x.score for x in empty.score(d).collect()} == {0.5}
    lm = op10.CharModel(model.counts)
    assert lm.restore("The DAY was 1d10t!") == "the day was idiot" and lm.restore("of%%% the&&& rain.") == "of%%% the&&& rain."


def test_every_changed_text_is_suspicious():
    lm = op10.CharModel(np.ones(28 ** 3))
    r = random.Random(8)
    for _ in range(3000):
        t = "".join(r.choices("aab1 0@$!. ,%x|\n", k=r.randint(1, 25)))
        buf, off = np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])
        s, e, doc = textbytes.spans(buf, off)
        keep = textbytes.trim(buf, s, e)
        if lm.restore(t) != t.lower() and len(s[keep]):
            odd = op10.suspicious(buf, s[keep], e[keep], doc[keep], 1)[0]
            words = lambda x: sorted(w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in x.split())
            assert odd or words(lm.restore(t)) == words(t.lower())


def test_texts_with_wide_symbols_are_suspicious():
    lm = op10.CharModel(np.ones(28 ** 3))
    r = random.Random(9)
    changed = 0
    for t in ["f€ck", "§hit", "the £", "a ¡b"] + ["".join(r.choices("aab1 @!.€£¡§é’", k=r.randint(1, 12))) for _ in range(3000)]:
        b = t.encode()
        buf, off = np.frombuffer(b, np.uint8), np.array([0, len(b)])
        s, e, doc = textbytes.spans(buf, off)
        keep = textbytes.trim(buf, s, e)
        if lm.restore(t) != t.lower() and len(s[keep]):
            odd = op10.suspicious(buf, s[keep], e[keep], doc[keep], 1)[0]
            words = lambda x: sorted(w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in x.split())
            assert odd or words(lm.restore(t)) == words(t.lower()), t
            changed += odd
    assert changed > 1000


def test_marks_at_the_edges_are_letters_or_nothing():
    text = " ".join(["shit idiot ass cunt"] * 3 + ["the rain is over and a day was good in town fish"] * 20).encode()
    got = next(op10._trigrams([pa.RecordBatch.from_pydict({"t": [text.decode()]})]))
    counts = np.zeros(28 ** 3)
    counts[got["tri"].to_numpy()] = got["n"].to_numpy()
    lm = op10.CharModel(counts)
    for t, want in (("sh!+", "shit"), ("a$$", "ass"), ("idio+", "idiot"), ("!diot", "idiot"), ("(unt", "cunt"),
                    ('"sh!+".', "shit"), ("rain!", "rain!"), ("town!!", "town!!"), ("(the", "(the"), ("day$$$", "day$$$")):
        assert lm.restore(t) == want, t


def test_toxicity_learns_from_every_labelled_row(spark):
    ids = spark.range(27_500).select(F.col("id").alias("doc_id")).where(~op10.held_out("doc_id"))
    late = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").offset(20_000).collect()]
    assert len(late) > 100
    bad = F.col("doc_id").isin(late)
    d = ids.select("doc_id", F.when(bad, "the zornquist day").otherwise("the good day").alias("text"))
    model = op10.fit(d, ids.select("doc_id", bad.cast("int").alias("toxic")))
    got = model.score(d).groupBy("text").agg(F.min("score"), F.max("score")).collect()
    assert all((r[1] >= op10.TOXIC, r[2] >= op10.TOXIC) == ((True, True) if "zornquist" in r.text else (False, False)) for r in got)


def test_gradient_steps_of_spark_equal_those_of_the_driver(spark, monkeypatch):
    monkeypatch.setattr(op10, "STEPS", 4)
    r = random.Random(4)
    rows = [(i, " ".join(r.sample(["day", "good", "rain", "town"], 2) + r.sample(["idiot", "stupid", "clown"], 2 if i % 5 == 0 else 0))) for i in range(200)]
    d = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    here = op10.fit(d, labels)
    monkeypatch.setattr(op10, "FIT_ENTRIES", 0)
    there = op10.fit(d, labels)
    assert len(here.weights) and np.allclose(here.weights, there.weights, atol=1e-12) and abs(here.bias - there.bias) < 1e-12


def test_toxicity_held_out_accuracy(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = op10.fit(d, labels).score(d.select("doc_id", "text")).where(op10.held_out("doc_id")).join(labels, "doc_id").toPandas()
    said = got.score >= op10.TOXIC
    assert (said == (got.toxic == 1)).mean() > 0.97 and said[got.toxic == 1].mean() > 0.85


# ---- pipeline ---------------------------------------------------------------

def test_pipeline_stages(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    copies = d.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 10**6)
    odd = spark.createDataFrame([(None, None, None, None, None), (10**7, "", "en", "s", 0)], d.schema)
    now = d.unionByName(copies).unionByName(odd).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF).cache()
        assert out.columns == d.columns, name
        if name == "near_duplicates":
            sets = {x.doc_id: shingles(x.text, 5) for x in now.collect() if x.doc_id is not None}
            pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
                     and len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b])]
            want = union_find(sets, pairs)
            assert {x.doc_id for x in out.collect()} - {None} == {i for i in sets if want[i] == i}
        elif name != "line_dedup":
            assert out.exceptAll(now).count() == 0
        now = out
    left = {x.doc_id for x in now.collect()}
    assert not left & set(range(10**6, 10**6 + 20))
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {x.doc_id for x in pieces.collect()} == left
    none = d.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_pipeline_runs_from_the_table(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
