"""Toxicity scores of deobfuscated texts.

Noisy channel: a suspicious token (letters mixed with leetspeak characters,
letters repeated three times or more, letters spelled out one by one) becomes
a lattice of the letters it may stand for, and a Viterbi search under a
character trigram model takes the likeliest reading. Leetspeak marks before and
behind a word may be letters or nothing. Tokens that are plain
have one path only and are not searched. A logistic model over the words of
the restored text and their beginnings gives the score.

Everything is learned from all labelled rows that are not held out. Their texts
are shuffled only if the labels are too many to be broadcast. The logistic model
is fitted on the distinct word sets with their numbers of rows; where those have
more than FIT_ENTRIES words together, every gradient step is a Spark job over
them. Scoring is one scan of the texts.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from feedlens.llm import textbytes as tb
from feedlens.llm.common import short_batches, written
from feedlens.operators.joins import broadcast_if_small

FIT_WORDS = 20_000   # words that the logistic model weighs, the most telling ones
FIT_ENTRIES = 1_000_000  # words of distinct word sets up to which the driver takes the gradient steps itself
STEPS = 400          # gradient steps
MIN_TOXIC = 2        # toxic rows that a weighed word occurs in
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes of the beginnings of longer words that count as words, too
TOXIC = 0.3          # score from which a text counts as toxic
PENALTY = 0.02       # of the squared weights
DROP = float(np.log(28))  # cost of a mark that is no letter: any of the character model's symbols

# fixed values: the letters that a character may stand for
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "§": "s"}

_EDGE = 26           # symbol of a word edge; 27 is any other letter
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_U = np.uint64
_EDGES = np.zeros(256, bool)
_EDGES[[ord(c) for c in "@$!|+("]] = True
_WIDE = [c.encode() for c in LEET if ord(c) > 127]


def _symbol(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else _EDGE if c == " " else 27


class CharModel:
    """Trigram log-probabilities of the letters of words."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(28, 28, 28) + 0.05
        self.logp = np.log(c / c.sum(axis=2, keepdims=True)).tolist()
        self.read = lru_cache(maxsize=50_000)(self._read)
        self.token = lru_cache(maxsize=50_000)(self._token)

    @staticmethod
    def _steps(token: str, drop: float | None) -> list[list[tuple[str, float]]]:
        """(letters, cost) that each character or run may stand for; ``drop``:
        the cost at which a character may also be left out, a run of three for free."""
        steps: list[list[tuple[str, float]]] = []
        i, n = 0, len(token)
        while i < n:
            c, j = token[i], i
            while j < n and token[j] == c:
                j += 1
            run = j - i
            if c == " ":
                steps.append([("", 0.0), (" ", 0.0)])
            elif c in LEET or c.isalpha():
                options = LEET.get(c, c)
                if run >= 3:
                    steps.append([(o * k, 0.0) for o in options for k in (1, 2)] + [("", 0.0)] * (drop is not None))
                else:
                    steps.extend([[(o, 0.0) for o in options] + [("", drop)] * (drop is not None)] * run)
            i = j
        return steps

    def _read(self, token: str, before: str = "", after: str = "") -> str:
        """The likeliest reading of an obfuscated token (may hold spaces) with
        the marks ``before`` and ``after`` it, which are letters or nothing."""
        steps = [*self._steps(before, DROP), *self._steps(token, None), *self._steps(after, DROP)]
        best = {(_EDGE, _EDGE): (0.0, "")}
        for options in [*steps, [(" ", 0.0)]]:
            nxt: dict[tuple[int, int], tuple[float, str]] = {}
            for (p, q), (score, text) in best.items():
                for o, cost in options:
                    a, b, s = p, q, score - cost
                    for ch in o:
                        x = _symbol(ch)
                        s += self.logp[a][b][x]
                        a, b = b, x
                    if (a, b) not in nxt or s > nxt[a, b][0]:
                        nxt[a, b] = (s, text + o)
            best = nxt
        return max(best.values())[1].strip()

    def restore(self, text: str) -> str:
        """``text`` in lower case with suspicious tokens in their likeliest reading."""
        return _SPELLED.sub(lambda m: self.read(m[0].replace(m[1], " ") if m[1] else m[0]),
                            _TOKEN.sub(lambda m: self.token(m[0]), text.lower()))

    def _token(self, token: str) -> str:
        bare = token.rstrip(_MARKS)
        core = bare.lstrip(_MARKS)
        if not core:
            return token
        # the marks beside the core that may be letters
        before = _BEFORE.search(bare[:len(bare) - len(core)])[0]
        after = _AFTER.match(token[len(bare):])[0]
        if not _ODD.search(before + core + after):
            return token
        inner = re.sub(r"[^\w@$!|+(€£¡§]|_", "", core)
        said = self.read(inner, before, after)
        return token if said == core else said


_MARKS = "".join(chr(c) for c in np.flatnonzero(tb.PUNCT))
_BEFORE, _AFTER = re.compile(r"[@$!|+(]*\Z"), re.compile(r"[@$!|+(]*")
_TOKEN = re.compile(r"\S+")
_ODD = re.compile(r"[a-z][._*-]+[a-z][._*-]+[a-z]|[a-z][@$!|+(€£¡§0-9]|[@$!|+(€£¡§0-9][a-z]|([a-z])\1\1")
# three single letters or more, one by one
_SPELLED = re.compile(r"(?<!\S)[a-z](?:( |\t)[a-z]){2,}(?!\S)")


def suspicious(buf: np.ndarray, s: np.ndarray, e: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Which documents may hold a token that needs a search; every document
    whose text ``restore`` would change by more than case is among them."""
    low = _LOW[buf]
    letter = _LETTER[buf]
    odd = ~letter & ~tb.IS_SPACE[buf]
    mark = np.zeros(len(buf) + 1, np.int64)
    hit = np.zeros(len(buf), bool)
    hit[2:] = (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & letter[2:]       # a run of three
    hit[1:] |= letter[:-1] & odd[1:] | odd[:-1] & letter[1:]                      # a symbol beside a letter
    for c in _WIDE:                                                               # a symbol of several bytes
        last = buf[len(c) - 1:] == c[-1]
        for k in range(len(c) - 1):
            last &= buf[k:len(buf) - len(c) + 1 + k] == c[k]
        hit[len(c) - 1:] |= last
    np.cumsum(hit, out=mark[1:])
    inside = mark[e] - mark[np.minimum(s + 1, e)] > 0                             # seen within the bare token
    inside |= (s > 0) & _EDGES[buf[np.maximum(s - 1, 0)]]                         # one before or behind it
    inside |= (e < len(buf)) & _EDGES[buf[np.minimum(e, len(buf) - 1)]]
    out = np.zeros(n_docs, bool)
    out[doc[inside]] = True
    one = (e - s == 1)
    if len(one) >= 3:
        out[doc[2:][one[2:] & one[1:-1] & one[:-2] & (doc[2:] == doc[:-2])]] = True
    return out


def _word_hashes(b: np.ndarray, s: np.ndarray, e: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the words and of the beginnings of longer words."""
    starts, ends, docs, salt = [s], [e], [doc], [np.zeros(len(s), np.uint64)]
    for n in BEGINNINGS:
        longer = e - s > n
        starts.append(s[longer])
        ends.append(s[longer] + n)
        docs.append(doc[longer])
        salt.append(np.full(len(docs[-1]), n, np.uint64))
    return tb.hash_spans(b, np.concatenate(starts), np.concatenate(ends)) + np.concatenate(salt), np.concatenate(docs)


def _word_sets(col, model: CharModel, words: np.ndarray | None = None):
    """(first document, end, hashes, documents): the distinct words and
    beginnings of restored texts; ``words``: only those among these."""
    if words is not None:
        maybe = np.zeros(1 << 20, bool)
        maybe[words & _U((1 << 20) - 1)] = True
    buf, off = tb.buffers(col)
    for d, end in tb.slices(off):
        b, o = buf[off[d]:off[end]], off[d:end + 1] - off[d]
        s, e, doc = tb.spans(b, o)
        keep = tb.trim(b, s, e)
        s, e, doc = s[keep], e[keep], doc[keep]
        odd = np.flatnonzero(suspicious(b, s, e, doc, end - d)) if len(s) else np.zeros(0, np.int64)
        plain = ~np.isin(doc, odd)
        h, doc = _word_hashes(b, s[plain], e[plain], doc[plain])
        if len(odd):
            texts = [model.restore(b[o[i]:o[i + 1]].tobytes().decode()).encode() for i in odd]
            rb = np.frombuffer(b"".join(texts), np.uint8)
            rs, re_, rd = tb.spans(rb, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
            keep = tb.trim(rb, rs, re_)
            rh, rd = _word_hashes(rb, rs[keep], re_[keep], odd[rd[keep]])
            h, doc = np.concatenate([h, rh]), np.concatenate([doc, rd])
        if words is not None:
            some = np.flatnonzero(maybe[h & _U((1 << 20) - 1)])
            some = some[tb.member(words, h[some])]
            h, doc = h[some], doc[some]
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        yield d, end, h[new], doc[new]


def _trigrams(batches):
    """Counts of the letter trigrams of words made of letters only."""
    total = np.zeros(28 ** 3, np.int64)
    code = np.full(256, 27, np.int64)
    code[97:123] = np.arange(26)
    for batch in batches:
        buf, off = tb.buffers(batch.column(0))
        for d, end in tb.slices(off):
            b, o = buf[off[d]:off[end]], off[d:end + 1] - off[d]
            s, e, _ = tb.spans(b, o)
            keep = tb.trim(b, s, e)
            s, e = s[keep], e[keep]
            bad = np.concatenate([[0], np.cumsum(~_LETTER[b])])
            keep = bad[e] == bad[s]
            s, n = s[keep], (e - s)[keep]
            if not len(s):
                continue
            # every word with two edges before it and one behind it
            stop = np.cumsum(n + 3)
            x = np.full(stop[-1], _EDGE, np.int64)
            at = np.repeat(stop - n - 1, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x[at] = code[_LOW[b[np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]]
            tri = (x[:-2] * 28 + x[1:-1]) * 28 + x[2:]
            ok = (x[2:] != _EDGE) | (x[1:-1] != _EDGE)
            total += np.bincount(tri[ok], minlength=28 ** 3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"tri": pa.array(at), "n": pa.array(total[at])})


def _word_counts(model_counts: np.ndarray):
    def run(batches):
        model = CharModel(model_counts)
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for d, end, h, doc in _word_sets(batch.column(0), model):
                u, inv = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array(u.view(np.int64)), "n": pa.array(np.bincount(inv, minlength=len(u))),
                    "t": pa.array(np.bincount(inv, weights=toxic[doc + d], minlength=len(u)).astype(np.int64))})
    return run


def _features(model_counts: np.ndarray, words: np.ndarray):
    def run(batches):
        model = CharModel(model_counts)
        for batch in batches:
            for d, end, h, doc in _word_sets(batch.column(0), model, words):
                at = np.searchsorted(words, h)
                bounds = np.searchsorted(doc, np.arange(end - d + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(1).slice(d, end - d),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at.astype(np.int32)))],
                    names=["toxic", "words"])
    return run


def _slopes(words: np.ndarray, bounds: np.ndarray, n: np.ndarray, t: np.ndarray, w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
    """Gradient by weight and by bias of the loss over word sets that ``n`` rows
    have, ``t`` of them toxic."""
    r = np.repeat(np.arange(len(n)), np.diff(bounds))
    z = np.bincount(r, weights=w[words], minlength=len(n)) + b
    g = n / (1 + np.exp(-np.clip(z, -30, 30))) - t
    return np.bincount(words, weights=g[r], minlength=len(w)), float(g.sum())


def _arrays(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, bounds, n, t) of a batch of (words, n, t)."""
    words, n, t = batch.columns
    bounds = words.offsets.to_numpy()
    return words.values.to_numpy()[bounds[0]:bounds[-1]].astype(np.int64), bounds - bounds[0], n.to_numpy(), t.to_numpy()


def _spark_slopes(sets: DataFrame):
    """``_slopes`` as a Spark job over ``sets(words, n, t)``; one row per word
    comes back, and one for the bias."""
    def slopes(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        def run(batches):
            total, bias = np.zeros(len(w)), 0.0
            for batch in batches:
                g, g0 = _slopes(*_arrays(batch), w, b)
                total, bias = total + g, bias + g0
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"word": pa.array([-1, *at], pa.int64()), "g": pa.array([bias, *total[at]], pa.float64())})
        found = sets.mapInArrow(run, "word long, g double").groupBy("word").agg(F.sum("g").alias("g")).toArrow()
        word, g, out = found["word"].to_numpy(), found["g"].to_numpy(), np.zeros(len(w) + 1)
        out[word] = g  # the bias is the last one
        return out[:-1], float(out[-1])
    return slopes


def fit_logistic(slopes, seen: np.ndarray, total: int, toxic: int) -> tuple[np.ndarray, float]:
    """(weights, bias) of a logistic model over word presence in ``total`` rows, of
    which ``seen`` have a word, by gradient steps with a diagonal scale."""
    rate = (toxic + 0.5) / (total + 1)
    w, b = np.zeros(len(seen)), float(np.log(rate / (1 - rate)))
    scale = seen / total * 0.25 + PENALTY / 10
    for _ in range(STEPS):
        g, g0 = slopes(w, b)
        w, b = w - 0.3 * (g / total + PENALTY / total * w) / scale, b - 0.5 * g0 / total / 0.25
    return w, b


class ToxicityModel:
    """A fitted scorer: character counts, word hashes, weights and bias."""

    def __init__(self, counts: np.ndarray, words: np.ndarray, weights: np.ndarray, bias: float):
        self.counts, self.words, self.weights, self.bias = counts, words, weights, bias

    def score(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``score`` between 0 and 1 (a null text is an empty
        one); a column of that name is replaced."""
        docs = docs.drop("score")
        short_batches(docs.sparkSession)
        counts, words, weights, bias = self.counts, self.words, self.weights, self.bias
        at, names = docs.columns.index(text), [*docs.columns, "score"]

        def run(batches):
            model = CharModel(counts)
            for batch in batches:
                z = np.full(batch.num_rows, bias)
                for d, _, h, doc in _word_sets(batch.column(at), model, words):
                    np.add.at(z, doc + d, weights[np.searchsorted(words, h)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=names)

        return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on documents with a label (``labels``: doc_id, toxic 0 or 1) that are
    not held out; null ids, texts and labels teach nothing. Repeated labels of an
    id count once (the largest). Without labelled rows every score is 0.5.
    """
    short_batches(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id")) \
        .groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    rows = written(docs.select("doc_id", "text").where("text IS NOT NULL")
                   .join(broadcast_if_small(known), "doc_id").select("text", "toxic"), "labelled")
    counts = np.zeros(28 ** 3, np.int64)
    for r in rows.select("text").mapInArrow(_trigrams, "tri long, n long").groupBy("tri").agg(F.sum("n").alias("n")) \
            .collect():  # one row per trigram of 28 symbols
        counts[r.tri] = r.n
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return ToxicityModel(counts, np.zeros(0, np.uint64), np.zeros(0), -30.0 if total else 0.0)
    n, t, base = F.col("n"), F.col("t"), toxic / total
    told = rows.mapInArrow(_word_counts(counts), "word long, n long, t long").groupBy("word") \
        .agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where((t >= MIN_TOXIC) & (t > 2 * base * n)) \
        .orderBy(F.desc(t * F.log(t / (n * base))), "word").limit(FIT_WORDS).select("word").collect()
    words = np.sort(np.array([r.word for r in told], np.int64).view(np.uint64))
    sets = written(rows.mapInArrow(_features(counts, words), "toxic long, words array<int>").groupBy("words")
                   .agg(F.count("*").alias("n"), F.sum("toxic").alias("t")), "sets")
    if sets.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0] <= FIT_ENTRIES:
        # in order, so that the fit does not depend on the order of partitions
        found = _arrays(sets.orderBy("words").toArrow().combine_chunks().to_batches()[0])  # FIT_ENTRIES at most
        seen = np.bincount(found[0], weights=np.repeat(found[2], np.diff(found[1])), minlength=len(words))
        return ToxicityModel(counts, words, *fit_logistic(lambda w, b: _slopes(*found, w, b), seen, total, toxic))
    seen = np.zeros(len(words))
    for r in sets.select(F.explode("words").alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n")).collect():  # FIT_WORDS at most
        seen[r.word] = r.n
    return ToxicityModel(counts, words, *fit_logistic(_spark_slopes(sets), seen, total, toxic))
