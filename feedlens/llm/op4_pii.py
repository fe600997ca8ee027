"""Personal data in texts: fixed patterns, and a character BiLSTM with CRF transitions.

The base spans follow fixed patterns (kinds email, ip, card, phone). A small
bidirectional LSTM over characters with CRF transitions, trained in numpy on
labelled spans, adds spans that the patterns miss. It reads overlapping
windows around every character that personal data of these kinds cannot do
without (a digit or @); the windows' emissions are merged by the distance to
the window's edge, and one Viterbi path over the whole run of windows
reconciles them. Added spans that overlap a base span or another one give way.

The labelled spans are made from the documents: lines of at most FIT_ROWS of
them, into which values of known kind, written in different ways, are put;
the same seed always gives the same model. Its weights (about 40 KB) go to the tasks.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import short_batches, written

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS = 2_000    # documents whose lines the labelled spans are put into
EXAMPLES = 3_000    # labelled lines
STEPS = 220         # training steps of BATCH lines
BATCH = 48
HIDDEN, EMBED = 20, 12
WINDOW, OVERLAP = 96, 32   # characters of a window, and common to two
CONTEXT = 24        # characters read on both sides of a digit or @
SURE = 0.9          # least mean probability of the labels of an added span

# fixed values: the base patterns
_EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NEEDS = re.compile("[0-9@]")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of name@host; every match needs an @, and its name is
    the run of name characters before it that no earlier match has taken."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        if at >= end:
            s = at
            while s > end and text[s - 1] in _NAME_CHARS:
                s -= 1
            m = _EMAIL_HOST.match(text, at) if s < at else None
            if m:
                out.append((s, m.end()))
                end = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start, then kind as listed."""
    if not _NEEDS.search(text):
        return []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    spans = [(s, 0, e) for s, e in _emails(text)]
    spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    spans += [(m.start(), 2, m.end()) for m in _CARD.finditer(text)
              if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(spans)


def write_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---- the tagger -------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind
_ALPHABET = "\n \t0123456789abcdefghijklmnopqrstuvwxyz@.+-()_%:/,;'\"[]{}<>#&*=!?$|~"
_CODE = {c: i + 2 for i, c in enumerate(_ALPHABET)}
SYMBOLS = len(_ALPHABET) + 2  # 0 is the edge, 1 any other character


def codes(text: str) -> np.ndarray:
    return np.array([_CODE.get(c, 1) for c in text.lower()[:len(text)].ljust(len(text))], np.int64)


class Tagger:
    """Bidirectional LSTM over characters with CRF transitions."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        h, e = HIDDEN, EMBED
        self.p = {"emb": r.normal(0, 0.3, (SYMBOLS, e)),
                  "out": r.normal(0, 0.3, (2 * h, TAGS)), "bias": np.zeros(TAGS), "trans": np.zeros((TAGS, TAGS))}
        for d in "fb":
            self.p[f"w{d}"] = r.normal(0, 0.25, (e + h, 4 * h))
            self.p[f"c{d}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])

    def _lstm(self, x: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        w, c0 = self.p[f"w{d}"], self.p[f"c{d}"]
        n, t, _ = x.shape
        h = np.zeros((n, HIDDEN))
        c = np.zeros((n, HIDDEN))
        out = np.zeros((n, t, HIDDEN))
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = np.concatenate([x[:, i], h], axis=1)
            g = z @ w + c0
            gate = 1 / (1 + np.exp(-g[:, :3 * HIDDEN]))
            a = np.tanh(g[:, 3 * HIDDEN:])
            was, c = c, gate[:, HIDDEN:2 * HIDDEN] * c + gate[:, :HIDDEN] * a
            tc = np.tanh(c)
            h = gate[:, 2 * HIDDEN:] * tc
            out[:, i] = h
            if keep is not None:
                keep.append((i, z, gate, a, was, tc))
        return out

    def emissions(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Scores (window, character, tag) of windows of symbol codes."""
        v = self.p["emb"][x]
        hs = []
        for d in "fb":
            steps = None if keep is None else keep.setdefault(d, [])
            hs.append(self._lstm(v, d, steps))
        h = np.concatenate(hs, axis=2)
        if keep is not None:
            keep["h"] = h
        return h @ self.p["out"] + self.p["bias"]

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tag probabilities, expected transitions, log partition) under the CRF."""
        n, t, k = e.shape
        tr = self.p["trans"]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for i in range(1, t):
            alpha[:, i] = e[:, i] + _lse(alpha[:, i - 1][:, :, None] + tr, 1)
        for i in range(t - 2, -1, -1):
            beta[:, i] = _lse(tr + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
        z = _lse(alpha[:, -1], 1)
        pair = np.exp(alpha[:, :-1, :, None] + tr + (e + beta)[:, 1:, None, :] - z[:, None, None, None])
        return np.exp(alpha + beta - z[:, None, None]), pair, z

    def step(self, x: np.ndarray, y: np.ndarray, m: dict, rate: float, at: int) -> float:
        """One Adam step on windows x with tags y; returns the mean loss a window."""
        keep: dict = {}
        e = self.emissions(x, keep)
        prob, pair, z = self.marginals(e)
        n, t, _ = e.shape
        gold = np.take_along_axis(e, y[:, :, None], 2).sum() + self.p["trans"][y[:, :-1], y[:, 1:]].sum()
        de = prob.copy()
        np.put_along_axis(de, y[:, :, None], np.take_along_axis(prob, y[:, :, None], 2) - 1, 2)
        de /= n
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["trans"] = pair.sum((0, 1)) / n
        np.add.at(g["trans"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1 / n)
        g["out"] = np.einsum("nth,ntk->hk", keep["h"], de)
        g["bias"] = de.sum((0, 1))
        dh_all = de @ self.p["out"].T
        dv = np.zeros((n, t, EMBED))
        for d, lo in (("f", 0), ("b", HIDDEN)):
            w = self.p[f"w{d}"]
            dh_next, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for i, zz, gate, a, was, tc in reversed(keep[d]):
                dh = dh_all[:, i, lo:lo + HIDDEN] + dh_next
                gi, gf, go = np.split(gate, 3, axis=1)
                dc = dc + dh * go * (1 - tc ** 2)
                dz = np.concatenate([dc * a * gi * (1 - gi), dc * was * gf * (1 - gf), dh * tc * go * (1 - go),
                                     dc * gi * (1 - a ** 2)], axis=1)
                g[f"w{d}"] += zz.T @ dz
                g[f"c{d}"] += dz.sum(0)
                back = dz @ w.T
                dv[:, i] += back[:, :EMBED]
                dh_next, dc = back[:, EMBED:], dc * gf
        np.add.at(g["emb"], x, dv)
        for k, v in g.items():
            v = np.clip(v, -1, 1)
            m1, m2 = m.setdefault(k, [np.zeros_like(v), np.zeros_like(v)])
            m1 *= 0.9
            m1 += 0.1 * v
            m2 *= 0.99
            m2 += 0.01 * v * v
            self.p[k] -= rate * (m1 / (1 - 0.9 ** at)) / (np.sqrt(m2 / (1 - 0.99 ** at)) + 1e-8)
        return float((z.sum() - gold) / n)


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


# ---- labelled spans ---------------------------------------------------------

def _digits(r: np.random.Generator, n: int) -> str:
    return "".join(map(str, r.integers(0, 10, n)))


def _value(r: np.random.Generator, kind: int) -> str:
    """A value of the kind, in one of the ways in which people write it."""
    word = lambda: "".join(chr(97 + c) for c in r.integers(0, 26, r.integers(3, 9)))
    if kind == 0:
        name = r.choice([word(), f"{word()}.{word()}", f"{word()}_{_digits(r, 2)}"])
        at, dot = [("@", "."), (" @ ", "."), ("@", " . "), ("[@]", "[.]")][min(3, int(r.integers(0, 6)))]
        return f"{name}{at}{word()}{dot}{r.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'io'])}"
    if kind == 1:
        return (" . " if r.random() < 0.15 else ".").join(str(x) for x in r.integers(0, 256, 4))
    if kind == 2:
        body = r.choice(["4", "51", "55", "37", "6011"])
        body += _digits(r, 15 - len(body))
        full = body + next(str(c) for c in range(10) if luhn(body + str(c)))
        sep = r.choice(["", " ", "-", ".", "/"])
        return sep.join(full[i:i + 4] for i in range(0, 16, 4))
    a, b, c = _digits(r, 3), _digits(r, 3), _digits(r, 4)
    country = r.choice(["", "+1 ", "+44 ", "+49-", "0049 ", "001-"])
    return country + r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{a}{b}{c}"]
                              if country else [f"({a}) {b}-{c}", f"({a}) {b} {c}"])


def _distractor(r: np.random.Generator) -> str:
    """Digits and @ that are no personal data."""
    return str(r.choice([
        f"{r.integers(1900, 2100)}-{r.integers(1, 13):02d}-{r.integers(1, 29):02d}", f"{r.integers(0, 24)}:{_digits(r, 2)}",
        f"v{r.integers(0, 20)}.{r.integers(0, 20)}.{r.integers(0, 20)}", f"{r.integers(1, 10**6):,}", _digits(r, int(r.integers(1, 7))),
        f"{r.integers(0, 1000)}.{_digits(r, 2)}", f"${r.integers(1, 10**5)}", "".join(f"{x:x}" for x in r.integers(0, 16, 24)),
        f"#{_digits(r, 5)}", f"@{''.join(chr(97 + c) for c in r.integers(0, 26, 6))}", _digits(r, 16), f"ISBN {_digits(r, 13)}"]))


def labelled(lines: list[str], seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, tags) of WINDOW characters each: lines with values put in."""
    r = np.random.default_rng(seed)
    xs, ys = [], []
    for _ in range(EXAMPLES):
        line = lines[int(r.integers(0, len(lines)))] if lines else ""
        words = [w for w in line.split(" ") if not _NEEDS.search(w)][:40]
        at = int(r.integers(0, len(words) + 1))
        kind = int(r.integers(-2, len(KINDS)))
        value = _value(r, kind) if kind >= 0 else _distractor(r)
        before, after = " ".join(words[:at]), " ".join(words[at:])
        left = (before + (" " if before else ""))[-int(r.integers(4, 60)):]
        text = left + value + str(r.choice(["", ".", ",", "!"])) + " " + after
        x, y = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        c = codes(text)[:WINDOW]
        x[:len(c)] = c
        if kind >= 0:
            s, e = len(left), min(len(left) + len(value), WINDOW)
            y[s:e] = 2 + 2 * kind
            y[s] = 1 + 2 * kind
        xs.append(x)
        ys.append(y)
    return np.stack(xs), np.stack(ys)


def train(lines: list[str], seed: int = 5) -> Tagger:
    """A tagger trained on labelled spans in these lines; deterministic."""
    model, moments, r = Tagger(), {}, np.random.default_rng(seed)
    x, y = labelled(sorted(lines))
    for at in range(1, STEPS + 1):
        pick = r.integers(0, len(x), BATCH)
        model.step(x[pick], y[pick], moments, 0.02 if at < STEPS * 2 // 3 else 0.005, at)
    return model


# ---- decoding ---------------------------------------------------------------

def regions(text: str) -> list[tuple[int, int]]:
    """Runs of text that windows must cover: every digit or @ with its context."""
    out: list[list[int]] = []
    for m in _NEEDS.finditer(text):
        s, e = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and s <= out[-1][1]:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def added_spans(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) by text, decoded from overlapping windows."""
    runs = [(i, s, e) for i, t in enumerate(texts) for s, e in regions(t)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for lo in range(0, len(runs), 256):
        part = runs[lo:lo + 256]
        wins = [(k, w) for k, (_, s, e) in enumerate(part) for w in range(s, max(s + 1, e - OVERLAP), WINDOW - OVERLAP)]
        emit = [np.zeros((e - s, TAGS)) for _, s, e in part]
        mass = [np.zeros((e - s, 1)) for _, s, e in part]
        # a character counts more the farther it is from its window's edge
        trust = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])[:, None] + 1.0
        for b in range(0, len(wins), 512):
            some = wins[b:b + 512]
            x = np.zeros((len(some), WINDOW), np.int64)
            for row, (k, w) in enumerate(some):
                c = codes(texts[part[k][0]][w:min(w + WINDOW, part[k][2])])
                x[row, :len(c)] = c
            em = model.emissions(x)
            for row, (k, w) in enumerate(some):
                _, s, e = part[k]
                n = min(w + WINDOW, e) - w
                emit[k][w - s:w - s + n] += (em[row] * trust)[:n]
                mass[k][w - s:w - s + n] += trust[:n]
        for k, (i, s, _) in enumerate(part):
            e = emit[k] / mass[k]
            path, prob = _decode(model, e)
            at = 0
            while at < len(path):
                if path[at] % 2 == 1:
                    kind, end = (path[at] - 1) // 2, at + 1
                    while end < len(path) and path[end] == 2 + 2 * kind:
                        end += 1
                    if prob[at:end].mean() >= SURE:
                        out[i].append((s + at, kind, s + end))
                    at = end
                else:
                    at += 1
    return out


def _decode(model: Tagger, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Viterbi path, probability of each of its tags)."""
    tr, n = model.p["trans"], len(e)
    best, back = e[0], np.zeros((n, TAGS), np.int64)
    for i in range(1, n):
        s = best[:, None] + tr
        back[i] = s.argmax(0)
        best = s.max(0) + e[i]
    path = np.zeros(n, np.int64)
    path[-1] = best.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    prob, _, _ = model.marginals(e[None]) if n > 1 else (np.exp(e - _lse(e, 1)[:, None])[None], None, None)
    return path, prob[0][np.arange(n), path]


# fixed values: digits that a value of each kind must have at least and at most
_DIGITS_OF = {0: (0, 99), 1: (4, 12), 2: (12, 19), 3: (9, 15)}


def all_spans(model: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, by start, then kind as listed."""
    out = []
    some = [i for i, t in enumerate(texts) if _NEEDS.search(t)]
    more = dict(zip(some, added_spans(model, [texts[i] for i in some])))
    for i, t in enumerate(texts):
        base = base_spans(t) if i in more else []
        spans = list(base)
        for s, k, e in more.get(i, []):
            while s < e and not (t[s].isalnum() or t[s] in "(+"):
                s += 1
            while s < e and not t[e - 1].isalnum():
                e -= 1
            v = t[s:e]
            digits = "".join(c for c in v if c in "0123456789")
            lo, hi = _DIGITS_OF[k]
            ok = e - s >= 6 and lo <= len(digits) <= hi and ("@" in v and "." in v if k == 0 else "@" not in v)
            ok = ok and (k != 2 or luhn(digits)) and (k != 1 or v.count(".") == 3)
            if ok and not any(s < y and x < e for x, _, y in spans):
                spans.append((s, k, e))
        out.append((base, sorted(spans)))
    return out


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, base, found) with arrays of (kind, start, end) in code points,
    end exclusive, by start, then kind as listed in KINDS.

    Needs ``doc_id`` and ``text``; other columns are ignored. Null and empty
    texts hold nothing. Repeated rows give a row each, a null doc_id is kept. An
    empty table gives an empty result.
    """
    short_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = written(source.select("doc_id").where("doc_id IS NOT NULL").distinct()
                     .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS), "fit")  # FIT_ROWS ids
    lines = source.join(F.broadcast(sample), "doc_id").select(F.explode(F.split("text", "\n")).alias("line")) \
        .where("length(line) BETWEEN 20 AND 400").orderBy(F.xxhash64("line"), "line").limit(FIT_ROWS).collect()
    model = train([r.line for r in lines])
    weights = {k: v.astype(np.float32) for k, v in model.p.items()}

    def run(batches):
        tagger = Tagger()
        tagger.p = weights
        kind = pa.array(KINDS)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            got = all_spans(tagger, texts)
            cols = []
            for which in (0, 1):
                flat = [x for g in got for x in g[which]]
                bounds = np.concatenate([[0], np.cumsum([len(g[which]) for g in got])])
                cols.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
                    [kind.take(pa.array([k for _, k, _ in flat], pa.int64())), pa.array([s for s, _, _ in flat], pa.int64()),
                     pa.array([e for _, _, e in flat], pa.int64())], names=["kind", "start", "end"])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "base", "found"])

    spans = "array<struct<kind:string,start:long,end:long>>"
    return source.mapInArrow(run, f"doc_id long, base {spans}, found {spans}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_pii``."""
    text = lambda c: F.array_join(F.transform(
        c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(text("base"), 256).alias("base_sha256"), text("found").alias("spans"))


def sha_of(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(write_spans(spans).encode()).hexdigest()
