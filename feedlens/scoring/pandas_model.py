"""Scorer kind (c): a Python model applied with ``mapInPandas``.

The model is any callable ``texts -> (sentiment_logits, emotion_logits)``
built by a zero-argument factory; it is loaded once per Python worker (module
cache) and called on chunks of at most ``batch_size`` texts (the request
ceiling of the scoring service, 100). A chunk that raises is retried text by
text, so one bad text fails only its own row (``_scored`` false -> defaults).
Latency is measured per chunk and spread over its rows.

Rows travel to Python as Arrow batches: only the columns of the frame handed
to ``class_scores`` are serialised, so callers project first.
"""

from __future__ import annotations

import hashlib
import time

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from feedlens.constants import FIXTURE_NEGATIVE_WORDS, FIXTURE_POSITIVE_WORDS, MAX_BATCH_TEXTS
from feedlens.scoring.lexicon import EMOTION_WEIGHTS, SENTIMENT_WEIGHTS

_MODELS: dict = {}


def _softmax_rows(logits: np.ndarray) -> np.ndarray:
    """Row-wise softmax, summing terms left to right like the Column form."""
    m = logits.max(axis=1, keepdims=True)
    e = np.exp(logits - m)
    total = e[:, 0].copy()
    for j in range(1, e.shape[1]):
        total = total + e[:, j]
    return e / total[:, None]


class LexiconModel:
    """The fixture lexicon as a Python model (same tokens and logits as the
    Column scorer, so both scorers agree)."""

    def __init__(self, negative=None, positive=None):
        import regex
        self._tok = regex.compile(r"\p{L}+")
        self.neg = set(negative or FIXTURE_NEGATIVE_WORDS)
        self.pos = set(positive or FIXTURE_POSITIVE_WORDS)

    def __call__(self, texts: list[str]):
        n = np.zeros(len(texts))
        p = np.zeros(len(texts))
        for i, t in enumerate(texts):
            toks = self._tok.findall(t.lower())
            n[i] = sum(1 for x in toks if x in self.neg)
            p[i] = sum(1 for x in toks if x in self.pos)
        w = SENTIMENT_WEIGHTS
        sent = np.stack([n * w["neg"], n * 0.0 + w["neutral_bias"], p * w["pos"]], axis=1)
        emo = np.stack([n * a + p * b + c for a, b, c in EMOTION_WEIGHTS], axis=1)
        return sent, emo


def lexicon_model_factory():
    return LexiconModel()


def _model(factory, key: str):
    """The worker's model of a factory; ``key`` is the factory's content, so two
    factories made by one function have models of their own."""
    m = _MODELS.get(key)
    if m is None:
        m = factory()
        _MODELS[key] = m
    return m


class PandasScorer:
    """Scorer protocol on top of a Python model run by ``mapInPandas``."""

    kind = "pandas"

    def __init__(self, model_factory=lexicon_model_factory, batch_size: int = MAX_BATCH_TEXTS):
        self.model_factory = model_factory
        self.batch_size = batch_size

    def class_scores(self, df: DataFrame, text_col: str, emotion: bool = True) -> DataFrame:
        from feedlens.session import ship_package
        ship_package(df.sparkSession)
        factory, size = self.model_factory, self.batch_size
        key = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()
        out_schema = T.StructType(df.schema.fields + [
            T.StructField("_sent_scores", T.ArrayType(T.DoubleType())),
            T.StructField("_emo_scores", T.ArrayType(T.DoubleType())),
            T.StructField("_scored", T.BooleanType()),
            T.StructField("_latency_ms", T.DoubleType()),
        ])

        def run(batches):
            model = _model(factory, key)
            for pdf in batches:
                texts = pdf[text_col]
                n = len(pdf)
                sent = [None] * n
                emo = [None] * n
                ok = np.zeros(n, dtype=bool)
                lat = np.full(n, np.nan)
                idx = [i for i in range(n) if isinstance(texts.iat[i], str)]
                for s in range(0, len(idx), size):
                    chunk = idx[s:s + size]
                    t0 = time.perf_counter()
                    try:
                        ls, le = model([texts.iat[i] for i in chunk])
                        results = [(ls[k:k + 1], le[k:k + 1]) for k in range(len(chunk))]
                    except Exception:  # retry one by one: one bad text fails one row
                        results = []
                        for i in chunk:
                            try:
                                results.append(model([texts.iat[i]]))
                            except Exception:
                                results.append(None)
                    dt_ms = (time.perf_counter() - t0) * 1000.0 / max(len(chunk), 1)
                    for i, r in zip(chunk, results):
                        if r is None:
                            continue
                        sent[i] = _softmax_rows(np.asarray(r[0], dtype=float))[0].tolist()
                        if emotion:
                            emo[i] = _softmax_rows(np.asarray(r[1], dtype=float))[0].tolist()
                        ok[i] = True
                        lat[i] = dt_ms
                out = pdf.copy()
                out["_sent_scores"] = pd.Series(sent, dtype=object)
                out["_emo_scores"] = pd.Series(emo, dtype=object)
                out["_scored"] = ok
                out["_latency_ms"] = lat
                yield out

        return df.mapInPandas(run, out_schema)
