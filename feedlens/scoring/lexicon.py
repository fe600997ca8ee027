"""Lexicon scorer expressed as Catalyst Columns (scorer kind (a)).

Tokens are maximal runs of letters of the lower-cased text; the scorer counts
tokens that belong to a negative and to a positive word list and turns the
counts into class logits. Logits are small multiples of integer counts, so
comparisons between classes are exact and ties resolve to the first class in
every engine. Everything runs in the JVM: no Python worker is started.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.constants import FIXTURE_NEGATIVE_WORDS, FIXTURE_POSITIVE_WORDS
from feedlens.functions.scores import softmax_cols

TOKEN_SPLIT = r"[^\p{L}]+"


def tokens(text: Column) -> Column:
    """Maximal runs of letters of the lower-cased text (array form)."""
    return F.split(F.lower(text), TOKEN_SPLIT)


def word_pattern(words: list[str]) -> str:
    """A regex matching any of ``words`` as a whole run of letters. The
    leading first-letter look-ahead lets most positions fail on one
    character-class test before the look-behind and the alternation run."""
    ws = [w.lower() for w in words]
    first = "".join(sorted({re.escape(w[0]) for w in ws}))
    alts = "|".join(re.escape(w) for w in ws)
    return rf"(?=[{first}])(?<!\p{{L}})(?:{alts})(?!\p{{L}})"


def count_words(low_text: Column, words: list[str]) -> Column:
    """Number of tokens of an already lower-cased text equal to one of
    ``words``: one regex pass over the whole text, nothing materialised."""
    return F.regexp_count(low_text, F.lit(word_pattern(words)))


# Logit weights. Sentiment: (negative, neutral, positive).
SENTIMENT_WEIGHTS = {"neg": 2.0, "neutral_bias": 1.0, "pos": 0.5}
# Emotion: (anger, disgust, fear, joy, neutral, sadness, surprise) as
# (weight on negative hits, weight on positive hits, bias).
EMOTION_WEIGHTS = [(1.0, 0.0, 0.0), (0.75, 0.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.25, 0.0),
                   (0.0, 0.0, 1.0), (0.5, 0.0, 0.0), (0.0, 0.0, 0.0)]


class LexiconScorer:
    """Scorer protocol: ``class_scores(df, text_col)`` adds ``_sent_scores``
    (array<double>, 3 classes), ``_emo_scores`` (array<double>, 7 classes, or
    NULL when emotion is off), ``_scored`` (boolean) and ``_latency_ms``. A
    NULL text is not scored (``_scored`` false, NULL class scores).

    The two hit counts are produced by a one-row ``inline`` (a Generate node).
    Catalyst does not push a filter on generated columns below a Generate, so
    a later filter on a derived score (``churn_risk > 0.7``) cannot inline the
    text scan into the filter condition: each text is scanned exactly once."""

    kind = "lexicon"

    def __init__(self, negative_words=None, positive_words=None):
        self.negative_words = list(negative_words or FIXTURE_NEGATIVE_WORDS)
        self.positive_words = list(positive_words or FIXTURE_POSITIVE_WORDS)

    def hit_counts(self, low_text: Column) -> tuple[Column, Column]:
        """(negative, positive) token counts of a lower-cased text; NULL text
        gives NULL counts."""
        return (count_words(low_text, self.negative_words),
                count_words(low_text, self.positive_words))

    def class_scores(self, df: DataFrame, text_col: str, emotion: bool = True) -> DataFrame:
        hits, score_cols = self._exprs(text_col, emotion)
        df = df.select("*", F.lower(F.col(text_col)).alias("_low"))
        df = df.select(*[c for c in df.columns if c != "_low"], F.inline(F.array(hits)))
        keep = [c for c in df.columns if c not in ("_neg_hits", "_pos_hits")]
        return df.select(*keep, *score_cols)

    @functools.lru_cache(maxsize=None)
    def _exprs(self, text_col: str, emotion: bool):
        """The scorer's Column trees, built once per (scorer, text column).

        No CASE WHEN around the softmax: a NULL hit count propagates NULL
        through the logits, and keeping the maths unconditional lets
        subexpression elimination compute each exp() once (inside a CASE
        branch it would be expanded per reference)."""
        neg, pos = self.hit_counts(F.col("_low"))
        hits = F.struct(neg.alias("_neg_hits"), pos.alias("_pos_hits"))
        n, p = F.col("_neg_hits").cast("double"), F.col("_pos_hits").cast("double")
        w = SENTIMENT_WEIGHTS
        sent = softmax_cols([n * w["neg"], n * 0.0 + F.lit(w["neutral_bias"]), p * w["pos"]])
        if emotion:
            emo = softmax_cols([n * a + p * b + F.lit(c) for a, b, c in EMOTION_WEIGHTS])
        else:
            emo = F.lit(None).cast("array<double>")
        return hits, (sent.alias("_sent_scores"), emo.alias("_emo_scores"),
                      F.col("_neg_hits").isNotNull().alias("_scored"),
                      F.lit(None).cast("double").alias("_latency_ms"))
