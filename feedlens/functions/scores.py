"""Column functions over class scores.

All of these are Catalyst expressions (higher-order array functions and
arithmetic), so they stay inside whole-stage codegen and run unchanged on
batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlens.constants import EMOTION_LABELS, SENTIMENT_LABELS, TOXIC_KEYWORDS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def softmax(logits) -> Column:
    """Numerically stable softmax of an array<double>."""
    a = _c(logits)
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / total)


def softmax_cols(logits: list) -> Column:
    """X1 for a fixed number of classes given as scalar Columns: closed form
    ``exp(l_i - max) / sum_j exp(l_j - max)`` with no lambda, so it stays in
    generated code and every term is evaluated once."""
    ls = [_c(x) for x in logits]
    m = F.greatest(*ls)
    es = [F.exp(x - m) for x in ls]
    total = es[0]
    for e in es[1:]:
        total = total + e
    return F.array(*[e / total for e in es])


def confidence(scores) -> Column:
    """The largest class probability."""
    return F.array_max(_c(scores))


def polarity(scores) -> Column:
    """-1 * negative + 0 * neutral + 1 * positive, evaluated in that order."""
    s = _c(scores)
    return (F.element_at(s, 1) * F.lit(-1.0) + F.element_at(s, 2) * F.lit(0.0)) \
        + F.element_at(s, 3) * F.lit(1.0)


def label_map(scores, labels) -> Column:
    """Labels zipped with scores as map<string,double>."""
    return F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), _c(scores))


def emotion_map(scores, labels=EMOTION_LABELS) -> Column:
    return label_map(scores, labels)


def raw_scores(scores, labels=SENTIMENT_LABELS) -> Column:
    return label_map(scores, labels)


def argmax_label(scores, labels) -> Column:
    """K3: label at the first index holding the maximum score."""
    s = _c(scores)
    pos = F.array_position(s, F.array_max(s))
    return F.element_at(F.array(*[F.lit(x) for x in labels]), pos.cast("int"))


def map_get(m, key: str, default: float = 0.0) -> Column:
    """Map read with a default for a missing key or NULL value."""
    return F.coalesce(F.try_element_at(_c(m), F.lit(key)), F.lit(default))


def keyword_hits(text, words=TOXIC_KEYWORDS) -> Column:
    """Number of distinct keywords occurring as substrings of the lower-cased
    text ("whatever" contains "hate")."""
    low = F.lower(_c(text))
    total = F.lit(0)
    for w in words:
        total = total + F.when(low.contains(w), 1).otherwise(0)
    return total


def toxicity(score, emotions, text, words=TOXIC_KEYWORDS, has_emotions=True) -> Column:
    """Heuristic toxicity, terms added in the reference's order, capped at 1."""
    s = _c(score)
    t = F.when(s < -0.5, F.lit(0.3)).otherwise(F.lit(0.0))
    if has_emotions:
        # A NULL map reads as 0 for every key, and t + 0.0 == t, so no branch
        # is needed for "emotions absent".
        m = _c(emotions)
        t = t + map_get(m, "anger") * 0.4
        t = t + map_get(m, "disgust") * 0.3
        t = t + map_get(m, "fear") * 0.1
    t = t + F.least(keyword_hits(text, words) * F.lit(0.1), F.lit(0.3))
    return F.least(t, F.lit(1.0))


def churn_risk(score, emotions, tox, has_emotions=True) -> Column:
    """Heuristic churn risk, terms added in the reference's order, capped at 1."""
    s = _c(score)
    c = F.when(s < 0, F.abs(s) * 0.5).otherwise(F.lit(0.0))
    c = c + F.coalesce(_c(tox), F.lit(0.0)) * 0.3
    if has_emotions:
        m = _c(emotions)
        c = c + map_get(m, "anger") * 0.4
        c = c + map_get(m, "sadness") * 0.2
        c = c + map_get(m, "fear") * 0.1
    return F.least(c, F.lit(1.0))


def sign_flag(score) -> Column:
    """Positive side of zero (score >= 0)."""
    return _c(score) >= 0


def fixed(col, n: int) -> Column:
    """X11: round half-up to n decimals (see README on toFixed)."""
    return F.round(_c(col), n)


def preview(text, n: int = 50) -> Column:
    """First n characters."""
    return F.substring(_c(text), 1, n)


def iso_ts(col) -> Column:
    """ISO-8601 text to TIMESTAMP (UTC session zone)."""
    return F.to_timestamp(_c(col))


def utc_date(col) -> Column:
    """UTC date part of a timestamp."""
    return F.to_date(_c(col))


def iso_text(col) -> Column:
    """TIMESTAMP to ISO-8601 text with milliseconds and Z."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
