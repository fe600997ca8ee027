"""Scalar scoring functions: hand-computed cases and properties."""

import math

import pytest
from pyspark.sql import functions as F

from feedlens.constants import EMOTION_LABELS
from feedlens.functions import scores as X
from feedlens.operators.enrich import enrich, scorable
from feedlens.scoring.lexicon import LexiconScorer


def test_softmax_sums_to_one_and_is_stable(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1000.0, 1000.0, -1000.0],)], "l array<double>")
    rows = df.select(X.softmax("l").alias("p"),
                     X.softmax_cols([F.col("l")[0], F.col("l")[1], F.col("l")[2]]).alias("q")).collect()
    for r in rows:
        assert math.isclose(sum(r.p), 1.0, rel_tol=1e-12)
        assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(r.p, r.q))
    assert rows[1].p[0] == rows[1].p[1] == pytest.approx(0.5)


def test_argmax_first_index_on_ties(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.3, 0.6],)], "s array<double>")
    got = [r[0] for r in df.select(X.argmax_label("s", ["negative", "neutral", "positive"])).collect()]
    assert got == ["negative", "positive"]


def test_polarity_and_confidence(spark):
    df = spark.createDataFrame([([0.2, 0.3, 0.5],)], "s array<double>")
    r = df.select(X.polarity("s").alias("p"), X.confidence("s").alias("c")).first()
    assert r.p == pytest.approx(0.3) and r.c == 0.5


def test_keyword_hits_substring_and_distinct(spark):
    df = spark.createDataFrame([("whatever",), ("hate hate HATE",), ("scam and fraud",), (None,)], "t string")
    got = [r[0] for r in df.select(X.keyword_hits("t")).collect()]
    assert got == [1, 1, 2, 0]


def test_toxicity_formula(spark):
    df = spark.createDataFrame(
        [(-0.6, {"anger": 0.5, "disgust": 0.2, "fear": 0.1}, "awful scam fraud hate"),
         (0.1, None, "fine"),
         (-0.9, {"anger": 1.0, "disgust": 1.0, "fear": 1.0}, "worst")],
        "s double, e map<string,double>, t string")
    got = [r[0] for r in df.select(X.toxicity("s", "e", "t")).collect()]
    # 0.3 + 0.2 + 0.06 + 0.01 + min(0.4, 0.3)
    assert got[0] == pytest.approx(0.87)
    assert got[1] == 0.0
    assert got[2] == 1.0  # capped


def test_churn_formula(spark):
    df = spark.createDataFrame([(-0.4, {"anger": 0.5, "sadness": 0.5, "fear": 1.0}, 0.5),
                                (0.5, None, None)],
                               "s double, e map<string,double>, tox double")
    got = [r[0] for r in df.select(X.churn_risk("s", "e", "tox")).collect()]
    # 0.2 + 0.15 + 0.2 + 0.1 + 0.1
    assert got[0] == pytest.approx(0.75)
    assert got[1] == 0.0


def test_scorable_bounds(spark):
    df = spark.createDataFrame([("",), ("x" * 5000,), ("x" * 5001,), (None,), ("  ",)], "t string")
    assert [r[0] for r in df.select(scorable("t")).collect()] == [False, True, False, False, True]


def test_lexicon_counts_whole_words_only(spark):
    sc = LexiconScorer(["trash"], ["with"])
    df = spark.createDataFrame([("Trash, trash! trashy withheld with",), ("été trash",), (None,)], "t string")
    out = sc.class_scores(df, "t").select("_scored", "_sent_scores").collect()
    assert out[2]._scored is False
    # 2 negative hits (trashy is not "trash"), 1 positive: logits (4, 1, 0.5)
    e = [math.exp(x - 4.0) for x in (4.0, 1.0, 0.5)]
    assert out[0]._sent_scores == pytest.approx([v / sum(e) for v in e])


def test_enrich_defaults_and_bounds(spark):
    rows = [("a", "pathetic trash idiot", "x"), ("b", "x" * 5001, "y"), ("c", "with this from", "z"),
            ("d", "plain words", "w")]
    df = spark.createDataFrame(rows, "id string, text string, channel string")
    out = {r.id: r for r in enrich(df, LexiconScorer(), max_chars=5000).collect()}
    d = out["b"]
    assert (d.sentiment_score, d.sentiment_label, d.confidence, d.emotion, d.toxicity,
            d.churn_risk, d.inference_time_ms, d.emotion_scores, d.scored_ok) == \
        (0.0, "neutral", 0.0, "neutral", 0.0, 0.0, 0.0, None, False)
    assert out["a"].sentiment_label == "negative" and out["a"].emotion == "anger"
    assert out["c"].sentiment_label == "positive"
    assert out["d"].sentiment_label == "neutral"
    for r in out.values():
        assert -1.0 <= r.sentiment_score <= 1.0
        assert 0.0 <= r.confidence <= 1.0 and 0.0 <= r.toxicity <= 1.0 and 0.0 <= r.churn_risk <= 1.0
        if r.emotion_scores is not None:
            assert set(r.emotion_scores) == set(EMOTION_LABELS)
            assert sum(r.emotion_scores.values()) == pytest.approx(1.0)


def test_optional_parts_give_null(spark):
    from feedlens.operators.enrich import response_fields
    df = spark.createDataFrame([("trash",)], "text string")
    sc = LexiconScorer().class_scores(df, "text", emotion=False)
    r = response_fields(sc, emotion=False, toxicity=False).first()
    assert r.emotion is None and r.emotion_scores is None and r.toxicity is None
    assert r.churn_risk is not None


def test_filter_on_score_does_not_inline_scoring(spark):
    """A filter on a derived score stays above the Generate barrier."""
    df = spark.createDataFrame([("a", "trash idiot moron")], "id string, text string")
    q = enrich(df, LexiconScorer()).filter(F.col("churn_risk") > 0.1)
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    gen = plan.find("Generate")
    filt = plan.find("Filter")
    assert gen > filt  # the filter is printed above (before) the Generate
    assert q.count() == 1


def _fixed_model(value):
    def factory():
        return lambda texts: ([[value, 0.0, 0.0]] * len(texts), [[0.0] * 7] * len(texts))

    def build():
        import numpy as np
        inner = factory()
        return lambda texts: tuple(np.array(x) for x in inner(texts))
    return build


def test_two_factories_of_one_function_keep_their_models(spark):
    from feedlens.scoring.pandas_model import PandasScorer
    df = spark.createDataFrame([("a",)], "text string").coalesce(1)
    first, second = (PandasScorer(_fixed_model(v)).class_scores(df, "text").first()["_sent_scores"] for v in (0.0, 5.0))
    assert first[0] < 0.4 < 0.9 < second[0]
