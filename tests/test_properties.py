"""Property tests and user functions on a stream."""

import datetime as dt
import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlens.operators import metrics as M
from feedlens.operators.enrich import enrich
from feedlens.operators.filters import clean
from feedlens.scoring.lexicon import LexiconScorer
from feedlens.streaming import jobs as J

WORDS = ["trash", "idiot", "with", "this", "from", "hate", "été", "fine", "Trash!", ""]
texts = st.lists(st.sampled_from(WORDS), min_size=0, max_size=12).map(" ".join)
rows = st.lists(st.tuples(texts, st.sampled_from(["Dubai", "Ajman", None]),
                          st.sampled_from(["Branch", "Website"])), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None)
@given(rows)
def test_rollup_invariants(spark, data):
    df = spark.createDataFrame([(str(i), t, c, ch) for i, (t, c, ch) in enumerate(data)],
                               "id string, text string, city string, channel string")
    s = enrich(df, LexiconScorer(), processed_at="2024-01-01 00:00:00")
    for r in s.collect():
        assert -1.0 <= r.sentiment_score <= 1.0 and 0.0 <= r.toxicity <= 1.0
        assert 0.0 <= r.churn_risk <= 1.0 and 0.0 <= r.confidence <= 1.0
        if r.emotion_scores:
            assert abs(sum(r.emotion_scores.values()) - 1.0) < 1e-9
    seg = M.multi_segment_metrics(s, ts_col=None).collect()
    overall = [r for r in seg if r.dim == "overall"][0]
    assert overall["count"] == len(data)
    for r in seg:
        assert r.positive_count + r.negative_count + r.neutral_count == r["count"]
        assert sum((r.emotion_distribution or {}).values()) == r["count"]  # emotion never empty
    for d in ("geo", "channel"):
        assert sum(r["count"] for r in seg if r.dim == d) == overall["count"]


def test_user_functions_compose_on_a_stream(spark):
    """Plain functions chained with DataFrame.transform run on a stream."""
    base = tempfile.mkdtemp(prefix="fl-u7-")
    src = os.path.join(base, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write('{"id": "a", "text": "trash idiot", "timestamp": "2024-01-01T00:00:00"}\n')
        fh.write('{"id": "b", "text": "", "timestamp": "2024-01-01T00:00:01"}\n')
    raw = J.read_raw_stream(spark, "text", src)
    out = raw.transform(J.parse_raw).transform(clean) \
        .transform(lambda d: enrich(d, LexiconScorer())) \
        .transform(lambda d: d.withColumn("loud", F.upper("text")))
    q = J.start(out.select("id", "loud", "sentiment_label"), "u7", sink="memory",
                trigger={"availableNow": True}, checkpoint_location=os.path.join(base, "ck"))
    q.awaitTermination()
    got = spark.sql("SELECT * FROM u7").collect()
    assert [(r.id, r.loud, r.sentiment_label) for r in got] == [("a", "TRASH IDIOT", "negative")]
