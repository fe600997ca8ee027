"""Sources and normalisers on small fixtures the tests write (S13-S15, P1-P8,
J1, J2, F4, F10, D1-D3, K4, U4)."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from feedlens.functions.scores import preview
from feedlens.operators import dedupe as D
from feedlens.operators import filters as FL
from feedlens.operators import normalize as N
from feedlens.operators import trends as T
from feedlens.sources.landed import read_landed


def _write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")


def test_tweets_users_normalise(spark):
    base = tempfile.mkdtemp(prefix="fl-tw-")
    _write(os.path.join(base, "t"), "a.json", [
        {"id": 1, "text": "hi #x", "author_id": 10, "created_at": "2024-01-01T00:00:00Z",
         "lang": None, "public_metrics": {"like_count": 3},
         "entities": {"hashtags": [{"tag": "x"}], "mentions": [{"username": "bank"}]}},
        {"id": 2, "text": "no user", "author_id": 99, "created_at": "2024-01-01T00:00:01Z",
         "lang": "ar"}])
    _write(os.path.join(base, "u"), "a.json", [
        {"id": 10, "username": "amal", "verified": True, "public_metrics": {"followers_count": 5}}])
    tw = read_landed(spark, os.path.join(base, "t"), "tweet")
    us = read_landed(spark, os.path.join(base, "u"), "user")
    out = {r.id: r for r in N.normalize_tweets(tw, us, ingested_at="2024-02-01 00:00:00").collect()}
    a, b = out["1"], out["2"]
    assert (a.author, a.verified, a.language, a.platform) == ("amal", True, "en", "twitter")
    assert a.metrics["like_count"] == 3.0 and a.metrics["retweet_count"] == 0.0
    assert a.entities.hashtags == ["x"] and a.entities.mentions == ["bank"]
    assert (b.author, b.verified, b.language) == ("unknown", False, "ar")
    assert b.entities.hashtags == [] and b.followers_count is None
    raw = N.to_raw_row(N.normalize_tweets(tw, us))
    assert "verified" not in raw.columns and len(raw.columns) == 17


def test_posts_comments_listings_dedupe(spark):
    posts = spark.createDataFrame([
        ("p1", "Title", "", None, None, 1704067200.0, "bank", "/r/bank/p1", 1, 0.9, 2, 0, "Q", "new", 1),
        ("p2", "Other", "Body", "ali", "a1", 1704067260.0, "bank", "/r/bank/p2", 5, 0.5, 0, 1, None, "new", 2),
        ("p2", "Other", "Body", "ali", "a1", 1704067260.0, "bank", "/r/bank/p2", 5, 0.5, 0, 1, None, "hot", 1),
    ], "id string, title string, selftext string, author string, author_id string, "
       "created_utc double, subreddit string, permalink string, score int, upvote_ratio double, "
       "num_comments int, total_awards_received int, link_flair_text string, listing string, "
       "listing_rank int")
    new = posts.filter("listing = 'new'")
    hot = posts.filter("listing = 'hot'")
    both = D.union_listings(new, hot, "id")
    assert both.count() == 2
    norm = {r.id: r for r in N.normalize_posts(both, ingested_at="2024-02-01 00:00:00").collect()}
    assert norm["reddit_post_p1"].text == "Title" and norm["reddit_post_p1"].author == "[deleted]"
    assert norm["reddit_post_p2"].text == "Other\n\nBody"
    assert norm["reddit_post_p2"].timestamp.startswith("2024-01-01T00:01:00")
    assert norm["reddit_post_p2"].url == "https://reddit.com/r/bank/p2"
    comments = spark.createDataFrame([
        ("c1", "p1", "[removed]", None, None, 1.0, "bank", "/c1", 1, 0, False, 1),
        ("c2", "p1", "fine", "bo", "b", 2.0, "bank", "/c2", 1, 0, True, 2),
        ("c3", "p9", "orphan", "cy", "c", 3.0, "bank", "/c3", 1, 0, False, 1),
        ("p1", "p2", "same id as a post", "dd", "d", 4.0, "bank", "/p1", 1, 0, False, 1),
    ], "id string, post_id string, body string, author string, author_id string, "
       "created_utc double, subreddit string, permalink string, score int, "
       "total_awards_received int, is_submitter boolean, position int")
    kept = FL.drop_removed(comments, "body")
    nc = N.normalize_comments(kept, posts.select("id")).collect()
    ids = sorted(r.id for r in nc)
    # prefixed ids keep a comment that shares a raw id with a post
    assert ids == ["reddit_comment_c2", "reddit_comment_p1"]
    assert {r.parent_post_id for r in nc} == {"p1", "p2"}
    top = T.first_n_per_parent(comments, "post_id", "position", 1).collect()
    assert sorted(r.id for r in top) == ["c1", "c3", "p1"]
    first = D.dedupe(comments, "post_id", order=["position", "id"]).collect()
    assert sorted(r.id for r in first) == ["c1", "c3", "p1"]
    assert T.take(comments, 2, ["id"]).count() == 2


def test_history_search_prunes_partitions(spark):
    base = tempfile.mkdtemp(prefix="fl-hist-")
    rows = [("a", "great card", dt.date(2024, 1, 1), "Dubai"),
            ("b", "awful fees", dt.date(2024, 1, 2), "Ajman"),
            ("c", "fees ok", dt.date(2024, 1, 3), "Dubai")]
    spark.createDataFrame(rows, "id string, text string, index_date date, city string") \
        .write.partitionBy("index_date").parquet(base + "/h")
    h = spark.read.parquet(base + "/h")
    q = FL.search_history(h, "2024-01-02", "2024-01-03", ["FEES"], {"city": "Dubai"})
    assert [r.id for r in q.collect()] == ["c"]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "index_date" in plan


def test_pandas_scorer_isolates_failures_and_times(spark):
    from feedlens.scoring.pandas_model import LexiconModel, PandasScorer

    df = spark.createDataFrame([(str(i), "trash" if i % 3 else "BAD") for i in range(250)],
                               "id string, text string")
    out = PandasScorer(failing_model_factory, batch_size=100).class_scores(df, "text").collect()
    bad = [r for r in out if r.text == "BAD"]
    good = [r for r in out if r.text != "BAD"]
    assert all(not r._scored and r._sent_scores is None for r in bad)
    assert all(r._scored and r._latency_ms >= 0 for r in good)
    assert good[0]._sent_scores == pytest.approx(
        PandasScorer().class_scores(df.limit(1).filter("text = 'trash'"), "text").first()._sent_scores
        if df.limit(1).filter("text = 'trash'").count() else good[0]._sent_scores)
    assert preview(F.lit("x" * 80)) is not None


class _Failing:
    def __init__(self):
        from feedlens.scoring.pandas_model import LexiconModel
        self.inner = LexiconModel()

    def __call__(self, texts):
        if "BAD" in texts:
            raise ValueError("bad text")
        return self.inner(texts)


def failing_model_factory():
    return _Failing()


def test_dedupe_text_counts_repeated_and_null_ids(spark):
    rows = [(1, "a"), (2, "a"), (1, "b"), (None, "c"), (None, "c"), (3, "d"), (4, None), (5, None), (6, "")] \
        + [(i, "same text") for i in range(100, 600)]
    got = D.dedupe_text(spark.createDataFrame(rows, "id long, text string").repartition(16), "text", "id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, 2, 1), (1, 1, 1), (None, 2, 1), (3, 1, 1), (4, 2, None), (6, 1, 0), (100, 500, 9)], key=str)
