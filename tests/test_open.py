"""Open maps, many keywords, quantile sketches and recursive ranks, counters, hot ids."""

import json
import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from feedlens.functions.keywords import contains_any_of, keyword_matches
from feedlens.operators import dedupe as D
from feedlens.operators import filters as FL
from feedlens.operators import metrics as M
from feedlens.operators import open_maps as OM
from feedlens.operators import stats as ST
from feedlens.scoring.lexicon import LexiconScorer
from feedlens.streaming import counters as C
from feedlens.streaming import jobs as J


def test_open_maps_keep_every_type_from_wire_to_wire(spark):
    sent = {"id": "a", "text": "hi", "unknown": 1, "author": {"not": "plain"},
            "metrics": {"n": 3, "x": 2.5, "flair": "hot", "on": True, "off": False, "none": None, "deep": {"l": [1, "b", None]}},
            "metadata": {"k": []}, "entities": {"hashtags": ["u", "v"]}}
    rows = spark.createDataFrame([(json.dumps(sent),), ("{broken",), ("[1]",), ("3",), (None,), ('{"id": 7}',)], "value string")
    out = OM.parse_open(rows)
    r = {x["id"] or x["bad"]: x for x in out.select(
        "id", F.col("_corrupt_record").alias("bad"), "author", OM.number("metrics", "n").alias("n"), OM.number("metrics", "on").alias("on"),
        OM.number("metrics", "flair").alias("no"), OM.text("metrics", "flair").alias("flair"), OM.text("metrics", "deep.l").alias("l"),
        OM.text("metrics", "gone").alias("gone")).collect()}
    assert set(r) == {"a", "7", "{broken", "[1]", "3"}
    a = r["a"]
    assert (a.n, a.on, a.no, a.flair, json.loads(a.l), a.gone, a.bad) == (3.0, 1.0, None, "hot", [1, "b", None], None, None)
    assert a.author == '{"not":"plain"}'
    back = json.loads(OM.open_wire(out.where("id = 'a'")).first().value)
    assert {k: back[k] for k in ("metrics", "metadata", "entities", "id", "text")} == {k: sent[k] for k in ("metrics", "metadata", "entities", "id", "text")}


def test_many_keywords_equal_one_by_one(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5))) for _ in range(2000)] + ["ABC"]
    texts = ["".join(rng.choice("abcdéÉ ABC") for _ in range(n)) for n in (0, 1, 3, 20, 200)] + [None, "zzz"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.m for r in df.select("i", keyword_matches("text", words).alias("m")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (None if t is None else sorted({w.lower() for w in words if w.lower() in t.lower()}))
    ids = lambda d: sorted(r.i for r in d.select("i").collect())
    assert ids(contains_any_of(df, "text", words[:9])) == ids(FL.contains_any(df, "text", words[:9]))
    assert ids(contains_any_of(df, "text", [""])) == [0, 1, 2, 3, 4, 6] and ids(contains_any_of(df, "text", [])) == []


@pytest.mark.parametrize("leaf", [5, 100_000])
def test_ranks_are_exact_however_often_bins_are_cut(spark, monkeypatch, leaf):
    monkeypatch.setattr(ST, "LEAF", leaf)
    monkeypatch.setattr(ST, "BINS", 4)
    rng = random.Random(2)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(3000)] + [("b", 1.0)] * 40 + [(None, float(i)) for i in range(7)] + [("one", 2.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: r for r in ST.latency_stats(df, "v", ["k"]).collect()}
    for k in ("hot", "b", None):
        v = [x for kk, x in rows if kk == k and x is not None]
        q = statistics.quantiles(v, n=100)
        assert got[k]["count"] == len(v) and got[k].median == pytest.approx(statistics.median(v))
        assert got[k].p95 == pytest.approx(q[94]) and got[k].p99 == pytest.approx(q[98])
    assert got["one"].p99 == 2.0


def test_sketches_of_windows_merge_within_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 3 == 0).alias("k"), F.timestamp_seconds(F.col("id") * 10).alias("ts"),
                                     F.sqrt(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double")).alias("v"))
    days = ST.quantile_sketches(df, "v", ["k"], "ts", "1 day")
    assert days.count() == 48  # 24 days of two keys, a few kB each
    est = ST.merge_sketches(days, ["k"], {"m": 0.5, "p99": 0.99}).collect()
    for r in est:
        mine = df.where(F.col("k") == r.k)
        n, m, p = mine.agg(F.count("*"), F.count_if(F.col("v") <= r.m), F.count_if(F.col("v") <= r.p99)).first()
        assert r.n == n and abs(m / n - 0.5) <= ST.RANK_ERROR and abs(p / n - 0.99) <= ST.RANK_ERROR


def test_counters_go_on_after_a_restart_and_count_once(spark, tmp_path):
    good = json.dumps({"id": "a", "text": "so good"})
    parts = [[good, "{broken", good], [json.dumps({"id": "e", "text": ""}), json.dumps({"id": "t", "text": "x", "timestamp": "yesterday"})], [good]]

    def run():
        scored = C.score_stream_counted(J.read_raw_stream(spark, "text", f"{tmp_path}/in", max_files=1), LexiconScorer())
        q = J.start(scored.select("id"), "counted", path=f"{tmp_path}/out", trigger={"availableNow": True}, checkpoint_location=f"{tmp_path}/cp")
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    log = C.CounterLog(spark, f"{tmp_path}/log")
    twice = C.CounterLog(spark, f"{tmp_path}/log")  # the same report again changes nothing
    spark.streams.addListener(log)
    spark.streams.addListener(twice)
    try:
        for part in ([0, 1], [2]):
            for k in part:
                spark.createDataFrame([(x,) for x in parts[k]], "value string").coalesce(1).write.mode("append").text(f"{tmp_path}/in")
                time.sleep(0.02)
            run()
    finally:
        spark.streams.removeListener(log)
        spark.streams.removeListener(twice)
    n = {r.name: r.n for r in C.read_counters(spark, f"{tmp_path}/log", "counted").collect()}
    assert n == {"input": 6, "late": 0, "messages": 6, "malformed": 1, "timestamp": 1, "empty": 1, "scored": 3}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_a_hot_id_is_let_through_once_by_slices(spark, tmp_path):
    rows = [(0 if i % 3 else i, 1_700_000_000 + i) for i in range(300)]
    for k in range(3):
        spark.createDataFrame(rows[k * 100:(k + 1) * 100], "id long, s long").select("id", F.timestamp_seconds("s").alias("ts")) \
            .repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.02)
    src = spark.readStream.schema("id long, ts timestamp").option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")
    q = J.start(D.dedupe(src, "id", watermark_col="ts", delay="1 hour", slices=4), "hot", path=f"{tmp_path}/out",
                trigger={"availableNow": True}, checkpoint_location=f"{tmp_path}/cp")
    q.awaitTermination()
    got = sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted({r[0] for r in rows})


def test_histogram_shares_leave_out_zero_entries(spark):
    df = spark.createDataFrame([("a", {"joy": 3, "anger": 0, "fear": 1}), ("b", {"joy": 0}), ("c", {})], "k string, emotion_distribution map<string,bigint>")
    got = sorted(map(tuple, M.histogram_shares(df, ["k"]).collect()))
    assert got == [("a", "fear", 1, 4, 0.25), ("a", "joy", 3, 4, 0.75)]
