"""What runs while messages come in: arrival-anchored windows, comments joined to posts,
newest points, the versioned store, the search index."""

import glob
import os
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from feedlens.operators import arrival as A
from feedlens.operators.joins import broadcast_if_small
from feedlens.plans import live_q
from feedlens.session import shared_path
from feedlens.sinks import search as SE
from feedlens.sinks.store import Conflict, VersionedStore
from feedlens.sources.tables import message_base
from feedlens.streaming import jobs as J
from feedlens.streaming import stateful as SF
from feedlens.streaming.joins import comments_of_posts

from .conftest import SF001

SCORED = "k string, id string, t double, sentiment_score double, sentiment_label string, churn_risk double, toxicity double"


def messages(counts, seed=3):
    rng, rows = random.Random(seed), []
    for k, n in counts:
        t = 1_700_000_000.0
        for _ in range(n):
            t += rng.choice([0, 0.5, 3, 10, 30, 61, 59.5, 200, 3000] if rng.random() < .3 else [0, 1, 2, 5])
            rows.append((k, f"m{rng.randrange(10**6):06d}", t, rng.random() * 2 - 1,
                         rng.choice(["positive", "negative", None]), rng.random(), None if rng.random() < .1 else rng.random()))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCORED).withColumn("timestamp", F.timestamp_micros((F.col("t") * 1e6).cast("long")))


def cut(rows, width=60.0):
    """Arrival-anchored windows row by row: (key, time, id) -> (start, end)."""
    out = {}
    for key in {r[0] for r in rows}:
        ms = sorted({(r[2], r[1] or "") for r in rows if r[0] == key and r[2] is not None})
        wins, start, cur = [], ms[0][0] if ms else None, []
        for t, i in ms:
            cur.append((t, i))
            if t >= start + width:
                wins.append((start, t, cur))
                start, cur = t, []
        for s, e, c in [*wins, (start, None, cur)]:
            out.update({(key, *m): (s, e) for m in c})
    return out


@pytest.mark.parametrize("span", [1, 4, 64])
def test_arrival_windows_equal_the_row_by_row_cut(spark, monkeypatch, span):
    monkeypatch.setattr(A, "SPAN", span)
    rows = messages([("hot", 300), ("b", 50), (None, 30), ("c", 1)])
    rows += [rows[5], ("hot", "x", None, 0.0, None, 0.0, 0.0), ("hot", None, 1_700_000_010.0, 0.0, None, 0.0, 0.0)]
    got = A.arrival_windows(frame(spark, rows).repartition(5), 60, ["k"]).select(
        "k", F.coalesce("id", F.lit("")).alias("i"), "t", F.unix_micros("window_start").alias("s"), F.unix_micros("window_end").alias("e")).collect()
    want = cut(rows)
    assert len(got) == len(rows) - 1
    assert all((r.s / 1e6, r.e / 1e6 if r.e else None) == want[(r.k, r.t, r.i)] for r in got)


def test_arrival_windows_without_keys_and_of_nothing(spark):
    rows = messages([("a", 40), ("b", 40)])
    got = A.arrival_windows(frame(spark, rows), 60).select("id", "t", F.unix_micros("window_start").alias("s")).collect()
    want = cut([("", *r[1:]) for r in rows])
    assert all(r.s / 1e6 == want[("", r.t, r.id)][0] for r in got)
    assert A.arrival_metrics(frame(spark, rows).limit(0), 60, ["k"]).count() == 0


def drain(spark, df, name, path, **kw):
    q = J.start(df, name, path=None if "foreach_batch" in kw else f"{path}/out", trigger={"availableNow": True},
                checkpoint_location=f"{path}/checkpoint", **kw)
    q.awaitTermination()
    return q


def put(df, path):
    df.coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)  # the file source takes files by their time


def test_arrival_stream_equals_batch_with_rows_out_of_order(spark, tmp_path):
    rng, rows = random.Random(5), messages([("hot", 200), ("b", 40)])
    rows.sort(key=lambda r: r[2] + 30 * rng.random())  # up to half a minute late
    df, src = frame(spark, rows), f"{tmp_path}/in"
    for i in range(4):
        put(frame(spark, rows[i * 60:(i + 1) * 60]), src)
    put(frame(spark, [(None, None, 1_900_000_000.0, None, None, None, None)]), src)  # moves the watermark on
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    drain(spark, SF.arrival_metrics_stream(stream, 60, "k", delay="2 minutes"), "arr", str(tmp_path))
    cols = ["k", "window_start", "window_end", "count", "positive_count", "neutral_count", "high_churn_count",
            F.round("avg_sentiment", 6), F.round("avg_toxicity", 6)]
    rows = lambda d: sorted(map(str, d.select(*cols).collect()))
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(A.arrival_metrics(df, 60, ["k"]))


def test_processors_run_in_a_session_with_the_default_store(spark, tmp_path):
    rows, was = messages([("hot", 30), ("b", 10)]), spark.conf.get(SF.PROVIDER)
    put(frame(spark, rows), f"{tmp_path}/in")
    stream = spark.readStream.schema(frame(spark, rows).schema).parquet(f"{tmp_path}/in")
    daily = stream.withWatermark("timestamp", "1 day").groupBy(F.window("timestamp", "1 day").alias("w"), F.col("k").alias("key")) \
        .agg(F.avg("sentiment_score").alias("avg_sentiment")).select(F.lit("k").alias("dim"), "key", F.col("w.start").alias("window_start"), "avg_sentiment")
    try:
        for i, make in enumerate([lambda: SF.arrival_metrics_stream(stream, 60, "k"), lambda: SF.recent_points_stream(stream, "k", 5, slices=2),
                                  lambda: SF.velocity_stream(daily)]):
            spark.conf.set(SF.PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
            q = drain(spark, make(), f"store{i}", f"{tmp_path}/{i}", foreach_batch=lambda b, i: b.count(), mode="update" if i == 1 else "append")
            assert q.exception() is None and sum(p["numInputRows"] for p in q.recentProgress) == 40
    finally:
        spark.conf.set(SF.PROVIDER, was)


def test_comments_meet_posts_that_come_before_after_twice_or_never(spark, tmp_path):
    posts = "id string, created_utc double"
    comments = "id string, post_id string, created_utc double"
    base = 1_700_000_000.0
    for rows in ([("p1", base), ("hot", base)], [("p1", base)], [("late", base + 30)], []):
        put(spark.createDataFrame(rows, posts), f"{tmp_path}/posts")
    hot = [(f"h{i}", "hot", base + i) for i in range(60)]
    for rows in ([("a", "p1", base + 5), ("early", "late", base + 40)], [*hot, ("old", "p1", base + 9000)],
                 [("none", None, base), ("lost", "nowhere", base), ("before", "late", base + 10)], [("b", "p1", base + 50)]):
        put(spark.createDataFrame(rows, comments), f"{tmp_path}/comments")
    read = lambda n, s: spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{n}")
    out = comments_of_posts(read("comments", comments), read("posts", posts), before="10 seconds", after="1 hour", delay="3 hours")
    drain(spark, out, "cm", str(tmp_path))
    got = [r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == sorted(["a", "b", "early", *[h[0] for h in hot]])


def test_newest_points_are_kept_by_slice_and_forgotten(spark, tmp_path):
    rows = messages([("hot", 90), ("b", 10)])
    for i in range(0, 100, 25):
        put(frame(spark, rows[i:i + 25]), f"{tmp_path}/in")
    stream = spark.readStream.schema(frame(spark, rows).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = drain(spark, SF.recent_points_stream(stream, "k", 5, slices=3, ttl_hours=1000, delay="1 day"), "ring", str(tmp_path), mode="update",
              foreach_batch=lambda b, i: b.withColumn("batch_id", F.lit(i).cast("long")).write.mode("append").parquet(f"{tmp_path}/out"))
    out = SF.merge_points(spark.read.parquet(f"{tmp_path}/out"), "k", 5).collect()
    for key in ("hot", "b"):
        want = sorted(((r[2], r[1]) for r in rows if r[0] == key), reverse=True)[:5]
        assert [r.id for r in sorted((r for r in out if r.k == key), key=lambda r: -r.position)] == [i for _, i in want]
    assert sum(p["numInputRows"] for p in q.recentProgress) == 100


METRICS = "dim string, key string, window_end long, value long, last_updated timestamp"


def version(spark, value, n=20):
    return spark.range(n).select(F.lit("d").alias("dim"), F.col("id").cast("string").alias("key"), F.lit(value).cast("long").alias("window_end"),
                                 F.lit(value).cast("long").alias("value"), F.timestamp_seconds(F.lit(value * 3600)).alias("last_updated"))


def test_store_replays_versions_and_expires(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        s.read()
    one = s.upsert(version(spark, 1), 0)
    two = s.upsert(version(spark, 2, 5), 1)
    assert s.upsert(version(spark, 2, 5), 1) == two + 1  # a replay takes the place of its part
    assert len(s.manifest()["parts"]) == 2
    values = lambda v=None: sorted(r.value for r in s.read(v).collect())
    assert values(one) == [1] * 20 and values() == [1] * 15 + [2] * 5
    base = s.compact()
    assert len(s.manifest()["parts"]) == 1 and values() == [1] * 15 + [2] * 5
    assert s.upsert(version(spark, 9), 1) == base  # taken in by the compaction already
    s.compact(as_of=version(spark, 25).first().last_updated, ttl_hours=24)
    assert values() == [2] * 5  # written 24 hours ago or earlier: gone
    assert values(one) == [1] * 20  # an older version is still whole
    assert s.vacuum(keep=1) and values() == [2] * 5 and s.versions() == [s.manifest()["version"]]


def test_store_commits_are_exclusive(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "m"))
    s.upsert(version(spark, 1), 0)
    with pytest.raises(Conflict):
        s.folder.put_once("_versions/000000000001.json", "{}")
    assert s.manifest(1)["version"] == 1  # what was there stays
    writers = [threading.Thread(target=lambda k=k: VersionedStore(spark, s.path).upsert(version(spark, k), k)) for k in (1, 2, 3)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert s.versions() == [1, 2, 3, 4] and {p["batch"] for p in s.manifest()["parts"]} == {0, 1, 2, 3}


def test_store_is_read_whole_while_it_is_compacted(spark, tmp_path):
    s = VersionedStore(spark, str(tmp_path / "m"))
    s.upsert(version(spark, 0), 0)
    seen, failed, stop = [], [], threading.Event()

    def look():
        while not stop.is_set():
            try:
                seen.append({r.value for r in VersionedStore(spark, s.path).read().collect()})
            except Exception as e:  # any failure of a reader is what this test is about
                failed.append(e)
    readers = [threading.Thread(target=look) for _ in range(2)]
    [r.start() for r in readers]
    for i in range(1, 7):
        s.upsert(version(spark, i), i)
        s.compact()
        s.vacuum(keep=4)
    stop.set()
    [r.join() for r in readers]
    assert not failed and len(seen) > 3
    assert all(len(v) == 1 for v in seen)  # never two versions in one answer


HISTORY = "id string, platform string, text string, channel string, timestamp timestamp"


def test_search_opens_only_files_that_can_match(spark, tmp_path):
    path = str(tmp_path / "h")

    def batch(i, texts):
        return spark.createDataFrame([(f"{i}_{k}", "x", t, "a" if k % 2 else "b") for k, t in enumerate(texts)], "id string, platform string, text string, channel string") \
            .select("*", F.expr(f"timestamp'2024-01-0{i + 1} 10:00:00'").alias("timestamp"),
                    *[F.lit(None).cast(t).alias(c) for c, t in [("city", "string"), ("product", "string"), ("sentiment_label", "string"), ("emotion", "string"),
                                                                ("language", "string"), ("sentiment_score", "double"), ("toxicity", "double"), ("churn_risk", "double")]])
    texts = [["Red apple, red", "green pear", None, ""], ["blue plum", "RED plum!"], ["apple-pie of red apples", "nothing"], ["pear"] * 4]
    for i, t in enumerate(texts):
        for _ in range(2 if i == 2 else 1):  # one micro-batch is replayed
            SE.write_indexed_history(batch(i, t), path, i, "timestamp")
    ids = lambda df: sorted(r.id for r in df.collect())
    both = SE.search(spark, path, ["RED", "apple"])
    assert ids(both) == ["0_0", "2_0"]
    opened = [f for f in both.inputFiles() if "/messages/" in f]
    assert len(opened) <= 2 < len(spark.read.parquet(f"{path}/messages").inputFiles())
    assert ids(SE.search(spark, path, ["plum", "pie"], every=False)) == ["1_0", "1_1", "2_0"]
    assert ids(SE.search(spark, path, ["red"], "2024-01-02", "2024-01-03")) == ["1_1", "2_0"]
    assert ids(SE.search(spark, path, ["plum"], equals={"channel": "a"})) == ["1_1"]
    assert ids(SE.search(spark, path, ["absent"])) == []
    with pytest.raises(ValueError):
        SE.search(spark, path, ["!"])


@pytest.mark.parametrize("told", [0, 100])
def test_index_splits_a_text_once_however_often_it_stands(spark, tmp_path, monkeypatch, told):
    monkeypatch.setattr(SE, "TOLD", told)
    texts = ["red apple", "Red apple", None, "", "red apple", "pear", "red apple"]
    b = spark.createDataFrame([(str(k), t, k % 3) for k, t in enumerate(texts)], "id string, text string, d int") \
        .withColumn("timestamp", F.timestamp_seconds(F.lit(1_704_100_000) + 86_400 * F.col("d"))).repartition(3)
    SE.write_indexed_history(b, str(tmp_path), 0, "timestamp")
    assert spark.read.parquet(f"{tmp_path}/words").count() == 2 * 2 + 1  # two words of two texts, one of another
    assert sorted(r.id for r in SE.search(spark, str(tmp_path), ["red", "apple"]).collect()) == ["0", "1", "4", "6"]
    found = SE.postings(spark, str(tmp_path), ["red"]).select("file", F.explode("rows")).collect()
    assert len(found) == len(set(found)) == 4


def test_scored_messages_are_kept_packed(spark):
    live_q.stream_scoring(spark, SF001)
    folder = max(glob.glob(shared_path(spark, "queries", "scoring_*")), key=os.path.getmtime)
    for name in ("raw", "scored"):
        files = glob.glob(f"{folder}/{name}/part-*")
        assert files and all(f.endswith(".json.gz") for f in files)


def test_the_heartbeat_of_a_stream_can_go_through_any_plan(spark, tmp_path):
    at = "timestamp_ntz'2024-01-05 10:00:00'"
    rows = [(3, 7), (-1, None), (-2, -3), (None, 4)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long").select("event_id", F.expr(at).alias("ts"), "user_id", F.lit("view").alias("event_type"), F.lit(1.0).alias("value"))
    got = message_base(spark, SF001, ev.repartition(3)).select("event_id", "platform", "device").collect()
    assert {r.event_id: (r.platform, r.device) for r in got} == {3: ("facebook", "Web"), -1: (None, None), -2: (None, None), None: (None, "Desktop")}


def one_line(spark, texts, i):
    return spark.createDataFrame([(f"{i}_{k}", t) for k, t in enumerate(texts)], "id string, text string") \
        .withColumn("timestamp", F.timestamp_seconds(F.lit(1_704_100_000 + 86_400 * i))).repartition(2)


@pytest.mark.parametrize("told", [0, 100])
def test_index_splits_a_text_once_in_all_micro_batches(spark, tmp_path, monkeypatch, told):
    monkeypatch.setattr(SE, "TOLD", told)
    path, batches = str(tmp_path), [["red apple", "pear"], ["pear", "red apple", None, "red pear"], ["red apple"]]
    for i in (0, 1, 1, 2):  # one is replayed
        SE.write_indexed_history(one_line(spark, batches[i], i), path, i, "timestamp")
    assert spark.read.parquet(f"{path}/words").count() == 2 + 1 + 2  # of three texts
    ids = lambda *w, **kw: sorted(r.id for r in SE.search(spark, path, [*w], **kw).collect())
    assert ids("red", "apple") == ["0_0", "1_1", "2_0"] and ids("pear") == ["0_1", "1_0", "1_3"]
    assert ids("red", date_from="2024-01-02") == ["1_1", "1_3", "2_0"]
    monkeypatch.setattr(SE, "RECENT", 1)  # a text that is split again is found once
    for i, texts in ((3, ["x"]), (4, ["red apple"])):
        SE.write_indexed_history(one_line(spark, texts, i), path, i, "timestamp")
    assert ids("red", "apple") == ["0_0", "1_1", "2_0", "4_0"]
    found = SE.postings(spark, path, ["red"]).select("file", F.explode("rows")).collect()
    assert len(found) == len(set(found)) == 5


@pytest.mark.parametrize("piece", [7, 200_000])
def test_arrival_rows_wait_packed_by_their_time(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(SF, "PIECE_ROWS", piece)
    monkeypatch.setattr(SF, "SPAN_US", 90_000_000)
    rows = messages([("hot", 150), ("b", 30)], seed=8)
    rows += rows[20:30] + [("hot", None, rows[40][2], 0.5, None, 0.1, 0.2)]
    rows.sort(key=lambda r: r[2])
    for i in range(3):
        put(frame(spark, rows[i * 64:(i + 1) * 64]), f"{tmp_path}/in")
    put(frame(spark, [(None, None, 1_900_000_000.0, None, None, None, None)]), f"{tmp_path}/in")
    stream = spark.readStream.schema(frame(spark, rows).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = drain(spark, SF.arrival_metrics_stream(stream, 60, "k", delay="1 minute"), f"packed{piece}", str(tmp_path))
    want = {r: n for r, n in ((str((r.k, r.window_start, r.window_end, r["count"])), 1) for r in A.arrival_metrics(frame(spark, rows), 60, ["k"]).collect())}
    got = [str((r.k, r.window_start, r.window_end, r["count"])) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == sorted(want)
    kept = max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"])
    assert piece == 7 or kept < 64  # not a state row for each message


def test_a_table_of_many_rows_is_no_broadcast_however_well_it_packs(spark, tmp_path):
    spark.range(50_000).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    plan = lambda **kw: spark.range(5).join(broadcast_if_small(t, 1 << 20, **kw), F.col("id") == F.col("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan() and "strategy=broadcast" in plan(rows=100) and "strategy=broadcast" not in plan(rows=50_000)
