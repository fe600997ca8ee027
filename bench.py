"""Benchmark the headline queries.

Runs each query in ``BENCH`` on the driver tables at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON
line: total of the per-query medians plus per-query medians, rows out and
rows in. Each run executes the whole plan (``noop`` sink), nothing is cached
between runs, and one warm-up pass over all queries runs before timing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedlens.plans.registry import bench_queries, queries  # noqa: E402
from feedlens.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def _sf(path: str):
    base = os.path.basename(path.rstrip("/"))
    try:
        return float(base.replace("sf", ""))
    except ValueError:
        return base


def stream_throughput(spark) -> dict:
    """Scored-stream throughput: the message view as JSON values in Parquet
    files, read as a stream (parse -> clean -> score -> 1-hour windowed rollup
    with watermark), drained with availableNow; rows/s from the query
    progress of the batches that had input."""
    from pyspark.sql import functions as F

    from feedlens.plans.catalog import DEFAULT_SCORER
    from feedlens.sources.tables import messages
    from feedlens.streaming import jobs as J

    import uuid

    from feedlens.session import shared_path
    base = shared_path(spark, "bench", f"stream-{uuid.uuid4().hex}")
    src = os.path.join(base, "in")
    m = messages(spark, SF_DIR).drop("value").withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    m.select(F.to_json(F.struct(*m.columns)).alias("value")).repartition(16) \
        .write.parquet(src)
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 4).parquet(src)
    scored = J.score_stream(raw, DEFAULT_SCORER)
    win = J.windowed_stream(scored, "timestamp", "1 hour", "1 hour", emotions=True)
    t = time.perf_counter()
    q = J.start(win, "bench_stream", sink="noop", trigger={"availableNow": True},
                checkpoint_location=os.path.join(base, "ckpt"))
    q.awaitTermination()
    wall = time.perf_counter() - t
    progress = [p for p in q.recentProgress if p["numInputRows"] > 0]
    rows = sum(p["numInputRows"] for p in progress)
    busy = sum(p["durationMs"].get("triggerExecution", 0) for p in progress) / 1000.0
    steady = progress[1:]  # the first micro-batch pays JIT and code generation
    s_rows = sum(p["numInputRows"] for p in steady)
    s_busy = sum(p["durationMs"].get("triggerExecution", 0) for p in steady) / 1000.0
    return {"rows": rows, "batches": len(progress), "wall_sec": round(wall, 3),
            "rows_per_sec": round(rows / busy, 1) if busy else None,
            "steady_rows_per_sec": round(s_rows / s_busy, 1) if s_busy else None}


def main() -> None:
    spark = build_session(f"local[{CPUS}]", app="feedlens-bench",
                          shuffle_partitions=int(CPUS) * 2,
                          extra={"spark.driver.memory": "16g"})
    qs = queries()
    names = bench_queries()
    per, rows = {}, {}
    # Warm-up pass over every query (JVM JIT, code generation, the memoised
    # broadcast size checks); not timed.
    for name in names:
        qs[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    for name in names:
        times = []
        for _ in range(REPEAT):
            t = time.perf_counter()
            df = qs[name](spark, SF_DIR)
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        per[name] = round(statistics.median(times), 3)
        rows[name] = qs[name](spark, SF_DIR).count()
    stream = stream_throughput(spark)
    events_in = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    docs_in = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per.values()), 3),
        "unit": "sec",
        "queries": per,
        "rows_out": rows,
        "rows_in": {"events": events_in, "documents": docs_in},
        "stream": stream,
        "repeat": REPEAT,
        "cpus": int(CPUS),
        "sf": _sf(SF_DIR),
    }
    spark.stop()
    print(json.dumps(out), flush=True)


if __name__ == "__main__":
    main()
