"""Running counters of a stream (A10, A11, T-3): rows, dead letters and late rows, counted in
the pass that processes them and kept beside the stream, so that they go on after a
restart.

``counted`` puts named counts into the plan (``observe``); Spark reports them with every
micro-batch. ``CounterLog`` is a listener that writes each report to a file named after
the query and the micro-batch; a micro-batch that is reported again finds its file there,
so nothing is counted twice. ``read_counters`` adds the files up.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from feedlens.operators import filters as FL
from feedlens.operators.enrich import enrich
from feedlens.sinks.store import Conflict, _Folder
from feedlens.streaming.jobs import parse_raw

COUNTERS = "query string, batch long, name string, n long"


def counted(df: DataFrame, **counts: Column) -> DataFrame:
    """``df`` with a count of the rows for which each condition holds, under its name."""
    return df.observe("counters", *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in counts.items()])


def score_stream_counted(raw_values: DataFrame, scorer, processed_at=None) -> DataFrame:
    """T-4 with counters from one parse: ``messages`` (values that came), ``malformed`` and
    ``timestamp`` (dead letters by reason), ``empty`` (no text) and ``scored``."""
    p = parse_raw(raw_values)
    broken = F.col("_corrupt_record").isNotNull()
    ts = F.col("timestamp")
    untimed = ~broken & ts.isNotNull() & F.try_to_timestamp(ts).isNull()
    good = ~broken & ~F.coalesce(untimed, F.lit(False))
    has_text = F.coalesce(F.col("text") != "", F.lit(False))
    p = counted(p, messages=F.lit(True), malformed=broken, timestamp=untimed, empty=good & ~has_text, scored=good & has_text)
    return enrich(FL.clean(p.where(good).drop("_corrupt_record")), scorer, processed_at=processed_at)


class CounterLog(StreamingQueryListener):
    """Writes the counters of every micro-batch below ``path``; add it with
    ``spark.streams.addListener``. Queries need a name of their own."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = _Folder(spark, path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = {"input": p.numInputRows, "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators)}
        for row in p.observedMetrics.values():
            counts |= row.asDict()
        lines = [json.dumps({"query": p.name, "batch": p.batchId, "name": k, "n": int(n or 0)}) for k, n in counts.items()]
        try:
            self.folder.put_once(f"{p.name}/{p.batchId}.json", "\n".join(lines))
        except Conflict:
            pass  # this micro-batch was reported before

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_counters(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(name, n): the counters of a query since it first ran. ``late`` counts what the
    stateful operators dropped, which for a windowed rollup are groups of rows."""
    return spark.read.schema(COUNTERS).json(f"{path}/{query}/*.json").groupBy("name").agg(F.sum("n").alias("n"))
