"""Stateful processors (T-1 arrival windows, W1, W5 on streams).

Rows of a micro-batch come in any order, and those of several partitions interleave.
The processors that need arrival order therefore keep rows as pending state and act on
them, in the order of (time, id), once the watermark has passed them; a timer at the
oldest pending row wakes a key that gets no more rows. State holds what the watermark
delay keeps open and a few numbers for each key. Rows behind the watermark are dropped
by Spark and counted as late.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedlens.constants import HIGH_CHURN_THRESHOLD
from feedlens.operators.trends import recent_trend
from feedlens.streaming.jobs import with_lateness

# Spark starts one worker for a processor beside the driver, which does not get shipped files
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = "org.apache.spark.sql.execution.streaming.state."

SPAN_US = 3_600_000_000  # time of the rows that wait in one piece of state
PIECE_ROWS = 200_000  # rows that are split into pieces at a time
SUMS = ["sentiment", "positive", "negative", "churn", "high_churn", "toxicity"]


def keep_states(spark: SparkSession) -> None:
    """Processors have several states and timers, which Spark's default store cannot hold: a
    session that has the default gets RocksDB. Any other store stays."""
    if spark.conf.get(PROVIDER) == _STATE + "HDFSBackedStateStoreProvider":
        spark.conf.set(PROVIDER, _STATE + "RocksDBStateStoreProvider")


class _Ordered(StatefulProcessor):
    """Hands a key's rows to ``advance`` in order, when the watermark has passed them. Rows
    wait in packed pieces by their span of time, so state is read and written a piece at a
    time, and memory holds one span. ``numbers``: the double columns kept beside us and id."""

    numbers: list[str] = []

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "span long, piece long", "first long, rows binary")
        self.schema = pa.schema([("us", pa.int64()), ("id", pa.string()), *[(c, pa.float64()) for c in self.numbers]])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is not None:
            self.pieces = self._pieces()
            parts, n = [], 0
            for part in rows:
                parts.append(pa.Table.from_pandas(part[self.schema.names], self.schema, preserve_index=False))
                n += len(part)
                if n >= PIECE_ROWS:
                    self._keep(pa.concat_tables(parts))
                    parts, n = [], 0
            if n:
                self._keep(pa.concat_tables(parts))
            yield from self._ripe(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.pieces = self._pieces()
        yield from self._ripe(key, timerValues.getCurrentWatermarkInMs())

    def _pieces(self) -> dict[int, list[int]]:
        """The pieces that wait, by span."""
        out: dict[int, list[int]] = {}
        for span, piece in self.waiting.keys() if self.waiting.exists() else []:
            out.setdefault(span, []).append(piece)
        return out

    def _keep(self, t: pa.Table) -> None:
        t = t.filter(pc.is_valid(t["us"])).sort_by("us")
        us = t["us"].to_numpy()
        spans = us // SPAN_US
        starts = np.flatnonzero(np.diff(spans, prepend=spans[0] - 1)) if len(us) else []
        for lo, hi in zip(starts, [*starts[1:], len(us)]):
            span, sink = int(spans[lo]), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(t.slice(lo, hi - lo).combine_chunks())
            own = self.pieces.setdefault(span, [])
            own.append(max(own, default=-1) + 1)
            self.waiting.updateValue((span, own[-1]), (int(us[lo]), sink.getvalue().to_pybytes()))

    def _take(self, span: int) -> pa.Table:
        """The rows of a span, which wait no longer, by time and id."""
        parts = []
        for piece in self.pieces.pop(span):
            parts.append(pa.ipc.open_stream(bytes(self.waiting.getValue((span, piece))[1])).read_all())
            self.waiting.removeKey((span, piece))
        t = pa.concat_tables(parts)
        return t.set_column(1, "id", pc.fill_null(t["id"], "")).sort_by([("us", "ascending"), ("id", "ascending")])

    def _ripe(self, key, watermark_ms: int) -> Iterator[pd.DataFrame]:
        if not self.pieces:
            return
        until = watermark_ms * 1000  # rows up to here are ripe
        for span in sorted(s for s in self.pieces if s * SPAN_US <= until):
            t = self._take(span)
            n = int(np.searchsorted(t["us"].to_numpy(), until, "right"))
            if n < len(t):
                self._keep(t.slice(n))
            if n:
                yield from self.advance(key, t.slice(0, n))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if self.pieces:  # a timer is in milliseconds: the first one at which the oldest row is ripe
            span = min(self.pieces)
            first = min(self.waiting.getValue((span, p))[0] for p in self.pieces[span])
            self.handle.registerTimer(-(-first // 1000))

    def advance(self, key, rows: pa.Table) -> Iterator[pd.DataFrame]:
        raise NotImplementedError


class ArrivalWindows(_Ordered):
    """T-1: a window opens with a message, closes with the first one ``width`` later."""

    numbers = SUMS

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open = handle.getValueState("open", "opened long, n long, " + ", ".join(f"{c} double" for c in SUMS))

    def advance(self, key, rows):
        us, ids = rows["us"].to_numpy(), rows["id"]
        values = np.column_stack([rows[c].to_numpy() for c in SUMS])
        if self.open.exists():
            opened, n, *sums = self.open.get()
            sums = np.array(sums)
        else:
            opened, n, sums = int(us[0]), 0, np.zeros(len(SUMS))
        out, i = [], 0
        while i < len(us):
            j = int(np.searchsorted(us, opened + self.width))  # the message that closes
            if j >= len(us):
                n, sums = n + len(us) - i, sums + values[i:].sum(axis=0)
                break
            k = j + 1  # rows alike in time and id are one message
            while k < len(us) and us[k] == us[j] and ids[k].as_py() == ids[j].as_py():
                k += 1
            out.append((*key, opened, int(us[j]), n + k - i, *(sums + values[i:k].sum(axis=0))))
            opened, n, sums, i = int(us[j]), 0, np.zeros(len(SUMS)), k
        self.open.update((opened, n, *map(float, sums)))
        if out:
            yield pd.DataFrame(out, columns=["key", "opened", "closed", "n", *SUMS])


def arrival_metrics_stream(scored: DataFrame, width_seconds: float, key: str, ts_col: str = "timestamp",
                           id_col: str = "id", delay: str | None = "10 minutes") -> DataFrame:
    """T-1 on a stream: the metrics of the arrival-anchored windows of each ``key`` as they
    close, the same rows as ``operators.arrival.arrival_metrics``. ``delay`` None: ``scored``
    carries its watermark already. A key's windows are one chain and so one state; rows with a null key take no
    part (give them a key first)."""
    keep_states(scored.sparkSession)
    s, n = scored if delay is None else with_lateness(scored, ts_col, delay), F.col("n")
    value = {"sentiment": F.col("sentiment_score"), "churn": F.col("churn_risk"), "toxicity": F.col("toxicity"),
             "positive": (F.col("sentiment_label") == "positive").cast("double"),
             "negative": (F.col("sentiment_label") == "negative").cast("double"),
             "high_churn": (F.col("churn_risk") > HIGH_CHURN_THRESHOLD).cast("double")}
    rows = s.select(F.col(key).alias("key"), F.col(ts_col), F.unix_micros(ts_col).alias("us"), F.col(id_col).cast("string").alias("id"),
                    *[F.coalesce(value[c].cast("double"), F.lit(0.0)).alias(c) for c in SUMS])
    out = rows.groupBy("key").transformWithStateInPandas(
        ArrivalWindows(round(width_seconds * 1_000_000)),
        f"key {scored.schema[key].dataType.simpleString()}, opened long, closed long, n long, " + ", ".join(f"{c} double" for c in SUMS),
        "append", "EventTime")
    count = lambda c: F.col(c).cast("long")
    return out.select(
        F.col("key").alias(key), F.timestamp_micros("opened").alias("window_start"), F.timestamp_micros("closed").alias("window_end"),
        n.alias("count"), (F.col("sentiment") / n).alias("avg_sentiment"), count("positive").alias("positive_count"),
        count("negative").alias("negative_count"), (n - count("positive") - count("negative")).alias("neutral_count"),
        (F.col("churn") / n).alias("avg_churn_risk"), count("high_churn").alias("high_churn_count"),
        (F.col("toxicity") / n).alias("avg_toxicity"))


class Velocity(StatefulProcessor):
    """The change of a key's windowed mean against its window before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "start timestamp, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a key closes few windows in a micro-batch, and closes them in order from one to the next
        now = pd.concat(list(rows)).sort_values("window_start")
        start, value = now["window_start"], now["value"]
        if self.last.exists():
            before_start, before_value = self.last.get()
            before_start = pd.Series([pd.Timestamp(before_start), *start[:-1]], index=now.index)
            before_value = pd.Series([before_value, *value[:-1]], index=now.index)
        else:
            before_start, before_value = start.shift(), value.shift()
        self.last.update((start.iloc[-1].to_pydatetime(), float(value.iloc[-1])))
        elapsed = (start - before_start).dt.total_seconds()
        yield pd.DataFrame({"dim": key[0], "key": key[1], "window_start": start, "value": value,
                            "delta": value - before_value, "elapsed_sec": elapsed,
                            "velocity": (value - before_value) / elapsed.where(elapsed != 0)})


def velocity_stream(windowed: DataFrame, value_col: str = "avg_sentiment") -> DataFrame:
    """W5 on a stream: ``trend_velocity`` of the closed windows of ``windowed`` (what
    ``windowed_stream`` gives in append mode), chained behind that aggregation."""
    keep_states(windowed.sparkSession)
    rows = windowed.select("dim", "key", "window_start", F.col(value_col).cast("double").alias("value"))
    out = rows.groupBy("dim", "key").transformWithStateInPandas(
        Velocity(), "dim string, key string, window_start timestamp, value double, delta double, elapsed_sec double, "
        "velocity double", "append", "None")
    nan = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)  # noqa: E731  pandas has NaN for what is missing
    return out.select("dim", "key", "window_start", F.col("value").alias(value_col), nan("delta"), nan("elapsed_sec"), nan("velocity"))


class Ring(StatefulProcessor):
    """The newest points of a key, no more than ``n``; forgotten when the watermark is
    ``ttl_ms`` past the newest."""

    def __init__(self, n: int, ttl_ms: int):
        self.n, self.ttl_ms = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getListState("points", "us long, id string, score double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = ["us", "id", "score"]
        kept = pd.DataFrame([tuple(p) for p in self.points.get()], columns=names) if self.points.exists() else None
        for part in rows:
            kept = part[names] if kept is None else pd.concat([kept, part[names]])
            kept = kept.sort_values(["us", "id"], ascending=False).head(self.n)
        self.points.put([(int(u), i, None if pd.isna(x) else float(x)) for u, i, x in kept.itertuples(index=False)])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(int(kept["us"].iloc[0]) // 1000 + self.ttl_ms)
        yield kept.assign(key=key[0], slice=key[1])[["key", "slice", "us", "id", "score"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.points.clear()
        return iter([])


def recent_points_stream(scored: DataFrame, key: str, n: int = 50, slices: int = 8, ttl_hours: int = 24,
                         ts_col: str = "timestamp", id_col: str = "id", score_col: str = "sentiment_score",
                         delay: str | None = "10 minutes") -> DataFrame:
    """W1 on a stream: the newest ``n`` points of each slice of a ``key``, whenever the slice
    gets new ones (update mode). A key's rows are dealt to ``slices`` by their id, so a hot
    key is not one task; ``merge_points`` puts the slices together. A slice is forgotten
    when the watermark is ``ttl_hours`` past its newest point (processing time would do,
    but a stream with such timers never runs dry). Rows without a time or id are left out;
    ``delay`` None: ``scored`` carries its watermark already."""
    keep_states(scored.sparkSession)
    s = scored if delay is None else with_lateness(scored, ts_col, delay)
    rows = s.select(F.col(key).cast("string").alias("key"), F.pmod(F.xxhash64(id_col), F.lit(slices)).alias("slice"), F.col(ts_col),
                    F.unix_micros(ts_col).alias("us"), F.col(id_col).cast("string").alias("id"),
                    F.col(score_col).cast("double").alias("score")).where("us IS NOT NULL AND id IS NOT NULL")
    return rows.groupBy("key", "slice").transformWithStateInPandas(
        Ring(n, ttl_hours * 3_600_000), "key string, slice long, us long, id string, score double", "update", "EventTime")


def merge_points(versions: DataFrame, key: str, n: int = 50) -> DataFrame:
    """W1 read side: from every version of the slices (``recent_points_stream`` with a
    ``batch_id``) the newest ``n`` points of each key, as ``trends.recent_trend`` gives them."""
    newest = versions.groupBy("key", "slice").agg(F.max("batch_id").alias("batch_id"))
    points = versions.join(newest, ["key", "slice", "batch_id"], "left_semi").select(
        F.col("key").alias(key), "id", F.timestamp_micros("us").alias("timestamp"), F.col("score").alias("sentiment_score"))
    return recent_trend(points, n, keys=[key])
