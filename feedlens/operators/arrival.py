"""Arrival-anchored windows (T-1 as the reference cuts them), batch form.

A window opens at a message's arrival and closes with the first message that comes
``width`` or more later; that message still belongs to it, and its arrival opens the
next window. So windows have no fixed grid: each one depends on where the last one
closed, and a key's windows are a chain through its arrival times.

The chain is followed without reading a key's messages in one place:

1. Arrival times are cut into spans of ``SPAN`` widths. A chain enters a span at one of
   the times of its first width, or at the first time after that, whatever came before.
   For each such entry one task per (key, span) finds where the chain leaves.
2. Leaving one span fixes the entry of a later one. These links, a small part of all
   times, are followed from each key's first message by pointer doubling: as many joins
   as the logarithm of the number of spans.
3. With its entry known, each span lists the windows that open in it.

A span holds distinct times only, so its size is bounded by the clock's resolution and
not by how many messages a key has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.operators import metrics as M
from feedlens.session import stored

SPAN = 64  # widths of a span


def _chain_ends(us: np.ndarray, width: int) -> np.ndarray:
    """For each time (ascending) the last time of the chain that starts there."""
    nxt = np.searchsorted(us, us + width)
    last = np.arange(len(us))
    nxt = np.append(nxt, len(us))  # beyond the end stays beyond
    last = np.append(last, len(us))
    step = nxt
    while (step[:-1] < len(us)).any():
        ahead = step < len(us)
        last = np.where(ahead, last[np.minimum(step, len(us) - 1)], last)
        step = step[step]
    return us[last[:-1]]


def _entries(width: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("us")
        us, span = t["us"].to_numpy(), t["span"].to_numpy()[0]
        early = int(np.searchsorted(us, (span * SPAN + 1) * width))
        n = min(early + 1, len(us))
        want = _chain_ends(us, width)[:n] + width
        return t.select(["chain", "span", "us"]).slice(0, n).append_column("want", pa.array(want))
    return run


def _opened(width: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("us")
        us, at = t["us"].to_numpy(), np.flatnonzero(t["entry"].to_numpy(zero_copy_only=False))
        nxt, opened = np.searchsorted(us, us + width), []
        i = int(at[0]) if len(at) else len(us)
        while i < len(us):
            opened.append(i)
            i = int(nxt[i])
        return t.select(["chain", "us", "first_id"]).take(pa.array(opened, pa.int64()))
    return run


def window_openings(arrivals: DataFrame, width: int) -> DataFrame:
    """(chain, us, first_id) of the arrivals that open a window, from ``arrivals(chain, us,
    first_id)`` with one row for each time of a chain; ``us`` and ``width`` in microseconds."""
    by = ["chain", "span"]
    nodes = stored(arrivals.withColumn("span", F.floor(F.col("us") / (width * SPAN)).cast("long")), "arrivals")
    entries = stored(nodes.select(*by, "us").groupBy(*by).applyInArrow(
        _entries(width), "chain string, span long, us long, want long"), "entries")

    # where a chain that leaves goes on: in the next span, or with the first of the next span that has any
    marks = entries.select(*by, F.col("us").alias("at"), F.lit(0).alias("asks"), F.lit(None).cast("long").alias("us"))
    asks = entries.select("chain", (F.col("span") + 1).alias("span"), F.col("want").alias("at"), F.lit(1).alias("asks"), "us")
    falling = Window.partitionBy(*by).orderBy(F.desc("at"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = marks.unionByName(asks) \
        .withColumn("hit", F.last(F.when(F.col("asks") == 0, F.col("at")), ignorenulls=True).over(falling)) \
        .where("asks = 1").select("chain", (F.col("span") - 1).alias("span"), "us", "hit")
    in_order = Window.partitionBy("chain").orderBy("span")  # a chain's spans, one row each
    spans = stored(nodes.groupBy(*by).agg(F.min("us").alias("first")).select(
        *by, F.row_number().over(in_order).alias("place"), F.lead("span").over(in_order).alias("span1"),
        F.lead("first").over(in_order).alias("first1"), F.lead("first", 2).over(in_order).alias("first2")), "spans")
    later = F.when(F.col("span1") == F.col("span") + 1, F.col("first2")).otherwise(F.col("first1"))
    jump = stored(found.join(spans, by).select("chain", "us", F.coalesce("hit", later).alias("next"))
                  .where("next IS NOT NULL"), "links")

    most = spans.agg(F.max("place")).first()[0] or 0
    reached = stored(nodes.groupBy("chain").agg(F.min("us").alias("us")), "reached")
    for _ in range(int(most).bit_length()):
        more = reached.join(jump, ["chain", "us"]).select("chain", F.col("next").alias("us"))
        reached = stored(reached.unionByName(more), "reached")
        onward = jump.select("chain", F.col("us").alias("next"), F.col("next").alias("beyond"))
        jump = stored(jump.join(onward, ["chain", "next"]).select("chain", "us", F.col("beyond").alias("next")), "links")
    entry = reached.distinct().withColumn("entry", F.lit(True))
    return nodes.join(entry, ["chain", "us"], "left").withColumn("entry", F.coalesce("entry", F.lit(False))) \
        .groupBy(*by).applyInArrow(_opened(width), "chain string, us long, first_id string")


def arrival_windows(df: DataFrame, width_seconds: float, keys: list[str] | None = None, ts_col: str = "timestamp",
                    id_col: str = "id") -> DataFrame:
    """``df`` with (window_start, window_end): the arrival that opened a row's window, and
    the arrival that closed it (null while it is open), per ``keys`` (none: one chain).

    Rows of a key are in the order of (ts_col, id_col), null ids first. The first row opens
    the first window; the first row at ``width_seconds`` or more after the opening closes
    it, belongs to it, and opens the next one with its arrival time. Rows alike in time and
    id count as one message, rows without a time belong to no window and are left out;
    a null key is a key of its own."""
    width = round(width_seconds * 1_000_000)
    cell = F.floor(F.col("us") / width).cast("long")
    chain = F.to_json(F.struct(*keys)) if keys else F.lit("{}")
    rows = df.select(F.struct(*df.columns).alias("row"), chain.alias("chain"),
                     F.unix_micros(F.col(ts_col).cast("timestamp")).alias("us"),
                     F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id")).where("us IS NOT NULL")
    arrivals = rows.groupBy("chain", "us").agg(F.min("id").alias("first_id"))
    openings = window_openings(arrivals, width)

    # two openings are a width apart at least, so a cell of that width has one at most
    up = Window.partitionBy("chain").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("chain").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    cells = stored(arrivals.select("chain", cell.alias("cell")).distinct().join(
        openings.select("chain", cell.alias("cell"), F.col("us").alias("opens"), "first_id"), ["chain", "cell"], "left")
        .withColumns({"before": F.last("opens", ignorenulls=True).over(up),
                      "after": F.last("opens", ignorenulls=True).over(down)}), "cells")
    closing = (F.col("us") == F.col("opens")) & (F.col("id") == F.col("first_id")) & F.col("before").isNotNull()
    own = F.coalesce((F.col("us") >= F.col("opens")) & ~closing, F.lit(False))
    start = F.when(own, F.col("opens")).otherwise(F.col("before"))
    end = F.when(own, F.col("after")).otherwise(F.coalesce("opens", "after"))
    return rows.withColumn("cell", cell).join(cells, ["chain", "cell"]).select(
        "row.*", F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(end).alias("window_end"))


def arrival_metrics(df: DataFrame, width_seconds: float, keys: list[str], ts_col: str = "timestamp",
                    id_col: str = "id") -> DataFrame:
    """T-1: the metrics of the closed arrival-anchored windows of each key."""
    w = arrival_windows(df, width_seconds, keys, ts_col, id_col).where("window_end IS NOT NULL")
    return w.groupBy(*keys, "window_start", "window_end").agg(*M.metric_aggs(None, emotions=False))
