"""Latency statistics and throughput.

Exact order statistics without sorting a whole group in one task: rows are first
counted by (keys, value), which also takes ties together; the distinct values of
a key are cut into BINS ranges at approximate quantiles, so a key holding a third
of all rows is spread over BINS groups; counts by bin give the number of rows
before each bin, and only the bins that hold a wanted rank are ranked, by
cumulative counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.session import stored

BINS = 32
LEAF = 100_000  # distinct values that one task ranks


def values_at_ranks(df: DataFrame, keys: list[str], value_col: str, ranks: dict[str, Column]) -> DataFrame:
    """Per key the values at 1-based ``ranks`` (columns over ``n``, the rows of the
    key) as columns of those names, and ``n``. Null keys are a key of their own.

    Rows are counted by (key, value). A key's values are cut into BINS and only the bins
    that hold a wanted rank go on; as long as one of those may have more than LEAF values
    it is cut again. So no task ranks more than about LEAF values, whatever a key has."""
    named = df.groupBy(*keys, value_col).agg(F.count(F.lit(1)).alias("_c")) \
        .withColumn("_k", F.to_json(F.struct(*keys)))
    totals = named.groupBy("_k").agg(F.sum("_c").alias("n"), F.first(F.struct(*keys)).alias("_keys"))
    h = named.join(totals, "_k").select("_k", "_keys", "n", F.lit(0).cast("long").alias("_path"), F.lit(0).cast("long").alias("_off"),
                                        F.col(value_col).alias("_v"), "_c")
    # a row has 8 bytes at least: when this many values cannot be there, once is enough
    most = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // 8
    while True:
        h = _wanted_bins(h, ranks)
        if most <= LEAF * BINS:
            break
        h = stored(h, "bins")
        most = h.groupBy("_k", "_path").agg(F.count("*").alias("d")).agg(F.max("d")).first()[0] or 0
        if most <= LEAF:
            break
    r = h.select("_k", "_keys", "n", "_v", "_c", (F.col("_off") + F.sum("_c").over(
        Window.partitionBy("_k", "_path").orderBy("_v"))).alias("_hi"))
    lo = F.col("_hi") - F.col("_c")
    return r.groupBy("_k").agg(F.first("_keys").alias("_keys"), F.max("n").alias("n"), *[
        F.max(F.when((rank > lo) & (rank <= F.col("_hi")), F.col("_v"))).alias(name)
        for name, rank in ranks.items()]).select("_keys.*", "n", *ranks)


def _wanted_bins(h: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """Each (_k, _path) cut into BINS by its values, without the bins that hold no wanted rank."""
    cuts = h.groupBy("_k", "_path").agg(F.percentile_approx("_v", [i / BINS for i in range(1, BINS)], 1000).alias("_cuts"))
    h = h.join(cuts, ["_k", "_path"]).withColumn("_b", F.size(F.filter("_cuts", lambda x: x < F.col("_v")))).drop("_cuts")
    w = Window.partitionBy("_k", "_path").orderBy("_b")  # BINS rows at most
    bins = h.groupBy("_k", "_path", "_b").agg(F.sum("_c").alias("_in"), F.first("n").alias("n"), F.first("_off").alias("_from")) \
        .withColumn("_before", F.col("_from") + F.sum("_in").over(w) - F.col("_in"))
    wanted = reduce(lambda x, y: x | y, [(r > F.col("_before")) & (r <= F.col("_before") + F.col("_in")) for r in ranks.values()])
    bins = bins.where(wanted).select("_k", "_path", "_b", "_before")
    return h.join(bins, ["_k", "_path", "_b"]).select(
        "_k", "_keys", "n", (F.col("_path") * BINS + F.col("_b")).alias("_path"), F.col("_before").alias("_off"), "_v", "_c")


def _exclusive_ranks(n, i: int, q: int):
    """Python ``statistics.quantiles(method='exclusive')`` cut i of q:
    j = i(n+1) // q clamped to [1, n-1], delta = i(n+1) - j q; value =
    (x_j (q - delta) + x_{j+1} delta) / q (1-based ranks)."""
    m = n + 1
    j_raw = F.floor((m * i) / F.lit(q)).cast("long")
    j = F.greatest(F.lit(1), F.least(j_raw, n - 1))
    delta = m * i - j * q
    return j, delta


def latency_stats(df: DataFrame, col: str, keys: list[str] | None = None,
                  method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Count, mean, median, min, max, sample stdev, p95, p99 per key.

    Quantiles follow the exclusive method (position p(n+1), linear
    interpolation, edge extrapolation as in Python's statistics module).
    ``method='approx'`` uses ``percentile_approx`` instead (one pass, bounded
    memory; inclusive definition, rank error 1/accuracy)."""
    keys = list(keys or [])
    base = df.select(*keys, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    g = base.groupBy(*keys) if keys else base.groupBy()
    moments = [F.count(F.lit(1)).alias("count"), F.avg("_v").alias("mean"),
               F.min("_v").alias("min"), F.max("_v").alias("max"),
               F.stddev_samp("_v").alias("stdev")]
    if method == "approx":
        return g.agg(*moments,
                     F.median("_v").alias("median"),
                     F.percentile_approx("_v", 0.95, accuracy).alias("p95"),
                     F.percentile_approx("_v", 0.99, accuracy).alias("p99"))
    kcols = keys or ["_all"]
    if not keys:
        base = base.withColumn("_all", F.lit(1))
    n = F.col("n")
    j95, d95 = _exclusive_ranks(n, 19, 20)
    j99, d99 = _exclusive_ranks(n, 99, 100)
    picks = values_at_ranks(base, kcols, "_v", {
        "_mlo": F.floor((n + 1) / 2).cast("long"), "_mhi": F.ceil((n + 1) / 2).cast("long"),
        "_a95": F.greatest(j95, F.lit(1)), "_b95": j95 + 1, "_a99": F.greatest(j99, F.lit(1)), "_b99": j99 + 1})

    def interp(a, b, d, q):
        b2 = F.coalesce(F.col(b), F.col(a))
        return (F.col(a) * (F.lit(q) - d) + b2 * d) / F.lit(q)

    quant = picks.select(
        *[F.col(k).alias(f"_q{k}") for k in kcols],
        ((F.col("_mlo") + F.col("_mhi")) / 2).alias("median"),
        F.when(n == 1, F.col("_a95")).otherwise(interp("_a95", "_b95", d95, 20)).alias("p95"),
        F.when(n == 1, F.col("_a99")).otherwise(interp("_a99", "_b99", d99, 100)).alias("p99"))
    mom = base.groupBy(*kcols).agg(*moments)
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_q{k}")) for k in kcols])
    return mom.join(quant, on).drop("_all", *[f"_q{k}" for k in kcols])


def throughput(stats: DataFrame, batch_size: int = 1, mean_col: str = "mean") -> DataFrame:
    """Requests (texts) per second from a mean latency in milliseconds;
    NULL for a zero mean (``try_divide``: no failure under ANSI mode)."""
    return stats.withColumn("throughput_per_sec",
                            F.try_divide(F.lit(batch_size) * F.lit(1000.0), F.col(mean_col)))


SKETCH_K = 800  # size of a quantile sketch
RANK_ERROR = 0.01  # of n; that size stays below 0.0056 with 99 % certainty


def quantile_sketches(df: DataFrame, col: str, keys: list[str], ts_col: str, width: str) -> DataFrame:
    """A8 over windows: per (keys, window) count, sum, least and greatest value and a
    mergeable quantile sketch (KLL) of ``col``. A few kB a window, batch or stream; a hot
    key is sketched where it is read and merged."""
    v = F.col(col).cast("double")
    return df.where(v.isNotNull()).groupBy(*keys, F.window(ts_col, width).alias("window")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.min(v).alias("least"), F.max(v).alias("greatest"),
        F.kll_sketch_agg_double(v, SKETCH_K).alias("sketch")) \
        .select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "n", "total", "least", "greatest", "sketch")


def merge_sketches(sketches: DataFrame, keys: list[str], quantiles: dict[str, float]) -> DataFrame:
    """Read side: the windows of ``quantile_sketches`` merged per ``keys``: n, mean, min, max
    and an estimate for each quantile, whose rank is within RANK_ERROR * n of the true one."""
    g = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"), F.min("least").alias("min"),
        F.max("greatest").alias("max"), F.kll_merge_agg_double("sketch", SKETCH_K).alias("_sketch"))
    return g.select(*keys, "n", "mean", "min", "max", *[
        F.kll_sketch_get_quantile_double("_sketch", F.lit(q)).alias(name) for name, q in quantiles.items()])
