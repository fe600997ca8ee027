"""Resolution of not-modified revisit records in web captures.

A revisit ("304, not modified") stands for the latest earlier full response of
the same canonical URL, if the validators agree; its headers are then the
response's, updated by those that the revisit may change.

The as-of join sorts the narrow rows by (URL, time, id) in range partitions,
which split a URL of any size, and carries the last full response forward
within each partition; what a partition's first URL lacks comes from a table of
one row per partition. Payloads do not move, and headers meet in one
join by record id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.common import width, written

# fixed values: header fields that a not-modified answer does not update
NOT_UPDATED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
               "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer",
               "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path without a last slash, and
    the sorted query without tracking fields (utm_*); no scheme, no fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z]+://", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    query = F.array_join(F.array_sort(F.filter(
        F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda q: (q != "") & ~q.startswith("utm_"))), "&")
    return F.concat(F.regexp_replace(F.lower(host), ":(80|443)$", ""),
                    F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/$", ""),
                    F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _carry(batches):
    """Rows in order with the last full response of their URL so far in this
    partition (null at its head), and at the end a row with what to carry on."""
    part = TaskContext.get().partitionId()
    last_key, last_id = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, rid, full = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
        n = len(rid)
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = key[0].as_py() != last_key
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        before = np.concatenate([[-1], np.maximum.accumulate(np.where(full, np.arange(n), -1))[:-1]])
        own = before >= start  # a full response before it, in this batch
        go_on = (start == 0) & ~new[0]  # the URL that the last batch ended in
        refers = np.where(own, rid[np.maximum(before, 0)], last_id if last_id is not None else 0)
        known = own | (go_on & (last_id is not None))
        head = ~known
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part] * n, pa.int32()), "url_key": key, "record_id": pa.array(rid),
            "refers_to": pa.array(refers, pa.int64(), mask=head), "carry": pa.array([False] * n)})
        i = n - 1
        if full[i]:
            last_id = int(rid[i])
        elif known[i]:
            last_id = int(refers[i])
        else:
            last_id = None
        last_key = key[i].as_py()
    if last_key is not None:
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "url_key": pa.array([last_key], pa.string()),
            "record_id": pa.array([None], pa.int64()), "refers_to": pa.array([last_id], pa.int64()),
            "carry": pa.array([True])})


def latest_response(records: DataFrame) -> DataFrame:
    """(record_id, refers_to): for every record the id of the latest earlier full
    response with its url_key, by (ts, record_id); null if there is none."""
    spark = records.sparkSession
    rows = records.select("url_key", "record_id", "full", "ts") \
        .repartitionByRange(width(spark), "url_key", "ts", "record_id") \
        .sortWithinPartitions("url_key", "ts", "record_id").select("url_key", "record_id", "full")
    out = written(rows.mapInArrow(_carry, "part int, url_key string, record_id long, refers_to long, carry boolean"),
                  "carried")
    # one row per partition: what its last URL hands on to the partitions after it
    ends = out.where("carry").select(F.col("part").alias("p"), F.col("url_key").alias("k"), F.col("refers_to").alias("r"))
    hand = ends.select("k", (F.col("p") + 1).alias("part"), F.last("r", ignorenulls=True).over(
        Window.partitionBy("k").orderBy("p")).alias("handed"))
    rows = out.where("NOT carry")
    return rows.join(hand, (rows.url_key == hand.k) & (rows.part == hand.part), "left") \
        .select("record_id", F.coalesce("refers_to", "handed").alias("refers_to"))


def resolve(records: DataFrame) -> DataFrame:
    """Every revisit of ``records`` with url_key, refers_to, outcome and headers.

    Needs ``record_id`` (integer, unique), ``url``, ``ts`` (orderable),
    ``kind`` ("response" or "revisit"), ``status`` (int) and ``headers`` (map
    of strings); other columns are ignored. A full response is a response
    with status 200. ``outcome``: "resolved"; "mismatch", when the latest
    earlier full response has other validators (an ETag is compared weakly and
    counts before Last-Modified); "unchecked", when the two share no validator;
    "no response", when there is no earlier one. Headers (names in lower case)
    are merged for resolved revisits and otherwise the revisit's own. Records
    of the same time follow each other by record_id. A null url has no
    earlier response; null headers are none; rows without record_id or ts are
    left out. An empty table gives an empty result.
    """
    # the last of several fields that differ in case counts
    lower = F.map_from_entries(F.map_entries(F.aggregate(
        F.map_entries(F.coalesce("headers", F.expr("map()").cast("map<string,string>"))),
        F.expr("map()").cast("map<string,string>"),
        lambda m, x: F.map_concat(F.map_filter(m, lambda k, v: k != F.lower(x["key"])),
                                  F.create_map(F.lower(x["key"]), x["value"])))))
    rec = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "ts", "kind", "status", lower.alias("headers")) \
        .where("record_id IS NOT NULL AND ts IS NOT NULL")
    rec = written(rec.withColumn("full", F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False))),
                  "records")
    prior = latest_response(rec.where("url_key IS NOT NULL"))
    old = rec.where("full").select(F.col("record_id").alias("refers_to"), F.col("headers").alias("old"))
    r = rec.where("kind = 'revisit'").join(prior, "record_id", "left")
    # revisits without an earlier response do not go through the join: they would share one key
    r = r.where("refers_to IS NOT NULL").join(old, "refers_to", "left").unionByName(
        r.where("refers_to IS NULL").withColumn("old", F.lit(None).cast("map<string,string>")))
    weak = lambda m: F.regexp_replace(F.col(m)["etag"], "^W/", "")
    same = F.coalesce(weak("headers") == weak("old"), F.col("headers")["last-modified"] == F.col("old")["last-modified"])
    outcome = F.when(F.col("old").isNull(), "no response").when(same, "resolved") \
        .when(~same, "mismatch").otherwise("unchecked")
    permitted = F.map_filter("headers", lambda k, v: ~k.isin(*NOT_UPDATED))
    merged = F.map_concat(F.map_filter("old", lambda k, v: ~F.map_contains_key(permitted, k)), permitted)
    return r.withColumn("outcome", outcome).select(
        "record_id", "url_key", "refers_to", "outcome",
        F.when(F.col("outcome") == "resolved", merged).otherwise(F.col("headers")).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """A capture log of ``pages``: for every page a full response and, at fixed
    distances, a second one with another body and revisits under other
    spellings of the URL, with equal, weak, outdated, dated and no validators, and
    one before any response."""
    start = F.lit(1704067200) + F.col("page_id") * 60
    tag = lambda text: F.concat(F.lit('"'), F.substring(F.md5(text), 1, 16), F.lit('"'))
    etag, etag2 = tag(F.col("html")), tag(F.concat("html", F.lit("2")))
    more = F.concat("url", F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_source=x"))
    size = F.octet_length("html")

    def record(k, when, ts, url, kind, status, length, *headers):
        pairs = [x for name, value in headers for x in (F.lit(name), value.cast("string"))]
        return F.when(when, F.struct(
            (F.col("page_id") * 8 + k).alias("record_id"), url.alias("url"), ts.alias("ts"), F.lit(kind).alias("kind"),
            F.lit(status).alias("status"), F.create_map(*pairs).alias("headers"), length.cast("long").alias("n_bytes")))

    page, none = F.col("page_id"), F.lit(0)
    full = lambda t, e, n, ts: (("ETag", t), ("Last-Modified", ts), ("Content-Type", F.lit("text/html")),
                                ("Content-Length", n), ("X-Cache", F.lit("MISS")), ("Date", ts))
    seen = lambda ts: (("Date", ts), ("X-Cache", F.lit("HIT")), ("Content-Length", none))
    swap = F.concat(F.regexp_replace("url", "^http://", "https://"), F.lit("#again"))
    t = [start + x for x in (0, 3600, 7200, 10800, 14400, -60, 18000)]
    rows = F.array(
        record(0, F.lit(True), t[0], F.col("url"), "response", 200, size, *full(etag, None, size, t[0])),
        record(1, F.lit(True), t[1], swap, "revisit", 304, none, ("ETag", etag), *seen(t[1])),
        record(2, page % 3 == 0, t[2], F.col("url"), "response", 200, size + 1, *full(etag2, None, size + 1, t[2])),
        record(3, F.lit(True), t[3], more, "revisit", 304, none, ("ETag", F.concat(F.lit("W/"), etag)), *seen(t[3])),
        record(4, page % 4 == 0, t[4], F.col("url"), "revisit", 304, none, ("Last-Modified", t[0]), *seen(t[4])),
        record(5, page % 7 == 0, t[5], F.col("url"), "revisit", 304, none, ("ETag", etag), *seen(t[5])),
        record(6, page % 5 == 0, t[6], F.col("url"), "revisit", 304, none, *seen(t[6])))
    return pages.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select("x.*")


def digest(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Resolved revisits with the payload's size and the headers as text."""
    size = records.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), "n_bytes")
    text = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda x: F.concat(
        x["key"], F.lit("="), x["value"]))), "; ")
    done = resolved.where("outcome = 'resolved'").join(size, "refers_to", "left")
    rest = resolved.where("outcome <> 'resolved'").withColumn("n_bytes", F.lit(None).cast("long"))
    return done.unionByName(rest).select(
        "record_id", "url_key", "refers_to", "outcome", "n_bytes", text.alias("headers"))
