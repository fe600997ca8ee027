"""A keyed metrics store that is read while it is written.

Data files are never changed. A version of the store is a manifest: a small JSON file
that names the data folders the version consists of. A writer puts new data into a
folder of its own and then commits the next manifest with one rename that fails if that
version exists; the loser of a race reads the winner's manifest and tries again. A reader
takes the newest manifest and reads the folders that it names, so it sees one whole
version, whatever upserts and compactions happen meanwhile. Folders that no kept version
names are deleted by ``vacuum`` alone.

A micro-batch that is replayed replaces its own part, or is left out if a compaction has
taken it in already. The rename is atomic on HDFS and on POSIX file systems; on an object
store use one that offers it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from py4j.protocol import Py4JJavaError

from feedlens.operators import trends as T


class Conflict(Exception):
    """The version to be committed is there already."""


class _Folder:
    """The few file system calls that the store makes, on the driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root
        self.gateway = spark.sparkContext._gateway
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_once(self, name: str, text: str) -> None:
        """Write a file under a name that must be free, by one rename."""
        parent, _, last = name.rpartition("/")
        self.fs.mkdirs(self.path(parent))
        step = self.path(f"{parent}/.{last}-{uuid.uuid4().hex}")
        out = self.fs.create(step)
        out.write(bytearray(text.encode()))
        out.close()
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.gateway.new_array(kind, 1)
        how[0] = kind.NONE
        try:
            self.context.rename(step, self.path(name), how)
        except Py4JJavaError as e:
            self.fs.delete(step, False)
            if "FileAlreadyExists" in str(e.java_exception):
                raise Conflict(name) from e
            raise
        except PySparkException:
            self.fs.delete(step, False)
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class VersionedStore:
    """One row for each of ``keys``, the last by ``order`` and then by micro-batch."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = ("dim", "key"), order: str = "window_end"):
        self.spark, self.path, self.keys, self.order = spark, path, list(keys), order
        self.folder = _Folder(spark, path)

    # a manifest: version, schema, through (micro-batches up to it are in the base), parts [{folder, batch}]
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.folder.names("_versions") if n.endswith(".json") and n[0] != "."]

    def manifest(self, version: int | None = None) -> dict:
        """Of a version, the newest by default; version 0 is the empty store."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, "schema": None, "through": -1, "parts": []}
        return json.loads(self.folder.read(f"_versions/{version:012d}.json"))

    def _commit(self, change) -> int:
        """Commit what ``change`` makes of the newest manifest (None: nothing to do)."""
        while True:
            old = self.manifest()
            new = change(old)
            if new is None:
                return old["version"]
            version = old["version"] + 1
            try:
                self.folder.put_once(f"_versions/{version:012d}.json", json.dumps(new | {"version": version}))
                return version
            except Conflict:
                continue

    def _write(self, rows: DataFrame, name: str) -> str:
        folder = f"data/{name}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def _latest(self, rows: DataFrame) -> DataFrame:
        return T.latest_metrics(rows, keys=self.keys, order_col=[self.order, "batch_id"])

    def upsert(self, batch: DataFrame, batch_id: int) -> int:
        """Put the rows of a micro-batch in; for ``foreachBatch``. The version that has them."""
        rows = self._latest(batch.withColumn("batch_id", F.lit(batch_id).cast("long")))
        schema, folder = rows.schema.json(), None

        def change(old):
            nonlocal folder
            if batch_id <= old["through"]:
                return None
            folder = folder or self._write(rows, f"batch-{batch_id}")
            parts = [p for p in old["parts"] if p["batch"] != batch_id]
            return old | {"schema": schema, "parts": [*parts, {"folder": folder, "batch": batch_id}]}
        return self._commit(change)

    def compact(self, as_of=None, ttl_hours: int | None = None, ts_col: str = "last_updated") -> int:
        """Fold the parts into a base of one row per key, without keys that were last
        written ``ttl_hours`` before ``as_of`` or earlier. Parts committed meanwhile stay."""
        seen = self.manifest()
        if not seen["parts"]:
            return seen["version"]
        rows = self._latest(self._read(seen))
        if ttl_hours is not None:
            rows = T.live_metrics(rows, as_of, ttl_hours, ts_col)
        base = {"folder": self._write(rows, "base"), "batch": -1}
        through = max([seen["through"], *(p["batch"] for p in seen["parts"])])
        folded = {p["folder"] for p in seen["parts"]}

        def change(old):
            if not folded <= {p["folder"] for p in old["parts"]}:
                return None  # another compaction, or a replay, was faster; its version stands
            return old | {"through": through, "parts": [base, *(p for p in old["parts"] if p["folder"] not in folded)]}
        return self._commit(change)

    def _read(self, manifest: dict) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p['folder']}" for p in manifest["parts"]])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default. The version is fixed now; the rows
        are read when the frame is used, which ``vacuum`` must leave time for."""
        manifest = self.manifest(version)
        if not manifest["parts"]:
            raise ValueError(f"nothing was put into {self.path} yet")
        return self._latest(self._read(manifest)).drop("batch_id")

    def live(self, as_of, ttl_hours: int = 24, ts_col: str = "last_updated") -> DataFrame:
        """The rows written within ``ttl_hours`` before ``as_of``."""
        return T.live_metrics(self.read(), as_of, ttl_hours, ts_col)

    def vacuum(self, keep: int = 10) -> list[str]:
        """Delete the folders that none of the last ``keep`` versions names, and the older
        manifests. A folder of a commit that is under way is newer than the newest manifest
        and stays."""
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        if not kept:
            return []
        named = {p["folder"] for m in kept for p in m["parts"]}
        old = {p["folder"] for v in versions[:-keep] for p in self.manifest(v)["parts"]}
        gone = sorted(old - named)
        for name in gone:
            self.folder.delete(name)
        for v in versions[:-keep]:
            self.folder.delete(f"_versions/{v:012d}.json")
        return gone
