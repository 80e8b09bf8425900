"""Stored tables with indexes, changed by versioned commits.

Every table is hash-bucketed parquet; a bucket is a list of folders that are
never changed once written.  A small manifest (JSON) names the folders of all
buckets of all tables.  A write stages new folders beside the old ones and then
commits: the next manifest is written aside and renamed into place.  Readers
take the last manifest, so they see a write whole (the documents and every
index that goes with them) or not at all, and a writer that dies before the
rename leaves files that nobody reads.  Two writers that began from the same
version cannot both commit.

A manifest has one entry for each table, bucket and folder, so its size follows
the bucket count, not the data; ``compact`` joins the folders of a bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import delete_path
from quarry.sources.layout_store import bucket_of, literal_bucket


class Conflict(RuntimeError):
    """Another writer committed first."""


class _Files:
    """The few file operations a commit needs, in any Hadoop file system."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(base).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def children(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [str(s.getPath().getName()) for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def write_new(self, name: str, data: bytes) -> bool:
        """Write a file whole, or not at all if there is one of that name."""
        aside, at = self.path(f"{name}.{uuid.uuid4().hex[:12]}.tmp"), self.path(name)
        out = self.fs.create(aside, False)
        out.write(bytearray(data))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(aside), self.fs.makeQualified(at),
                           self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as exc:  # py4j wraps the Java exception
            self.fs.delete(aside, False)
            if "FileAlreadyExistsException" in str(exc):
                return False
            raise
        return True

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()


class VersionedStore:
    """Tables under ``base`` at one version; ``refresh`` goes to the last."""

    def __init__(self, spark: SparkSession, base: str, manifest: dict):
        self.spark, self.base, self.manifest = spark, base.rstrip("/"), manifest

    # ------------------------------------------------------------ opening

    @classmethod
    def open(cls, spark: SparkSession, base: str, version: int | None = None) -> VersionedStore | None:
        """The store at its last (or a given) version; None if there is none."""
        base = base.rstrip("/")
        files = _Files(spark, base)
        found = sorted(int(n.split(".")[0]) for n in files.children(f"{base}/manifests") if n.endswith(".json"))
        if not found:
            return None
        number = found[-1] if version is None else version
        return cls(spark, base, json.loads(files.read(f"{base}/manifests/{number}.json")))

    @classmethod
    def create(cls, spark: SparkSession, base: str) -> VersionedStore:
        """An empty store, to be filled and committed as version 1."""
        return cls(spark, base, {"version": 0, "tables": {}})

    def refresh(self) -> VersionedStore:
        return type(self).open(self.spark, self.base) or self

    def fork(self, base: str) -> VersionedStore:
        """A store of its own with the same tables; nothing is copied, and its
        writes go to ``base``."""
        return type(self)(self.spark, base, {"version": 0, "tables": json.loads(json.dumps(self.manifest["tables"]))})

    # ------------------------------------------------------------ reading

    @property
    def version(self) -> int:
        return self.manifest["version"]

    def key(self, name: str) -> str:
        return self.manifest["tables"][name]["key"]

    def n_buckets(self, name: str) -> int:
        return self.manifest["tables"][name]["buckets"]

    def schema(self, name: str) -> StructType:
        return StructType.fromJson(self.manifest["tables"][name]["schema"])

    def table(self, name: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """All rows of a table, or those of some buckets."""
        of = self.manifest["tables"][name]["folders"]
        folders = [f for b in (of if buckets is None else map(str, sorted(set(buckets)))) for f in of.get(b, ())]
        if not folders:
            return self.spark.createDataFrame([], self.schema(name))
        return self.spark.read.schema(self.schema(name)).parquet(*folders)

    def lookup(self, name: str, values: Sequence) -> DataFrame:
        """Rows whose key is one of ``values``: only their buckets are read."""
        key, n = self.key(name), self.n_buckets(name)
        kind = self.schema(name)[key].dataType.simpleString()
        found = self.table(name, {literal_bucket(v, kind, n) for v in values})
        return found.filter(F.col(key).isin(list(values)) if len(values) != 1 else F.col(key) == F.lit(values[0]))

    def buckets_of(self, name: str, keys: DataFrame) -> list[int]:
        """The buckets of the keys in ``keys`` (a column named as the table's
        key): at most as many numbers as the table has buckets."""
        rows = keys.select(bucket_of(F.col(self.key(name)), self.n_buckets(name)).alias("b")).distinct().collect()
        return sorted(r["b"] for r in rows if r["b"] is not None)

    # ------------------------------------------------------------ writing

    def define(self, name: str, key: str, n_buckets: int, schema: StructType, folder: str | None = None) -> None:
        """Add a table; ``folder`` takes over a written one (``bucket=`` sub-folders)."""
        plain = StructType([f for f in schema.fields if f.name != "bucket"])
        of = {c[7:]: [f"{folder}/{c}"] for c in _Files(self.spark, folder).children(folder) if c.startswith("bucket=")} if folder else {}
        self.manifest["tables"][name] = {"key": key, "buckets": n_buckets, "schema": plain.jsonValue(), "folders": of}

    def stage(self, name: str, rows: DataFrame, replace: Iterable[int] | None = None, few: bool = False,
              distinct: int = 0) -> dict:
        """Write ``rows`` aside.  They are added to the table, or take the
        place of the buckets ``replace``, when the result is committed.
        ``few`` rows are written by the tasks that have them, without a
        shuffle by bucket (``compact`` joins such files).  With ``distinct``
        equal rows are written once: they meet in the shuffle by bucket, which
        deals a bucket to that many parts."""
        folder = f"{self.base}/data/{name}/{uuid.uuid4().hex}"
        key = self.key(name)
        rows = rows.select(*self.schema(name).names).withColumn("bucket", bucket_of(F.col(key), self.n_buckets(name)))
        if distinct:
            cell = F.pmod(F.xxhash64(F.lit("cell"), *self.schema(name).names), F.lit(distinct))
            rows = (rows.withColumn("_cell", cell).repartition(self.n_buckets(name) * distinct, "bucket", "_cell").distinct().drop("_cell"))
        elif not few:
            rows = rows.hint("rebalance", "bucket")
        rows.sortWithinPartitions("bucket", key).write.partitionBy("bucket").parquet(folder)
        written = {c[7:]: f"{folder}/{c}" for c in _Files(self.spark, folder).children(folder) if c.startswith("bucket=")}
        return {"table": name, "folder": folder, "written": written, "replace": None if replace is None else [str(b) for b in replace]}

    def staged(self, change: dict) -> DataFrame:
        """The rows that a staged change wrote."""
        if not change["written"]:
            return self.spark.createDataFrame([], self.schema(change["table"]))
        return self.spark.read.schema(self.schema(change["table"])).parquet(*change["written"].values())

    def commit(self, changes: Sequence[dict] = ()) -> VersionedStore:
        """Make staged changes visible, all at once, as the next version."""
        new = json.loads(json.dumps(self.manifest))
        for c in changes:
            of = new["tables"][c["table"]]["folders"]
            for b in c["replace"] or ():
                of.pop(b, None)
            for b, folder in c["written"].items():
                of.setdefault(b, []).append(folder)
        new["version"] = self.version + 1
        files = _Files(self.spark, self.base)
        files.fs.mkdirs(files.path(f"{self.base}/manifests"))
        if not files.write_new(f"{self.base}/manifests/{new['version']}.json", json.dumps(new).encode()):
            raise Conflict(f"version {new['version']} of {self.base} is there already")
        self.manifest = new
        return self

    def compact(self, name: str, most: int = 1) -> VersionedStore:
        """Rewrite the buckets that have more than ``most`` folders."""
        many = [int(b) for b, f in self.manifest["tables"][name]["folders"].items() if len(f) > most]
        return self.commit([self.stage(name, self.table(name, many), replace=many)]) if many else self

    def vacuum(self, keep: int = 1) -> int:
        """Delete manifests before the last ``keep`` and the folders under
        ``base`` that none of the kept ones names (so also those that dead
        writers left).  Not while others write."""
        files = _Files(self.spark, self.base)
        found = sorted(int(n.split(".")[0]) for n in files.children(f"{self.base}/manifests") if n.endswith(".json"))
        live = set()
        for v in found[-keep:]:
            for t in json.loads(files.read(f"{self.base}/manifests/{v}.json"))["tables"].values():
                live |= {f.rsplit("/", 1)[0] for folders in t["folders"].values() for f in folders}
        gone = 0
        for name in files.children(f"{self.base}/data"):
            for one in files.children(f"{self.base}/data/{name}"):
                if f"{self.base}/data/{name}/{one}" not in live:
                    gone += delete_path(self.spark, f"{self.base}/data/{name}/{one}")
        for v in found[:-keep]:
            delete_path(self.spark, f"{self.base}/manifests/{v}.json")
        return gone
