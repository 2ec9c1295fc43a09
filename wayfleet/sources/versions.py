"""Keyed tables in versions: readers see the newest complete one, writers add folders and never overwrite.

A version is a small manifest that names the Parquet folders it consists of. A
writer first writes its folders, then the manifest; a writer that dies before that
leaves folders no manifest names, which ``vacuum`` removes with those of old versions.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfleet.operators.traffic import latest_by
from wayfleet.sources.tables import upsert_by_key


class Manifests:
    """Numbered manifests of a table folder, on any file system Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, folder: str) -> list[str]:
        at = self._hadoop(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self._names("manifest") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or one by its number; version 0 is the empty table."""
        known = self.versions()
        version = version if version is not None else (known[-1] if known else 0)
        if version == 0:
            return {"version": 0}
        stream = self._fs.open(self._hadoop(f"{self.path}/manifest/{version:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, manifest: dict) -> int:
        """Make a version visible at once: written aside, then renamed. A second writer of the same number fails."""
        target = self._hadoop(f"{self.path}/manifest/{manifest['version']:012d}.json")
        aside = self._hadoop(f"{self.path}/manifest/_{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            self._fs.delete(aside, False)
            raise RuntimeError(f"version {manifest['version']} was written by someone else")
        return manifest["version"]

    def new_folder(self) -> str:
        return f"data/{uuid.uuid4().hex}"

    def _folders(self, manifest: dict) -> list[str]:
        raise NotImplementedError

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` manifests and the folders that none of those names; returns how many folders went.

        No writer may be at work, as the folders of an unfinished version are not named yet.
        """
        known = self.versions()
        for old in known[:-keep]:
            self._fs.delete(self._hadoop(f"{self.path}/manifest/{old:012d}.json"), False)
        named = {f.split("/")[1] for v in known[-keep:] for f in self._folders(self.manifest(v))}
        gone = [n for n in self._names("data") if n not in named]
        for name in gone:
            self._fs.delete(self._hadoop(f"{self.path}/data/{name}"), True)
        return len(gone)


class StateTable(Manifests):
    """Newest row per key, from micro-batches: a base folder and the deltas since.

    A batch that was published before changes nothing. After ``compact_every``
    deltas they are folded into a new base, so a reader never meets more folders than that.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, order: str, schema: StructType, compact_every: int = 16):
        super().__init__(spark, path)
        self.key, self.order, self.schema, self.compact_every = key, order, schema, compact_every

    def _folders(self, manifest: dict) -> list[str]:
        return [f for f in [manifest.get("base"), *manifest.get("deltas", [])] if f]

    def publish(self, rows: DataFrame, batch_id: int) -> int:
        """Add one micro-batch; returns the version that holds it."""
        now = self.manifest()
        if batch_id <= now.get("batch", -1):
            return now["version"]
        folder = self.new_folder()
        latest_by(rows.select(*self.schema.names), [self.key], [self.order]).write.parquet(f"{self.path}/{folder}")
        made = now | {"version": now["version"] + 1, "batch": batch_id, "deltas": [*now.get("deltas", []), folder]}
        version = self.commit(made)
        return self.compact() if len(made["deltas"]) >= self.compact_every else version

    def compact(self) -> int:
        """Fold the deltas into a new base; readers of older versions keep theirs."""
        now = self.manifest()
        if not now.get("deltas"):
            return now["version"]
        folder = self.new_folder()
        self.read().write.parquet(f"{self.path}/{folder}")
        return self.commit(now | {"version": now["version"] + 1, "base": folder, "deltas": []})

    def read(self, version: int | None = None) -> DataFrame:
        """Newest row per key of a version; of equally new ones that of the later batch."""
        folders = self._folders(self.manifest(version))
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        parts = [self.spark.read.schema(self.schema).parquet(f"{self.path}/{f}").withColumn("_place", F.lit(i)) for i, f in enumerate(folders)]
        rows = reduce(DataFrame.unionByName, parts)
        return latest_by(rows, [self.key], [self.order, "_place"]).drop("_place")


class DocumentTable(Manifests):
    """Documents by key in hash buckets: a merge reads and writes the buckets it touches, the others stay as they are."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, buckets: int = 64):
        super().__init__(spark, path)
        self.key, self.schema, self.buckets = key, schema, buckets

    def _folders(self, manifest: dict) -> list[str]:
        return sorted(set(manifest.get("buckets", {}).values()))

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, touched: list[int], now: dict) -> int:
        folder = self.new_folder()
        (rows.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}"))
        held = set(self._names(folder))
        buckets = {k: v for k, v in now.get("buckets", {}).items() if int(k) not in touched}
        buckets |= {str(b): folder for b in touched if f"_bucket={b}" in held}
        return self.commit({"version": now["version"] + 1, "buckets": buckets, "touched": sorted(touched)})

    def create(self, rows: DataFrame) -> int:
        """The first version."""
        now = self.manifest()
        if now["version"]:
            raise ValueError("the table exists")
        return self._write(rows.select(*self.schema.names), list(range(self.buckets)), now)

    def merge(self, changes: DataFrame, reset: tuple[str, ...] = ()) -> int:
        """Upsert as ``upsert_by_key`` does, bucket by bucket; returns the new version."""
        now = self.manifest()
        touched = [r["b"] for r in changes.select(self._bucket().alias("b")).distinct().collect()]   # at most one number per bucket
        if not touched:
            return now["version"]
        return self._write(upsert_by_key(self._of(now, touched), changes, self.key, reset), touched, now)

    def _of(self, manifest: dict, wanted: list[int] | None = None) -> DataFrame:
        held = manifest.get("buckets", {})
        paths = [f"{self.path}/{folder}/_bucket={b}" for b, folder in held.items() if wanted is None or int(b) in wanted]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None, key: str | None = None) -> DataFrame:
        """All documents of a version, or one: then only its bucket is read."""
        now = self.manifest(version)
        if key is None:
            return self._of(now)
        own = self.spark.range(1).select(F.lit(key).alias(self.key)).select(self._bucket().alias("b")).first()["b"]
        return self._of(now, [own]).where(F.col(self.key) == key)

    def rewritten_share(self, version: int | None = None) -> float:
        """The share of the buckets that a version wrote anew."""
        return len(self.manifest(version).get("touched", [])) / self.buckets

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """(version, key, kind, before, after) of every document that a version after ``since`` changed.

        Only the buckets a version touched are compared. A merge that sets what is there already changes nothing.
        """
        until = until if until is not None else self.manifest()["version"]
        image = F.struct(*self.schema.names)
        parts = []
        for version in range(since + 1, until + 1):
            now = self.manifest(version)
            side = lambda m, tag: self._of(m, now["touched"]).select(F.col(self.key).alias(f"_{tag}"), image.alias(tag))
            both = side(self.manifest(version - 1), "before").join(side(now, "after"), F.col("_before") == F.col("_after"), "full_outer")
            kind = F.when(F.col("_before").isNull(), "insert").when(F.col("_after").isNull(), "delete").otherwise("update")
            parts.append(both.where(~F.col("before").eqNullSafe(F.col("after"))).select(
                F.lit(version).cast("long").alias("version"), F.coalesce("_after", "_before").alias(self.key), kind.alias("kind"), "before", "after"))
        if not parts:
            shape = self.schema.simpleString()
            kind = self.schema[self.key].dataType.simpleString()
            return self.spark.createDataFrame([], f"version long, {self.key} {kind}, kind string, before {shape}, after {shape}")
        return reduce(DataFrame.unionByName, parts)
