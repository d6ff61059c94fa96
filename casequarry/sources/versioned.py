"""A table in hash buckets whose versions are small pointer files: an upsert rewrites only the buckets that it touches."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casequarry.sources.files import write_text


class BucketedTable:
    """Rows of ``schema`` by the hash of ``key`` in ``buckets`` folders; version n is ``pointers/n.json``, which names each bucket's folder.

    A pointer file is moved to its place after its buckets are whole, so readers see a version or the one before it.
    A repeated upsert of a version writes the same buckets again.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str, schema: StructType, buckets: int = 64):
        self.spark, self.folder, self.key, self.schema, self.buckets = spark, folder, key, schema, buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _store(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, store = self._store(f"{self.folder}/pointers")
        if not store.exists(folder):
            return []
        names = [f.getPath().getName() for f in store.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def pointers(self, version: int | None = None) -> dict[int, str]:
        """Folder of each bucket in a version, by default the newest; a version that is not there is the one before it."""
        known = [v for v in self.versions() if version is None or v <= version]
        if not known:
            return {}
        said = self.spark.read.option("wholetext", True).text(f"{self.folder}/pointers/{known[-1]:09d}.json").first()[0]
        return {int(b): path for b, path in json.loads(said)["buckets"].items()}

    def _read(self, pointers: dict[int, str]) -> DataFrame:
        paths = [f"{self.folder}/{p}" for p in sorted(pointers.values())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.pointers(version))

    def upsert(self, version: int, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Write ``merge(old, rows)`` of the buckets that ``rows`` touches as a version, and return these buckets."""
        before = self.pointers(version - 1)
        touched = sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())  # at most ``buckets`` numbers
        old = self._read({b: p for b, p in before.items() if b in touched})
        new = merge(old, rows).select(*self.schema.names).withColumn("_bucket", self._bucket())
        data = f"data/{version:09d}"
        new.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/{data}")
        kept = {b for b in touched if self._there(f"{self.folder}/{data}/_bucket={b}")}
        after = {b: p for b, p in before.items() if b not in touched} | {b: f"{data}/_bucket={b}" for b in kept}
        write_text(self.spark, json.dumps({"version": version, "rewritten": touched, "buckets": after}), f"{self.folder}/pointers/{version:09d}.json")
        return touched

    def _there(self, path: str) -> bool:
        hadoop, store = self._store(path)
        return store.exists(hadoop)

    def vacuum(self, keep: int = 2) -> int:
        """Delete pointers but the newest ``keep`` and bucket folders that none of these names; returns the number of folders."""
        known = self.versions()
        used = {p for v in known[-keep:] for p in self.pointers(v).values()}
        gone = 0
        folder, store = self._store(f"{self.folder}/data")
        for version in store.listStatus(folder) if store.exists(folder) else []:
            number = version.getPath().getName()
            for bucket in store.listStatus(version.getPath()):
                name = bucket.getPath().getName()
                if name.startswith("_bucket=") and f"data/{number}/{name}" not in used and int(number) <= known[-1]:
                    gone += store.delete(bucket.getPath(), True)
        for v in known[:-keep]:
            path, store = self._store(f"{self.folder}/pointers/{v:09d}.json")
            store.delete(path, False)
        return gone
