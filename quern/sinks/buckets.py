"""A keyed table whose upserts rewrite only what they touch: hash buckets, and a manifest for each version."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.dedupe import latest_wins


class KeyedTable:
    """The latest row of each key under a path, in ``buckets`` folders of rows.

    A version is a manifest, which names a folder for each bucket. A batch reads and writes the buckets that its
    keys fall into; the others stay where they are. Batch n starts from the last version before n, so a batch that
    runs again has the same effect. Folders that none of the last ``keep`` versions names are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], order: list[str], buckets: int = 64, keep: int = 2) -> None:
        self.spark, self.path, self.schema, self.keys, self.order, self.buckets, self.keep = spark, path, schema, keys, order, buckets, keep
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        folder = self._at(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in self._fs.listStatus(folder) if f.getPath().getName().endswith(".json"))

    def manifest(self, version: int | None) -> dict[str, str]:
        """The folder of each bucket; none before the first version."""
        if version is None:
            return {}
        stream = self._fs.open(self._at(f"{self.path}/manifests/{version}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: int, folders: dict[str, str]) -> None:
        final, draft = self._at(f"{self.path}/manifests/{version}.json"), self._at(f"{self.path}/manifests/_{version}")
        stream = self._fs.create(draft, True)
        stream.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
        stream.close()
        self._fs.delete(final, False)
        self._fs.rename(draft, final)

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the last one); none if there is no version yet."""
        at = version if version is not None else max(self.versions(), default=None)
        return self._rows(sorted(self.manifest(at).values()))

    def upsert(self, batch: DataFrame, number: int) -> list[int]:
        """Makes version ``number``; the buckets that were written. A function for ``foreachBatch``."""
        before = max((v for v in self.versions() if v < number), default=None)
        folders = self.manifest(before)
        touched = [r.bucket for r in batch.select(self._bucket().alias("bucket")).distinct().collect()]  # ``buckets`` of them at most
        if touched:
            old = self._rows(sorted(folders[str(b)] for b in touched if str(b) in folders))
            rows = latest_wins(old.unionByName(batch.select(*old.columns)), self.keys, *self.order)
            to = f"{self.path}/v{number}"
            rows.withColumn("bucket", self._bucket()).write.mode("overwrite").partitionBy("bucket").parquet(to)
            folders = folders | {str(b): f"{to}/bucket={b}" for b in touched}
        self._publish(number, folders)
        self._drop_old()
        return sorted(touched)

    def _drop_old(self) -> None:
        versions = self.versions()
        kept = versions[-self.keep :]
        named = {folder for v in kept for folder in self.manifest(v).values()}
        for f in self._fs.listStatus(self._at(self.path)):
            name = f.getPath().getName()
            if name.startswith("v") and int(name[1:]) <= kept[-1]:
                for b in self._fs.listStatus(f.getPath()):
                    if b.isDirectory() and f"{self.path}/{name}/{b.getPath().getName()}" not in named:
                        self._fs.delete(b.getPath(), True)
        for v in versions[: -self.keep]:
            self._fs.delete(self._at(f"{self.path}/manifests/{v}.json"), False)
