"""Tables as batches in directories, with a manifest of the batches that make up the current version.

A batch is written beside the others and the manifest moves only after success: a path that is being
read is never overwritten, a failed write leaves the table as it was, and an append writes the new rows
only, however large the table is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self, name: str) -> int:
        """The current version, 0 before the first."""
        found = self._fs.globStatus(self._path(f"{self.root}/{name}/_v-*-of-*")) or []
        return max((int(f.getPath().getName().split("-")[1]) for f in found), default=0)

    def batches(self, name: str) -> list[int]:
        """Batches of the current version; the manifest's name holds the version and its first batch,
        as a rewrite drops all batches before it."""
        v = self.version(name)
        if not v:
            return []
        found = self._fs.globStatus(self._path(f"{self.root}/{name}/_v-{v}-of-*"))
        first = int(found[0].getPath().getName().split("-")[3])
        done = {int(f.getPath().getName().split("-")[1]) for f in self._fs.globStatus(self._path(f"{self.root}/{name}/_v-*-of-*"))}
        return [b for b in range(first, v + 1) if b in done]

    def exists(self, name: str) -> bool:
        return self.version(name) > 0

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """The current version; with a schema, an empty table where there is none yet."""
        parts = self.batches(name)
        if not parts and schema is not None:
            return self.spark.createDataFrame([], schema)
        data = f"{self.root}/{name}/data"
        return self.spark.read.option("basePath", data).parquet(*[f"{data}/batch={b}" for b in parts]).drop("batch")

    def _put(self, name: str, df: DataFrame, partition_by: list[str] | None, first: int | None) -> DataFrame:
        v = self.version(name) + 1
        to = df.write.mode("overwrite")
        (to.partitionBy(*partition_by) if partition_by else to).parquet(f"{self.root}/{name}/data/batch={v}")
        self._fs.create(self._path(f"{self.root}/{name}/_v-{v}-of-{v if first is None else first}"), True).close()
        return self.read(name)

    def write(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Replaces the table."""
        return self._put(name, df, partition_by, None)

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Adds rows to the table."""
        parts = self.batches(name)
        return self._put(name, df, partition_by, parts[0] if parts else None)
