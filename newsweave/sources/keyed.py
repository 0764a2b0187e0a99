"""A table of the keys handled so far, in folders by hash of the key, so that a batch reads and writes only its own folders.

``<path>/bits=<b>/bucket=<hash modulo 2**b>/version=<batch>/``. A batch reads the folders its keys fall into, and writes
those that get new keys again, each as one file with the old and the new keys; a folder holds at most two versions, the
older one until the next batch comes by. Where folders grow beyond ``rows_per_bucket``, all keys are dealt to four times
as many, which over the life of the table moves a key a bounded number of times. So a batch costs as much as its own keys and
``rows_per_bucket`` for each, however large the table is.

A batch that is repeated after a failure finds the versions before it and replaces what its first try left. One writer at
a time; batches count upwards.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 50_000
FIRST_BITS = 4
GROWTH_BITS = 2


class KeyTable:
    def __init__(self, spark: SparkSession, path: str, key: str = "url", rows_per_bucket: int = ROWS_PER_BUCKET):
        self.spark, self.path, self.key, self.rows_per_bucket = spark, path, key, rows_per_bucket
        self.schema = f"`{key}` string, bucket int, version long"
        self._jvm = spark.sparkContext._jvm
        self._files = self._location("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _location(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def _numbers(self, below: str, name: str) -> list[int]:
        """The numbers n of the folders ``name``=n."""
        where = self._location(below)
        if not self._files.exists(where):
            return []
        found = (re.fullmatch(rf"{name}=(\d+)", entry.getPath().getName()) for entry in self._files.listStatus(where))
        return sorted(int(m[1]) for m in found if m)

    def bits(self) -> int | None:
        """Of the present layout; a layout counts once it was written to the end."""
        whole = [b for b in self._numbers("", "bits") if self._files.exists(self._location(f"bits={b}/_SUCCESS"))]
        return max(whole, default=None)

    def bucket(self, bits: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(1 << bits)).cast("int")

    def _read(self, bits: int, buckets: list[int]) -> DataFrame:
        root = f"{self.path}/bits={bits}"
        paths = [f"{root}/bucket={k}" for k in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", root).parquet(*paths)

    def _write(self, rows: DataFrame, bits: int, whole: bool = False) -> None:
        """One file per bucket; ``whole`` replaces the layout, otherwise only the (bucket, version) folders in ``rows``."""
        writer = rows.repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket", "version")
        writer.option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(f"{self.path}/bits={bits}")

    def start(self, keys: DataFrame, batch: int) -> list[int]:
        """Buckets of the keys that exist already, cleared of versions that are out of date or of an earlier try of ``batch``."""
        bits = self.bits()
        if bits is None:
            self._write(self.spark.createDataFrame([], self.schema), FIRST_BITS, whole=True)
            return []
        for old in self._numbers("", "bits"):  # left by a try that ended before it could clear up
            if old < bits:
                self._files.delete(self._location(f"bits={old}"), True)
        there = set(self._numbers(f"bits={bits}", "bucket"))
        wanted = sorted(there & {r["bucket"] for r in keys.select(self.bucket(bits).alias("bucket")).distinct().collect()})
        for bucket in wanted:
            below = f"bits={bits}/bucket={bucket}"
            versions = self._numbers(below, "version")
            last = max((v for v in versions if v < batch), default=None)
            for v in versions:
                if v != last:
                    self._files.delete(self._location(f"{below}/version={v}"), True)
        kept = [b for b in wanted if self._numbers(f"bits={bits}/bucket={b}", "version")]
        if kept and self._read(bits, kept).count() > self.rows_per_bucket * len(kept):
            self._grow(bits, batch)
            return self.start(keys, batch)
        return kept

    def known(self, buckets: list[int]) -> DataFrame:
        """All keys of the buckets that ``start`` gave."""
        return self._read(self.bits(), buckets).select(self.key)

    def add(self, keys: DataFrame, batch: int) -> None:
        """Add the keys of a batch; ``start`` goes before."""
        bits = self.bits()
        fresh = keys.select(self.key).distinct().withColumn("bucket", self.bucket(bits))
        changed = {r["bucket"] for r in fresh.select("bucket").distinct().collect()}  # at most one row per bucket
        old = self._read(bits, sorted(changed & set(self._numbers(f"bits={bits}", "bucket"))))
        rows = old.select(self.key, "bucket").unionByName(fresh).distinct()
        self._write(rows.withColumn("version", F.lit(batch).cast("long")), bits)

    def _grow(self, bits: int, batch: int) -> None:
        """Deal all keys to more folders, as of the batch before; the old layout goes when the new one is whole."""
        more = bits + GROWTH_BITS
        rows = self._read(bits, self._numbers(f"bits={bits}", "bucket")).select(self.key).distinct()
        rows = rows.withColumn("bucket", self.bucket(more)).withColumn("version", F.lit(batch - 1).cast("long"))
        self._write(rows, more, whole=True)
        self._files.delete(self._location(f"bits={bits}"), True)
