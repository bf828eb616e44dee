"""Keyed tables in hash buckets: a merge reads and rewrites only the buckets of its keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

Merge = Callable[[DataFrame, DataFrame], DataFrame]
_STATE = "seq bigint, token string, phase string, buckets int"


class KeyedTable:
    """Parquet under ``path``, partitioned by a hash of ``keys`` into ``buckets`` folders.

    ``apply`` stores the new content of the touched buckets aside, notes that it is whole,
    and then overwrites those partitions with it. If a job is lost between, the next
    ``apply`` (or ``recover``) publishes the stored content again, so that no bucket is
    lost or half written. A batch whose token was the last one applied is left out, which
    makes a stream's repeated batch harmless. There may be one writer at a time; a reader
    beside it can meet a bucket that is just being replaced.

    A bucket is rewritten whole: take so many buckets that one holds some 100 MB. Null keys
    share a bucket and are matched as the merge says. The number of buckets of a path is fixed.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType, keys: list[str], buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, keys, buckets
        empty = spark.createDataFrame([], schema)
        self.schema = empty.schema
        self._with_bucket = StructType([*self.schema.fields, StructField("bucket", IntegerType())])
        held = self._state()
        if held is None:
            empty.withColumn("bucket", F.lit(0)).write.mode("ignore").partitionBy("bucket").parquet(f"{path}/rows")
            self._note(0, None, "applied")
        elif held.buckets != buckets:
            raise ValueError(f"{path} has {held.buckets} buckets, not {buckets}")

    def _state(self):
        """The newer of two notes; one is whole while the other is being written."""
        found = []
        for slot in (0, 1):
            try:
                found += self.spark.read.schema(_STATE).parquet(f"{self.path}/state-{slot}").collect()
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        return max(found, key=lambda r: r.seq, default=None)

    def _note(self, seq: int, token: str | None, phase: str) -> None:
        row = self.spark.createDataFrame([(seq, token, phase, self.buckets)], _STATE)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state-{seq % 2}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(k).cast(self.schema[k].dataType) for k in self.keys)), F.lit(self.buckets)).cast("int")

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self._with_bucket).parquet(f"{self.path}/rows")

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        rows = self._rows()
        if only is not None:
            rows = rows.where(F.col("bucket").isin(only))
        return rows.drop("bucket")

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of a batch's keys: at most ``buckets`` numbers."""
        return sorted(r.bucket for r in batch.select(self._bucket().alias("bucket")).distinct().collect())

    def recover(self):
        """Publish a merge that was stored but perhaps not published; returns the note of the last merge."""
        held = self._state()
        if held.phase == "staged":
            staged = self.spark.read.schema(self._with_bucket).parquet(f"{self.path}/stage")
            staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.path}/rows")
            self._note(held.seq + 1, held.token, "applied")
            held = self._state()
        return held

    def apply(self, batch: DataFrame, merge: Merge, token: str | None = None) -> list[int]:
        """Put ``merge(old rows of the touched buckets, batch)`` in those buckets' place; returns the buckets.

        The merge returns every row that these buckets shall hold. The batch is read twice.
        """
        held = self.recover()
        if token is not None and token == held.token:
            return []
        only = self.touched(batch)
        if only:
            new = merge(self.read(only), batch).select(*self.schema.names).withColumn("bucket", self._bucket())
            new.hint("rebalance", F.col("bucket")).write.mode("overwrite").parquet(f"{self.path}/stage")
            self._note(held.seq + 1, token, "staged")
            self.recover()
        return only
