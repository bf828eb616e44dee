"""Ingest and live metrics as Structured Streaming jobs; the batch operators are used unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from localpulse.operators.grid import solv
from localpulse.operators.profiles import with_neglect
from localpulse.operators.store import merge_businesses, replace_by_key
from localpulse.sources.keyed import KeyedTable, Merge

BUSINESS = "place_id string, state_code string, trade_bucket string, relevance string, name string, website string, review_count bigint, found_via array<string>, first_seen timestamp, last_refreshed timestamp"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = {
    _PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _on_disk(spark: SparkSession, start) -> StreamingQuery:
    """Start a query with its state on disk, of which a batch uploads only its changes; the session's settings stay."""
    before = {k: spark.conf.get(k, None) for k in _ROCKS}
    try:
        for k, v in _ROCKS.items():
            spark.conf.set(k, v)
        return start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _into(table: KeyedTable, merge: Merge, checkpoint: str):
    """A ``foreachBatch`` function that merges each batch once."""

    def put(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            table.apply(kept, merge, f"{checkpoint}#{number}")
        finally:
            kept.unpersist()

    return put


def business_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, path, BUSINESS, ["place_id"], buckets)


def grid_table(spark: SparkSession, path: str, scan_type: str = "int", buckets: int = 64) -> KeyedTable:
    return KeyedTable(spark, path, f"place_id string, scan_id {scan_type}, scan_ts timestamp, solv double, avg_rank double, top3_share double, found_share double", ["place_id", "scan_id"], buckets)


def ingest_listings(sightings: DataFrame, table: KeyedTable, checkpoint: str, refresh: bool = False) -> StreamingQuery:
    """Merge arriving sightings into the business table, stamped with the time of the batch.

    Only the buckets of the batch's places are read and rewritten; the checkpoint and the
    table's token make it exactly-once.
    """
    merge = lambda old, new: merge_businesses(old, new, F.current_timestamp(), refresh)
    return sightings.writeStream.foreachBatch(_into(table, merge, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_snapshots(audits: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Score arriving audits and append one row per place and time to the Parquet table at ``path``, however late.

    The places and times seen are keyed state on disk, so a batch looks up its own rows and
    never reads the table again; the state has one small key for each row of the table. A
    null place or time counts as a value. The file sink's log makes it exactly-once: read
    the folder with Spark.
    """
    once = audits.dropDuplicates(["place_id", "audited_ts"])
    scored = with_neglect(once).withColumn("signals", F.map_keys("signals"))
    return _on_disk(audits.sparkSession, lambda: scored.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def live_grid(points: DataFrame, table: KeyedTable, checkpoint: str, delay: str = "7 days") -> StreamingQuery:
    """Share of local voice per scan as its pins arrive, one row a scan in ``table``.

    ``points`` carry their scan's start as ``scan_ts``. A scan's sums are kept until a scan
    that started more than ``delay`` later has been seen in an earlier batch; then the scan
    is closed, and pins that still arrive for it are left out of its live row and counted
    by the query's progress (``numRowsDroppedByWatermark``); ``solv`` over the stored pins has
    them. Pins without ``scan_ts`` never close.
    """
    merge = lambda old, new: replace_by_key(old, new, ["place_id", "scan_id"])
    rows = solv(points.withWatermark("scan_ts", delay), ["place_id", "scan_id", "scan_ts"])
    return _on_disk(points.sparkSession, lambda: rows.writeStream.foreachBatch(_into(table, merge, checkpoint)).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stale_places(audits: DataFrame, since) -> DataFrame:
    """Places without an audit since a time."""
    return audits.groupBy("place_id").agg(F.max("audited_ts").alias("last")).where(F.col("last") < since).select("place_id")
