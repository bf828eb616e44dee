"""Keyed tables rewrite only what a merge touches and survive lost jobs; streams keep bounded state."""

import datetime
import glob
import shutil

import pytest
from pyspark.sql import functions as F

from localpulse.operators import store
from localpulse.sources.keyed import KeyedTable
from localpulse.sources.scratch import new_path
from localpulse.streaming.jobs import grid_table, ingest_snapshots, live_grid

PAIR = "k bigint, v string"


def replace(old, new):
    return store.replace_by_key(old, new, ["k"])


def files(path):
    """Data files by bucket."""
    found = {}
    for f in glob.glob(path.removeprefix("file://") + "/rows/bucket=*/*.parquet"):
        found.setdefault(f.split("bucket=")[1].split("/")[0], set()).add(f)
    return found


def pairs(table):
    return sorted((r.k is None, r.k or 0, r.v) for r in table.read().collect())


@pytest.fixture
def table(spark):
    made = KeyedTable(spark, new_path(spark, "keyed"), PAIR, ["k"], 256)
    made.apply(spark.range(1000).selectExpr("id AS k", "'old' AS v"), replace)
    return made


def test_merge_of_one_percent_rewrites_its_buckets_only(spark, table):
    before = files(table.path)
    batch = spark.range(0, 1000, 100).selectExpr("id AS k", "'new' AS v")
    only = table.touched(batch)
    plan = table.read(only)._jdf.queryExecution().toString()
    assert 0 < len(only) <= 10 and "PartitionFilters: [isnotnull(bucket" in plan.replace("\n", "") or "PartitionFilters: [bucket" in plan
    assert table.apply(batch, replace) == only
    after = files(table.path)
    assert {b for b in before if before[b] != after[b]} == {str(b) for b in only}
    assert pairs(table) == [(False, k, "new" if k % 100 == 0 else "old") for k in range(1000)]


def test_merge_reads_no_other_bucket(spark, table):
    """A broken file in a bucket that is not touched is not noticed."""
    batch = spark.createDataFrame([(5, "new")], PAIR)
    (own,) = table.touched(batch)
    other = next(b for b in files(table.path) if int(b) != own)
    for f in files(table.path)[other]:
        with open(f, "wb") as out:
            out.write(b"no parquet")
    assert table.apply(batch, replace) == [own]
    assert [r.v for r in table.read([own]).where("k = 5").collect()] == ["new"]


def test_token_is_applied_once(spark, table):
    add = lambda old, new: old.unionByName(new)  # noqa: E731 - not idempotent by itself
    batch = spark.createDataFrame([(1, "more")], PAIR)
    assert table.apply(batch, add, "s#1") and not table.apply(batch, add, "s#1")
    assert table.read().count() == 1001
    assert KeyedTable(spark, table.path, PAIR, ["k"], 256).apply(batch, add, "s#1") == []
    table.apply(batch, add, "s#2")
    assert table.read().count() == 1002


def test_lost_publication_is_made_up_for(spark, table):
    """The driver is lost when the merge is stored but its buckets are half replaced."""
    batch = spark.createDataFrame([(1, "new"), (2, "new"), (2000, "new")], PAIR)

    class Lost(Exception):
        pass

    def lost():
        if table._state().phase == "staged":
            for b in table.touched(batch)[:2]:
                shutil.rmtree(table.path.removeprefix("file://") + f"/rows/bucket={b}", ignore_errors=True)
            raise Lost
        return KeyedTable.recover(table)

    table.recover = lost
    with pytest.raises(Lost):
        table.apply(batch, replace, "s#7")
    again = KeyedTable(spark, table.path, PAIR, ["k"], 256)
    assert again.read().count() < 1001
    assert again.apply(batch, replace, "s#7") == []  # published from the store, not merged anew
    assert pairs(again) == sorted([(False, k, "new" if k in (1, 2) else "old") for k in range(1000)] + [(False, 2000, "new")])


def test_lost_merge_leaves_the_table(spark, table):
    def broken(old, new):
        return old.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        table.apply(spark.createDataFrame([(1, "new")], PAIR), broken, "s#1")
    assert pairs(table) == [(False, k, "old") for k in range(1000)]
    assert table.apply(spark.createDataFrame([(1, "new")], PAIR), replace, "s#1")


def test_defined_cases(spark, table):
    assert table.apply(spark.createDataFrame([], PAIR), replace) == [] and table.read().count() == 1000
    table.apply(spark.createDataFrame([(None, "a")], PAIR), replace)
    table.apply(spark.createDataFrame([(None, "b")], PAIR), replace)  # null keys match nothing here
    assert [r.v for r in table.read().where("k IS NULL").orderBy("v").collect()] == ["a", "b"]
    table.apply(spark.createDataFrame([(3, "int key", 1)], "k int, v string, bucket int"), replace_pair)  # a narrower key and a clashing column
    assert [r.v for r in table.read().where("k = 3").collect()] == ["int key"]
    with pytest.raises(ValueError, match="256 buckets"):
        KeyedTable(spark, table.path, PAIR, ["k"], 16)


def replace_pair(old, new):
    return replace(old, new.select(F.col("k").cast("bigint"), "v"))


def day(n):
    return datetime.datetime(2026, 1, 1) + datetime.timedelta(days=n)


def test_audit_batches_cost_the_same(spark):
    """Twenty batches: each looks up its own rows in the state; the last is cut off and made again after a restart."""
    schema = "place_id string, audited_ts timestamp, total_photos int"
    source, sink, checkpoint = (new_path(spark, t) for t in ("a-in", "a-out", "a-cp"))
    for n in range(20):
        rows = [(f"p{i}", day(n), i) for i in range(5)] + [("p0", day(0), 9), (None, None, n)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    read = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = ingest_snapshots(read(), sink, checkpoint)
    query.awaitTermination()
    states = [p.stateOperators[0] for p in query.recentProgress if p.numInputRows]
    assert len(states) == 20 and states[-1].numRowsTotal == 101
    assert sorted(s.numRowsUpdated for s in states) == [5] * 19 + [6]
    assert not any(sink in str(p.sources) for p in query.recentProgress)
    ingest_snapshots(read(), sink, checkpoint).awaitTermination()
    got = spark.read.parquet(sink)
    assert got.count() == 101 == got.select("place_id", "audited_ts").distinct().count()


def test_scans_close_and_their_state_goes(spark):
    schema = "place_id string, scan_id int, scan_ts timestamp, rank int"
    source, checkpoint = new_path(spark, "g-in"), new_path(spark, "g-cp")
    table = grid_table(spark, new_path(spark, "g-out"), buckets=16)
    pins = []

    def arrive(rows):
        pins.extend(rows)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        query = live_grid(spark.readStream.schema(schema).parquet(source), table, checkpoint, "3 days")
        query.awaitTermination()
        return query.recentProgress[-1].stateOperators[0]

    kept = []
    for n in range(6):  # a new scan a day; the second half of the one before comes late
        kept.append(arrive([(f"p{i % 3}", s, day(s), r) for s, r in ((n, 1), (n, None), (max(n - 1, 0), 4)) for i in range(3)]))
    assert max(s.numRowsTotal for s in kept) <= 3 * 5 < 3 * 6 and sum(s.numRowsDroppedByWatermark for s in kept) == 0
    want = {(p, s): 0 for p, s, _, _ in pins}
    for p, s, _, r in pins:
        want[p, s] += r is not None
    total = {k: sum((p, s) == k for p, s, _, _ in pins) for k in want}
    got = {(r.place_id, r.scan_id): r.found_share for r in table.read().collect()}
    assert got == {k: want[k] / total[k] for k in want} and table.read().count() == 18
    arrive([("p0", 0, day(0), 1)])  # long closed: the live row stays
    assert {(r.place_id, r.scan_id): r.found_share for r in table.read().collect()} == got
    arrive([(None, None, None, 1)])
    arrive([(None, None, None, None)])
    assert table.read().where("scan_id IS NULL").count() >= 1
