"""Properties: merges are idempotent, pruning is greedy, prefixes never overspend, streams equal batches."""

import datetime
import glob
import math
import random

import pytest
from pyspark.sql import functions as F

from localpulse.operators import budget, discovery, grid, pairs, store
from localpulse.plans.all import QUERIES
from localpulse.sources.scratch import new_path
from localpulse.streaming.jobs import business_table, ingest_listings, ingest_snapshots

SIGHTING = "place_id string, name string, website string, review_count bigint, state_code string, trade_bucket string, relevance string, found_via array<string>, seq bigint"
BUSINESS = "place_id string, state_code string, trade_bucket string, relevance string, name string, website string, review_count bigint, found_via array<string>, first_seen timestamp, last_refreshed timestamp"


def sightings(n, seed):
    rng = random.Random(seed)
    return [(f"p{rng.randrange(12)}", f"n{i}", None, i, "TN", "b", "match", [f"t{rng.randrange(4)}"], i) for i in range(n)]


def test_merge_is_idempotent(spark):
    new = spark.createDataFrame(sightings(40, 1), SIGHTING)
    empty = spark.createDataFrame([], BUSINESS)
    now = F.lit("2026-01-01").cast("timestamp")
    for refresh in (False, True):
        once = store.merge_businesses(empty, new, now, refresh).drop("action", "sightings")
        twice = store.merge_businesses(once, new, now, refresh).drop("action", "sightings")
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_merge_keeps_first_seen(spark):
    old = store.merge_businesses(spark.createDataFrame([], BUSINESS), spark.createDataFrame(sightings(10, 2), SIGHTING), F.lit("2025-01-01").cast("timestamp")).drop("action", "sightings")
    merged = store.merge_businesses(old, spark.createDataFrame(sightings(30, 3), SIGHTING), F.lit("2026-01-01").cast("timestamp"), True)
    first = {r.place_id: r.first_seen for r in old.collect()}
    assert all(r.first_seen == first[r.place_id] for r in merged.collect() if r.place_id in first)


@pytest.mark.parametrize("buckets", [1, 7])
def test_stream_equals_batch(spark, buckets):
    rows = sightings(60, 4)
    path, target, checkpoint = new_path(spark, "in"), new_path(spark, "out"), new_path(spark, "cp")
    table = business_table(spark, target, buckets)
    for part in (rows[:40], rows[40:45], rows[45:]):
        spark.createDataFrame(part, SIGHTING).coalesce(1).write.mode("append").parquet(path)
        ingest_listings(spark.readStream.schema(SIGHTING).parquet(path), table, checkpoint).awaitTermination()
    batch = store.merge_businesses(spark.createDataFrame([], BUSINESS), spark.createDataFrame(rows, SIGHTING), F.lit(None).cast("timestamp"))
    pick = lambda df: sorted((r.place_id, r.name, tuple(r.found_via)) for r in df.collect())
    assert pick(table.read()) == pick(batch) == pick(business_table(spark, target, buckets).read())


def test_pruning_is_greedy(spark):
    rng = random.Random(7)
    rows = [(f"c{i:03d}", 35 + rng.random() * 1.2, -90 + rng.random() * 1.2, rng.randrange(1_000, 900_000)) for i in range(120)]
    cells = discovery.plan_cells(spark.createDataFrame(rows, "cell_id string, lat double, lng double, population bigint"))
    radius = {r.cell_id: r.radius_m for r in cells.collect()}

    def metres(a, b):
        p, q = math.radians(a[1]), math.radians(b[1])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6_371_000 * math.asin(min(1, math.sqrt(h)))

    kept = []
    for row in sorted(rows, key=lambda r: (-r[3], r[0])):
        near = lambda k: abs(row[1] // 0.5 - k[1] // 0.5) <= 1 and abs(row[2] // 0.5 - k[2] // 0.5) <= 1  # noqa: E731, B023
        if not any(near(k) and metres(row, k) <= max(radius[row[0]], radius[k[0]]) for k in kept):
            kept.append(row)
    assert sorted(r.cell_id for r in discovery.prune_overlapping(cells).collect()) == sorted(k[0] for k in kept)


def test_pruning_in_batches_is_greedy(spark):
    """Batches of 8, 16, ... cells, some of them crowded; unknown places and populations cover nothing."""
    rng = random.Random(8)
    rows = [(f"c{i:03d}", 35 + rng.random() * 1.2, -90 + rng.random() * 1.2, rng.randrange(1_000, 900_000) // 50_000 * 50_000) for i in range(200)]
    rows += [(f"d{i:03d}", 35.2, -89.9, 300_000) for i in range(60)] + [("n1", None, -89.9, 300_000), ("n2", 35.2, -89.9, None)]
    cells = discovery.plan_cells(spark.createDataFrame(rows, "cell_id string, lat double, lng double, population bigint"))
    edges = {}
    for r in discovery.cover_edges(cells).collect():
        edges.setdefault(r.small, set()).add(r.large)
    kept = set()
    for row in sorted(rows, key=lambda r: (-(r[3] or 0), r[0])):
        if not edges.get(row[0], set()) & kept:
            kept.add(row[0])
    assert {r.cell_id for r in discovery.prune_overlapping(cells, first=8).collect()} == kept >= {"n1", "n2"}


def test_pruning_a_crowded_spot_stores_few_covers(spark):
    """1,500 cells at one spot have 1,124,250 covers; only those within a batch are looked up."""
    cells = spark.range(1500).select(F.format_string("c%05d", "id").alias("cell_id"), F.lit(30.0).alias("lat"), F.lit(-100.0).alias("lng"), F.col("id").alias("population"), F.lit(8000).alias("radius_m"))
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/market/covers-*"
    before = set(glob.glob(folder))
    assert [r.cell_id for r in discovery.prune_overlapping(cells, first=64).collect()] == ["c01499"]
    stored = set(glob.glob(folder)) - before
    assert stored and sum(spark.read.parquet(path).count() for path in stored) <= 9 * 64 * 64


@pytest.mark.parametrize("crowd", ["cover_edges", "c13"])
def test_pairs_of_a_crowd_span_many_tasks(spark, monkeypatch, tmp_path, crowd):
    monkeypatch.setattr(pairs, "SIDE", 20)
    monkeypatch.setattr(pairs, "PER_TASK", 4000)
    n = 300
    if crowd == "cover_edges":
        cells = spark.range(n).select(F.format_string("c%05d", "id").alias("cell_id"), (F.lit(30.0) + F.col("id") * 1e-6).alias("lat"), (F.lit(-100.0) + F.col("id") * 1e-6).alias("lng"), F.col("id").alias("population"), F.lit(8000).alias("radius_m"))
        found = discovery.cover_edges(cells)
    else:
        for name in ("nation", "region"):
            spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
        spark.range(n).selectExpr("id AS s_suppkey", "'s' AS s_name", "3 AS s_nationkey", "CAST(id AS DOUBLE) AS s_acctbal").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
        found = QUERIES["c13_haversine"](spark, str(tmp_path))
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == n * (n - 1) // 2 and max(tasks) <= sum(tasks) / 4


def test_rows_of_a_crowd_are_sent_by_many_tasks(spark, monkeypatch):
    """Each of 600 rows meets 30 pieces: 36,000 rows are sent, from inputs of one task each."""
    monkeypatch.setattr(pairs, "SIDE", 20)
    monkeypatch.setattr(pairs, "PER_TASK", 40_000)
    monkeypatch.setattr(pairs, "SENT", 1_000, raising=False)
    side = spark.range(0, 600, 1, 1).select(F.lit(1).alias("k"), "id")
    gateway, store = spark.sparkContext._gateway, spark.sparkContext._jsc.sc().statusStore()
    each = lambda seq: [seq.apply(i) for i in range(seq.size())]
    stages = lambda: {s.stageId() for s in each(store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList()))}
    before = stages()
    assert pairs.tiled_join(side, side, ["k"], F.col("a.id") < F.col("b.id")).count() == 600 * 599 // 2
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    metrics = [t.taskMetrics() for number in stages() - before for t in each(store.taskList(number, 0, 10_000))]
    sent = [m.get().shuffleWriteMetrics().recordsWritten() for m in metrics if m.isDefined()]
    assert sum(sent) >= 36_000 and max(sent) <= 3_000


def test_guarded_prefix_never_overspends(spark):
    rng = random.Random(9)
    rows = [(i, rng.randrange(1, 9), rng.randrange(0, 15), rng.random() < 0.2) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, est bigint, act bigint, bad boolean")
    got = sorted(r.id for r in budget.guarded_prefix(df, "est", "act", F.col("bad"), ["id"], 300).collect())
    spent, want = 0, []
    for i, est, act, bad in rows:
        if spent + est <= 300:
            want.append(i)
        spent += est if bad else max(act, est)
    assert got == want


def test_empty_tables(spark):
    points = spark.createDataFrame([], "place_id string, scan_id int, row int, col int, keyword string, rank int")
    assert grid.solv(points, ["place_id"]).count() == 0 and grid.diff_pins(points, points).count() == 0
    cells = spark.createDataFrame([], "cell_id string, lat double, lng double, population bigint")
    assert discovery.prune_overlapping(discovery.plan_cells(cells)).count() == 0
    assert budget.budget_prefix(spark.createDataFrame([], "id int, cost bigint"), "cost", ["id"], 5).count() == 0


def test_late_audits_are_kept(spark):
    schema = "place_id string, audited_ts timestamp, total_photos int"
    source, sink, checkpoint = (new_path(spark, tag) for tag in ("late-in", "late-out", "late-cp"))
    day = lambda d: datetime.datetime(2026, 3, d)
    for rows in ([("a", day(20), 1), ("a", day(20), 1), ("b", day(19), 2)], [("a", day(2), 3), ("a", day(20), 1), ("c", day(1), 4)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        ingest_snapshots(spark.readStream.schema(schema).parquet(source), sink, checkpoint).awaitTermination()
    got = sorted((r.place_id, r.audited_ts.day) for r in spark.read.parquet(sink).collect())
    assert got == [("a", 2), ("a", 20), ("b", 19), ("c", 1)]
