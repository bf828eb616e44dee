"""Queries over grids, cells, stores, lenses and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from localpulse.functions import columns as C
from localpulse.operators import benchmark, budget, discovery, grid, lenses, profiles, reviews, store
from localpulse.operators.pairs import tiled_join
from localpulse.plans.registry import query
from localpulse.sources.keyed import KeyedTable
from localpulse.sources.scratch import new_path

VIS = "CASE WHEN rank IS NOT NULL AND rank <= 20 THEN (21 - rank) / CAST(20 AS DOUBLE) ELSE 0 END"
SOLV = f"100 * SUM({VIS}) / COUNT(*) AS solv, AVG(rank) AS avg_rank, COUNT(*) FILTER (rank <= 3) / CAST(COUNT(*) AS DOUBLE) AS top3_share, COUNT(rank) / CAST(COUNT(*) AS DOUBLE) AS found_share"
STATUS = "CASE WHEN b.rank IS NULL AND c.rank IS NULL THEN 'still_absent' WHEN b.rank IS NULL THEN 'gained' WHEN c.rank IS NULL THEN 'lost' WHEN b.rank > c.rank THEN 'improved' WHEN b.rank < c.rank THEN 'declined' ELSE 'unchanged' END"
DIFF = f"""diff AS (SELECT b.place_id, b."row", b.col, b.keyword, b.rank AS base_rank, c.rank AS cur_rank, {STATUS} AS status, b.rank - c.rank AS improvement
  FROM base_points b JOIN cur_points c ON b.place_id = c.place_id AND b."row" = c."row" AND b.col = c.col AND b.keyword = c.keyword)"""

# --- grids ------------------------------------------------------------------


@query("flagship_grid_diff", f"WITH {DIFF} SELECT place_id, COUNT(*) AS pins, COUNT(*) FILTER (status = 'improved') AS improved, COUNT(*) FILTER (status = 'declined') AS declined, COUNT(*) FILTER (status IN ('gained')) AS gained, COUNT(*) FILTER (status = 'lost') AS lost FROM diff GROUP BY place_id", "base_points", "cur_points")
def flagship(s):
    d = grid.diff_pins(s.base_points, s.cur_points)
    count = lambda v: F.count_if(F.col("status") == v).alias(v)
    return d.groupBy("place_id").agg(F.count("*").alias("pins"), *(count(v) for v in ("improved", "declined", "gained", "lost")))


query("a4_g7_solv_per_scan", f"SELECT place_id, scan_id, {SOLV} FROM points GROUP BY place_id, scan_id", "points")(lambda s: grid.solv(s.points, ["place_id", "scan_id"]))
query(
    "a5_solv_by_keyword",
    f"""WITH b AS (SELECT place_id, keyword, 100 * SUM({VIS}) / COUNT(*) AS v FROM base_points GROUP BY 1, 2), c AS (SELECT place_id, keyword, 100 * SUM({VIS}) / COUNT(*) AS v FROM cur_points GROUP BY 1, 2)
    SELECT COALESCE(b.place_id, c.place_id) AS place_id, COALESCE(b.keyword, c.keyword) AS keyword, COALESCE(b.v, 0) AS base_solv, COALESCE(c.v, 0) AS cur_solv, ROUND(COALESCE(c.v, 0) - COALESCE(b.v, 0), 9) + 0.0 AS change
    FROM b FULL JOIN c ON b.place_id = c.place_id AND b.keyword = c.keyword""",
    "base_points",
    "cur_points",
)(lambda s: grid.solv_by_keyword(s.base_points, s.cur_points, ["place_id"]))
query(
    "o9_keyword_changes_ranked",
    f"""WITH b AS (SELECT place_id, keyword, 100 * SUM({VIS}) / COUNT(*) AS v FROM base_points GROUP BY 1, 2), c AS (SELECT place_id, keyword, 100 * SUM({VIS}) / COUNT(*) AS v FROM cur_points GROUP BY 1, 2),
    j AS (SELECT COALESCE(b.place_id, c.place_id) AS place_id, COALESCE(b.keyword, c.keyword) AS keyword, ROUND(COALESCE(c.v, 0) - COALESCE(b.v, 0), 6) + 0.0 AS change FROM b FULL JOIN c ON b.place_id = c.place_id AND b.keyword = c.keyword)
    SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY change DESC, keyword) AS place FROM j""",
    "base_points",
    "cur_points",
)(lambda s: discovery.rank_within(grid.solv_by_keyword(s.base_points, s.cur_points, ["place_id"]).select("place_id", "keyword", F.round("change", 6).alias("change")), "place_id", [F.desc("change"), F.col("keyword")]))
query("a6_pin_mean", 'SELECT place_id, "row", col, AVG(rank) AS mean_rank FROM points GROUP BY 1, 2, 3', "points")(lambda s: grid.pin_mean(s.points))
query("j17_g8_diff_pins", f"WITH {DIFF} SELECT * FROM diff", "base_points", "cur_points")(lambda s: grid.diff_pins(s.base_points, s.cur_points))
query(
    "a7_diff_counts",
    f"""WITH {DIFF} SELECT place_id, {", ".join(f"COUNT(*) FILTER (status = '{x}') AS {x}" for x in ("improved", "declined", "unchanged", "gained", "lost", "still_absent"))},
    COUNT(*) FILTER (status IN ('improved', 'gained')) - COUNT(*) FILTER (status IN ('declined', 'lost')) AS net_improved FROM diff GROUP BY place_id""",
    "base_points",
    "cur_points",
)(lambda s: grid.diff_counts(grid.diff_pins(s.base_points, s.cur_points), ["place_id"]))
query(
    "w11_top_movers",
    f"""WITH {DIFF} SELECT * FROM (SELECT *, CASE WHEN improvement > 0 THEN 'gain' ELSE 'drop' END AS direction,
    ROW_NUMBER() OVER (PARTITION BY place_id, improvement > 0 ORDER BY ABS(improvement) DESC, "row", col, keyword) AS place FROM diff WHERE improvement <> 0) WHERE place <= 5""",
    "base_points",
    "cur_points",
)(lambda s: grid.top_movers(grid.diff_pins(s.base_points, s.cur_points)))
query("x1_shared_pins", 'SELECT place_id, "row", col, keyword FROM base_points INTERSECT SELECT place_id, "row", col, keyword FROM cur_points', "base_points", "cur_points")(lambda s: grid.shared_pins(s.base_points, s.cur_points))
query("x2_all_keywords", "SELECT place_id, keyword FROM base_points UNION SELECT place_id, keyword FROM cur_points", "base_points", "cur_points")(lambda s: grid.all_keywords(s.base_points, s.cur_points))
TIER = "CASE WHEN v IS NULL THEN 'absent' WHEN v <= 3 THEN 'top3' WHEN v <= 10 THEN 'page1' WHEN v <= 20 THEN 'deep' ELSE 'absent' END"
query("g10_f20_heatmap", f"""SELECT place_id, "row", col, v AS value, {TIER} AS tier, COALESCE(CAST(CAST(ROUND_EVEN(v, 0) AS INT) AS VARCHAR), '-') AS label FROM (SELECT place_id, "row", col, AVG(rank) AS v FROM points GROUP BY 1, 2, 3)""", "points")(lambda s: grid.heatmap_cells(s.points))
query("g11_grid_section", "SELECT place_id, COUNT(*) AS n_scans, MIN(scan_id) AS first_scan, MAX(scan_id) AS last_scan, CASE WHEN COUNT(*) >= 2 THEN 'before_after' ELSE 'single' END AS section FROM scans GROUP BY place_id", "scans")(lambda s: grid.grid_section(s.scans))
query("w1_latest_scan", "SELECT place_id, scan_id, n_pins FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY scan_id DESC) AS r FROM scans) WHERE r = 1", "scans")(lambda s: grid.latest(s.scans, ["place_id"], ["scan_id"]).select("place_id", "scan_id", "n_pins"))
query("w2_baseline_scan", "SELECT place_id, scan_id, n_pins FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY scan_id) AS r FROM scans) WHERE r = 1", "scans")(lambda s: grid.earliest(s.scans, ["place_id"], ["scan_id"]).select("place_id", "scan_id", "n_pins"))


@query(
    "g9_scan_headline",
    f"""WITH b AS (SELECT place_id, {SOLV} FROM base_points GROUP BY 1), c AS (SELECT place_id, {SOLV} FROM cur_points GROUP BY 1),
    f AS (SELECT place_id, grid_rows, grid_cols FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY scan_id) r FROM scans) WHERE r = 1), l AS (SELECT place_id, grid_rows, grid_cols FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY scan_id DESC) r FROM scans) WHERE r = 1)
    SELECT place_id, c.solv - b.solv AS solv_change, b.avg_rank - c.avg_rank AS rank_change, (f.grid_rows, f.grid_cols) IS DISTINCT FROM (l.grid_rows, l.grid_cols) AS geometry_changed FROM b JOIN c USING (place_id) JOIN f USING (place_id) JOIN l USING (place_id)""",
    "base_points",
    "cur_points",
    "scans",
)
def headline(s):
    b, c = grid.solv(s.base_points, ["place_id"]).alias("b"), grid.solv(s.cur_points, ["place_id"]).alias("c")
    warn = grid.geometry_warning(grid.earliest(s.scans, ["place_id"], ["scan_id"]), grid.latest(s.scans, ["place_id"], ["scan_id"]), ["grid_rows", "grid_cols"])
    return b.join(c, "place_id").join(warn, "place_id").select("place_id", (F.col("c.solv") - F.col("b.solv")).alias("solv_change"), (F.col("b.avg_rank") - F.col("c.avg_rank")).alias("rank_change"), "geometry_changed")


POS = "SELECT *, SUM(CASE WHEN item_id IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY keyword ORDER BY seq ROWS UNBOUNDED PRECEDING) AS position FROM items"
query("w4_business_position", f"SELECT keyword, seq, CASE WHEN item_id IS NOT NULL THEN CAST(position AS BIGINT) END AS position FROM ({POS})", "items")(lambda s: s.items.select("keyword", "seq", grid.business_position(F.col("item_id"), ["keyword"], ["seq"]).cast("bigint").alias("position")))
query("w5_extract_rank", f"SELECT keyword, item_id, CAST(arg_min(COALESCE(NULLIF(rank_absolute, 0), NULLIF(rank_group, 0), position), position) AS INT) AS rank FROM ({POS}) WHERE item_id IS NOT NULL GROUP BY 1, 2", "items")(lambda s: grid.extract_rank(s.items, ["keyword"], ["seq"]))
query("c18_visibility", f'SELECT place_id, scan_id, "row", col, keyword, {VIS} AS visibility FROM points', "points")(lambda s: s.points.select("place_id", "scan_id", "row", "col", "keyword", C.visibility(F.col("rank")).alias("visibility")))
query("a22_grid_cost", "SELECT place_id, scan_id, n_pins * 2 * 0.002e0 AS usd FROM scans", "scans")(lambda s: budget.grid_cost(s.scans.withColumn("n_keywords", F.lit(2)), 0.002).select("place_id", "scan_id", "usd"))

# --- cells ------------------------------------------------------------------

RADIUS = "CASE WHEN population < 5000 THEN 8000 WHEN population < 25000 THEN 14000 WHEN population < 100000 THEN 22000 WHEN population < 500000 THEN 32000 ELSE 45000 END"
EXPECTED = "CASE WHEN population < 200000 THEN 1 WHEN population < 750000 THEN 4 ELSE 9 END"
HIGH = "CASE WHEN population < 100000 THEN 1 WHEN population < 200000 THEN 4 WHEN population < 750000 THEN 9 ELSE 16 END"
query("f10_o1_plan_cells", f"SELECT cell_id, population, {RADIUS} AS radius_m, {EXPECTED} AS expected_cells, {HIGH} AS high_cells FROM cells", "cells")(lambda s: discovery.plan_cells(s.cells).select("cell_id", "population", "radius_m", "expected_cells", "high_cells"))
query("f2_filter_region_names", "SELECT cell_id FROM cells WHERE lower(state_code) IN ('france', 'asia') OR lower(state_name) IN ('france', 'asia')", "cells")(lambda s: discovery.filter_region(s.cells, "France, ASIA").select("cell_id"))
query("f2_filter_region_bbox", "SELECT cell_id FROM cells WHERE lat BETWEEN 35.5e0 AND 36.5e0 AND lng BETWEEN -89.5e0 AND -88e0", "cells")(lambda s: discovery.filter_region(s.cells, "bbox:35.5,-89.5,36.5,-88").select("cell_id"))
query("f3_filter_states", "SELECT place_id FROM businesses WHERE lower(state_code) IN ('nation_3', 'nation_7')", "businesses")(lambda s: discovery.filter_states(s.businesses, "NATION_3,nation_7").select("place_id"))
query("c17_geo_bucket", "SELECT cell_id, CAST(FLOOR(lat / 0.5e0) AS BIGINT) AS y, CAST(FLOOR(lng / 0.5e0) AS BIGINT) AS x FROM cells", "cells")(lambda s: s.cells.select("cell_id", *(c.alias(n) for c, n in zip(C.geo_bucket(F.col("lat"), F.col("lng")), ("y", "x"), strict=True))))
HAV = "2 * 6371000e0 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2))))"
query("c13_haversine", f"SELECT a.cell_id AS a, b.cell_id AS b, ROUND({HAV}, 3) AS metres FROM cells a JOIN cells b ON a.state_code = b.state_code AND a.cell_id < b.cell_id", "cells")(
    lambda s: tiled_join(s.cells.select("state_code", "cell_id", "lat", "lng"), s.cells.select("state_code", "cell_id", "lat", "lng"), ["state_code"], F.col("a.cell_id") < F.col("b.cell_id")).select(F.col("a.cell_id").alias("a"), F.col("b.cell_id").alias("b"), F.round(C.haversine_m(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")), 3).alias("metres"))
)
query("c14_degrees", "SELECT cell_id, 14000 / 111320e0 AS dlat, 14000 / (111320e0 * greatest(0.1, cos(radians(lat)))) AS dlng FROM cells", "cells")(lambda s: s.cells.select("cell_id", *(c.alias(n) for c, n in zip(C.degrees_of(F.lit(14000.0), F.col("lat")), ("dlat", "dlng"), strict=True))))
query(
    "c15_pin_grid",
    """SELECT cell_id AS place_id, CAST(r AS INT) AS "row", CAST(c AS INT) AS col, ROUND(lat + (2 - r) * (2 / 110.574e0), 6) AS lat, ROUND(lng + (c - 2) * (2 / (111.32e0 * cos(radians(lat)))), 6) AS lng FROM cells, range(5) x(r), range(5) y(c)""",
    "cells",
)(lambda s: grid.pin_grid(s.cells.withColumnRenamed("cell_id", "place_id"), 5, 5, 2.0))
query(
    "c16_subdivide",
    f"""SELECT cell_id || '/q' || i AS cell_id, ROUND(lat + sa * r * 0.5 / 111320e0, 9) AS lat, ROUND(lng + sb * r * 0.5 / (111320e0 * greatest(0.1, cos(radians(lat)))), 9) AS lng, greatest(2000, CAST(floor(r * 0.6e0) AS INT)) AS radius_m
    FROM (SELECT *, {RADIUS} AS r FROM cells), (VALUES (0, 1, 1), (1, 1, -1), (2, -1, 1), (3, -1, -1)) q(i, sa, sb)""",
    "cells",
)(lambda s: discovery.subdivide(discovery.plan_cells(s.cells)).select("cell_id", F.round("lat", 9).alias("lat"), F.round("lng", 9).alias("lng"), "radius_m"))
COVERS = f"""c AS (SELECT *, {RADIUS} AS radius_m FROM cells), covers AS (SELECT a.cell_id AS small, b.cell_id AS large FROM c a JOIN c b
  ON abs(floor(a.lat / 0.5e0) - floor(b.lat / 0.5e0)) <= 1 AND abs(floor(a.lng / 0.5e0) - floor(b.lng / 0.5e0)) <= 1 AND (b.population > a.population OR (b.population = a.population AND b.cell_id < a.cell_id))
  WHERE {HAV} <= greatest(a.radius_m, b.radius_m))"""
query("j9_cover_edges", f"WITH {COVERS} SELECT small, large FROM covers", "cells")(lambda s: discovery.cover_edges(discovery.plan_cells(s.cells)))
query(
    "j9_prune_overlapping",
    f"""WITH RECURSIVE {COVERS}, ranked AS (SELECT cell_id, row_number() OVER (ORDER BY population DESC, cell_id) AS n, coalesce((SELECT list(large) FROM covers WHERE small = cell_id), []) AS larges FROM cells),
    keep(n, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) UNION ALL
      SELECT r.n, CASE WHEN list_has_any(k.kept, r.larges) THEN k.kept ELSE list_append(k.kept, r.cell_id) END FROM keep k JOIN ranked r ON r.n = k.n + 1)
    SELECT unnest(kept) AS cell_id FROM keep WHERE n = (SELECT max(n) FROM keep)""",
    "cells",
)(lambda s: discovery.prune_overlapping(discovery.plan_cells(s.cells)).select("cell_id"))
BUCKETS = "(VALUES ('core', 'excavating contractor'), ('core', 'excavation company'), ('septic', 'septic service')) q(bucket, phrase)"
query("f11_j21_query_plan", f"SELECT cell_id, bucket, phrase FROM cells, {BUCKETS} WHERE population >= 10000 OR bucket = 'core'", "cells")(
    lambda s: discovery.query_plan(s.cells, s.spark.createDataFrame([("core", "excavating contractor"), ("core", "excavation company"), ("septic", "septic service")], "bucket string, phrase string"), "core").select("cell_id", "bucket", "phrase")
)
query(
    "a21_sweep_estimate",
    f"""WITH t AS (SELECT COUNT(*) AS l, SUM({EXPECTED}) AS e, SUM({HIGH}) AS h FROM cells) SELECT CAST(floor(l * 5e0 + 0.999e0) AS BIGINT) AS low_requests, CAST(floor(e * 7e0 + 0.999e0) AS BIGINT) AS expected_requests, CAST(floor(h * 11e0 + 0.999e0) AS BIGINT) AS high_requests,
    floor(l * 5e0 + 0.999e0) * 35e0 / 1000 AS low_usd, floor(e * 7e0 + 0.999e0) * 35e0 / 1000 AS expected_usd, floor(h * 11e0 + 0.999e0) * 35e0 / 1000 AS high_usd FROM t""",
    "cells",
)(lambda s: discovery.sweep_estimate(s.cells, 5, 35.0))
RESULTS = "SELECT CAST(l_suppkey AS {s}) AS cell_id, l_returnflag AS bucket, CAST(l_quantity AS BIGINT) AS n_results, l_quantity > 48 AS more FROM {t}"
query("a20_cell_results", f"SELECT cell_id, bucket, SUM(n_results)::BIGINT AS found, bool_or(more OR n_results >= 60) AS saturated FROM ({RESULTS.format(s='VARCHAR', t='lineitem')}) GROUP BY 1, 2")(lambda s: discovery.cell_results(s.spark.sql(RESULTS.format(s="STRING", t="{l}"), l=s.lineitem)))
query("u5_commit_cells", f"SELECT cell_id, bucket, found, saturated FROM (SELECT cell_id, bucket, SUM(n_results)::BIGINT AS found, bool_or(more OR n_results >= 60) AS saturated FROM ({RESULTS.format(s='VARCHAR', t='lineitem')}) GROUP BY 1, 2) WHERE bucket <> 'R'")(
    lambda s: store.commit_cells(discovery.cell_results(s.spark.sql(RESULTS.format(s="STRING", t="{l}"), l=s.lineitem)).withColumn("complete", F.col("bucket") != "R"))
)

# --- budgets ----------------------------------------------------------------

query("w8_budget_prefix", "SELECT id, cost, CAST(running AS BIGINT) AS running FROM (SELECT *, SUM(cost) OVER (ORDER BY priority DESC, id ROWS UNBOUNDED PRECEDING) AS running FROM requests) WHERE running <= 20000", "requests")(lambda s: budget.budget_prefix(s.requests, "cost", [F.desc("priority"), F.col("id")], 20000).select("id", "cost", "running"))
query(
    "w9_guarded_prefix",
    """SELECT id, CAST(running AS BIGINT) AS running FROM (SELECT *, CASE WHEN failed THEN cost ELSE greatest(actual, cost) END AS charged, SUM(CASE WHEN failed THEN cost ELSE greatest(actual, cost) END) OVER (ORDER BY priority DESC, id ROWS UNBOUNDED PRECEDING) AS running FROM requests) WHERE running - charged + cost <= 20000""",
    "requests",
)(lambda s: budget.guarded_prefix(s.requests, "cost", "actual", F.col("failed"), [F.desc("priority"), F.col("id")], 20000).select("id", "running"))
query("w10_assign_batches", "SELECT place_id, (ROW_NUMBER() OVER (ORDER BY place_id) - 1) // 40 AS batch FROM businesses", "businesses")(lambda s: reviews.assign_batches(s.businesses.select("place_id"), 40, ["place_id"]))
query("o7_top_k", "SELECT place_id, review_count FROM businesses ORDER BY review_count DESC, place_id LIMIT 25", "businesses")(lambda s: store.top_k(s.businesses, 25, [F.desc("review_count"), F.col("place_id")]).select("place_id", "review_count"))
query("a22_review_cost", "SELECT CAST(id AS BIGINT) AS id, 0.00075e0 + ceil(actual / 10.0) * 0.00075e0 AS usd FROM requests", "requests")(lambda s: budget.review_cost(s.requests.withColumn("depth", F.col("actual")), 0.00075, 0.00075).select("id", "usd"))

# --- store ------------------------------------------------------------------

query("a1_store_status", "SELECT COUNT(*) AS businesses, COUNT(*) FILTER (no_website = 1) AS no_website, COUNT(DISTINCT NULLIF(state_code, '')) AS states FROM businesses", "businesses")(lambda s: store.store_status(s.businesses))
query("a2_enrichment_status", "SELECT mgmt_status, COUNT(*) AS n FROM enrichment GROUP BY 1", "enrichment")(lambda s: s.enrichment.groupBy("mgmt_status").agg(F.count("*").alias("n")))
query("a3_profile_status", "SELECT status, COUNT(*) AS audits, COUNT(DISTINCT place_id) AS places, COUNT(*) FILTER (is_claimed = 0) AS unclaimed FROM audits GROUP BY 1", "audits")(lambda s: s.audits.groupBy("status").agg(F.count("*").alias("audits"), F.countDistinct("place_id").alias("places"), F.count_if(F.col("is_claimed") == 0).alias("unclaimed")))
query("j4_leads_to_enrich", "SELECT place_id FROM businesses WHERE place_id NOT IN (SELECT place_id FROM enrichment)", "businesses", "enrichment")(lambda s: store.pending(s.businesses, s.enrichment, ["place_id"]).select("place_id"))
query("j3_retry_list", "SELECT place_id, site_status FROM businesses JOIN enrichment USING (place_id) WHERE site_status IN ('blocked', 'unreachable')", "businesses", "enrichment")(lambda s: s.businesses.join(s.enrichment, "place_id").where(F.col("site_status").isin("blocked", "unreachable")).select("place_id", "site_status"))
query("j6_restrict_cohort", "SELECT place_id FROM businesses WHERE place_id IN (SELECT place_id FROM contacts)", "businesses", "contacts")(lambda s: store.restrict(s.businesses, s.contacts.select("place_id")).select("place_id"))
query("j7_pending_pins", 'SELECT place_id, "row", col, keyword FROM cur_points EXCEPT SELECT place_id, "row", col, keyword FROM base_points', "base_points", "cur_points")(lambda s: store.pending(s.cur_points, s.base_points, grid.PIN).select(*grid.PIN))
MERGED = "s AS (SELECT place_id, {pick}(name, seq) AS name, {pick}(website, seq) AS website, {pick}(review_count, seq) AS review_count, arg_min(state_code, seq) AS state_code, list_sort(list_distinct(list(via))) AS via, COUNT(*) AS n FROM sightings GROUP BY 1)"


MERGED_FIELDS = ["state_code", "trade_bucket", "relevance", "name", "website", "review_count", "found_via", "first_seen", "last_refreshed"]


def _held(s):
    return s.businesses.where("CAST(place_id AS BIGINT) % 2 = 0").withColumns({"found_via": F.array("trade_bucket"), "first_seen": F.lit("2025-01-01").cast("timestamp"), "last_refreshed": F.lit("2025-01-01").cast("timestamp")})


def _merged(s, refresh: bool):
    old = _held(s)
    new = s.sightings.withColumn("found_via", F.array("via"))
    return store.merge_businesses(old, new, F.lit("2026-01-01").cast("timestamp"), refresh)


def _merge_sql(refresh: bool) -> str:
    held = "o.place_id IS NOT NULL" + (" AND s.place_id IS NULL" if refresh else "")
    return f"""WITH {MERGED.format(pick="arg_max" if refresh else "arg_min")}, o AS (SELECT * FROM businesses WHERE CAST(place_id AS BIGINT) % 2 = 0)
    SELECT COALESCE(o.place_id, s.place_id) AS place_id, CASE WHEN o.place_id IS NOT NULL THEN o.state_code ELSE s.state_code END AS state_code, CASE WHEN {held} THEN o.name ELSE s.name END AS name, CASE WHEN {held} THEN o.review_count ELSE s.review_count END AS review_count,
    array_to_string(list_sort(list_distinct(list_concat(CASE WHEN o.place_id IS NULL THEN [] ELSE [o.trade_bucket] END, COALESCE(s.via, [])))), '|') AS via, CASE WHEN o.place_id IS NULL THEN 'inserted' WHEN s.place_id IS NOT NULL THEN 'updated' ELSE 'kept' END AS action
    FROM o FULL JOIN s ON o.place_id = s.place_id"""


for _name, _refresh in (("u1_a24_merge", False), ("u1_merge_refresh", True)):
    query(_name, _merge_sql(_refresh), "businesses", "sightings")(lambda s, r=_refresh: _merged(s, r).select("place_id", "state_code", "name", "review_count", F.array_join("found_via", "|").alias("via"), "action"))
query("a23_merge_counters", "WITH o AS (SELECT place_id FROM businesses WHERE CAST(place_id AS BIGINT) % 2 = 0), n AS (SELECT COUNT(DISTINCT place_id) AS i FROM sightings WHERE place_id NOT IN (SELECT place_id FROM o)) SELECT i AS inserted, (SELECT COUNT(*) FROM sightings) - i AS updated FROM n", "businesses", "sightings")(lambda s: store.merge_counters(_merged(s, False)))
REPLACE_SQL = "SELECT place_id, site_status FROM enrichment WHERE place_id NOT IN (SELECT place_id FROM contacts) UNION ALL SELECT place_id, 'live' FROM contacts"
query("u2_u3_replace_by_key", REPLACE_SQL, "enrichment", "contacts")(lambda s: store.replace_by_key(s.enrichment.select("place_id", "site_status"), s.contacts.select("place_id", F.lit("live").alias("site_status")), ["place_id"]))
PINS_SQL = 'SELECT COALESCE(o.place_id, n.place_id) AS place_id, COALESCE(o."row", n."row") AS "row", COALESCE(o.col, n.col) AS col, COALESCE(o.keyword, n.keyword) AS keyword, COALESCE(o.scan_id, n.scan_id) AS scan_id, CASE WHEN n.place_id IS NOT NULL THEN n.rank ELSE o.rank END AS rank FROM (SELECT 1 AS scan_id, * FROM base_points) o FULL JOIN (SELECT 2 AS scan_id, * FROM cur_points) n ON o.place_id = n.place_id AND o."row" = n."row" AND o.col = n.col AND o.keyword = n.keyword'
query(
    "u4_upsert_pins",
    PINS_SQL,
    "base_points",
    "cur_points",
)(lambda s: store.upsert_pins(s.base_points.withColumn("scan_id", F.lit(1)), s.cur_points.withColumn("scan_id", F.lit(2))))

# The same merges into stored tables in buckets: the first apply puts the old rows in, the second merges.


def _stored(tag: str, old, new, keys: list[str], merge):
    table = KeyedTable(old.sparkSession, new_path(old.sparkSession, tag), old.schema, keys)
    table.apply(old, lambda held, rows: rows)
    table.apply(new, merge)
    return table.read()


@query("u1_keyed_merge", f"SELECT place_id, state_code, name, review_count, via FROM ({_merge_sql(True)})", "businesses", "sightings")
def keyed_merge(s):
    old = _held(s).select("place_id", *MERGED_FIELDS)
    stored = _stored("businesses", old, s.sightings.withColumn("found_via", F.array("via")), ["place_id"], lambda o, n: store.merge_businesses(o, n, F.lit("2026-01-01").cast("timestamp"), True))
    return stored.select("place_id", "state_code", "name", "review_count", F.array_join("found_via", "|").alias("via"))


@query("u2_keyed_replace", REPLACE_SQL, "enrichment", "contacts")
def keyed_replace(s):
    return _stored("enrichment", s.enrichment.select("place_id", "site_status"), s.contacts.select("place_id", F.lit("live").alias("site_status")), ["place_id"], lambda o, n: store.replace_by_key(o, n, ["place_id"]))


@query("u3_keyed_ledger", "SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END AS requests FROM orders")
def keyed_ledger(s):
    runs = s.orders.select(F.col("o_orderkey").cast("bigint").alias("run_id"), F.lit("all").alias("region"), F.lit(5.0).alias("budget"), F.lit("live").alias("mode"), F.lit("2026-01-01").cast("timestamp").alias("started_ts"), F.lit(None).cast("timestamp").alias("ended_ts"), F.lit(0).cast("bigint").alias("requests"), F.lit(0.0).alias("cost"))
    done = s.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("run_id"), F.lit("2026-01-02").cast("timestamp").alias("ended_ts"), F.col("o_custkey").cast("bigint").alias("requests"), F.col("o_totalprice").alias("cost"))
    return _stored("ledger", runs, done, ["run_id"], store.finish_run).select("run_id", "requests")


@query("u4_keyed_pins", PINS_SQL, "base_points", "cur_points")
def keyed_pins(s):
    old = s.base_points.withColumn("scan_id", F.lit(1)).select(*grid.PIN, "scan_id", "rank")
    return _stored("pins", old, s.cur_points.withColumn("scan_id", F.lit(2)), grid.PIN, store.upsert_pins)


# --- lenses -----------------------------------------------------------------

LEAD = "lead AS (SELECT b.*, e.site_status, e.readiness_score, e.google_ads, e.mgmt_status, c.phone FROM businesses b LEFT JOIN enrichment e USING (place_id) LEFT JOIN contacts c USING (place_id))"
_lead = lambda s: lenses.lead_view(s.businesses, s.enrichment, s.contacts)
LENS = ("businesses", "enrichment", "contacts")
query("j1_lead_view", f"WITH {LEAD} SELECT place_id, name, site_status, readiness_score, phone FROM lead", *LENS)(lambda s: _lead(s).select("place_id", "name", "site_status", "readiness_score", "phone"))
BUCKET = "CASE WHEN no_website = 1 THEN 0 WHEN site_status IN ('dead', 'unreachable', 'social_only', 'directory', 'parked') THEN 1 WHEN site_status = 'live' THEN 2 ELSE 4 END"
query("f15_opp_bucket", f"WITH {LEAD} SELECT place_id, {BUCKET} AS bucket FROM lead", *LENS)(lambda s: _lead(s).select("place_id", C.opp_bucket(F.col("no_website"), F.col("site_status")).alias("bucket")))
query(
    "f16_readiness_cell",
    f"WITH {LEAD} SELECT place_id, CASE WHEN no_website = 1 THEN 'NO SITE' WHEN site_status = 'live' THEN COALESCE(CAST(readiness_score AS VARCHAR), 'n/a') WHEN site_status IS NOT NULL THEN 'n/a (' || site_status || ')' ELSE 'n/a' END AS cell, CASE WHEN no_website = 1 THEN 'no website - full build opportunity' ELSE 'solid site - few gaps' END AS gap FROM lead",
    *LENS,
)(lambda s: _lead(s).select("place_id", C.readiness_cell(F.col("no_website"), F.col("site_status"), F.col("readiness_score")).alias("cell"), C.top_gap(F.col("no_website"), F.array().cast("array<string>")).alias("gap")))
OPP = f"CASE relevance WHEN 'match' THEN 0 WHEN 'maybe' THEN 1 ELSE 9 END, {BUCKET}, COALESCE(readiness_score, -1) DESC, COALESCE(review_count, 0) DESC, COALESCE(name, ''), place_id"
query("o2_w3_opportunity_rank", f"WITH {LEAD} SELECT place_id, state_code, ROW_NUMBER() OVER (PARTITION BY state_code ORDER BY {OPP}) AS place FROM lead", *LENS)(lambda s: discovery.rank_within(_lead(s), "state_code", lenses.opportunity_order()).select("place_id", "state_code", "place"))
TAGS = "CASE WHEN CAST(place_id AS BIGINT) % 5 = 0 THEN ['Hotjar', 'HubSpot', 'CallRail'] ELSE [] END"
SIGNAL = f"CASE WHEN google_ads = 1 THEN 'Google Ads' WHEN mgmt_status = 'likely agency-managed' THEN 'agency-managed' WHEN CAST(place_id AS BIGINT) % 5 = 0 THEN 'CallRail/HubSpot' ELSE '' END"
GAP = "(no_website = 1 OR (site_status IS NOT NULL AND site_status <> 'live') OR COALESCE(readiness_score, -1) >= 5)"
BUDGET = f"bud AS (SELECT *, {SIGNAL} AS sig, CASE WHEN {SIGNAL} <> '' THEN 1 WHEN review_count >= 20 AND {GAP} THEN 2 ELSE 3 END AS budget_tier FROM lead)"


def _budget(s):
    tags = F.when(F.col("place_id").cast("bigint") % 5 == 0, F.array(F.lit("Hotjar"), F.lit("HubSpot"), F.lit("CallRail"))).otherwise(F.array().cast("array<string>"))
    return lenses.with_budget(_lead(s).withColumn("marketing_tags", tags))


query("f17_x4_paid_signal", f"WITH {LEAD} SELECT place_id, {SIGNAL} AS signal FROM lead", *LENS)(lambda s: _budget(s).select("place_id", C.paid_signal(F.col("google_ads"), F.col("mgmt_status"), F.col("marketing_tags")).alias("signal")))
query("f18_has_gap", f"WITH {LEAD} SELECT place_id, {GAP} AS gap FROM lead", *LENS)(lambda s: _lead(s).select("place_id", C.has_gap(F.col("no_website"), F.col("site_status"), F.col("readiness_score")).alias("gap")))
query(
    "f19_budget_tier",
    f"""WITH {LEAD}, {BUDGET} SELECT place_id, budget_tier, CASE budget_tier WHEN 1 THEN 'PROVEN BUDGET' WHEN 2 THEN 'QUALIFIED DEMAND' ELSE 'long tail' END AS budget_label,
    CASE budget_tier WHEN 1 THEN sig WHEN 2 THEN 'busy: ' || review_count || ' reviews, ' || CASE WHEN no_website = 1 THEN 'no site' WHEN site_status IS NOT NULL AND site_status <> 'live' THEN 'dead/blocked site' ELSE 'weak site' END ELSE '' END AS budget_reason FROM bud""",
    *LENS,
)(lambda s: _budget(s).select("place_id", "budget_tier", "budget_label", "budget_reason"))
query(
    "o3_budget_rank",
    f"WITH {LEAD}, {BUDGET} SELECT place_id, budget_tier, ROW_NUMBER() OVER (PARTITION BY state_code ORDER BY budget_tier, CASE WHEN budget_tier = 1 THEN COALESCE(readiness_score, -1) ELSE review_count END DESC, CASE WHEN budget_tier = 1 THEN review_count ELSE COALESCE(readiness_score, -1) END DESC, name, place_id) AS place FROM bud",
    *LENS,
)(lambda s: discovery.rank_within(_budget(s), "state_code", lenses.budget_order()).select("place_id", "budget_tier", "place"))
query("a18_tier_counts", f"WITH {LEAD}, {BUDGET} SELECT budget_tier, COUNT(*) AS n FROM bud GROUP BY 1", *LENS)(lambda s: _budget(s).groupBy("budget_tier").agg(F.count("*").alias("n")))
query("a16_state_totals", "SELECT state_code, COUNT(*) AS leads, COUNT(*) FILTER (no_website = 1) AS no_site FROM businesses GROUP BY 1", "businesses")(lambda s: lenses.state_totals(s.businesses))
query("j5_shortlist", f"SELECT place_id, ROW_NUMBER() OVER (PARTITION BY state_code ORDER BY readiness_score DESC, review_count DESC, place_id) AS place FROM businesses LEFT JOIN enrichment USING (place_id) WHERE website IS NOT NULL AND no_website = 0 AND readiness_score IS NOT NULL AND place_id NOT IN (SELECT place_id FROM contacts)", *LENS)(lambda s: discovery.rank_within(lenses.shortlist(s.businesses, s.enrichment, s.contacts), "state_code", lenses.shortlist_order()).select("place_id", "place"))
query("j5_shortlist_keys", "SELECT place_id, readiness_score FROM businesses LEFT JOIN enrichment USING (place_id) WHERE place_id NOT IN (SELECT place_id FROM contacts) AND place_id IN (SELECT place_id FROM sightings)", "businesses", "enrichment", "contacts", "sightings")(
    lambda s: lenses.shortlist(s.businesses, s.enrichment, s.contacts, s.sightings).select("place_id", "readiness_score")
)
query("s7_area_label", "SELECT string_agg(DISTINCT state_name, ', ' ORDER BY state_name) AS label FROM businesses", "businesses")(lambda s: __import__("localpulse.sources.tables", fromlist=["area_label"]).area_label(s.businesses))

query(
    "f23_lead_records",
    f"""WITH {LEAD}, {BUDGET} SELECT place_id, CASE budget_tier WHEN 1 THEN 'PROVEN BUDGET' WHEN 2 THEN 'QUALIFIED DEMAND' ELSE 'long tail' END AS qualified, CASE relevance WHEN 'match' THEN 'CONFIRMED' ELSE 'REVIEW' END AS tier, review_count AS reviews, CASE WHEN no_website = 1 THEN 'NO' ELSE 'yes' END AS has_website,
    COALESCE(site_status, CASE WHEN no_website = 1 THEN 'none' ELSE '' END) AS site_status, COALESCE(mgmt_status, '') AS management, array_to_string({TAGS}, ', ') AS marketing_tags, COALESCE(phone, '') AS phone, COALESCE(website, '') AS website, state_code AS state FROM bud""",
    *LENS,
)(lambda s: lenses.to_record(_budget(s)).drop("name", "budget_signal", "readiness"))
query(
    "f23_profile_records",
    "WITH lat AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY id DESC) AS r FROM audits WHERE status = 'complete') WHERE r = 1) SELECT place_id, CASE relevance WHEN 'match' THEN 'CONFIRMED' ELSE 'REVIEW' END AS tier, CASE WHEN is_claimed IS NULL THEN '?' WHEN is_claimed <> 0 THEN 'yes' ELSE 'NO' END AS claimed, COALESCE(CAST(rating_votes AS VARCHAR), '') AS votes, COALESCE(CAST(total_photos AS VARCHAR), '') AS photos, COALESCE(phone, '') AS phone, state_code AS state FROM businesses JOIN lat USING (place_id) LEFT JOIN contacts USING (place_id)",
    "businesses",
    "audits",
    "contacts",
)(lambda s: lenses.to_profile_record(lenses.profile_view(s.businesses, profiles.latest_audits(profiles.with_neglect(s.audits)), s.contacts)).drop("name", "neglect", "top_gaps"))
PROSPECT = """pr AS (SELECT b.place_id, b.name, b.review_count, b.website IS NULL OR b.page % 3 = 1 AS no_usable, CASE WHEN b.page % 3 = 0 THEN b.page % 8 END AS score, CASE WHEN contains(b.name, '77') THEN 'chain' ELSE 'local' END AS tier, 'p' || b.name AS phone, b.page % 3 AS k, b.page
  FROM (SELECT x.*, p.page_id AS page FROM businesses x LEFT JOIN (SELECT max(page_id) AS page_id, regexp_extract(url, '://([^/]*)', 1) AS h FROM pages GROUP BY 2) p ON p.h = regexp_extract(x.website, '://([^/]*)', 1)) b)"""
GROUPED = "SELECT *, CASE WHEN no_usable THEN 'build' ELSE tier END AS grp, ROW_NUMBER() OVER (PARTITION BY CASE WHEN no_usable THEN 'build' ELSE tier END ORDER BY CASE WHEN NOT no_usable AND tier = 'local' THEN COALESCE(score, -1) ELSE 0 END DESC, review_count DESC, place_id) AS rank FROM pr"


def _prospects(s):
    page = F.col("page_id")
    audits = s.pages.groupBy(C.host_of(F.col("url")).alias("host")).agg(F.max("page_id").alias("page_id"))
    audits = audits.select("host", F.when(page % 3 == 0, 200).when(page % 3 == 1, 404).otherwise(403).alias("http_status"), F.lit("Home").alias("title"), F.lit(300).alias("word_count"), (page % 8).alias("score"), F.lit(True).alias("https"))
    contacts = s.businesses.select("name", F.concat(F.lit("p"), "name").alias("phone"))
    return lenses.prospect_groups(lenses.prospect_table(s.businesses, audits, contacts).withColumn("tier", C.tier_of(F.col("name"), ["77"])))


query("j23_o6_prospect_groups", f"WITH {PROSPECT} SELECT place_id, grp AS \"group\", rank FROM ({GROUPED})", "businesses")(lambda s: _prospects(s).select("place_id", "group", "rank"))
query("f24_flat_prospects", f"WITH {PROSPECT} SELECT place_id, grp AS \"group\", rank, name, CASE WHEN no_usable THEN 'NO SITE' WHEN score IS NULL THEN 'n/a (site error)' ELSE CAST(score AS VARCHAR) END AS score, phone, CASE WHEN page IS NULL THEN '' ELSE 'yes' END AS https, CASE WHEN page IS NULL THEN '' ELSE '300' END AS words FROM ({GROUPED})", "businesses")(lambda s: lenses.flat_prospects(_prospects(s)))
query("s19_run_ledger", "SELECT DISTINCT o_orderkey AS run_id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END AS requests, CASE WHEN o_orderkey % 2 = 0 THEN round(o_totalprice, 2) ELSE 0 END AS cost FROM orders UNION ALL SELECT max(o_orderkey) + 1, 0, 0 FROM orders")(
    lambda s: store.open_run(
        store.finish_run(
            s.orders.select(F.col("o_orderkey").alias("run_id"), F.lit("all").alias("region"), F.lit(5.0).alias("budget"), F.lit("live").alias("mode"), F.lit("2026-01-01").cast("timestamp").alias("started_ts"), F.lit(None).cast("timestamp").alias("ended_ts"), F.lit(0).cast("bigint").alias("requests"), F.lit(0.0).alias("cost")),
            s.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("run_id"), F.lit("2026-01-02").cast("timestamp").alias("ended_ts"), F.col("o_custkey").cast("bigint").alias("requests"), F.col("o_totalprice").alias("cost")),
        ), "all", 5.0, "live", F.lit("2026-01-03").cast("timestamp")
    ).select("run_id", "requests", "cost")
)

# --- profiles ---------------------------------------------------------------

SCORE = "(CASE WHEN rating_votes < 10 THEN 10 ELSE 0 END + CASE WHEN total_photos < 10 THEN 10 ELSE 0 END + CASE WHEN additional_categories_count = 0 THEN 8 ELSE 0 END + CASE WHEN has_hours = 0 THEN 7 ELSE 0 END)"
LAT = "lat AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY id DESC) AS r FROM audits WHERE status = 'complete') WHERE r = 1)"
BASE = "bas AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY audited_ts, id) AS r FROM audits WHERE status = 'complete' AND audit_type IN ('baseline', 'prospect')) WHERE r = 1)"
query("g4_neglect_score", f"SELECT id, CAST({SCORE} AS DOUBLE) AS neglect_score FROM audits", "audits")(lambda s: profiles.with_neglect(s.audits).select("id", "neglect_score"))
query("w1_latest_audit", f"WITH {LAT} SELECT place_id, id FROM lat", "audits")(lambda s: profiles.latest_audits(s.audits).select("place_id", "id"))
query("w2_baseline_audit", f"WITH {BASE} SELECT place_id, id FROM bas", "audits")(lambda s: profiles.baseline_audits(s.audits).select("place_id", "id"))
query("g3_audit_rows", f"SELECT id, CASE WHEN status = 'error' THEN 'error' WHEN rating_votes IS NOT NULL THEN 'complete' ELSE 'no_data' END AS status, CASE WHEN status <> 'error' AND rating_votes IS NOT NULL THEN CAST({SCORE} AS DOUBLE) END AS neglect_score FROM audits", "audits")(
    lambda s: profiles.audit_rows(profiles.with_neglect(s.audits).withColumns({"failed": F.col("status") == "error", "found": F.col("rating_votes").isNotNull()})).select("id", "status", "neglect_score")
)
query("g5_rescore", f"SELECT id, CAST({SCORE} - CASE WHEN has_hours = 0 THEN 7 ELSE 0 END AS DOUBLE) AS neglect_score, has_hours = 0 AS moved FROM audits", "audits")(lambda s: profiles.rescore(profiles.with_neglect(s.audits), {**__import__("localpulse.config", fromlist=["x"]).NEGLECT_WEIGHTS, "no_hours": 0}).select("id", "neglect_score", "moved"))
SIG = "list_filter([CASE WHEN rating_votes < 10 THEN 'thin_reviews' END, CASE WHEN total_photos < 10 THEN 'few_photos' END, CASE WHEN additional_categories_count = 0 THEN 'no_secondary_categories' END, CASE WHEN has_hours = 0 THEN 'no_hours' END], lambda x: x IS NOT NULL)"
query(
    "g6_x3_diff_profiles",
    f"""WITH {BASE}, cur AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY audited_ts DESC, id DESC) AS r FROM audits WHERE status = 'complete') WHERE r = 1),
    b AS (SELECT *, {SCORE} AS sc, {SIG} AS sig FROM bas), c AS (SELECT *, {SCORE} AS sc, {SIG} AS sig FROM cur)
    SELECT b.place_id, b.id AS base_id, c.id AS cur_id, c.rating_votes - b.rating_votes AS votes_delta, c.total_photos - b.total_photos AS photos_delta, b.has_hours = 0 AND c.has_hours = 1 AS hours_added, CAST(b.sc - c.sc AS DOUBLE) AS neglect_improvement,
    array_to_string(list_sort(list_filter(b.sig, lambda x: NOT list_contains(c.sig, x))), ',') AS resolved FROM b JOIN c USING (place_id) WHERE b.id <> c.id""",
    "audits",
)(lambda s: profiles.diff_profiles(s.audits))
query("f25_recently_audited", "SELECT DISTINCT place_id FROM audits WHERE audited_ts >= (SELECT max(audited_ts) - INTERVAL 2 DAY FROM audits) AND status IN ('complete', 'no_data')", "audits")(
    lambda s: profiles.recently_audited(s.audits, F.lit(s.audits.agg(F.max("audited_ts")).first()[0]) - F.expr("INTERVAL 2 DAYS"))
)
query("j2_o4_profile_rank", f"WITH {LAT}, v AS (SELECT b.place_id, b.state_code, b.relevance, b.review_count, b.name, {SCORE} AS sc FROM businesses b JOIN lat USING (place_id)) SELECT place_id, ROW_NUMBER() OVER (PARTITION BY state_code ORDER BY CASE relevance WHEN 'match' THEN 0 ELSE 1 END, sc DESC NULLS LAST, review_count DESC, name, place_id) AS place FROM v", "businesses", "audits")(
    lambda s: discovery.rank_within(lenses.profile_view(s.businesses, profiles.latest_audits(profiles.with_neglect(s.audits)), s.contacts), "state_code", lenses.profile_order()).select("place_id", "place")
)
query("a17_profile_summary", f"WITH {LAT} SELECT AVG(CAST({SCORE} AS DOUBLE)) AS mean_neglect, COUNT(*) FILTER (is_claimed = 0) AS unclaimed FROM lat", "audits")(lambda s: profiles.latest_audits(profiles.with_neglect(s.audits)).agg(F.avg("neglect_score").alias("mean_neglect"), F.count_if(F.col("is_claimed") == 0).alias("unclaimed")))
query(
    "w12_x6_stratified",
    f"WITH {LAT} SELECT * FROM (SELECT place_id, 'unclaimed' AS stratum FROM lat WHERE is_claimed = 0 ORDER BY rating_votes DESC NULLS LAST, place_id LIMIT 20) UNION ALL SELECT * FROM (SELECT place_id, 'claimed' AS stratum FROM lat WHERE is_claimed = 1 AND rating_votes >= 5 ORDER BY place_id LIMIT 10)",
    "audits",
)(lambda s: profiles.stratified(profiles.latest_audits(s.audits), 20, 10))
CMP = "c AS (SELECT l.place_id, abs(l.rating_votes - m.votes) AS gap, m.votes, l.has_hours = m.h AS ok FROM lat l JOIN (SELECT place_id, rating_votes AS votes, has_hours AS h FROM bas) m USING (place_id))"


def _compared(s):
    stored = profiles.latest_audits(s.audits).select("place_id", F.lit(4.0).alias("rating"), F.col("rating_votes").alias("votes"), "has_hours")
    live = profiles.baseline_audits(s.audits).select("place_id", F.lit(4.1).alias("rating"), F.col("rating_votes").alias("votes"), "has_hours")
    return profiles.compare_sources(stored, live)


query("j20_compare_sources", f"WITH {LAT}, {BASE}, {CMP} SELECT place_id, COALESCE(gap <= greatest(2, votes * 0.05e0), false) AS votes_ok, ok AS hours_ok, COALESCE(gap > greatest(5, votes * 0.2e0), false) AS votes_far FROM c", "audits")(lambda s: _compared(s).select("place_id", "votes_ok", "hours_ok", "votes_far"))
query("a19_reliability", f"WITH {LAT}, {BASE}, {CMP} SELECT COUNT(*) AS n, COUNT(*) FILTER (gap <= greatest(2, votes * 0.05e0)) / COUNT(*)::DOUBLE AS votes_ok_share, COUNT(*) FILTER (ok) / COUNT(*)::DOUBLE AS hours_ok_share, COUNT(*) FILTER (gap > greatest(5, votes * 0.2e0)) / COUNT(*)::DOUBLE AS votes_far_share FROM c", "audits")(lambda s: profiles.reliability(_compared(s)).drop("rating_ok_share"))

# --- reviews ----------------------------------------------------------------

query("f21_negatives", "SELECT review_id FROM reviews WHERE rating <= 2 AND trim(text) <> ''", "reviews")(lambda s: reviews.negatives(s.reviews).select("review_id"))
query("a12_review_rollup", "SELECT place_id, COUNT(*) AS n_reviews, COUNT(*) FILTER (rating <= 2 AND trim(text) <> '') AS n_negative FROM reviews GROUP BY 1", "reviews")(lambda s: reviews.review_rollup(s.reviews))
query("j19_f9_reviews_in_scope", "SELECT r.review_id, b.trade_bucket FROM reviews r JOIN businesses b USING (place_id) WHERE b.trade_bucket IN ('BUILDING', 'MACHINERY')", "reviews", "businesses")(lambda s: s.reviews.join(s.businesses, "place_id").where(F.col("trade_bucket").isin("BUILDING", "MACHINERY")).select("review_id", "trade_bucket"))
query("a11_coverage_notes", "SELECT 'audits' AS input, COUNT(*) AS n, CASE WHEN COUNT(*) = 0 THEN 'not measured' ELSE 'measured' END AS note FROM audits UNION ALL SELECT 'errors', COUNT(*), CASE WHEN COUNT(*) = 0 THEN 'not measured' ELSE 'measured' END FROM audits WHERE status = 'none'", "audits")(lambda s: benchmark.coverage_notes({"audits": s.audits, "errors": s.audits.where("status = 'none'")}))


# --- listing responses --------------------------------------------------------


def _responses(s):
    """Listing responses of the parts: rating, categories, description, hours and attributes, some of them absent."""
    size = F.col("p_size")
    return s.part.select(
        F.col("p_partkey").cast("string").alias("place_id"),
        F.when(size % 4 != 0, size % 4 == 1).alias("is_claimed"),
        F.when(size % 5 != 0, F.struct(F.col("p_retailprice").alias("value"), size.cast("int").alias("votes_count"))).alias("rating"),
        F.col("p_type").alias("category"),
        F.when(size % 3 != 0, F.split("p_name", " ")).alias("additional_categories"),
        F.when(size % 2 == 0, F.col("p_name")).otherwise(F.lit("  ")).alias("description"),
        F.when(size % 7 != 0, size.cast("int")).alias("total_photos"),
        F.when(size % 3 == 1, F.col("p_brand")).alias("work_time"),
        F.when(size % 6 == 0, F.to_json(F.split("p_name", " "))).when(size % 6 == 1, F.to_json(F.struct(F.split("p_name", " ").alias("a"), F.array("p_brand").alias("b")))).alias("attributes"),
        F.when(size % 2 == 1, F.create_map(F.lit("1"), size.cast("int"), F.lit("2"), F.lit(2), F.lit("4"), F.lit(9))).alias("rating_distribution"),
        F.when(size % 9 == 1, F.col("p_type")).alias("snippet"),
        F.when(size % 6 == 2, F.to_json(F.array("p_type"))).alias("unavailable_attributes"),
    )


query(
    "g1_extract_profile",
    """SELECT CAST(p_partkey AS VARCHAR) AS place_id, CAST(CASE WHEN p_size % 4 <> 0 THEN p_size % 4 = 1 END AS INT) AS is_claimed, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS rating_value, CAST(CASE WHEN p_size % 5 <> 0 THEN p_size END AS INT) AS rating_votes, p_type AS category,
      CAST(CASE WHEN p_size % 3 <> 0 THEN len(string_split(p_name, ' ')) END AS INT) AS additional_categories_count, CAST(p_size % 2 = 0 OR p_size % 9 = 1 AS INT) AS has_description, CAST(CASE WHEN p_size % 7 <> 0 THEN p_size END AS INT) AS total_photos, CAST(p_size % 3 = 1 AS INT) AS has_hours,
      CAST(CASE p_size % 6 WHEN 0 THEN len(string_split(p_name, ' ')) WHEN 1 THEN len(string_split(p_name, ' ')) + 1 END AS INT) AS attr_available_count, CAST(CASE WHEN p_size % 6 = 2 THEN 1 END AS INT) AS attr_unavailable_count, CAST(CASE WHEN p_size % 2 = 1 THEN p_size + 2 END AS BIGINT) AS neg_reviews FROM part""",
)(lambda s: profiles.extract_profile(_responses(s)).withColumns({"attr_available_count": F.col("attr_available_count").cast("int"), "attr_unavailable_count": F.col("attr_unavailable_count").cast("int"), "neg_reviews": F.col("neg_reviews").cast("bigint")}))
query(
    "g2_extract_posts",
    "SELECT user_id AS place_id, COUNT(*) AS post_count, date_trunc('second', max(ts)) AS last_post_ts, CAST(floor(epoch(TIMESTAMP '2025-06-01' - date_trunc('second', max(ts))) / 86400) AS INT) AS days_since_post FROM events GROUP BY 1",
)(lambda s: profiles.extract_posts(s.events.select(F.col("user_id").alias("place_id"), F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("timestamp")), F.lit("2025-06-01").cast("timestamp")).withColumn("days_since_post", F.col("days_since_post").cast("int")))
