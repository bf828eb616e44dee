"""Every registered market query against its SQL, and literal rows for what the tables do not hold."""

import glob
import json
import math
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from localpulse import config as K
from localpulse.functions import columns as C
from localpulse.operators import budget, discovery, grid, names, ordering, pages, profiles, reviews
from localpulse.operators.ordering import ranked
from localpulse.plans.all import ORACLES, QUERIES
from localpulse.sources import tables

DATA = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(DATA + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    rows = sorted(repr([norm(r[c]) for c in cols]) for r in df.collect())
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        held = [d[0] for d in cur.description]
        assert sorted(held) == cols
        assert rows == sorted(repr([norm(r[held.index(c)]) for c in cols]) for r in cur.fetchall())


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_neglect_all_fired(spark):
    df = spark.createDataFrame([(0, 0, None, 1, 1, 0, 0, 0, 0), (None,) * 9], "is_claimed int, post_count int, days_since_post int, rating_votes int, total_photos int, additional_categories_count int, has_hours int, attr_available_count int, has_description int")
    a, b = profiles.with_neglect(df).orderBy(F.desc("neglect_score")).collect()
    assert a.neglect_score == 60 and "unclaimed" not in a.signals and len(a.signals) == 7
    assert b.neglect_score == 0 and b.signals == {}


def test_solv_all_first(spark):
    r = grid.solv(spark.createDataFrame([("p", 1), ("p", 1), ("p", 1)], "place_id string, rank int"), ["place_id"]).first()
    assert (r.solv, r.avg_rank, r.top3_share, r.found_share) == (100.0, 1.0, 1.0, 1.0)
    r = grid.solv(spark.createDataFrame([("p", None)], "place_id string, rank int"), ["place_id"]).first()
    assert (r.solv, r.avg_rank, r.found_share) == (0.0, None, 0.0)


def test_diff_counts(spark):
    pin = "place_id string, row int, col int, keyword string, rank int"
    base = spark.createDataFrame([("p", 0, 0, "k", 5), ("p", 0, 1, "k", 3), ("p", 1, 0, "k", None), ("p", 1, 1, "k", 7)], pin)
    cur = spark.createDataFrame([("p", 0, 0, "k", 2), ("p", 0, 1, "k", 3), ("p", 1, 0, "k", 9), ("p", 1, 1, "k", None)], pin)
    r = grid.diff_counts(grid.diff_pins(base, cur), ["place_id"]).first()
    assert (r.improved, r.unchanged, r.gained, r.lost, r.net_improved) == (1, 1, 1, 1, 1)


def test_pin_grid_rejects_bad_sizes(spark):
    with pytest.raises(ValueError):
        grid.pin_grid(spark.createDataFrame([("a", 1.0, 1.0)], "place_id string, lat double, lng double"), 0, 3, 1.0)


def test_budget_prefix_never_over(spark):
    df = spark.range(500).select("id", (F.col("id") * 7 % 13).alias("cost"))
    kept = budget.budget_prefix(df, "cost", ["id"], 700).collect()
    want, total = [], 0
    for i in range(500):
        total += i * 7 % 13
        if total <= 700:
            want.append(i)
    assert sorted(r.id for r in kept) == want and max(r.running for r in kept) <= 700


def test_bbox_needs_four_numbers(spark):
    with pytest.raises(ValueError):
        discovery.filter_region(spark.createDataFrame([("a", "b", 1.0, 1.0)], "state_code string, state_name string, lat double, lng double"), "bbox:1,2,3")


def test_strings(spark):
    lit = F.lit
    r = one(
        spark,
        C.host_of(lit("https://WWW.Ex.com:8080/a?b")).alias("a"),
        C.host_of(lit("ex.com/a")).alias("b"),
        C.norm_domain(lit("www.Ex.com")).alias("c"),
        C.title_case(lit("o'fallon new-york")).alias("d"),
        C.parse_location(lit("1 A St, St. Louis, MO 63101, USA")).alias("e"),
        C.parse_ts(lit("2026/01/02 03:04:05 +00:00")).cast("string").alias("f"),
        C.parse_ts(lit("junk")).alias("g"),
        C.leaf_count(lit('{"a":["x","y"],"b":{"c":1},"d":5}')).alias("h"),
        C.host_of(lit(None).cast("string")).alias("i"),
    )
    assert (r.a, r.b, r.c, r.d, tuple(r.e), r.f, r.g, r.h, r.i) == ("ex.com:8080", "", "ex.com", "O'Fallon New-York", ("st. louis", "MO"), "2026-01-02 03:04:05", None, 4, "")


def test_mentions_need_word_boundaries(spark):
    texts = spark.createDataFrame([(1, "Acme Dirt rocks"), (2, "AcmeDirty"), (3, "see ACME DIRT!"), (4, None), (5, "")], "key int, text string")
    aliases = spark.createDataFrame([("e", "acme dirt")], "entity string, alias string")
    assert sorted(r.key for r in names.mention_join(texts, aliases).collect()) == [1, 3]


def test_ranks_by_range(spark):
    """Groups over many partitions, null groups and ties by key; ranks are gapless, and the sink's parts are in order."""
    rng = random.Random(6)
    rows = [(rng.choice([None, "a", "hot", "hot", "hot"]), rng.choice([None, 1, 2, 3]), f"k{i:04d}") for i in range(2000)]
    df = spark.createDataFrame(rows, "state_code string, score int, place_id string").repartition(7)
    order = [F.desc_nulls_last("score"), F.asc("place_id")]
    got = {(r.state_code, r.rank): r.place_id for r in ranked(df, order, "rank", by=["state_code"]).collect()}
    want = {}
    for g in (None, "a", "hot"):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-(r[1] or 0), r[2]))
        want |= {(g, i): r[2] for i, r in enumerate(own, 1)}
    assert got == want
    assert [r.n for r in ranked(df, order, "n", start=3).orderBy("n").collect()] == list(range(3, 2003))
    assert ranked(df.limit(0), order).count() == 0


def test_ranked_sink_is_ordered_by_part(spark, tmp_path):
    df = spark.createDataFrame([(state, i % 50, f"k{i:04d}") for i, state in enumerate(["b", "a", "hot", "hot"] * 200)], "state_code string, score int, place_id string")
    tables.write_ranked(df, str(tmp_path / "out"), [F.desc("score"), F.asc("place_id")])
    lines = [line for part in sorted(glob.glob(str(tmp_path / "out" / "part-*"))) for line in open(part).read().splitlines()[1:]]
    held = [(line.split(",")[0], int(line.split(",")[3])) for line in lines]
    assert held == sorted(held) and len(held) == 800


def test_pruning_follows_long_chains_in_few_rounds(spark):
    """Every cell covers the next one: the greedy result keeps every second."""
    n = 1500
    cells = spark.range(n).select(F.format_string("c%05d", "id").alias("cell_id"), (F.lit(30.0) + F.col("id") * 0.01).alias("lat"), F.lit(-100.0).alias("lng"), (F.lit(10**6) - F.col("id")).alias("population"), F.lit(1500).alias("radius_m"))
    kept = sorted(int(r.cell_id[1:]) for r in discovery.prune_overlapping(cells).collect())
    assert kept == list(range(0, n, 2))
    assert discovery.prune_overlapping(cells.limit(0)).count() == 0


def test_result_lists_are_ranked_by_tasks_of_a_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS", 100)
    rows = [(f"k{i % 400}", i, None if i % 7 == 0 else f"b{i % 5}", 0, 0) for i in range(2000)]
    items = spark.createDataFrame(rows, "keyword string, seq int, item_id string, rank_absolute int, rank_group int")
    ranks = grid.extract_rank(items, ["keyword"], ["seq"]).withColumn("task", F.spark_partition_id()).collect()
    want, placed = {}, {}
    for keyword, _, item, _, _ in rows:
        if item is not None:
            placed[keyword] = placed.get(keyword, 0) + 1
            want.setdefault((keyword, item), placed[keyword])
    assert {(r.keyword, r.item_id): r["rank"] for r in ranks} == want
    assert len({r.task for r in ranks}) > 10


def test_pages_are_searched_once(spark):
    """Plans name a search of the page once for each kind, not once for every use of what it finds."""
    plan = lambda name: QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    for name, links, lowered in (("h9_agency_credit", 1, 0), ("h10_management", 2, 3)):
        text = plan(name)
        assert text.count("regexp_extract_all(coalesce(html#") == links and text.count("lower(coalesce(html#") <= lowered


def test_credit_is_the_first_match_of_the_whole_pattern(spark):
    rng = random.Random(4)
    bits = ["Designed by ", "site by", " by ", "<br>", "<", ">", "\n", "é" * 45, "x" * 60, "</a>", "<a ", "<A HREF='//b.io/x'>", '<a href="https://www.c.org">', "Label", "L", "<abbr>", "wix.com", "&amp; "]
    links = ['Powered by <a href="https://d.net">Dee</a>', "by <a href='e.com'>Ee</a>", 'website <b>by <a href="https://f.com"></a>']
    rows = [(i, "".join(rng.choice(bits + links) for _ in range(rng.randrange(14)))) for i in range(600)]
    want = {}
    for i, html in rows:
        for ahead, tag, label in re.findall(r"(?i)([^<>]{0,80})<a\b([^>]*)>([^<]{2,60})</a>", html):
            said = re.findall("[a-z]+", ahead.lower())
            href = re.search(r"(?i)\bhref\s*=\s*[\"']([^\"']+)", tag)
            domain = re.sub(r"^www[.]", "", re.sub("^(https?:)?//", "", href[1]).split("/")[0]) if href else ""
            if said[-1:] == ["by"] and set(said[-4:-1]) & set(K.CREDIT_WORDS) and domain not in ("", "own.com"):
                want[i] = (domain, label.strip(" "), bool(set(said[-4:-1]) & set(K.STRONG_CREDIT)))
                break
    found = spark.createDataFrame(rows, "id int, html string").select("id", pages.agency_credit(F.col("html"), F.lit("own.com")).alias("c")).where("c IS NOT NULL")
    assert {r.id: tuple(r.c) for r in found.collect()} == want and len(want) > 50


def test_credits_by_the_words_before_a_link(spark):
    page = '<footer>{}<a href="https://www.agency.com/x">Agency One</a></footer>'
    said = {"Website design &amp; SEO by ": True, "Designed by: ": True, "Powered by ": False, "Site by ": False, "Reviewed by ": None, "By design of ": None, "Built and hosted by ": True, "Marketing, it was once said in town, by ": None, "": None}
    df = spark.createDataFrame([(k, page.format(k)) for k in said], "said string, html string")
    got = {r.said: r.c and r.c.strong for r in df.select("said", pages.agency_credit(F.col("html"), F.lit("own.com")).alias("c")).collect()}
    assert got == said
    own = spark.createDataFrame([(page.format("Designed by "),)], "html string").select(pages.agency_credit(F.col("html"), F.lit("agency.com")).alias("c")).first()
    assert own.c is None


def test_mentions_by_phrase(spark):
    """Word runs, gaps, edges and aliases without a word, against the pattern written out."""
    rng = random.Random(4)
    bits = ["the", "The", "crag", "Crags", "climb", "ÉCLAIR", "éclair", "&", "++", "c", "-", " ", " ", " ", ", ", ".", "_", "(", ")"]
    made = [(k, "".join(rng.choice(bits) for _ in range(rng.randrange(14)))) for k in range(400)]
    known = ["the", "The Crag", "the crag climb", "c++", "&", "++", "(crag)", ". c", "éclair", "crag", "the  crag", "-", " & ", "", "climb."]
    texts = spark.createDataFrame([*made, (900, None), (901, ""), (902, "I love The Crag downtown")], "key int, text string")
    aliases = spark.createDataFrame([(f"e{i}", a) for i, a in enumerate(known)] + [("none", None)], "entity string, alias string")
    got = {tuple(r) for r in names.mention_join(texts, aliases).collect()}
    want = {(k, f"e{i}") for k, t in [*made, (902, "I love The Crag downtown")] for i, a in enumerate(known) if a and re.search(r"(?<!\w)" + re.escape(a.lower()) + r"(?!\w)", t.lower())}
    assert got == want and len(want) > 300


def test_mention_plan_carries_no_text(spark):
    texts = spark.range(100).selectExpr("id AS key", "concat('the crag ', id) AS text")
    aliases = spark.sql("SELECT * FROM VALUES ('a', 'the crag') AS v(entity, alias)")
    plan = names.mention_join(texts, aliases)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("text" in line for line in joins)


def test_page_facts_and_fingerprint(spark):
    html = """<html lang="en"><head><title>Best Dirt Co of Town</title><meta name="viewport" content="x"><meta name="description" content="d">
    <link rel="canonical" href="https://a.com/"><script type="application/ld+json">{"@type":["LocalBusiness","Thing"],"founder":{"@type":"Person","name":"Ann B"}}</script>
    <script type="application/ld+json">{bad</script></head><body><h1>Hi</h1><h2>a</h2><h2>b</h2><img src=x><a href="/in">i</a><a href="https://o.com/">o</a>
    call 555-123-4567 or mail <a href="mailto:Info@a.com?x">us</a> the owner is here. Website designed by <a href="https://www.agency.com/">Agency</a> wixstatic.com gtm-1 callrail.com</body></html>"""
    df = spark.createDataFrame([(1, "https://a.com/", html), (2, "https://b.com/", None)], "page_id bigint, url string, html string")
    f = {r.page_id: r for r in pages.page_signals(df).collect()}
    assert (f[1].title, f[1].h1_count, f[1].h2_count, f[1].viewport, f[1].has_phone, f[1].canonical, f[1].images_missing_alt) == ("Best Dirt Co of Town", 1, 2, True, True, "https://a.com/", 1)
    assert f[2].title is None and f[2].word_count == 0 and f[2].og_title is None
    og = spark.createDataFrame([(4, '<meta property="OG:Title" content=" Dirt &amp; Co "><meta property="og:title" content="later"><meta property="og:image" content=""><meta name="og:type" content="x"><meta name="robots" property="og:url" content="u">')], "page_id bigint, html string")
    g = pages.page_signals(og).first()
    assert (g.og_title, g.og_image, g.og_type, g.og_url, g.meta_robots, g.og_site_name) == ("Dirt & Co", None, None, "u", "u", None)
    cut = spark.createDataFrame([(3, "<title>a</title><p>one two&am")], "page_id bigint, html string")
    assert pages.page_signals(cut).first().word_count == 3
    j = {r.page_id: r for r in pages.jsonld(df).collect()}
    assert (j[1].n_blocks, j[1].n_valid, j[1].local_business, j[2].n_blocks) == (2, 1, True, 0) and "Person" in j[1].types
    o = {r.page_id: r for r in pages.owners(df).collect()}
    assert o[1].founders == ["Ann B"] and o[2].founders == []
    links = {r.page_id: r for r in pages.link_counts(df).collect()}
    assert (links[1].internal_links, links[1].external_links) == (1, 2)
    hints = {r.page_id: r.hints for r in pages.owner_hints(df).collect()}
    assert any("owner" in h for h in hints[1]) and hints[2] == []
    r = df.where("page_id = 1").select(pages.detect_builder(F.col("html")).alias("b"), pages.detect_tags(F.col("html")).alias("t"), pages.agency_credit(F.col("html"), F.lit("a.com")).alias("c"), pages.emails(F.col("html")).alias("e")).first()
    assert r.b == "Wix" and r.t == ["CallRail", "Google Tag Manager"] and r.c.domain == "agency.com" and r.c.strong and r.e == ["info@a.com"]


def test_page_signals_of_titles_cut_within_a_reference(spark, tmp_path):
    """As the tables cut them, for every length of the page modulo 6 (which says where the title is repeated)."""
    title = "A key = &quot;a&quot; &amp;amp; b&amp;&amp;"
    made = [f'<!DOCTYPE html><html lang="en"><head><title>{title[:n]}</title></head><body><h1>{title[:n]}</h1><p><b>Word {"x" * pad}</p></body></html>' for n in range(1, len(title) + 1) for pad in range(6)]
    spark.createDataFrame([(i, f"https://a.com/en/{i}", h) for i, h in enumerate(made)], "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df = QUERIES["h1_page_signals"](spark, str(tmp_path))
    got = {r.page_id: tuple(r) for r in df.collect()}
    cur = con.execute(ORACLES["h1_page_signals"])
    held = [d[0] for d in cur.description]
    assert got == {r[held.index("page_id")]: tuple(r[held.index(c)] for c in df.columns) for r in cur.fetchall()}
    assert {'A key = "a&quot', 'A key = "a&quo'} <= {r[df.columns.index(c)] for r in got.values() for c in ("title", "og_title")}


def test_page_signals_read_whole_references_only(spark):
    html = """<title>A &#39;b&#x27; &lt;c&gt; &copy; D&eacute;</title><meta name="description" content="&quot; &quot &#39 &quotation; &notit; R&notes &amp &amp;lt; &ampquot;">
    <link rel="canonical" href="https://a.com/?a=1&copy=2&amp;b=3&quot"><img alt="&quot"><script>if (a && b) t = "&lt";</script><p>a && b &nbsp"""
    f = pages.page_signals(spark.createDataFrame([(1, html)], "page_id bigint, html string")).first()
    assert (f.title, f.title_length) == ("A 'b' <c> © Dé", 14)
    assert f.meta_description == '" &quot &#39 &quotation; &notit; R&notes & &lt; &quot;'
    assert (f.canonical, f.images_missing_alt, f.word_count) == ("https://a.com/?a=1&copy=2&b=3&quot", 0, 9)


def test_robots_groups(spark):
    text = "User-agent: GPTBot\nDisallow: /\nUser-agent: CCBot\nAllow: /\nUser-agent: *\nContent-Signal: search=yes, ai-train=no\n"
    df = spark.createDataFrame([("a", text), ("b", ""), ("c", None)], "host string, robots string")
    got = {(r.host, r.bot): r.status for r in pages.robots_status(df).collect()}
    assert got["a", "GPTBot"] == "blocked" and got["a", "CCBot"] == "allowed" and got["a", "Bingbot"] == "blocked"
    assert got["b", "GPTBot"] == "unspecified" and got["c", "GPTBot"] == "unspecified"


def test_replies_are_repaired(spark):
    df = spark.createDataFrame([("f1", 'x [{"place_id":"p","complaint_count":-1,"complaint_types":["quality","zzz"],"evidence":["a"]}] y'), ("f2", 'no list'), ("f3", '[{"place_id":"p","complaint_count":4}]')], "file string, reply string")
    r = reviews.latest_flags(df).collect()
    assert len(r) == 1 and r[0].complaint_count == 4 and r[0].complaint_types == []


def test_rescore_is_idempotent(spark):
    audits = profiles.with_neglect(spark.createDataFrame([(1, 3, 0), (2, None, 1)], "id int, rating_votes int, has_hours int"))
    once = profiles.rescore(audits, {**__import__("localpulse.config", fromlist=["x"]).NEGLECT_WEIGHTS, "no_hours": 0})
    again = profiles.rescore(once.drop("moved", "old_score"), {**__import__("localpulse.config", fromlist=["x"]).NEGLECT_WEIGHTS, "no_hours": 0})
    assert once.where("moved").count() == 1 and again.where("moved").count() == 0


def test_builder_and_credit_of_literal_pages(spark):
    rows = [
        (1, '<meta content="Hand Made 2" data-x="1" name="generator">', {"X-Powered-By": "none"}),
        (2, "<p>hello</p>", {"X-Via": "cdn.Squarespace.com"}),
        (3, '<footer>Website designed by <a class="x" href="https://www.smith-studio.com/x">Smith Studio</a></footer>', None),
        (4, '<footer>powered by: <a href="https://wix.com">Wix</a> built and hosted by <a href="//own.com/">Own</a> site by <a href="https://other.io">Other</a></footer>', None),
        (5, "<p>Sold by <a href='https://shop.com'>Shop</a></p>", None),
        (6, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, html string, headers map<string,string>").withColumn("credit", pages.agency_credit(F.col("html"), F.lit("www.own.com")))
    kinds = pages.management(pages.detect_builder(F.col("html"), F.col("headers")), pages.detect_tags(F.col("html")), F.col("credit"), pages.detect_ads(F.col("html")), F.col("html").isNotNull())
    got = {r.id: r for r in df.select("id", pages.detect_builder(F.col("html"), F.col("headers")).alias("builder"), "credit", *(c.alias(n) for c, n in zip(kinds, ("status", "confidence", "evidence"), strict=True))).collect()}
    assert got[1].builder == "Hand Made 2" and got[2].builder == "Squarespace" and got[5].builder is None
    assert got[3].credit.asDict() == {"domain": "smith-studio.com", "label": "Smith Studio", "strong": True} and got[4].credit.domain == "other.io" and not got[4].credit.strong
    assert got[1].credit is None and got[5].credit is None
    assert (got[3].status, got[3].confidence, got[3].evidence) == ("likely agency-managed", "high", ["footer credit: Smith Studio (smith-studio.com)"])
    assert (got[2].status, got[2].evidence) == ("DIY / unmanaged", ["builder: Squarespace"])
    assert got[4].confidence == "medium" and got[5].evidence == ["no recognizable builder or marketing tags"]
    assert (got[6].status, got[6].confidence, got[6].evidence) == ("unknown", "n/a", ["site did not load - could not fingerprint"])


def test_profiles_of_literal_responses(spark):
    schema = profiles.INFO
    rows = [("a", True, (4.5, 12), "Plumber", ["x", "y"], " text ", 7, "mon", '{"a":["p","q"],"b":["r"]}', {"1": 2, "2": 1, "5": 9}, None, '["z"]'), ("b", *[None] * 11), ("c", False, (None, 0), "", [], "  ", 0, "", "{bad", {}, "snip", None)]
    got = {r.place_id: r for r in profiles.extract_profile(spark.createDataFrame(rows, schema)).collect()}
    assert tuple(got["a"])[1:] == (1, 4.5, 12, "Plumber", 2, 1, 7, 1, 3, 1, 3)
    assert tuple(got["b"])[1:] == (None, None, None, None, None, 0, None, 0, None, None, None)
    assert (got["c"].is_claimed, got["c"].rating_votes, got["c"].additional_categories_count, got["c"].total_photos, got["c"].neg_reviews, got["c"].has_description) == (0, 0, 0, 0, None, 1)
    posts = spark.createDataFrame([("a", "2024/05/01 10:00:00"), ("a", "2024-05-03 09:00:00"), ("b", "junk"), ("b", None)], "place_id string, timestamp string")
    out = {r.place_id: r for r in profiles.extract_posts(posts, F.lit("2024-05-10 08:00:00").cast("timestamp")).collect()}
    assert (out["a"].post_count, out["a"].days_since_post) == (2, 6) and (out["b"].post_count, out["b"].last_post_ts, out["b"].days_since_post) == (2, None, None)


def test_jsonld_of_any_depth(spark):
    """Types, blocks and names equal those of a recursive walk over the parsed JSON."""
    deep = '{"@type":"L0","k":' * 300 + '{"owner":[{"name":" Zoé\\/B ","@type":["Person",7,"\\u0041\\"q\\""]},{"name":""},"x",{"name":["no"]}]}' + "}" * 300
    blocks = [
        ['{"@type":"Caf\\u00e9\\/Bar","founder":{"name":"A \\"B\\" C"},"employee":[{"name":"D"},[{"name":"nested list"}]]}'],
        ['[[{"@type":["X","Y"],"a":{"b":{"c":[{"d":{"@type":"Person","name":"E"}}]}}}]]', "{bad", "  ", '{"@type":"Z"} trailing', "3", "null", '{"@type":"1"},{"@type":"2"}'],
        [deep],
        ['{"@type":{"@type":"Inner"},"owner":{"name":null},"founder":"plain","text":"\\"@type\\":\\"Fake\\""}'],
        [],
    ]
    page = lambda bs: "".join(f'<script type="application/ld+json">{b}</script>' for b in bs)
    df = spark.createDataFrame([(i, page(b)) for i, b in enumerate(blocks)] + [(9, None)], "page_id bigint, html string")
    strings = lambda v: [x for x in (v if isinstance(v, list) else [v]) if isinstance(x, str)]

    def walk(v, types, persons, founders):
        if isinstance(v, dict):
            types |= set(strings(v.get("@type")))
            if "Person" in strings(v.get("@type")) and isinstance(v.get("name"), str):
                persons.add(v["name"].strip())
            for k in ("founder", "owner", "employee"):
                held = v.get(k)
                founders |= {x["name"].strip() for x in (held if isinstance(held, list) else [held]) if isinstance(x, dict) and isinstance(x.get("name"), str) and x["name"]}
        for x in v.values() if isinstance(v, dict) else v if isinstance(v, list) else []:
            walk(x, types, persons, founders)

    facts = {r.page_id: r for r in pages.jsonld(df).collect()}
    names_of = {r.page_id: r for r in pages.owners(df).collect()}
    for i, bs in enumerate(blocks):
        sets, valid = (set(), set(), set()), 0
        for b in bs:
            try:
                walk(json.loads(b), *sets)
                valid += 1
            except ValueError:
                continue
        assert (facts[i].types, names_of[i].persons, names_of[i].founders) == tuple(sorted(x) for x in sets)
        assert (facts[i].n_valid, facts[i].n_blocks) == (valid, sum(bool(b.strip()) for b in bs))
    assert (facts[9].types, facts[9].n_valid, names_of[9].persons) == ([], 0, [])
    assert not any("Python" in line or "Pandas" in line for line in pages.owners(df)._jdf.queryExecution().executedPlan().toString().splitlines())


def test_owner_snippets_overlap_and_merge(spark):
    words = "lorem " * 20
    texts = ["Owner and FOUNDER " + words + "x family-owned y " + words + "owner owner", "<script>owner</script>no<!-- owner -->thing", "owner", "é president ü " * 9, None, "owner"]
    df = spark.createDataFrame([(i, f"<p>{t}</p>" if t is not None else None, "h" if i != 1 else "n") for i, t in enumerate(texts)], "page_id bigint, html string, host string")
    want = {}
    for i, t in enumerate(texts):
        t = " ".join(re.sub(r"(?s)<script>.*?</script>|<!--.*?-->", " ", t or "").split())
        found = (t[max(0, m.start() - 70) : m.end() + 90].strip() for m in re.finditer(K.OWNER_PATTERN, t, re.IGNORECASE))
        want[i] = list(dict.fromkeys(found))[:5]
    got = pages.owner_hints(df)
    assert {r.page_id: r.hints for r in got.collect()} == want and len(want[0]) == 5 and len(want[3]) == 5
    leads = {r.host: r.hints for r in pages.lead_hints(got.join(df.select("page_id", "host"), "page_id")).collect()}
    assert leads == {"h": list(dict.fromkeys(x for i in sorted(want) if i != 1 for x in want[i]))[:6]} and len(leads["h"]) == 6
