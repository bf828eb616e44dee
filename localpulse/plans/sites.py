"""Queries over names, pages, sites, contacts, benchmarks, file shapes and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from localpulse import config as K
from localpulse.functions import columns as C
from localpulse.operators import benchmark, names, pages, profiles, reviews
from localpulse.plans.registry import query
from localpulse.sources import tables
from localpulse.sources.scratch import new_path

# --- strings and addresses --------------------------------------------------

HOST = r"regexp_replace(lower(regexp_extract({c}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '^www\.', '')"
query("c1_host_of", f"SELECT page_id, {HOST.format(c='url')} AS host FROM pages")(lambda s: s.pages.select("page_id", C.host_of(F.col("url")).alias("host")))
query("c2_norm_domain", f"SELECT page_id, {HOST.format(c='url')} AS a, {HOST.format(c=chr(39) + 'http://' + chr(39) + ' || substr(url, 9)')} AS b FROM pages")(
    lambda s: s.pages.select("page_id", C.norm_domain(F.col("url")).alias("a"), C.norm_domain(F.substr("url", F.lit(9))).alias("b"))
)
query("c3_origin_of", r"SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || '/' AS origin, " + HOST.format(c="url") + " AS host FROM pages")(lambda s: s.pages.select("page_id", C.origin_of(F.col("url")).alias("o")).select("page_id", "o.*"))
query("c4_brand_key", "SELECT place_id, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS key FROM businesses", "businesses")(lambda s: s.businesses.select("place_id", C.brand_key(F.col("name")).alias("key")))
query("c6_title_case", "SELECT n_nationkey, array_to_string(list_transform(string_split(lower(n_name), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS city FROM nation")(lambda s: s.nation.select("n_nationkey", C.title_case(F.col("n_name")).alias("city")))
query("c7_fill_template", "SELECT place_id, 'best ' || lower(trade_bucket) || ' in ' || state_name || ', ' || state_code AS q, state_name || ',' || state_code || ',United States' AS location FROM businesses", "businesses")(
    lambda s: s.businesses.select("place_id", C.fill_template(F.lit("best {trade} in {city}, {state}"), F.lower("trade_bucket"), F.col("state_name"), F.col("state_code")).alias("q"), C.location_string(F.col("state_name"), F.col("state_code"), F.lit("United States")).alias("location"))
)
query("c8_expected_states", "SELECT n_nationkey, lower(n_name) || '|tennessee' AS tokens FROM nation")(lambda s: s.nation.select("n_nationkey", F.array_join(C.expected_states(F.concat(F.lit("x, "), "n_name"), F.lit("Town,Tennessee,United States")), "|").alias("tokens")))
query("c9_query_text", "SELECT n_nationkey, n_name || ' market' AS q FROM nation")(lambda s: s.nation.select("n_nationkey", C.query_text(F.col("n_name"), F.lit("market")).alias("q")))
query("c10_clip_text", "SELECT review_id, substr(text, 1, 160) AS clip FROM reviews", "reviews")(lambda s: s.reviews.select("review_id", C.clip_text(F.col("text"), 160).alias("clip")))
query("c11_parse_ts", "SELECT id, audited_ts::TIMESTAMP - (INTERVAL 1 MICROSECOND * (epoch_us(audited_ts) % 1000000)) AS ts FROM audits", "audits")(lambda s: s.audits.select("id", C.parse_ts(F.date_format("audited_ts", "yyyy/MM/dd HH:mm:ss")).alias("ts")).withColumn("ts", F.col("ts").cast("timestamp_ntz")))
query("c12_days_since", "SELECT id, CAST(floor((epoch(TIMESTAMP '2030-01-01') - floor(epoch(audited_ts))) / 86400) AS INT) AS days FROM audits", "audits")(lambda s: s.audits.select("id", C.days_since(F.col("audited_ts"), F.lit("2030-01-01").cast("timestamp")).alias("days")))
query("c19_delta", 'SELECT b.place_id, b."row", b.col, b.keyword, round(c.rank - b.rank, 2) AS delta FROM base_points b JOIN cur_points c USING (place_id, "row", col, keyword)', "base_points", "cur_points")(
    lambda s: s.base_points.alias("b").join(s.cur_points.alias("c"), ["place_id", "row", "col", "keyword"]).select("place_id", "row", "col", "keyword", C.delta(F.col("c.rank"), F.col("b.rank")).alias("delta"))
)
query("c20_json_list", "SELECT id, CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE 2 END AS INT) AS n FROM audits", "audits")(lambda s: s.audits.select("id", F.size(C.json_list(F.when(F.col("id") % 3 == 0, F.lit("{bad")).otherwise(F.to_json(F.array("audit_type", "status"))))).alias("n")))
query("c21_leaf_count", "SELECT id, CAST(CASE WHEN id % 3 = 0 THEN 2 WHEN id % 3 = 1 THEN 4 END AS INT) AS n FROM audits", "audits")(
    lambda s: s.audits.select("id", C.leaf_count(F.when(F.col("id") % 3 == 0, F.to_json(F.array("audit_type", "status"))).when(F.col("id") % 3 == 1, F.concat(F.lit('{"a":["'), "status", F.lit('","y"],"b":{"p":1},"c":true}')))).alias("n"))
)
query("c22_negative_count", "SELECT id, CAST(CASE WHEN id % 2 = 0 THEN (id % 5) + 3 END AS BIGINT) AS n FROM audits", "audits")(lambda s: s.audits.select("id", C.negative_count(F.when(F.col("id") % 2 == 0, F.create_map(F.lit("1"), F.col("id") % 5, F.lit("2"), F.lit(3).cast("bigint"), F.lit("5"), F.lit(9).cast("bigint")))).alias("n")))
SIG2 = "list_filter([CASE WHEN rating_votes < 10 THEN 'few reviews' END, CASE WHEN total_photos < 10 THEN 'few photos' END, CASE WHEN additional_categories_count = 0 THEN 'no 2nd categories' END, CASE WHEN has_hours = 0 THEN 'no hours' END], lambda x: x IS NOT NULL)"
query("c23_signal_label", f"SELECT id, array_to_string(({SIG2})[1:2], ', ') AS label FROM audits", "audits")(lambda s: profiles.with_neglect(s.audits).select("id", C.signal_label(F.col("signals")).alias("label")))
query(
    "f4_relevance",
    "SELECT place_id, CASE WHEN trade_bucket = 'BUILDING' OR contains(lower(name || ' ' || trade_bucket), '77') THEN 'match' WHEN contains(lower(name || ' ' || trade_bucket), 'mach') THEN 'maybe' ELSE 'other' END AS rel FROM businesses",
    "businesses",
)(lambda s: s.businesses.select("place_id", C.relevance(F.col("name"), F.array("trade_bucket"), F.lit(None).cast("string"), ["BUILDING"], ["77"], ["mach"]).alias("rel")))
query("f5_tier_of", "SELECT place_id, CASE WHEN contains(lower(name), '77') THEN 'chain' ELSE 'local' END AS tier FROM businesses", "businesses")(lambda s: s.businesses.select("place_id", C.tier_of(F.col("name"), ["77"]).alias("tier")))
query("f6_is_microsite", f"SELECT page_id, starts_with(split_part({HOST.format(c='url')}, '.', 1), 'site') OR starts_with(split_part({HOST.format(c='url')}, '.', 1), 'ex') AS micro FROM pages")(lambda s: s.pages.select("page_id", C.is_microsite(C.host_of(F.col("url")), ["site", "ex"]).alias("micro")))
query("f7_footprint", "SELECT place_id, state_name NOT IN ('ASIA', 'AFRICA') AS inside FROM businesses", "businesses")(lambda s: s.businesses.select("place_id", (~F.col("state_name").isin("ASIA", "AFRICA")).alias("inside")))
query("f8_parse_location", "SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN '' ELSE lower(p_name) END AS town, CASE p_size % 3 WHEN 0 THEN 'TN' WHEN 1 THEN 'ON' ELSE '' END AS state FROM part")(
    lambda s: s.part.select("p_partkey", C.parse_location(F.concat(F.col("p_partkey").cast("string"), F.lit(" Main, Old, XX St, "), "p_name", F.lit(", "), F.when(F.col("p_size") % 3 == 0, "TN").when(F.col("p_size") % 3 == 1, "ON").otherwise("QQ"), F.lit(" 12345, USA"))).alias("l")).select("p_partkey", "l.*")
)
query("f9_trade_group", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'excavation' WHEN 1 THEN 'septic' WHEN 2 THEN 'plumber' WHEN 3 THEN 'construction' ELSE 'other' END AS grp FROM part")(
    lambda s: s.part.select("p_partkey", C.trade_group(F.element_at(F.array(*(F.lit(x) for x in ("Paving contractor", "Septic system service", "Plumber", "Contractor", "Roofer"))), (F.col("p_partkey") % 5 + 1).cast("int"))).alias("grp"))
)
query("f12_looks_blocked", "SELECT page_id, CASE WHEN page_id % 4 = 0 THEN true WHEN page_id % 4 = 1 THEN true ELSE length(html) < 2000 AND page_id % 4 = 2 END AS blocked FROM pages")(
    lambda s: s.pages.select("page_id", C.looks_blocked(F.when(F.col("page_id") % 4 == 1, 403).when(F.col("page_id") % 4 == 2, 200).when(F.col("page_id") % 4 == 3, 404), F.col("html")).alias("blocked"))
)
query(
    "f13_f14_site_status",
    "SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'none' WHEN 1 THEN 'social_only' WHEN 2 THEN 'directory' WHEN 3 THEN 'unreachable' WHEN 4 THEN 'parked' WHEN 5 THEN 'dead' ELSE 'live' END AS status FROM pages",
)(
    lambda s: s.pages.select(
        "page_id",
        C.site_status(
            F.when(F.col("page_id") % 7 == 1, "m.facebook.com").when(F.col("page_id") % 7 == 2, "www.yelp.com").otherwise("a.com"),
            (F.col("page_id") % 7 == 0).cast("int"),
            F.col("page_id") % 7 != 3,
            F.when(F.col("page_id") % 7 == 5, 404).otherwise(200),
            F.when(F.col("page_id") % 7 == 4, "This domain is for sale").otherwise("Home"),
            F.lit(500),
        ).alias("status"),
    )
)
query("f22_listing_cells", "SELECT place_id, CASE WHEN no_website = 1 THEN CAST(review_count AS VARCHAR) ELSE 'withheld' END AS cell FROM businesses", "businesses")(lambda s: s.businesses.select("place_id", F.when(F.col("no_website") == 1, F.col("review_count").cast("string")).otherwise("withheld").alias("cell")))

# --- matching ---------------------------------------------------------------

DOM = "d AS (SELECT DISTINCT host AS domain FROM h WHERE hash_ = 1)"
HOSTS = f"h AS (SELECT page_id, {HOST.format(c='url')} AS host FROM pages)"


def _hosts(s):
    return s.pages.select("page_id", C.host_of(F.col("url")).alias("host"))


def _domains(s):
    return _hosts(s).where("page_id % 2 = 0").select(F.col("host").alias("domain")).distinct()


DOMAINS = "d AS (SELECT DISTINCT host AS domain FROM h WHERE page_id % 2 = 0)"
query("j10_domain_join", f"WITH {HOSTS}, {DOMAINS} SELECT DISTINCT host, domain FROM h, d WHERE host = domain OR ends_with(host, '.' || domain) OR ends_with(domain, '.' || host)")(lambda s: names.domain_join(_hosts(s), _domains(s)))
query("j14_citation_join", f"WITH {HOSTS.replace('url', 'url')}, {DOMAINS} SELECT key, turn, domain FROM (SELECT key, turn, {HOST.format(c='url')} AS host FROM answers) a JOIN d ON host = domain OR ends_with(host, '.' || domain)", "answers")(lambda s: names.citation_join(s.answers, _domains(s)).select("key", "turn", "domain"))
ALIASES = "VALUES ('a', 'the'), ('b', 'and'), ('c', 'der'), ('d', 'thing'), ('e', 'Tion the'), ('f', 'de, la'), ('g', ' -'), ('h', '.'), ('i', 'thing.')"
ALIAS_SQL = f"({ALIASES}) v(entity, alias)"
MENTION = rf"SELECT DISTINCT review_id AS key, entity FROM reviews, {ALIAS_SQL} WHERE regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])' || regexp_escape(alias) || '([^\p{{L}}\p{{N}}_]|$)')"


def _aliases(s):
    return s.spark.sql(f"SELECT * FROM {ALIASES} AS v(entity, alias)")


query("j13_mention_join", MENTION, "reviews")(lambda s: names.mention_join(s.reviews.select(F.col("review_id").alias("key"), "text"), _aliases(s)))


@query("a9_ai_scoreboard", f"WITH m AS ({MENTION}) SELECT entity, (SELECT COUNT(*) FROM reviews) AS asked, COUNT(key) AS mentioned, COUNT(key) FILTER (key % 2 = 0) AS cited FROM {ALIAS_SQL} LEFT JOIN m USING (entity) GROUP BY entity", "reviews")
def scoreboard(s):
    aliases = _aliases(s)
    m = names.mention_join(s.reviews.select(F.col("review_id").alias("key"), "text"), aliases)
    return names.ai_scoreboard(aliases.select("entity"), s.reviews.count(), m, m.where("key % 2 = 0"))


query(
    "j11_pick_audit",
    f"""WITH {HOSTS}, {DOMAINS}, a AS (SELECT host, page_id AS position, page_id % 3 = 0 AS live FROM h), j AS (SELECT domain AS entity, position, ROW_NUMBER() OVER (PARTITION BY domain ORDER BY live DESC, (host = domain) DESC, position) AS r FROM d JOIN a ON host = domain OR ends_with(host, '.' || domain) OR ends_with(domain, '.' || host)) SELECT entity, position FROM j WHERE r = 1""",
)(lambda s: names.pick_audit(_domains(s).withColumn("entity", F.col("domain")), _hosts(s).select("host", F.col("page_id").alias("position"), (F.col("page_id") % 3 == 0).alias("live"))).select("entity", "position"))
query("w7_organic_rank", f"WITH {HOSTS}, {DOMAINS} SELECT keyword, domain AS entity, min(NULLIF(rank, 0)) AS rank FROM (SELECT page_id % 10 AS keyword, page_id % 6 AS rank, host FROM h) x JOIN d ON host = domain OR ends_with(host, '.' || domain) GROUP BY 1, 2")(
    lambda s: names.organic_rank(_hosts(s).select((F.col("page_id") % 10).alias("keyword"), (F.col("page_id") % 6).alias("rank_absolute"), F.col("host").alias("domain")), _domains(s).withColumn("entity", F.col("domain")))
)
PACK_ROWS = """SELECT keyword, seq, item_id, rank_absolute, rank_group, CASE WHEN seq % 4 = 0 THEN NULL WHEN seq % 4 = 1 THEN CONCAT('shop.d', CAST(item_id AS BIGINT) % 9, '.com') ELSE CONCAT('d', CAST(item_id AS BIGINT) % 9, '.com') END AS domain, CONCAT('The Name ', COALESCE(CAST(item_id AS BIGINT), 0) % 9, ' shop') AS title FROM {items}"""
PACK = f"""it AS ({PACK_ROWS.format(items="items")}), pk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY keyword ORDER BY seq) AS position FROM it WHERE item_id IS NOT NULL),
e AS (SELECT 'e' || n_nationkey AS entity, 'd' || n_nationkey || '.com' AS dom, 'name ' || n_nationkey AS name FROM nation WHERE n_nationkey < 5)"""


def _pack(s):
    ents = s.nation.where("n_nationkey < 5").select(F.concat(F.lit("e"), "n_nationkey").alias("entity"), F.concat(F.lit("d"), "n_nationkey", F.lit(".com")).alias("domain"), F.concat(F.lit("name "), "n_nationkey").alias("name"))
    return names.pack_rank(s.spark.sql(PACK_ROWS.format(items="{items}"), items=s.items), ents)


query("w6_pack_rank", f"WITH {PACK} SELECT keyword, entity, CAST(arg_min(COALESCE(NULLIF(rank_absolute, 0), NULLIF(rank_group, 0), position), position) AS INT) AS rank FROM pk JOIN e ON domain = dom OR ends_with(domain, '.' || dom) OR (domain IS NULL AND contains(lower(title), name || ' ')) GROUP BY 1, 2", "items")(lambda s: _pack(s)[0])
query("w6_pack_leaders", f"WITH {PACK} SELECT keyword, position, title, domain FROM pk WHERE position <= 3", "items")(lambda s: _pack(s)[1])
CAND = "SELECT c_custkey % 100 AS position, {n} AS entity, CONCAT('Acme ', c_custkey % 9, CASE WHEN c_custkey % 2 = 0 THEN ' Dirt' ELSE '' END) AS candidate, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN 'Town, TN 1' ELSE 'Town, GA 2' END AS address FROM {c} WHERE c_custkey % 7 <> 0"
ENTITY = "SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 2 = 0 THEN CONCAT('Acme ', s_suppkey % 9) ELSE CONCAT('The Acme ', s_suppkey % 9, ' Dirt Co') END AS name FROM {s}"


@query(
    "j15_resolve_listing",
    f"""WITH e AS ({ENTITY.format(s="supplier")}), c AS ({CAND.format(n="CAST(c_custkey // 100 AS BIGINT)", c="customer")}),
    j AS (SELECT e.entity, candidate, position, candidate IS NOT NULL AND (contains(' ' || lower(candidate) || ' ', ' ' || lower(name) || ' ') OR contains(' ' || lower(name) || ' ', ' ' || lower(candidate) || ' ')) AND (address = '' OR contains(address, ' TN ')) AS ok FROM e LEFT JOIN c USING (entity))
    SELECT entity, CASE WHEN count(*) FILTER (ok) > 0 THEN 'matched' WHEN count(candidate) > 0 THEN 'mismatch' ELSE 'not_found' END AS status, arg_min(candidate, position) FILTER (ok) AS matched FROM j GROUP BY 1""",
)
def resolve(s):
    e = s.spark.sql(ENTITY.format(s="{s}"), s=s.supplier).withColumn("states", F.array(F.lit("tn")))
    return names.resolve_listing(e, s.spark.sql(CAND.format(n="CAST(c_custkey div 100 AS BIGINT)", c="{c}"), c=s.customer))


query(
    "j16_with_fallback",
    """WITH a AS (SELECT c_custkey AS entity, CASE WHEN c_custkey % 3 = 0 THEN 'matched' ELSE 'not_found' END AS status, 'a' || c_custkey AS matched FROM customer WHERE c_custkey % 5 <> 0), b AS (SELECT c_custkey AS entity, CASE WHEN c_custkey % 2 = 0 THEN 'matched' ELSE 'mismatch' END AS status, 'b' || c_custkey AS matched FROM customer WHERE c_custkey % 4 <> 0),
    j AS (SELECT COALESCE(a.entity, b.entity) AS entity, a.status AS sa, b.status AS sb, a.matched AS ma, b.matched AS mb, COALESCE(a.status, '') <> 'matched' AND COALESCE(b.status, '') = 'matched' AS use_b FROM a FULL JOIN b ON a.entity = b.entity)
    SELECT entity, CASE WHEN use_b THEN sb ELSE COALESCE(sa, sb) END AS status, CASE WHEN use_b THEN mb ELSE COALESCE(ma, mb) END AS matched, CASE WHEN use_b THEN 'second source' ELSE 'first source' END AS source FROM j""",
)(
    lambda s: names.with_fallback(
        s.customer.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("entity"), F.expr("CASE WHEN c_custkey % 3 = 0 THEN 'matched' ELSE 'not_found' END").alias("status"), F.concat(F.lit("a"), "c_custkey").alias("matched")),
        s.customer.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("entity"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'matched' ELSE 'mismatch' END").alias("status"), F.concat(F.lit("b"), "c_custkey").alias("matched")),
    )
)
KEY = f"CASE WHEN website IS NOT NULL THEN 'host:' || {HOST.format(c='website')} ELSE 'name:' || regexp_replace(lower(name), '[^a-z0-9]', '', 'g') END"


def _collapsed(s):
    rows = s.businesses.withColumns({"seq": F.col("place_id").cast("bigint"), "found_via": F.array("state_code"), "notes": F.lit("")})
    return names.collapse_listings(rows)


query("a13_collapse_listings", f"SELECT {KEY} AS dedup_key, arg_max(place_id, (review_count, -CAST(place_id AS BIGINT))) AS place_id, COUNT(*) AS n_listings, COUNT(DISTINCT state_code) AS n_via FROM businesses GROUP BY 1", "businesses")(lambda s: _collapsed(s).select("dedup_key", "place_id", "n_listings", F.size("found_via").cast("bigint").alias("n_via")))
query(
    "a14_normalize_summary",
    f"WITH k AS (SELECT {KEY} AS key, arg_max(name, (review_count, -CAST(place_id AS BIGINT))) AS name FROM businesses GROUP BY 1) SELECT COUNT(*) AS kept, COUNT(*) FILTER (NOT contains(lower(name), '77')) AS local, COUNT(*) FILTER (contains(lower(name), '77')) AS chain, COUNT(*) FILTER (starts_with(key, 'name:')) AS no_site, COUNT(*) FILTER (starts_with(key, 'host:site')) AS microsites, (SELECT COUNT(*) FROM businesses) AS raw FROM k",
    "businesses",
)(lambda s: names.normalize_summary(s.businesses, _collapsed(s), ["77"], ["site"]))
query("j18_fan_out", f"SELECT place_id, {HOST.format(c='website')} AS host, length({HOST.format(c='website')}) AS measure FROM businesses WHERE website IS NOT NULL", "businesses")(
    lambda s: names.fan_out(s.businesses.where("website IS NOT NULL"), s.businesses.where("website IS NOT NULL").select(C.origin_of(F.col("website")).alias("o")).select("o.*").distinct().withColumn("measure", F.length("host"))).select("place_id", "host", "measure")
)

# --- pages ------------------------------------------------------------------

UNQUOTED = "regexp_replace(replace({c}, '&quot;', '\"'), '&amp;?', '&', 'g')"
META = r"""regexp_extract(html, '(?i)<meta name="{n}" content="([^"]*)"', 1)"""
# Page facts in SQL, enough for the markup of the pages.
FACTS = rf"""b AS (SELECT *, regexp_extract_all(html, '(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', 1) AS blocks, {HOST.format(c='url')} AS host, starts_with(lower(url), 'https://') AS https,
    NULLIF(trim({UNQUOTED.format(c="regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")}), '') AS title, NULLIF(trim({UNQUOTED.format(c=META.format(n='description'))}), '') AS meta_description,
    NULLIF({META.format(n='robots')}, '') AS meta_robots, NULLIF({META.format(n='twitter:card')}, '') AS twitter_card, regexp_matches(html, '(?i)<meta name="viewport"') AS viewport,
    NULLIF(regexp_extract(html, '(?i)<link rel="canonical" href="([^"]*)"', 1), '') AS canonical, NULLIF(regexp_extract(html, '(?i)<html lang="([^"]*)"', 1), '') AS html_lang,
    regexp_extract_all(html, '(?i)<img[^>]*>') AS images,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[ >].*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*(>|$)', ' ', 'g'), '\s+', ' ', 'g') AS txt FROM sitepages),
  v AS (SELECT *, list_filter(blocks, lambda s: json_valid(s)) AS valid FROM b),
  ld AS (SELECT v.page_id AS pid, x.key, x.type, x.path, x.value FROM v, unnest(v.valid) u(s), json_tree(u.s) x),
  ldt AS (SELECT pid, list_sort(list(DISTINCT json_extract_string(value, '$'))) AS types FROM ld WHERE type = 'VARCHAR' AND (key = '@type' OR ends_with(path, '."@type"')) GROUP BY 1),
  t AS (SELECT v.*, COALESCE(ldt.types, []) AS types FROM v LEFT JOIN ldt ON v.page_id = ldt.pid),
  facts AS (SELECT *, CAST(COALESCE(length(title), 0) AS INT) AS title_length, CAST(COALESCE(length(meta_description), 0) AS INT) AS meta_description_length,
    CAST(len(regexp_extract_all(html, '(?i)<h1[\s>]')) AS INT) AS h1_count, CAST(len(regexp_extract_all(html, '(?i)<h2[\s>]')) AS INT) AS h2_count, CAST(len(regexp_extract_all(html, '(?i)<h3[\s>]')) AS INT) AS h3_count,
    CAST(len(regexp_extract_all(txt, '\S+')) AS INT) AS word_count, CAST(len(images) AS INT) AS images_total, CAST(len(list_filter(images, lambda i: NOT regexp_matches(i, '\salt="[^"]'))) AS INT) AS images_missing_alt,
    regexp_matches(txt, '\(?\d{{3}}\)?[\s.-]?\d{{3}}[\s.-]?\d{{4}}') AS has_phone, regexp_matches(lower(array_to_string(types, ' ')), 'localbusiness|excavating|sportsactivitylocation|healthclub|organization') AS local_business,
    list_contains(types, 'FAQPage') AS faq, list_contains(types, 'Organization') AS organization, list_contains(types, 'AggregateRating') OR list_contains(types, 'Review') AS rated FROM t)"""
OPEN_GRAPH = ", ".join("NULLIF(trim(" + UNQUOTED.format(c=META.replace("name=", "property=").format(n=f"og:{k}")) + f"), '') AS og_{k}" for k in pages.OPEN_GRAPH)
FACTS = FACTS.replace("AS txt FROM sitepages)", f"AS txt, {OPEN_GRAPH} FROM sitepages)")
query("h1_page_signals", f"WITH {FACTS} SELECT {', '.join(c.split()[0] for c in pages.SIGNALS.split(', '))} FROM facts", "sitepages")(lambda s: pages.page_signals(s.sitepages))
query("h1_heading_counts", r"SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<h1[\s>]')) AS INT) AS h1_count, CAST(len(regexp_extract_all(html, '(?i)<h2[\s>]')) AS INT) AS h2_count FROM pages")(lambda s: pages.page_signals(s.pages).select("page_id", "h1_count", "h2_count"))
query("h2_c24_jsonld", f"WITH {FACTS} SELECT page_id, CAST(len(blocks) AS INT) AS n_blocks, CAST(len(valid) AS INT) AS n_valid, array_to_string(types, ',') AS types, local_business, faq, organization, list_contains(types, 'AggregateRating') AS rating, list_contains(types, 'Review') AS review FROM facts", "sitepages")(
    lambda s: pages.jsonld(s.sitepages).withColumn("types", F.array_join("types", ","))
)
LINKS = r"""h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href=["\x27]([^"\x27]*)["\x27]', 1)) AS href FROM pages), k AS (SELECT page_id, href, NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\-]*:') OR regexp_extract(href, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) = regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) AS inside FROM h)"""
query("h3_link_counts", f"WITH {LINKS} SELECT pages.page_id, CAST(count(*) FILTER (inside) AS INT) AS internal_links, CAST(count(*) FILTER (NOT inside AND starts_with(href, 'http')) AS INT) AS external_links FROM pages LEFT JOIN k USING (page_id) GROUP BY 1")(lambda s: pages.link_counts(s.pages))
RULES = (
    ("NOT https", 3, "no HTTPS"), ("NOT viewport", 3, "not mobile-friendly (no viewport)"), ("len(types) = 0", 3, "no structured data"),
    ("len(types) > 0 AND NOT list_contains(types, 'LocalBusiness')", 1, "no local business schema"), ("len(types) > 0 AND NOT faq", 1, "no FAQ schema"),
    ("title_length NOT BETWEEN 10 AND 65", 1, "title length off"), ("meta_description_length NOT BETWEEN 50 AND 170", 1, "meta description off"),
    ("word_count < 400", 2, "thin homepage content"), ("word_count BETWEEN 400 AND 599", 1, "light homepage content"), ("canonical IS NULL", 1, "no canonical tag"),
)
READY = f"""{FACTS}, ready AS (SELECT *, CAST({' + '.join(f'CASE WHEN {c} THEN {n} ELSE 0 END' for c, n, _ in RULES)} AS INT) AS score,
  list_filter([{', '.join(f"CASE WHEN {c} THEN '{g}' END" for c, _, g in RULES)}], lambda x: x IS NOT NULL) AS gaps FROM facts)"""
query("h4_readiness", f"WITH {READY} SELECT page_id, score, array_to_string(gaps, '|') AS gaps FROM ready", "sitepages")(lambda s: _readiness(s).select("page_id", "score", F.array_join("gaps", "|").alias("gaps")))
query("h5_prospect_score", f"WITH {READY} SELECT page_id, CAST(score + 1 + page_id % 2 AS INT) AS score, array_to_string(list_concat(gaps, CASE page_id % 2 WHEN 0 THEN ['no sitemap'] ELSE ['no sitemap', 'no llms.txt'] END), '|') AS gaps FROM ready", "sitepages")(
    lambda s: _readiness(s).select("page_id", *(c.alias(n) for c, n in zip(pages.prospect_score(F.col("score"), F.col("gaps"), F.lit(False), F.col("page_id") % 2 == 0), ("score", "gaps"), strict=True))).withColumn("gaps", F.array_join("gaps", "|"))
)


def _facts(s):
    return pages.page_signals(s.sitepages).join(pages.jsonld(s.sitepages), "page_id").join(s.pages.select("page_id", "url", C.host_of(F.col("url")).alias("host")), "page_id").withColumn("https", F.lower("url").startswith("https://"))


def _readiness(s):
    score, gaps = pages.readiness(F.col("https"), F.col("viewport"), F.col("types"), F.col("title_length"), F.col("meta_description_length"), F.col("word_count"), F.col("canonical"))
    return _facts(s).withColumns({"score": score, "gaps": gaps})


LISTED = lambda c, words: "(" + " OR ".join(f"contains({c}, '{w}')" for w in words) + ")"


@query(
    "h6_enrich",
    f"""WITH {READY}, first AS (SELECT host, arg_min(struct_pack(score := score, title := lower(COALESCE(title, '')), words := word_count), page_id) AS p FROM ready GROUP BY 1),
    j AS (SELECT place_id, no_website, COALESCE({HOST.format(c='website')}, '') AS h, p.score AS score, p.title AS title, p.words AS words FROM businesses b LEFT JOIN first f ON f.host = {HOST.format(c='b.website')}),
    k AS (SELECT *, CASE WHEN no_website = 1 OR h = '' THEN 'none' WHEN {LISTED('h', K.SOCIAL_HOSTS)} THEN 'social_only' WHEN {LISTED('h', K.DIRECTORY_HOSTS)} THEN 'directory' WHEN score IS NULL THEN 'unreachable'
      WHEN {LISTED('title', K.PARKED_HINTS)} THEN 'parked' WHEN (contains(title, 'not found') OR contains(title, '404')) AND words < 120 THEN 'dead' ELSE 'live' END AS site_status FROM j)
    SELECT place_id, site_status, CASE WHEN site_status = 'live' THEN score END AS readiness_score FROM k""",
    "sitepages",
    "businesses",
)
def enrich(s):
    page = _readiness(s).groupBy("host").agg(F.min_by(F.struct("score", "title", "word_count"), "page_id").alias("p")).select("host", "p.*")  # a host's first page
    leads = s.businesses.withColumn("host", C.host_of(F.col("website"))).join(page, "host", "left")
    status = C.site_status(F.col("host"), F.col("no_website"), F.col("score").isNotNull(), F.lit(200), F.col("title"), F.col("word_count"))
    return leads.select("place_id", status.alias("site_status"), F.when(status == "live", F.col("score")).alias("readiness_score"))


GENERATOR_SQL = r"list_filter(regexp_extract_all(html, '(?i)<meta\s([^>]*)>', 1), lambda m: regexp_matches(m, '(?i)\bname\s*=\s*.generator[^a-z]'))[1]"
BUILDER_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(html), '{m}')" for m in marks) + f" THEN '{n}'" for n, marks in K.BUILDERS.items()) + rf" ELSE NULLIF(trim(split_part(split_part(lower({GENERATOR_SQL}), 'content=', 2)[2:], chr(34), 1)), '') END"
query("h7_builder", f"SELECT page_id, {BUILDER_SQL} AS builder FROM pages")(lambda s: s.pages.select("page_id", pages.detect_builder(F.col("html")).alias("builder")))
TAG_SQL = "list_sort(list_filter([" + ", ".join("CASE WHEN " + " OR ".join("contains(lower(html), '" + m.replace("'", "''") + "')" for m in marks) + f" THEN '{n}' END" for n, marks in K.TAGS.items()) + "], lambda x: x IS NOT NULL))"
query("h8_tags", f"SELECT page_id, array_to_string({TAG_SQL}, ',') AS tags, {' OR '.join(f'contains(lower(html), {chr(39)}{m}{chr(39)})' for m in K.ADS_MARKERS)} AS ads FROM pages")(lambda s: s.pages.select("page_id", F.array_join(pages.detect_tags(F.col("html")), ",").alias("tags"), pages.detect_ads(F.col("html")).alias("ads")))
LIST_OF = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
query(
    "h9_agency_credit",
    f"""WITH l AS (SELECT page_id, {HOST.format(c='url')} AS own, unnest(regexp_extract_all(html, '(?i)[^<>]{{0,80}}<a\\b[^>]*>[^<]{{2,60}}</a>')) AS link, generate_subscripts(regexp_extract_all(html, '(?i)[^<>]{{0,80}}<a\\b[^>]*>[^<]{{2,60}}</a>'), 1) AS k FROM pages),
    w AS (SELECT *, list_reverse(regexp_extract_all(lower(split_part(link, '<', 1)), '[a-z]+')) AS said, regexp_replace(regexp_extract(link, 'href=.([^\\x22\\x27]+)', 1), '^//', '') AS href, trim(split_part(split_part(link, '>', 2), '<', 1)) AS label FROM l),
    d AS (SELECT page_id, k, own, label, CASE WHEN contains(href, '://') THEN {HOST.format(c='href')} ELSE regexp_replace(lower(split_part(href, '/', 1)), '^www\\.', '') END AS domain, said, list_has_any(said[2:4], {LIST_OF(K.STRONG_CREDIT)}) AS strong FROM w WHERE said[1] = 'by' AND list_has_any(said[2:4], {LIST_OF(K.CREDIT_WORDS)})),
    f AS (SELECT page_id, arg_min(struct_pack(domain, label, strong), k) AS c FROM d WHERE domain <> '' AND domain <> own AND NOT regexp_matches(domain, '{'|'.join(K.PLATFORM_DOMAINS).replace('.', '[.]')}') GROUP BY 1)
    SELECT page_id, c.domain AS domain, c.label AS label, c.strong AS strong FROM pages LEFT JOIN f USING (page_id)""",
)(lambda s: s.pages.select("page_id", pages.agency_credit(F.col("html"), C.host_of(F.col("url"))).alias("c")).select("page_id", "c.*"))
names_of = lambda c: ", ".join(f"'{x}'" for x in c)
query(
    "h10_management",
    f"""WITH p AS (SELECT page_id, {BUILDER_SQL} AS builder, {TAG_SQL} AS tags, {' OR '.join(f"contains(lower(html), '{m}')" for m in K.ADS_MARKERS)} AS ads FROM pages),
    q AS (SELECT *, list_filter(tags, lambda x: x IN ({names_of(K.MANAGED_TAGS)})) AS m, list_filter(tags, lambda x: x IN ({names_of(K.ACTIVE_TAGS)}) AND x NOT IN ({names_of(K.MANAGED_TAGS)})) AS o, coalesce(builder IN ({names_of(K.DIY_BUILDERS)}), false) AS diy FROM p),
    e AS (SELECT *, list_filter(['builder: ' || builder, CASE WHEN len(m) > 0 THEN 'marketing stack: ' || array_to_string(m, ', ') END, CASE WHEN len(o) > 0 THEN 'tags: ' || array_to_string(o, ', ') END, CASE WHEN ads AND NOT list_contains(m, 'Google Ads') THEN 'running Google Ads' END], lambda x: x IS NOT NULL) AS found FROM q)
    SELECT page_id, CASE WHEN (len(m) > 0 OR ads) AND NOT diy THEN 'likely agency-managed' WHEN len(m) > 0 OR ads OR len(o) > 0 THEN 'self-managed (active marketing)' WHEN diy THEN 'DIY / unmanaged' ELSE 'custom/unclear - review' END AS status,
      CASE WHEN len(m) > 0 OR ads OR diy THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN len(found) > 0 THEN array_to_string(found, '|') ELSE 'no recognizable builder or marketing tags' END AS evidence FROM e""",
)(lambda s: _managed(s).select("page_id", "status", "confidence", F.array_join("evidence", "|").alias("evidence")))


def _managed(s):
    html = F.col("html")
    # The findings are columns before they are judged: each is named many times there.
    rows = s.pages.select("page_id", pages.detect_builder(html).alias("builder"), pages.detect_tags(html).alias("tags"), pages.agency_credit(html, C.host_of(F.col("url"))).alias("credit"), pages.detect_ads(html).alias("ads"), html.isNotNull().alias("reachable"))
    found = pages.management(*(F.col(c) for c in ("builder", "tags", "credit", "ads", "reachable")))
    return rows.select("page_id", *(c.alias(n) for c, n in zip(found, ("status", "confidence", "evidence"), strict=True)))


def _robots(s):
    return s.sitefiles.select(F.concat(F.lit("h"), "page_id").alias("host"), "robots", "sitemap", "llms")


BOT_SQL = ", ".join(f"('{b}')" for b in K.AI_BOTS)
query("h12_w13_robots_status", f"""SELECT 'h' || page_id AS host, bot, CASE WHEN kind IN ('blog', 'm') THEN 'unspecified' WHEN bot = agent THEN CASE WHEN shut THEN 'blocked' ELSE 'allowed' END
  WHEN star THEN CASE train WHEN 'no' THEN 'blocked' ELSE 'allowed' END ELSE 'unspecified' END AS status FROM sitefiles, (VALUES {BOT_SQL}) b(bot)""", "sitefiles")(lambda s: pages.robots_status(_robots(s)))
query("h11_site_files", """SELECT 'h' || page_id AS host, kind NOT IN ('blog', 'm') AS robots_exists, kind NOT IN ('blog', 'm') AND delay <> '' AS sitemap_declared, CASE WHEN kind NOT IN ('blog', 'm') THEN CAST(NULLIF(delay, '') AS INT) END AS crawl_delay,
  CASE WHEN NOT contains(url, '#') THEN links END AS url_count, contains(url, '?') AND NOT contains(url, '#') AS llms_exists FROM sitefiles""", "sitefiles")(lambda s: pages.site_files(_robots(s)))
query("w14_resolve_attempts", "SELECT url, arg_min(attempt, (CASE WHEN attempt = 0 OR length(html) < 2000 THEN 1 ELSE 0 END, attempt)) AS attempt FROM (SELECT url, html, unnest([0, 1, 2]) AS attempt FROM pages) GROUP BY url")(
    lambda s: pages.resolve_attempts(s.pages.select("url", "html", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("attempt")).withColumn("status", F.when(F.col("attempt") == 0, 503).otherwise(200))).select("url", "attempt")
)
EMAIL_SQL = rf"list_sort(list_distinct(list_transform(list_filter(list_concat(list_transform(regexp_extract_all(html, '(?i)href=[\x22\x27]mailto:([^\x22\x27?]+)', 1), lambda x: trim(x)), regexp_extract_all(html, '{K.EMAIL_PATTERN}')), lambda x: x <> '' AND NOT regexp_matches(x, '{K.JUNK_EMAIL_PATTERN}')), lambda x: lower(x))))"
query("h13_emails", f"SELECT page_id, array_to_string({EMAIL_SQL}, ',') AS emails FROM pages")(lambda s: s.pages.select("page_id", F.array_join(pages.emails(F.col("html")), ",").alias("emails")))
PHONE_SQL = rf"(list_sort(list_distinct(list_transform(regexp_extract_all(html, '{K.PHONE_PATTERN}'), lambda x: regexp_replace(trim(x), '\s+', ' ', 'g')))))[1:6]"
query("h14_phones", f"SELECT page_id, array_to_string({PHONE_SQL}, ',') AS phones FROM pages")(lambda s: s.pages.select("page_id", F.array_join(pages.phones(F.col("html")), ",").alias("phones")))
OWNER_SQL = """COALESCE(array_to_string(list_sort(list(DISTINCT name) FILTER ({c})), '|'), '')"""
query("h15_owners", f"""WITH {FACTS}, o AS (SELECT pid, trim(json_extract_string(value, '$.name')) AS name, COALESCE(regexp_matches(CAST(json_extract(value, '$."@type"') AS VARCHAR), '"Person"'), false) AS person,
    COALESCE(key IN ('founder', 'owner', 'employee') OR regexp_matches(path, '[.](founder|owner|employee)$') AND regexp_matches(key, '^[0-9]+$'), false) AS held FROM ld WHERE type = 'OBJECT' AND json_extract_string(value, '$.name') <> '')
  SELECT page_id, {OWNER_SQL.format(c='person')} AS persons, {OWNER_SQL.format(c='held')} AS founders FROM b LEFT JOIN o ON page_id = pid GROUP BY 1""", "sitepages")(
    lambda s: pages.owners(s.sitepages).select("page_id", F.array_join("persons", "|").alias("persons"), F.array_join("founders", "|").alias("founders"))
)
# Every owner word with the lengths of what lies before it, then the snippets of a page in order, first of equal ones.
HINT_SQL = rf"""x AS (SELECT page_id, {HOST.format(c='url')} AS host, trim(regexp_replace(regexp_replace(html, '{K.HIDDEN_PATTERN}', ' ', 'g'), '\s+', ' ', 'g')) AS txt FROM sitepages),
  g AS (SELECT *, string_split_regex(txt, '(?i){K.OWNER_PATTERN}') AS gaps, regexp_extract_all(txt, '(?i){K.OWNER_PATTERN}', 0) AS words FROM x),
  m AS (SELECT page_id, host, txt, unnest(range(1, len(words) + 1)) AS k, gaps, words FROM g),
  a AS (SELECT page_id, host, k, txt, list_sum(list_transform(gaps[1:k], lambda w: length(w))) + COALESCE(list_sum(list_transform(words[1:k - 1], lambda w: length(w))), 0) AS place, length(words[k]) AS n FROM m),
  z AS (SELECT page_id, host, trim(substring(txt, CAST(greatest(place - 70, 0) + 1 AS BIGINT), CAST(place + n + 90 - greatest(place - 70, 0) AS BIGINT))) AS hint, min(k) AS k FROM a GROUP BY ALL),
  few AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY k) AS r FROM z QUALIFY r <= 5)"""
query("h16_owner_hints", f"WITH {HINT_SQL} SELECT page_id, COALESCE(string_agg(hint, '|' ORDER BY r), '') AS hints FROM sitepages LEFT JOIN few USING (page_id) GROUP BY 1", "sitepages")(
    lambda s: pages.owner_hints(s.sitepages).withColumn("hints", F.array_join("hints", "|"))
)
query("h16_lead_hints", f"WITH {HINT_SQL}, f AS (SELECT host, hint, min((page_id, r)) AS place FROM few GROUP BY 1, 2), l AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY place) AS q FROM f QUALIFY q <= 6) SELECT host, string_agg(hint, '|' ORDER BY q) AS hints FROM l GROUP BY 1", "sitepages")(
    lambda s: pages.lead_hints(pages.owner_hints(s.sitepages).join(s.pages.select("page_id", C.host_of(F.col("url")).alias("host")), "page_id")).withColumn("hints", F.array_join("hints", "|"))
)


def _mailboxes(s):
    """Addresses at the page's own host and elsewhere, by what its text holds."""
    host, word = C.host_of(F.col("url")), F.lower(F.regexp_extract("html", "<p><b>([A-Za-z]+)", 1))
    held = F.array_compact(F.array(F.concat(word, F.lit("@mail.org")), F.when(F.length("html") % 2 == 0, F.concat(F.lit("sales@"), host)), F.when(F.length("html") % 3 == 0, F.concat(F.lit("office@"), host)), F.concat(F.lit("sales@"), word, F.lit(".zz"))))
    return s.pages.select("page_id", host.alias("host"), held.alias("held"))


WORD_SQL = "lower(regexp_extract(html, '<p><b>([A-Za-z]+)', 1))"
query("h17_best_email", f"SELECT page_id, CASE WHEN length(html) % 3 = 0 THEN 'office@' || {HOST.format(c='url')} WHEN length(html) % 2 = 0 THEN 'sales@' || {HOST.format(c='url')} ELSE 'sales@' || {WORD_SQL} || '.zz' END AS email FROM pages")(lambda s: _mailboxes(s).select("page_id", pages.best_email(F.col("held"), F.col("host")).alias("email")))
query("h18_best_email_strict", f"SELECT page_id, {WORD_SQL} || '@mail.org' AS email FROM pages")(lambda s: _mailboxes(s).select("page_id", pages.best_email_strict(F.concat(F.array(F.lit("test@test.com"), F.concat(F.lit("moc."), "host", F.lit("@y.com")), F.concat(F.lit("a@"), "host", F.lit(".zz"))), F.filter("held", lambda e: ~e.endswith(F.col("host"))))).alias("email")))


@query("a15_h19_x5_merge_contacts", f"WITH e AS (SELECT {HOST.format(c='url')} AS host, unnest({EMAIL_SQL}) AS x FROM pages) SELECT host, count(DISTINCT x) AS n FROM (SELECT {HOST.format(c='url')} AS host FROM pages) p LEFT JOIN e USING (host) GROUP BY 1")
def contacts(s):
    rows = s.pages.withColumns({"host": C.host_of(F.col("url")), "emails": pages.emails(F.col("html")), "phones": pages.phones(F.col("html"))}).join(pages.owners(s.pages), "page_id")
    return pages.merge_contacts(rows).select("host", F.size("emails").cast("bigint").alias("n"))


# --- benchmark --------------------------------------------------------------


def _bench(s):
    roll = benchmark.rollup_pages(_facts(s)).withColumnRenamed("host", "entity")
    extra = roll.select("entity", (F.length("entity") % 2 == 0).alias("sitemap"), (F.length("entity") % 3 == 0).alias("citation_ok"), F.lit(False).alias("llms"), F.lit(True).alias("ai_mentioned"))
    return benchmark.rubric(benchmark.benchmark_table(roll.select("entity"), {"rollup": roll, "site": extra}))


ROLLUP = f"""{FACTS}, roll AS (SELECT host, COUNT(*) AS pages_n, round_even(avg(word_count), 0) AS avg_words, bool_and(title_length BETWEEN 10 AND 65) AS all_titled, bool_and(meta_description_length BETWEEN 50 AND 170) AS all_desc,
  bool_and(h1_count >= 1) AS all_h1, bool_and(h2_count >= 2) AS multi_h2, bool_or(has_phone) AS has_phone, bool_or(local_business) AS local_business, bool_or(faq) AS faq, bool_or(organization) AS organization, bool_or(rated) AS rated,
  bool_or(len(types) > 0) AS any_jsonld, arg_min(canonical IS NOT NULL, page_id) AS canonical, arg_min(viewport, page_id) AS viewport, arg_min(https, page_id) AS https FROM facts GROUP BY 1)"""
RUBRIC = f"""{ROLLUP}, e AS (SELECT *, length(host) % 2 = 0 AS sitemap, length(host) % 3 = 0 AS cites FROM roll),
  points AS (SELECT host AS entity, CAST(sitemap AS INT) + CAST(cites AS INT) + CAST(all_titled AS INT) + CAST(all_desc AS INT) + CAST(canonical AND https AND viewport AS INT) AS technical,
    CAST(avg_words >= 400 AS INT) + CAST(avg_words >= 800 AS INT) + CAST(all_h1 AND multi_h2 AS INT) + CAST(faq AS INT) + CAST(pages_n >= 3 AS INT) AS content,
    least(5, 2 * CAST(local_business AS INT) + CAST(has_phone AS INT) + CAST(rated AS INT) + CAST(organization AS INT)) AS local, CAST(any_jsonld AS INT) + CAST(faq AS INT) + CAST(cites AS INT) + 1 AS agentic FROM e),
  scored AS (SELECT *, technical + content + local + agentic AS total FROM points)"""
query("a8_rollup_pages", f"WITH {ROLLUP} SELECT * FROM roll", "sitepages")(lambda s: benchmark.rollup_pages(_facts(s)))
query("a8_rollup_counts", f"SELECT {HOST.format(c='url')} AS host, COUNT(*) AS pages_n FROM pages GROUP BY 1")(lambda s: benchmark.rollup_pages(_facts(s)).select("host", "pages_n"))
query("g12_j22_rubric", f"WITH {RUBRIC} SELECT entity, technical, content, local, agentic, total FROM scored", "sitepages")(lambda s: _bench(s).select("entity", "technical", "content", "local", "agentic", "total"))
query("o8_leaderboard", f"WITH {RUBRIC} SELECT entity, total, CAST(ROW_NUMBER() OVER (ORDER BY total DESC, entity) AS INT) AS place FROM scored", "sitepages")(lambda s: benchmark.leaderboard(_bench(s)).select("entity", "total", "place"))
query("a10_market_gaps", "SELECT signal FROM (SELECT bool_and(NOT contains(lower(html), 'application/ld+json')) AS jsonld, bool_and(NOT contains(lower(html), 'viewport')) AS viewport, bool_and(NOT contains(html, '<h1')) AS h1, bool_and(NOT contains(html, 'lang=\"de\"')) AS german FROM pages) UNPIVOT (absent FOR signal IN (jsonld, viewport, h1, german)) WHERE absent")(
    lambda s: benchmark.market_gaps(s.pages.select(F.lower("html").contains("application/ld+json").alias("jsonld"), F.lower("html").contains("viewport").alias("viewport"), F.col("html").contains("<h1").alias("h1"), F.col("html").contains('lang="de"').alias("german")), ["jsonld", "viewport", "h1", "german"])
)
query(
    "g13_measure",
    "WITH r AS (SELECT item_id AS place_id, min(NULLIF(rank_absolute, 0)) AS rank FROM items WHERE item_id IS NOT NULL GROUP BY 1), v AS (SELECT place_id, bool_or(rating > 3) AS mentioned, bool_or(rating = 5) AS cited FROM reviews GROUP BY 1) SELECT b.place_id, r.rank, v.mentioned, v.cited FROM businesses b LEFT JOIN r USING (place_id) LEFT JOIN v USING (place_id)",
    "businesses",
    "items",
    "reviews",
)(
    lambda s: benchmark.measure(
        s.businesses.select("place_id"),
        s.items.where("item_id IS NOT NULL").select(F.col("item_id").alias("place_id"), F.col("rank_absolute").alias("rank")),
        s.contacts.select("place_id"),
        s.reviews.select("place_id", (F.col("rating") > 3).alias("mentioned"), (F.col("rating") == 5).alias("cited")),
    ).select("place_id", "rank", "mentioned", "cited")
)
query("g15_lead_location", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') || ',TN,United States' AS location FROM part")(
    lambda s: s.part.select("p_partkey", C.parse_location(F.concat("p_type", F.lit(" Rd, "), "p_name", F.lit(", TN 37000, USA"))).alias("l")).select("p_partkey", C.location_string(C.title_case(F.col("l.town")), F.col("l.state"), F.lit("United States")).alias("location"))
)

# --- reviews and replies ----------------------------------------------------


def _replies(s):
    entry = F.concat(F.lit('Here: [{"place_id":"'), (F.col("review_id") % 150).cast("string"), F.lit('","name":"n","complaint_count":'), (F.col("rating") + 1).cast("string"), F.lit(',"complaint_types":["no_show","nonsense"],"evidence":["a","b","c"]},{"name":"no key"}] done'))
    return s.reviews.select(F.format_string("f%08d", "review_id").alias("file"), F.when(F.col("review_id") % 11 == 0, F.lit("sorry, no list")).otherwise(entry).alias("reply"))


FLAGS = "fl AS (SELECT CAST(review_id % 150 AS VARCHAR) AS place_id, arg_max(rating + 1, review_id) AS complaint_count FROM reviews WHERE review_id % 11 <> 0 GROUP BY 1)"
query("s11_c25_latest_flags", f"WITH {FLAGS} SELECT place_id, complaint_count, 'no_show' AS types, 'a|b' AS evidence FROM fl", "reviews")(lambda s: reviews.latest_flags(_replies(s)).select("place_id", "complaint_count", F.array_join("complaint_types", "|").alias("types"), F.array_join("evidence", "|").alias("evidence")))
LAT = "lat AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY id DESC) AS r FROM audits WHERE status = 'complete') WHERE r = 1)"


def _pitch(s):
    flags = reviews.latest_flags(_replies(s)).select("place_id", "complaint_count")
    return reviews.pitch_rows(flags, s.businesses, profiles.latest_audits(s.audits).select("place_id", F.col("total_photos").alias("rating"), "rating_votes"), s.contacts, 40, 3)


query("j8_pitch_rows", f"WITH {FLAGS}, {LAT} SELECT place_id, complaint_count FROM fl JOIN businesses USING (place_id) JOIN lat USING (place_id) WHERE COALESCE(rating_votes, 0) <= 40 AND complaint_count >= 3", "reviews", "businesses", "audits")(lambda s: _pitch(s).select("place_id", "complaint_count"))


@query("o5_pitch_order", f"WITH {FLAGS}, {LAT} SELECT place_id, ROW_NUMBER() OVER (PARTITION BY state_code ORDER BY COALESCE(total_photos, 0) DESC, complaint_count DESC, COALESCE(rating_votes, 0), place_id) AS place FROM fl JOIN businesses USING (place_id) JOIN lat USING (place_id) WHERE COALESCE(rating_votes, 0) <= 40 AND complaint_count >= 3", "reviews", "businesses", "audits")
def pitch(s):
    from localpulse.operators.discovery import rank_within
    from localpulse.operators.lenses import pitch_order

    return rank_within(_pitch(s), "state_code", pitch_order()).select("place_id", "place")


query("g14_batch_payload", """SELECT place_id, length('{"place_id":"' || place_id || '","name":"' || name || '","negative_reviews":[]}') AS chars FROM businesses""", "businesses")(lambda s: reviews.batch_payload(s.businesses.withColumn("negative_reviews", F.array().cast("array<string>"))).select("place_id", "chars"))

# --- file shapes ------------------------------------------------------------


@query("s1_s2_gazetteer", "SELECT place_name AS name, lat, lng, population, state_code AS state_name FROM cells WHERE population >= 1000", "cells")
def gazetteer(s):
    line = F.concat_ws("\t", F.lit("1"), "place_name", F.lit(""), F.lit(""), F.col("lat").cast("string"), F.col("lng").cast("string"), F.lit("P"), F.lit("PPL"), F.lit("US"), F.lit(""), "state_code", F.lit(""), F.lit(""), F.lit(""), F.col("population").cast("string"), F.lit(""), F.lit(""), F.lit(""), F.lit(""))
    path = new_path(s.spark, "gazetteer")
    s.cells.select(line.alias("value")).union(s.cells.limit(1).select(F.lit("a broken row"))).write.text(path)
    admin1 = s.cells.select(F.concat(F.lit("US."), "state_code").alias("key"), F.col("state_code").alias("state_name")).distinct()
    codes = admin1.select("state_name", F.col("state_name").alias("state_code"))
    return tables.with_admin1(tables.read_gazetteer(s.spark, path), admin1, codes).select("name", "lat", "lng", "population", "state_name")


@query("s3_s4_seed", "SELECT place_name AS name, lat, lng, population FROM cells", "cells")
def seed(s):
    path = new_path(s.spark, "seed")
    tables.write_seed(s.cells.select(F.col("place_name").alias("name"), "lat", "lng", "population"), path)
    return tables.read_seed(s.spark, path).select("name", "lat", "lng", "population")


@query("s5_flatten_places", "SELECT place_id, name, no_website, review_count FROM businesses", "businesses")
def listings(s):
    path = new_path(s.spark, "responses")
    place = F.struct(F.col("place_id").alias("id"), F.struct(F.col("name").alias("text")).alias("displayName"), F.col("review_count").cast("int").alias("userRatingCount"), F.col("website").alias("websiteUri"))
    s.businesses.select(F.array(place, F.struct(F.lit(None).cast("string").alias("id"), F.struct(F.lit("x").alias("text")).alias("displayName"), F.lit(0).alias("userRatingCount"), F.lit("").alias("websiteUri"))).alias("places")).write.json(path)
    return tables.flatten_places(tables.read_responses(s.spark, path)).select("place_id", "name", "no_website", F.col("review_count").cast("bigint").alias("review_count"))


@query("s6_discover_roundtrip", "SELECT place_id, name, website, state_code FROM businesses", "businesses")
def discover(s):
    path = new_path(s.spark, "discover")
    tables.to_discover(s.businesses.withColumn("found_via", F.array("trade_bucket"))).write.json(path)
    return tables.read_discover(s.spark, path).select("place_id", "name", "website", "state_code")


@query("s8_read_cohort", "SELECT DISTINCT place_id FROM businesses WHERE no_website = 1", "businesses")
def cohort(s):
    path = new_path(s.spark, "cohort")
    s.businesses.where("no_website = 1").select(F.concat(F.lit(" "), "place_id", F.lit(", "), "place_id").alias("value")).write.text(path)
    return tables.read_cohort(s.spark, path)


@query("s9_s10_read_reviews", "SELECT place_id, rating, COUNT(*) AS n FROM reviews GROUP BY 1, 2", "reviews")
def review_files(s):
    path = new_path(s.spark, "reviews")
    s.reviews.groupBy("place_id").agg(F.collect_list(F.struct("rating", "text")).alias("reviews")).write.json(path)
    return tables.read_reviews(s.spark, path).groupBy("place_id", "rating").agg(F.count("*").alias("n"))


query("s13_pagespeed", "SELECT url, (page_id % 100) / 100e0 * 100 AS score, CAST(page_id AS DOUBLE) AS lcp FROM pages")(
    lambda s: tables.flatten_pagespeed(s.pages.select("url", F.struct((F.col("page_id") % 100 / 100).alias("score")).alias("lighthouse"), F.create_map(F.lit("lcp"), F.col("page_id").cast("string")).alias("field"))).select("url", "score", F.col("field")["lcp"].alias("lcp"))
)
query("s14_unwrap_tasks", "SELECT id AS task_id, CASE WHEN id % 4 = 0 THEN 'empty' WHEN id % 4 = 1 THEN 'error' ELSE 'ok' END AS status, CASE WHEN id % 4 > 1 THEN i END AS item FROM requests, (VALUES (1), (2)) t(i) WHERE id % 4 > 1 OR i = 1", "requests")(
    lambda s: tables.unwrap_tasks(s.requests.select(F.col("id").alias("task_id"), F.lit(20000).alias("status_code"), F.when(F.col("id") % 4 == 0, 40102).when(F.col("id") % 4 == 1, 50000).otherwise(20000).alias("task_code"), F.array(F.lit(1), F.lit(2)).alias("items")))
)
query("s15_backlinks", "SELECT url AS target, page_id % 7 AS rank, page_id AS backlinks FROM pages")(lambda s: tables.flatten_backlinks(s.pages.select(F.col("url").alias("target"), F.struct((F.col("page_id") % 7).alias("rank"), F.col("page_id").alias("backlinks"), F.lit(1).alias("referring_domains")).alias("summary"))).select("target", "rank", "backlinks"))


@query("s16_append_snapshot", "SELECT place_id, COUNT(*) AS n FROM audits GROUP BY 1", "audits")
def snapshots(s):
    path = new_path(s.spark, "snapshots")
    for odd in (0, 1):
        tables.append_snapshot(s.audits.where(F.col("id") % 2 == odd), path)
    return s.spark.read.parquet(path).groupBy("place_id").agg(F.count("*").alias("n"))


@query("s17_ranked_sink", "SELECT state_code, place_id, row_number() OVER (PARTITION BY state_code ORDER BY coalesce(review_count, 0) DESC, place_id) AS rank FROM businesses", "businesses")
def ranked_sink(s):
    path = new_path(s.spark, "ranked-csv")
    tables.write_ranked(s.businesses.select("state_code", "place_id", "review_count"), path, [F.desc(F.coalesce("review_count", F.lit(0))), F.asc("place_id")])
    return s.spark.read.csv(path, header=True, schema="state_code string, place_id string, review_count bigint, rank int").select("state_code", "place_id", "rank")


@query("s17_s18_written_by_state", "SELECT state_code, COUNT(*) AS n FROM businesses GROUP BY 1", "businesses")
def by_state(s):
    path = new_path(s.spark, "by-state")
    tables.write_by(s.businesses.select("place_id", "state_code"), "state_code", path)
    return s.spark.read.parquet(path).groupBy("state_code").agg(F.count("*").alias("n"))


@query("s12_read_audits", "SELECT page_id % 50 AS k, COUNT(*) AS n FROM pages WHERE page_id % 5 <> 0 GROUP BY 1")
def audit_files(s):
    path = new_path(s.spark, "page-audits")
    page = F.struct(F.lit(200).alias("status"), F.lit("t").alias("title"), F.lit(5).alias("word_count"), F.when(F.col("page_id") % 5 == 0, "timeout").alias("error"))
    rows = s.pages.groupBy((F.col("page_id") % 50).cast("string").alias("host")).agg(F.map_from_entries(F.collect_list(F.struct(F.concat("url", F.lit("#"), "page_id"), page))).alias("pages"))
    rows.write.json(path)
    return tables.read_audits(s.spark, path).groupBy(F.col("host").cast("bigint").alias("k")).agg(F.count("*").alias("n"))


query("j12_pick_pagespeed", f"WITH {HOSTS}, {DOMAINS}, r AS (SELECT host, page_id AS position, page_id * 2 AS score FROM h WHERE page_id % 3 <> 0) SELECT domain AS entity, arg_min(score, position) AS score FROM d JOIN r ON host = domain OR ends_with(host, '.' || domain) OR ends_with(domain, '.' || host) GROUP BY 1")(
    lambda s: names.pick_pagespeed(_domains(s).withColumn("entity", F.col("domain")), _hosts(s).select("host", F.col("page_id").alias("position"), F.when(F.col("page_id") % 3 == 0, "error").alias("error"), (F.col("page_id") * 2).alias("score")))
)

# --- streams ----------------------------------------------------------------


@query("t2_snapshot_stream", "SELECT place_id, COUNT(DISTINCT audited_ts) AS n FROM audits GROUP BY 1", "audits")
def snapshot_stream(s):
    from localpulse.streaming.jobs import ingest_snapshots

    source, sink = new_path(s.spark, "audit-files"), new_path(s.spark, "audit-table")
    s.audits.write.parquet(source)
    stream = s.spark.readStream.schema(s.audits.schema).parquet(source).withColumn("audited_ts", F.col("audited_ts").cast("timestamp"))
    ingest_snapshots(stream, sink, new_path(s.spark, "audit-checkpoint")).awaitTermination()
    return s.spark.read.parquet(sink).groupBy("place_id").agg(F.count("*").alias("n"))


@query("t1_listing_stream", "SELECT place_id, arg_min(name, seq) AS name FROM sightings GROUP BY 1", "sightings")
def listing_stream(s):
    from localpulse.streaming.jobs import business_table, ingest_listings

    source = new_path(s.spark, "sighting-files")
    rows = s.sightings.withColumn("found_via", F.array("via")).drop("via")
    rows.write.parquet(source)
    table = business_table(s.spark, new_path(s.spark, "business-table"))
    ingest_listings(s.spark.readStream.schema(rows.schema).parquet(source), table, new_path(s.spark, "listing-checkpoint")).awaitTermination()
    return table.read().select("place_id", "name")


@query("t3_live_grid", "SELECT place_id, scan_id, COUNT(rank) / CAST(COUNT(*) AS DOUBLE) AS found_share FROM points GROUP BY 1, 2", "points")
def live(s):
    from localpulse.streaming.jobs import grid_table, live_grid

    source = new_path(s.spark, "pin-files")
    pins = s.points.withColumn("scan_ts", F.make_date("scan_id", F.lit(1), F.lit(1)).cast("timestamp"))
    pins.write.parquet(source)
    table = grid_table(s.spark, new_path(s.spark, "grid"))
    live_grid(s.spark.readStream.schema(pins.schema).parquet(source), table, new_path(s.spark, "grid-checkpoint")).awaitTermination()
    return table.read().select("place_id", "scan_id", "found_share")


@query("t4_stale_places", "SELECT place_id FROM audits GROUP BY 1 HAVING max(audited_ts) < (SELECT max(audited_ts) - INTERVAL 12 HOUR FROM audits)", "audits")
def stale(s):
    from localpulse.streaming.jobs import stale_places

    now = s.audits.agg(F.max("audited_ts")).first()[0]
    return stale_places(s.audits, F.lit(now) - F.expr("INTERVAL 12 HOURS"))
