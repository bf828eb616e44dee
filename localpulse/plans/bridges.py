"""The market's relations as views over the driver's tables, in SQL that Spark and DuckDB both read.

``{str}``, ``{k}``, ``{row}`` and the table names are filled in for either engine.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from localpulse.operators.ordering import dealt

TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()

BRIDGES = {
    "businesses": """
        SELECT CAST(c_custkey AS {str}) AS place_id, c_name AS name, n_name AS state_code, r_name AS state_name, c_mktsegment AS trade_bucket,
          CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'match' ELSE 'maybe' END AS relevance, p.url AS website,
          CASE WHEN p.url IS NULL THEN 1 ELSE 0 END AS no_website, COALESCE(o.n, 0) AS review_count
        FROM {customer} c JOIN {nation} n ON c_nationkey = n_nationkey JOIN {region} r ON n_regionkey = r_regionkey
        LEFT JOIN {pages} p ON 2 * p.page_id = c_custkey % 100
        LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM {orders} GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "cells": """
        SELECT CAST(s_suppkey AS {str}) AS cell_id, s_name AS place_name, n_name AS state_code, r_name AS state_name,
          CAST(35 + (s_suppkey * 37 % 300) / 1e2 AS DOUBLE) AS lat, CAST(-90 + (s_suppkey * 53 % 300) / 1e2 AS DOUBLE) AS lng, CAST(FLOOR(ABS(s_acctbal) * 60) AS BIGINT) AS population
        FROM {supplier} s JOIN {nation} n ON s_nationkey = n_nationkey JOIN {region} r ON n_regionkey = r_regionkey""",
    "audits": """
        SELECT event_id AS id, CAST(user_id AS {str}) AS place_id,
          CASE event_type WHEN 'signup' THEN 'baseline' WHEN 'view' THEN 'prospect' WHEN 'click' THEN 'monthly' ELSE 'adhoc' END AS audit_type,
          CASE WHEN event_type = 'error' THEN 'error' ELSE 'complete' END AS status, ts AS audited_ts,
          CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(FLOOR(value) AS INT) END AS rating_votes, CASE WHEN k % 11 = 0 THEN NULL ELSE k % 30 END AS total_photos,
          k % 3 AS additional_categories_count, k % 2 AS has_hours, k % 5 AS is_claimed
        FROM (SELECT *, CAST({k} AS INT) AS k FROM {events}) e""",
    "points": """
        SELECT CAST(l_suppkey AS {str}) AS place_id, YEAR(l_shipdate) AS scan_id, CAST(l_partkey % 7 AS INT) AS {row}, CAST(l_orderkey % 7 AS INT) AS col, l_returnflag AS keyword,
          MIN(CASE WHEN l_quantity > 25 THEN NULL ELSE CAST(l_quantity AS INT) END) AS rank
        FROM {lineitem} l GROUP BY l_suppkey, YEAR(l_shipdate), CAST(l_partkey % 7 AS INT), CAST(l_orderkey % 7 AS INT), l_returnflag""",
    "scans": """
        SELECT place_id, scan_id, COUNT(*) AS n_pins, CAST(MAX({row}) + 1 AS INT) AS grid_rows, CAST(MAX(col) + 1 AS INT) AS grid_cols FROM {points} p GROUP BY place_id, scan_id""",
    "base_points": """
        SELECT place_id, {row}, col, keyword, rank FROM (SELECT p.*, MIN(scan_id) OVER (PARTITION BY place_id) AS pick FROM {points} p) x WHERE scan_id = pick""",
    "cur_points": """
        SELECT place_id, {row}, col, keyword, rank FROM (SELECT p.*, MAX(scan_id) OVER (PARTITION BY place_id) AS pick FROM {points} p) x WHERE scan_id = pick""",
    "items": """
        SELECT l_orderkey AS keyword, CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_suppkey AS {str}) END AS item_id,
          CAST(l_partkey % 4 AS INT) AS rank_absolute, CAST(l_linenumber % 3 AS INT) AS rank_group,
          ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_returnflag, l_discount, l_tax, l_linestatus) AS seq
        FROM {lineitem} l""",
    "reviews": """SELECT doc_id AS review_id, CAST(doc_id % 150 AS {str}) AS place_id, CAST(1 + n_chars % 5 AS INT) AS rating, text FROM {documents} d""",
    "enrichment": """
        SELECT CAST(c_custkey AS {str}) AS place_id, CASE c_custkey % 6 WHEN 0 THEN 'dead' WHEN 1 THEN 'blocked' WHEN 2 THEN 'social_only' WHEN 3 THEN NULL ELSE 'live' END AS site_status,
          CASE WHEN c_custkey % 6 > 3 THEN CAST(c_custkey % 12 AS INT) END AS readiness_score, CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS google_ads,
          CASE WHEN c_custkey % 13 = 0 THEN 'likely agency-managed' WHEN c_custkey % 13 < 5 THEN 'DIY / unmanaged' ELSE 'custom/unclear - review' END AS mgmt_status
        FROM {customer} c WHERE c_custkey % 4 <> 0""",
    "contacts": """SELECT CAST(c_custkey AS {str}) AS place_id, '555-' || CAST(c_custkey AS {str}) AS phone FROM {customer} c WHERE c_custkey % 3 = 0""",
    "sightings": """
        SELECT CAST(o_custkey AS {str}) AS place_id, o_orderpriority AS name, o_orderstatus AS website, CAST(o_orderkey % 100 AS BIGINT) AS review_count, o_orderstatus AS state_code, o_orderpriority AS trade_bucket, 'match' AS relevance, o_orderpriority AS via, o_orderkey AS seq
        FROM {orders} o""",
    "requests": """SELECT o_orderkey AS id, o_totalprice AS priority, CAST(ROUND(o_totalprice / 10000) AS BIGINT) AS cost, CAST(o_orderkey % 40 AS BIGINT) AS actual, o_orderstatus = 'P' AS failed FROM {orders} o""",
    # Pages with the markup that the table lacks (meta tags, JSON-LD, headings, images), made of each page's own address, title and first word.
    "sitepages": """
        SELECT page_id, url, replace(html, '</title>', '</title>'
            || CASE WHEN n % 2 = 0 THEN '<meta name="viewport" content="width=device-width">' ELSE '' END
            || CASE WHEN n % 3 = 0 THEN '<meta name="description" content="' || title || ' - ' || title || '">' ELSE '' END
            || CASE WHEN n % 6 < 2 THEN '<meta property="og:title" content="' || title || '"><meta property="og:url" content="' || split_part(url, '?', 1) || '"><meta property="og:site_name" content="' || word || '"><meta property="og:type" content="">' ELSE '' END
            || CASE WHEN n % 5 = 4 THEN '<p>Founder and owner ' || word || ' of ' || title || ' - family owned since ' || CAST(n % 90 + 1900 AS {str}) || '. ' || repeat(word || ' ', CAST(n % 40 AS INT)) || 'Proprietor: ' || word || '</p>' ELSE '' END
            || CASE WHEN n % 5 < 3 THEN '<link rel="canonical" href="' || split_part(url, '?', 1) || '">' ELSE '' END
            || CASE WHEN n % 9 < 3 THEN '<img src="a.png"><img src="b.png" alt="' || word || '">' ELSE '' END
            || CASE WHEN n % 7 < 4 THEN '<h2>Call (615) 555-' || lpad(CAST(n % 10000 AS {str}), 4, '0') || '</h2><h2>' || word || '</h2>' ELSE '' END
            || CASE WHEN n % 4 = 3 THEN '' ELSE '<script type="application/ld+json">' || chr(123) || CASE n % 4
                WHEN 0 THEN '"@type":["LocalBusiness","Organization"],"founder":' || chr(123) || '"@type":"Person","name":"' || word || '"' || chr(125) || chr(125)
                WHEN 1 THEN '"@type":"FAQPage","employee":[' || chr(123) || '"name":"Ann ' || word || '"' || chr(125) || ',' || chr(123) || '"name":"' || word || '"' || chr(125) || '],"x":' || chr(123) || '"@type":"Review"' || chr(125) || chr(125)
                ELSE '"@type":"AggregateRating","about":[[' || chr(123) || '"a":' || chr(123) || '"owner":' || chr(123) || '"@type":["Person","Caf' || chr(92) || 'u00e9' || chr(92) || '/Bar"],"name":"' || word || ' ' || chr(92) || '"Al' || chr(92) || '" ' || chr(92) || 'u00e9"' || repeat(chr(125), 2)
                  || ',"b":[1,null,' || chr(123) || '"@type":"' || word || '","name":7' || chr(125) || ']' || chr(125) || ']]' || chr(125) END || '</script>' END) AS html
        FROM (SELECT page_id, url, html, length(html) AS n, regexp_extract(html, '<title>([^<]*)', 1) AS title, regexp_extract(html, '<p><b>([A-Za-z]+)', 1) AS word FROM {pages} p) x""",
    # Robots, sitemap and llms files made of each page's address and text; blog hosts serve a page in place of robots.txt, mobile hosts none.
    "sitefiles": """
        SELECT page_id, agent, shut, star, train, delay, links, kind, word, url,
          CASE kind WHEN 'blog' THEN html WHEN 'm' THEN NULL ELSE 'User-agent: ' || agent || chr(10) || 'Disallow: /' || CASE WHEN shut THEN '' ELSE word END || chr(10)
            || CASE WHEN star THEN 'User-agent: *' || chr(10) || 'Content-Signal: search=yes, ai-train=' || train || chr(10) ELSE '' END
            || CASE WHEN delay = '' THEN '' ELSE 'Sitemap: ' || url || chr(10) || 'Crawl-delay: ' || delay || chr(10) END END AS robots,
          CASE WHEN url LIKE '%#%' THEN html ELSE '<urlset>' || repeat('<loc>' || word || '</loc>', links) || '</urlset>' END AS sitemap,
          CASE WHEN url LIKE '%#%' THEN html WHEN url LIKE '%?%' THEN '# ' || word END AS llms
        FROM (SELECT page_id, url, html, word, n % 3 = 0 OR word = '' AS shut, n % 5 < 3 AS star, CASE WHEN n % 2 = 0 THEN 'no' ELSE 'yes' END AS train, CAST(n % 50 AS INT) AS links,
            regexp_extract(url, '/([0-9]+)', 1) AS delay, split_part(split_part(url, '/', 3), '.', 1) AS kind, CASE split_part(url, '/', 4) WHEN 'en' THEN 'GPTBot' WHEN 'fr' THEN 'CCBot' ELSE 'Bingbot' END AS agent
          FROM (SELECT page_id, url, html, length(html) AS n, regexp_extract(html, '<p><b>([A-Za-z]+)', 1) AS word FROM {pages} p) x) y""",
    "answers": """SELECT c.conv_id AS key, c.turn, c.text, p.url FROM {conversations} c JOIN {pages} p ON p.page_id = c.conv_id % 50 WHERE c.role = 'assistant'""",
}

# Tables that a bridge numbers within a key: dealt by that key beforehand.
_DEALT = {("items", "lineitem"): ["l_orderkey"]}

_NEEDS = {"scans": ["points"], "base_points": ["points"], "cur_points": ["points"]}


def _fields(sql: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(sql) if f]


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bridge as a DataFrame."""
    sql = BRIDGES[name]
    words = {"str": "STRING", "k": "get_json_object(props, '$.k')", "row": "`row`"}
    used = {f for f in _fields(sql) if f not in words}
    frames = {f: frame(spark, sf_dir, f) if f in BRIDGES else spark.read.parquet(f"{sf_dir}/{f}.parquet") for f in used}
    frames |= {f: dealt(frames[f], keys) for (owner, f), keys in _DEALT.items() if owner == name}
    return spark.sql(sql.format(**words, **{f: "{" + f + "}" for f in used}), **frames)


def oracle(query: str, *names: str) -> str:
    """DuckDB SQL: the bridges as common table expressions, then ``query``."""
    words = {"str": "VARCHAR", "k": "json_extract_string(props, '$.k')", "row": '"row"'}
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    parts = []
    for n in order:
        sql = BRIDGES[n]
        parts.append(f"{n} AS ({sql.format(**words, **{f: f for f in _fields(sql) if f not in words})})")
    body = query.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ", ".join(parts) + ", " + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body
