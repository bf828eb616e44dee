"""Column builders: strings, dates, geography, arrays and classifications.

All of them are built-in expressions, so they stay inside code generation and are
pushed down like any other. Unknown is NULL throughout and fires nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from localpulse import config as K


def lit_array(values) -> Column:
    return F.array(*(F.lit(v) for v in values))


def contains_any(c: Column, needles) -> Column:
    return reduce(lambda a, b: a | b, (c.contains(n) for n in needles), F.lit(False))


def banded(c: Column, bands, otherwise) -> Column:
    """Value of the first band whose limit is above ``c``."""
    out = None
    for limit, value in bands:
        out = (F if out is None else out).when(c < limit, value)
    return out.otherwise(otherwise)


# --- URLs and names ---------------------------------------------------------


def host_of(url: Column) -> Column:
    """Host in lower case with its port, without a leading ``www.``; '' without a scheme."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def norm_domain(domain: Column) -> Column:
    """As ``host_of``, also for bare domains."""
    d = F.trim(F.coalesce(domain, F.lit("")))
    return host_of(F.when(d.contains("://"), d).otherwise(F.concat(F.lit("http://"), d)))


def origin_of(site: Column) -> Column:
    """Struct of ``origin`` (``scheme://host/``, https by default) and ``host``."""
    s = F.trim(site)
    full = F.when(s.contains("://"), s).otherwise(F.concat(F.lit("https://"), s))
    scheme = F.lower(F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    netloc = F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.struct(F.concat(scheme, F.lit("://"), netloc, F.lit("/")).alias("origin"), F.regexp_replace(F.lower(netloc), r"^www\.", "").alias("host"))


def brand_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]", "")


def title_case(c: Column) -> Column:
    """A capital after every character that is no letter, small letters elsewhere."""
    low = F.lower(c)
    parts = F.regexp_extract_all(low, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), "")


def fill_template(template: Column, trade: Column, city: Column, state: Column) -> Column:
    out = F.replace(template, F.lit("{trade}"), trade)
    return F.replace(F.replace(out, F.lit("{city}"), city), F.lit("{state}"), state)


def location_string(*parts: Column) -> Column:
    return F.concat_ws(",", *parts)


def expected_states(city: Column, location: Column) -> Column:
    """State tokens in small letters: what follows a city's last comma, and the second part of a location."""
    after = F.when(city.contains(","), F.split_part(city, F.lit(","), F.lit(-1)))
    parts = F.filter(F.transform(F.split(F.coalesce(location, F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")
    both = F.transform(F.array_compact(F.array(after, F.try_element_at(parts, F.lit(2)))), lambda t: F.lower(F.trim(t)))
    return F.array_distinct(F.filter(both, lambda t: t != ""))


def query_text(entity: Column, market: Column) -> Column:
    return F.concat_ws(" ", F.nullif(F.trim(entity), F.lit("")), F.nullif(F.trim(market), F.lit("")))


def clip_text(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def parse_location(address: Column) -> Column:
    """Struct of ``town`` (lower case) and ``state``: the last ``, City, ST`` pair whose ST is a known code; '' if none."""
    pattern = r",\s*([A-Za-z .'\-]+),\s*([A-Z]{2})\b"
    a = F.coalesce(address, F.lit(""))
    towns, states = (F.regexp_extract_all(a, F.lit(pattern), F.lit(i)) for i in (1, 2))
    good = F.filter(F.arrays_zip(towns.alias("town"), states.alias("state")), lambda p: p["state"].isin(*K.STATE_CODES))
    last = F.try_element_at(good, F.lit(-1))
    return F.struct(F.coalesce(F.lower(F.trim(last["town"])), F.lit("")).alias("town"), F.coalesce(last["state"], F.lit("")).alias("state"))


def suffixes(host: Column) -> Column:
    """``a.b.c`` as ``a.b.c``, ``b.c``, ``c``: what a domain may equal to match the host on a dot boundary."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def word_pattern(alias: Column) -> Column:
    """Pattern for ``alias`` between word boundaries, any case, Unicode words."""
    return F.concat(F.lit(r"(?iU)(?<!\w)\Q"), F.replace(alias, F.lit("\\E"), F.lit("")), F.lit(r"\E(?!\w)"))


def mentioned(text: Column, alias: Column) -> Column:
    return F.coalesce((F.coalesce(alias, F.lit("")) != "") & F.regexp_like(text, word_pattern(alias)), F.lit(False))


# --- dates ------------------------------------------------------------------


def parse_ts(s: Column) -> Column:
    """Timestamp from the tolerated formats; no zone means UTC; NULL if none fits."""
    t = F.replace(F.trim(s), F.lit("/"), F.lit("-"))
    formats = ("yyyy-MM-dd HH:mm:ss xxx", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssxxx", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    return F.coalesce(*(F.try_to_timestamp(t, F.lit(f)) for f in formats))


def days_since(ts: Column, now: Column) -> Column:
    """Whole 24-hour periods from ``ts`` to ``now``."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(ts)) / 86400).cast("int")


# --- geography and numbers --------------------------------------------------


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.lit(2 * K.EARTH_METRES) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def degrees_of(metres: Column, lat: Column) -> tuple[Column, Column]:
    """Latitude and longitude spans of a distance; the cosine is not let under 0.1."""
    return metres / K.METRES_PER_DEGREE, metres / (F.lit(K.METRES_PER_DEGREE) * F.greatest(F.lit(0.1), F.cos(F.radians(lat))))


def geo_bucket(lat: Column, lng: Column) -> tuple[Column, Column]:
    return F.floor(lat / K.BUCKET_DEGREES), F.floor(lng / K.BUCKET_DEGREES)


def visibility(rank: Column, max_rank: int = 20) -> Column:
    return F.when(rank.isNotNull() & (rank <= max_rank), (max_rank + 1 - rank) / F.lit(float(max_rank))).otherwise(0.0)


def delta(cur: Column, base: Column) -> Column:
    return F.round(cur - base, 2)


def radius_for(population: Column) -> Column:
    return banded(population, K.RADIUS_BANDS, K.RADIUS_MAX)


def expected_subdivision(population: Column) -> Column:
    return banded(population, K.EXPECTED_CELLS, K.EXPECTED_CELLS_MAX)


def high_subdivision(population: Column) -> Column:
    return banded(population, K.HIGH_CELLS, K.HIGH_CELLS_MAX)


# --- arrays and JSON --------------------------------------------------------


def json_list(s: Column) -> Column:
    return F.coalesce(F.from_json(s, "array<string>"), F.array().cast("array<string>"))


def leaf_count(attrs_json: Column) -> Column:
    """Leaves of an attribute JSON: a list's length; for an object the entries of its lists and objects, else one each; NULL for anything else."""
    flat = F.from_json(attrs_json, "array<string>")
    entries = F.map_values(F.from_json(attrs_json, "map<string,string>"))

    def leaves(v: Column) -> Column:
        of_list = F.when(v.startswith("["), F.json_array_length(v))
        of_map = F.when(v.startswith("{"), F.size(F.json_object_keys(v)))
        return F.coalesce(of_list, of_map, F.lit(1))

    total = F.aggregate(F.transform(entries, leaves), F.lit(0), lambda s, x: s + x)
    return F.when(F.trim(attrs_json).startswith("["), F.size(flat)).when(F.trim(attrs_json).startswith("{"), total)


def negative_count(histogram: Column) -> Column:
    """1- and 2-star ratings; NULL without a histogram."""
    one, two = (F.coalesce(F.try_element_at(histogram, F.lit(k)), F.lit(0)) for k in ("1", "2"))
    return F.when(histogram.isNotNull() & (F.size(histogram) > 0), one + two)


def signal_label(signals: Column, top: int = 2) -> Column:
    """Labels of the first ``top`` fired signals in weight order."""
    order = sorted(K.NEGLECT_WEIGHTS, key=lambda k: -K.NEGLECT_WEIGHTS[k])
    fired = F.array_compact(F.array(*(F.when(F.coalesce(F.try_element_at(signals, F.lit(k)), F.lit(False)), F.lit(K.SIGNAL_LABELS[k])) for k in order)))
    return F.array_join(F.slice(fired, 1, top), ", ")


def managed_tags(tags: Column) -> Column:
    return F.array_sort(F.array_intersect(tags, lit_array(K.MANAGED_TAGS_REPORT)))


# --- classifications --------------------------------------------------------


def trade_group(category: Column) -> Column:
    out = None
    for group, names in K.TRADES.items():
        out = (F if out is None else out).when(category.isin(*names), group)
    return out.otherwise("other")


def in_scope(category: Column) -> Column:
    return trade_group(category) != "other"


def relevance(name: Column, types: Column, primary: Column, primary_types, keywords, adjacent) -> Column:
    """``match``, ``maybe`` or ``other`` by a business's types and the words in its name and types."""
    text = F.lower(F.concat_ws(" ", name, primary, F.concat_ws(" ", types)))
    strong = F.coalesce(F.arrays_overlap(types, lit_array(primary_types)), F.lit(False)) | contains_any(text, [k.lower() for k in keywords])
    return F.when(strong, "match").when(contains_any(text, [k.lower() for k in adjacent]), "maybe").otherwise("other")


def tier_of(name: Column, chains) -> Column:
    return F.when(contains_any(F.lower(F.coalesce(name, F.lit(""))), chains), "chain").otherwise("local")


def is_microsite(host: Column, adjectives) -> Column:
    stem = F.split_part(F.coalesce(host, F.lit("")), F.lit("."), F.lit(1))
    return reduce(lambda a, b: a | b, (stem.startswith(x) for x in adjectives), F.lit(False))


def looks_blocked(status: Column, html: Column) -> Column:
    thin = (status == 200) & (F.length(F.coalesce(html, F.lit(""))) < K.THIN_PAGE_CHARS)
    return status.isNull() | status.isin(*K.BLOCKED_STATUSES) | thin


def site_status(host: Column, no_website: Column, has_page: Column, status: Column, title: Column, words: Column) -> Column:
    """What a business's site amounts to; the first rule that holds wins."""
    h, t = F.lower(F.coalesce(host, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    gone = status.isin(404, 410) | ((t.contains("not found") | t.contains("404")) & (F.coalesce(words, F.lit(0)) < 120))
    return (
        F.when(F.coalesce(no_website, F.lit(0)).cast("boolean") | (h == ""), "none")
        .when(contains_any(h, K.SOCIAL_HOSTS), "social_only")
        .when(contains_any(h, K.DIRECTORY_HOSTS), "directory")
        .when(~has_page, "unreachable")
        .when(contains_any(t, K.PARKED_HINTS), "parked")
        .when(gone, "dead")
        .when(status.isin(200, 201), "live")
        .otherwise("blocked")
    )


def opp_bucket(no_website: Column, status: Column) -> Column:
    return F.when(no_website == 1, 0).when(status.isin(*K.BROKEN), 1).when(status == "live", 2).otherwise(4)


def readiness_cell(no_website: Column, status: Column, score: Column) -> Column:
    known = F.coalesce(status, F.lit("")) != ""
    return F.when(no_website == 1, "NO SITE").when(status == "live", F.coalesce(score.cast("string"), F.lit("n/a"))).when(known, F.concat(F.lit("n/a ("), status, F.lit(")"))).otherwise("n/a")


def top_gap(no_website: Column, gaps: Column) -> Column:
    return F.when(no_website == 1, "no website - full build opportunity").otherwise(F.coalesce(F.try_element_at(gaps, F.lit(1)), F.lit("solid site - few gaps")))


def tags_str(tags: Column) -> Column:
    return F.coalesce(F.array_join(tags, ", "), F.lit(""))


def paid_signal(google_ads: Column, mgmt: Column, tags: Column) -> Column:
    """The strongest sign that a business pays for marketing; '' if none."""
    managed = managed_tags(F.coalesce(tags, F.array().cast("array<string>")))
    return F.when(F.coalesce(google_ads, F.lit(0)) == 1, "Google Ads").when(F.coalesce(mgmt, F.lit("")) == "likely agency-managed", "agency-managed").otherwise(F.array_join(managed, "/"))


def has_gap(no_website: Column, status: Column, score: Column) -> Column:
    broken = (F.coalesce(status, F.lit("")) != "") & (F.coalesce(status, F.lit("live")) != "live")
    return (F.coalesce(no_website, F.lit(0)) == 1) | broken | (F.coalesce(score, F.lit(-1)) >= K.WEAK_SITE)


def budget_tier(signal: Column, reviews: Column, gap: Column, min_reviews: int = K.MIN_REVIEWS) -> Column:
    return F.when(signal != "", 1).when((F.coalesce(reviews, F.lit(0)) >= min_reviews) & gap, 2).otherwise(3)


def rank_tier(rank: Column) -> Column:
    return F.when(rank.isNull(), "absent").when(rank <= 3, "top3").when(rank <= 10, "page1").when(rank <= 20, "deep").otherwise("absent")


def pin_status(base: Column, cur: Column) -> Column:
    return (
        F.when(base.isNull() & cur.isNull(), "still_absent")
        .when(base.isNull(), "gained")
        .when(cur.isNull(), "lost")
        .when(base > cur, "improved")
        .when(base < cur, "declined")
        .otherwise("unchanged")
    )
