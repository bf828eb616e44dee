"""Matching by domain and name: suffix joins, mentions, citations, listings, collapse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.functions import columns as C
from localpulse.sources.scratch import materialize


def domain_join(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """``host, domain`` pairs that are equal or of which one is a subdomain of the other: two equi-joins on suffixes."""
    h = hosts.select("host").distinct()
    d = domains.select("domain").distinct()
    down = h.withColumn("domain", F.explode(C.suffixes(F.col("host")))).join(d, "domain", "left_semi")
    up = d.withColumn("host", F.explode(C.suffixes(F.col("domain")))).join(h, "host", "left_semi")
    return down.select("host", "domain").union(up.select("host", "domain")).distinct()


def citation_join(urls: DataFrame, domains: DataFrame) -> DataFrame:
    """Cited URLs whose host is a domain or lies under it (one direction)."""
    host = urls.withColumn("_host", C.host_of(F.col("url")))
    return host.withColumn("domain", F.explode(C.suffixes(F.col("_host")))).join(domains, "domain").drop("_host")


def _words_and_gaps(text: Column) -> tuple[Column, Column]:
    """Words of a lower-cased text, and what stands before, between and after them (one more)."""
    low = F.lower(text)
    return F.regexp_extract_all(low, F.lit(r"(?U)\w+"), F.lit(0)), F.split(low, r"(?U)\w+", -1)


def _alias_trie(aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges of the trie of all aliases by word (``level, parent, word, gap, node``), and ends of whole aliases (``node, entity, lead, trail``).

    A node is the hash of the words and the gaps between them from the first word on.
    """
    words, gaps = _words_and_gaps(F.col("alias"))
    held = aliases.select("entity", words.alias("w"), gaps.alias("g")).where("size(w) > 0")
    prefix = "array_join(transform(sequence(1, {k}), j -> concat(if(j = 1, '', g[j - 1]), w[j - 1])), '')"
    edge = f"transform(sequence(1, size(w)), k -> struct(k AS level, if(k = 1, 0L, xxhash64({prefix.format(k='greatest(k - 1, 1)')})) AS parent, xxhash64(w[k - 1]) AS word, if(k = 1, '', g[k - 1]) AS gap, xxhash64({prefix.format(k='k')}) AS node))"
    edges = held.select(F.explode(F.expr(edge)).alias("e")).select("e.*").distinct()
    ends = held.select(F.expr(f"xxhash64({prefix.format(k='size(w)')})").alias("node"), "entity", F.expr("g[0]").alias("lead"), F.expr("element_at(g, -1)").alias("trail")).distinct()
    return edges, ends


def _mentions_without_words(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """``key, entity`` for aliases made of no word character, which can only stand inside a gap between words.

    Of every distinct gap, the pieces of the lengths that such aliases have meet them in an equi-join.
    """
    plain = aliases.select("entity", F.lower("alias").alias("piece")).where((F.col("piece") != "") & ~F.col("piece").rlike(r"(?U)\w"))
    sizes = plain.agg(F.collect_set(F.length("piece")).alias("sizes"))  # one row, no longer than the longest alias
    held = texts.select("key", _words_and_gaps(F.col("text"))[1].alias("g"))
    inner = held.select("key", F.explode(F.array_distinct(F.expr("slice(g, 2, greatest(size(g) - 2, 0))"))).alias("gap"), F.lit(False).alias("first"), F.lit(False).alias("last"))
    outer = held.select("key", F.expr("inline(array(struct(g[0] AS gap, true AS first, size(g) = 1 AS last), struct(if(size(g) = 1, '', element_at(g, -1)) AS gap, false AS first, true AS last)))"))
    spread = inner.unionByName(outer).where("gap <> ''")
    cut = spread.crossJoin(F.broadcast(sizes)).withColumn("size", F.explode("sizes")).where("length(gap) >= size")
    # The neighbours of a piece are no word characters: they are in the gap, or there are none.
    start = F.when(F.col("first"), 0).otherwise(1)
    stop = F.length("gap") - F.col("size") - F.when(F.col("last"), 0).otherwise(1)
    cut = cut.where(start <= stop).withColumn("at", F.explode(F.sequence(start, stop)))
    return cut.select("key", F.substr("gap", F.col("at") + 1, F.col("size")).alias("piece")).distinct().join(plain, "piece").select("key", "entity")


def mention_join(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """``key, entity`` where an alias of the entity stands between word boundaries in ``text``, in any case.

    A phrase index: of the texts only the words that occur in aliases leave their row, as
    key, position, hash and the gaps beside them. From a first word on, an alias's trie is
    followed word by word along the positions; words and the gaps between them must agree,
    and what an alias has before its first and after its last word. Aliases without a word
    character are looked up in the gaps. Null texts and null or empty aliases match nothing.
    """
    texts = texts.select("key", "text").where("text IS NOT NULL")
    aliases = aliases.select("entity", "alias").where("alias IS NOT NULL")
    edges, ends = _alias_trie(aliases)
    words, gaps = _words_and_gaps(F.col("text"))
    zipped = F.expr("arrays_zip(w, g, slice(g, 2, size(g)))")
    spread = texts.select("key", words.alias("w"), gaps.alias("g")).select("key", F.size("w").alias("n"), F.posexplode(zipped).alias("pos", "t"))
    spread = spread.select("key", "pos", F.col("t.w").alias("w"), F.col("t.g").alias("before"), F.col("t.2").alias("after"), (F.col("pos") == F.col("n") - 1).alias("last"))
    spread = spread.where("w IS NOT NULL").withColumn("word", F.xxhash64("w")).drop("w")
    # Stored: every step reads it, and the texts are read once.
    tokens = materialize(spread.join(edges.select("word").distinct(), "word", "left_semi"), "alias-words")

    step = lambda level: edges.where(F.col("level") == level).select("parent", "word", "gap", "node")
    at = tokens.join(step(1).drop("parent", "gap"), "word").select("key", "pos", "node", F.col("before").alias("ahead"), (F.col("pos") == 0).alias("first"), "after", "last")
    reached = [at]
    for level in range(2, 1 + (edges.agg(F.max("level").alias("n")).first().n or 1)):
        on = at.select("key", (F.col("pos") + 1).alias("pos"), F.col("node").alias("parent"), "ahead", "first")
        met = on.join(tokens.withColumnRenamed("before", "gap"), ["key", "pos"]).join(step(level), ["parent", "word", "gap"])
        at = met.select("key", "pos", "node", "ahead", "first", "after", "last")
        reached.append(at)
    led = (F.col("lead") == "") | (F.endswith("ahead", "lead") & ((F.length("ahead") > F.length("lead")) | F.col("first")))
    trailed = (F.col("trail") == "") | (F.startswith("after", "trail") & ((F.length("after") > F.length("trail")) | F.col("last")))
    found = reduce(DataFrame.unionByName, (r.join(ends, "node").where(led & trailed).select("key", "entity") for r in reached))
    return found.unionByName(_mentions_without_words(texts, aliases)).distinct()


def ai_scoreboard(entities: DataFrame, asked: int, mentions: DataFrame, citations: DataFrame) -> DataFrame:
    """Questions asked of the market, answers that mention and that cite each of ``entities`` (``key, entity`` pairs)."""
    m, c = (df.select("key", "entity").distinct().groupBy("entity").agg(F.count("*").alias(n)) for df, n in ((mentions, "mentioned"), (citations, "cited")))
    counted = entities.join(m, "entity", "left").join(c, "entity", "left")
    return counted.select("entity", F.lit(asked).cast("bigint").alias("asked"), *(F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("mentioned", "cited")))


def pick_audit(entities: DataFrame, audits: DataFrame) -> DataFrame:
    """The best page audit of each entity: a live one, then the exact host, then the first."""
    pairs = domain_join(audits.select("host"), entities.select("domain"))
    joined = entities.join(pairs, "domain").join(audits, "host")
    w = Window.partitionBy("entity").orderBy(F.desc("live"), F.desc(F.col("host") == F.col("domain")), "position")
    return joined.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def pick_pagespeed(entities: DataFrame, records: DataFrame) -> DataFrame:
    """The first record without an error of each entity's host (``host, position, error, score``)."""
    pairs = domain_join(records.select("host"), entities.select("domain"))
    joined = entities.join(pairs, "domain").join(records.where("error IS NULL"), "host")
    return joined.groupBy("entity").agg(F.min_by("score", "position").alias("score"))


def pack_rank(items: DataFrame, entities: DataFrame, top: int = 3) -> tuple[DataFrame, DataFrame]:
    """Each entity's rank in each keyword's map pack, and the leading items.

    ``items``: ``keyword, seq, item_id, rank_absolute, rank_group, domain, title``;
    rows without an id are ads. An item is matched by its domain (or what that lies
    under), and by an alias in its title only if it has no domain.
    """
    w = Window.partitionBy("keyword").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pack = items.where("item_id IS NOT NULL").withColumn("position", F.count("*").over(w).cast("int"))
    rank = F.coalesce(F.nullif("rank_absolute", F.lit(0)), F.nullif("rank_group", F.lit(0)), F.col("position"))
    pack = pack.withColumns({"rank": rank, "domain": F.nullif(C.norm_domain(F.col("domain")), F.lit(""))})
    own = entities.select("entity", F.col("domain").alias("suffix"))
    by_domain = pack.where("domain IS NOT NULL").withColumn("suffix", F.explode(C.suffixes(F.col("domain")))).join(own, "suffix").select("keyword", "entity", "position", "rank")
    titles = mention_join(pack.where("domain IS NULL").select(F.struct("keyword", "position", "rank").alias("key"), F.col("title").alias("text")), entities.select("entity", F.col("name").alias("alias")))
    found = by_domain.unionByName(titles.select("key.keyword", "entity", "key.position", "key.rank"))
    return found.groupBy("keyword", "entity").agg(F.min_by("rank", "position").alias("rank")), pack.where(F.col("position") <= top).select("keyword", "position", "title", "domain")


def organic_rank(items: DataFrame, entities: DataFrame) -> DataFrame:
    """Best organic rank of each entity and keyword; rank 0 is missing."""
    hit = items.withColumn("suffix", F.explode(C.suffixes(F.col("domain")))).join(entities.select("entity", F.col("domain").alias("suffix")), "suffix")
    return hit.groupBy("keyword", "entity").agg(F.min(F.nullif("rank_absolute", F.lit(0))).alias("rank"))


def resolve_listing(entities: DataFrame, candidates: DataFrame) -> DataFrame:
    """The first valid candidate of each entity (``entity, name, states``; ``entity, position, candidate, address``).

    One name stands in the other between word boundaries (the candidate in the entity's only with two words at least), and a shown address names an expected state.
    """
    two = F.size(F.split(F.trim("candidate"), r"\s+")) >= 2
    named = C.mentioned(F.col("candidate"), F.col("name")) | (two & C.mentioned(F.col("name"), F.col("candidate")))
    hidden = F.coalesce("address", F.lit("")) == ""
    place = hidden | (F.size("states") == 0) | F.exists("states", lambda x: C.mentioned(F.col("address"), x))
    rows = entities.join(candidates, "entity", "left").withColumn("valid", F.coalesce(named & place, F.lit(False)))
    out = rows.groupBy("entity").agg(F.count("candidate").alias("n"), F.min_by("candidate", F.when(F.col("valid"), F.col("position"))).alias("matched"))
    status = F.when(F.col("matched").isNotNull(), "matched").when(F.col("n") > 0, "mismatch").otherwise("not_found")
    return out.select("entity", status.alias("status"), "matched")


def with_fallback(first: DataFrame, second: DataFrame) -> DataFrame:
    """The first source's answer where it matched, else the second's, with its provenance."""
    a, b = first.alias("a"), second.alias("b")
    use_a = F.coalesce(F.col("a.status"), F.lit("")) == "matched"
    use_b = ~use_a & (F.coalesce(F.col("b.status"), F.lit("")) == "matched")
    pick = lambda c: F.when(use_b, F.col(f"b.{c}")).otherwise(F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}"))).alias(c)
    return a.join(b, "entity", "full").select("entity", pick("status"), pick("matched"), F.when(use_b, "second source").otherwise("first source").alias("source"))


def collapse_listings(df: DataFrame) -> DataFrame:
    """One row per website host, or per brand without a site: the most-reviewed listing, all towns, how many there were.

    ``seq`` gives the order of the listings; the first of equals stays.
    """
    host = C.host_of(F.col("website"))
    key = F.when(host != "", F.concat(F.lit("host:"), host)).otherwise(F.concat(F.lit("name:"), C.brand_key(F.col("name"))))
    best = F.struct(F.coalesce("review_count", F.lit(0)).cast("bigint"), -F.col("seq"))
    towns = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", "found_via"))), lambda x: x["found_via"])))
    out = df.withColumn("dedup_key", key).groupBy("dedup_key").agg(F.max_by(F.struct("place_id", "name", "website", "review_count"), best).alias("b"), towns.alias("found_via"), F.count("*").alias("n_listings"), F.min_by("notes", "seq").alias("notes"))
    extra = F.when(F.col("n_listings") > 1, F.when(F.col("dedup_key").startswith("host:"), F.concat(F.col("n_listings").cast("string"), F.lit(" locations under one website (deduped)"))).otherwise(F.concat(F.col("n_listings").cast("string"), F.lit(" listings (deduped)"))))
    return out.select("dedup_key", "b.*", "found_via", "n_listings", F.concat_ws("; ", F.nullif("notes", F.lit("")), extra).alias("notes"))


def normalize_summary(raw: DataFrame, kept: DataFrame, chains: list[str], adjectives: list[str]) -> DataFrame:
    tier = C.tier_of(F.col("name"), chains)
    host = C.host_of(F.col("website"))
    out = kept.agg(F.count("*").alias("kept"), F.count_if(tier == "local").alias("local"), F.count_if(tier == "chain").alias("chain"), F.count_if(host == "").alias("no_site"), F.count_if(C.is_microsite(host, adjectives)).alias("microsites"))
    return out.crossJoin(raw.agg(F.count("*").alias("raw")))  # one row each


def fan_out(leads: DataFrame, measured: DataFrame) -> DataFrame:
    """Results per homepage back to all leads that share it (``origin, host``)."""
    keyed = leads.withColumn("o", C.origin_of(F.col("website"))).select("*", "o.origin", "o.host").drop("o")
    return keyed.join(measured, ["origin", "host"])


def any_of(columns):
    return reduce(lambda a, b: a | b, columns, F.lit(False))
