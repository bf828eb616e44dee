"""The queries of this subpackage: one ``opN_<name>`` for each operator, and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations, and one that speaks a template's control strings, and read them back."""
    from localpulse.llm import replytree

    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], turns.schema)
    done = replytree.format_branches(replytree.turns_as_tree(turns.unionByName(odd)))
    back = done.select("tree", "formatted", replytree.parsed_turns(F.col("formatted")).alias("turns"), replytree.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return back.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def _op1_sql() -> str:
    from localpulse.llm.replytree import CONTROL, END, MIDDLE, START

    def escaped(c: str) -> str:
        out = f"replace({c}, '\\', '\\\\')"
        for s in CONTROL:
            out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
        return out

    frame = len(START + MIDDLE + END) + 1
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({frame} + length({escaped("role")}) + length({escaped("text")})) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and minimum-covariance-determinant verdicts for all documents."""
    from localpulse.llm import robust

    stats = robust.verdicts(robust.counts(_table(spark, sf_dir, "documents")))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of all documents along a Hilbert curve, row counts at most one apart."""
    from localpulse.llm import hilbert

    placed = hilbert.shard_documents(_table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents into pair-grammar shards and read the ids back."""
    from localpulse.llm import repair

    shards = repair.write_shards(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return repair.read_documents(shards)


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in all documents by a positional inverted index."""
    from localpulse.llm import positional

    index = positional.build_index(_table(spark, sf_dir, "documents"))
    return positional.contamination(index, _table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM iw, LATERAL (SELECT unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i) WHERE len(w) > 0),
gram AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM dw, (SELECT DISTINCT k FROM win) ks, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)),
hit AS (SELECT gram.doc_id, gram.k, gram.i, win.item_id FROM gram JOIN win USING (k, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op6_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents by deficit round-robin over their sources, in target shares that raise small sources."""
    from localpulse.llm import mixpack

    return mixpack.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1, temper=0.7)


def op7_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that stand on eight sites or more are removed but for their first occurrence."""
    from localpulse.llm import linespread

    out = linespread.remove_boilerplate(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), min_sites=8)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length(text).cast("bigint").alias("kept_chars"), F.md5(text).alias("kept_md5"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS site, p - 1 AS pos, parts[p] AS line
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS p)),
w AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded FROM l),
bad AS (SELECT line, min((doc_id, pos)) AS first FROM w WHERE worded GROUP BY line HAVING count(DISTINCT site) >= 8),
m AS (SELECT w.*, bad.line IS NOT NULL AND (w.doc_id, w.pos) <> bad.first AS gone FROM w LEFT JOIN bad ON w.worded AND w.line = bad.line),
d AS (SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (gone) AS n_removed, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS t FROM m GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, length(coalesce(t, '')) AS kept_chars, md5(coalesce(t, '')) AS kept_md5
FROM documents LEFT JOIN d USING (doc_id)
"""


def op8_count_vector_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 4-word shingles, Jaccard 0.85."""
    from localpulse.llm import rtree

    return rtree.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=85)


OP8_SQL = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM dw, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT dw.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM dw LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned outside the fold crc32(doc_id) mod 5 = 0."""
    from localpulse.llm import langid

    return langid.identify(_table(spark, sf_dir, "documents"), folds=5, fold=0)


def op10_pattern_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned outside the fold crc32(doc_id) mod 4 = 2."""
    from localpulse.llm import toxicity

    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), folds=4, fold=2)


def op11_divergence_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language diverge in their terms, over all documents."""
    from localpulse.llm import stripes

    out = stripes.divergences(_table(spark, sf_dir, "documents"), min_docs=10, top=10)
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT doc_id, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
lc AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
ln AS (SELECT lang, sum(n) AS total FROM lc GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (total + 2 * v)::HUGEINT AS BIGINT) AS p
      FROM gn JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
q AS (SELECT lang, term, CAST(1 + (1000000000 * (n + 2)::HUGEINT) // (total + 2 * v)::HUGEINT AS BIGINT) AS q FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
out AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT p.lang, source, 'term', p.term, (p - q) * (p - q) // (p + q) FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM out QUALIFY part = 'pair' OR rank <= 10
"""


def op12_spelling_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all documents, one run in 199 misspelt."""
    from localpulse.llm import spelling

    return spelling.variants(_table(spark, sf_dir, "documents"), every=199).select("word", "form", "root", "n", "n_near", "form_n")


def _op12_sql() -> str:
    """CRC-32 bit by bit: each byte, then seven shifts. The distance counts bytes, so Latin-1 letters are set to single bytes."""
    wide = "".join(map(chr, range(0xC0, 0x100)))
    narrow = "".join(map(chr, range(0x21, 0x61))).replace("'", "''")
    bits = "flatten(list_transform(string_split(id || ':' || w, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c), -1, -1, -1, -1, -1, -1, -1] ELSE [195, -1, -1, -1, -1, -1, -1, -1, ord(c) - 64, -1, -1, -1, -1, -1, -1, -1] END))"
    fed = "(CASE WHEN x >= 0 THEN xor(h, x::BIGINT) ELSE h END)"
    crc = f"xor(list_reduce({bits}, lambda h, x: xor({fed} >> 1, 3988292384 * ({fed} & 1)), 4294967295::BIGINT), 4294967295)"
    return f"""
WITH RECURSIVE t AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents),
c AS (SELECT id, w, count(*) AS n FROM t WHERE length(w) >= 6 GROUP BY ALL),
h AS (SELECT w, n, {crc} AS h FROM c),
m AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS size, left(word, 1) AS head, right(word, 1) AS tail, translate(word, '{wide}', '{narrow}') AS spelt FROM m WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
sized AS (SELECT *, unnest([size - 1, size, size + 1]) AS other FROM words),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM sized a JOIN words b ON a.other = b.size AND a.head = b.head WHERE levenshtein(a.spelt, b.spelt) = 1
  UNION SELECT a.word, b.word, b.n FROM sized a JOIN words b ON a.other = b.size AND a.tail = b.tail WHERE levenshtein(a.spelt, b.spelt) = 1),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS form_n FROM near GROUP BY word),
form AS (SELECT best.word, min(near) AS form, any_value(form_n) AS form_n FROM best JOIN near ON near.word = best.word AND near_n = form_n JOIN words ON words.word = best.word WHERE form_n >= 5 * n GROUP BY best.word),
chain(word, root) AS (SELECT word, word FROM words UNION ALL SELECT chain.word, form.form FROM chain JOIN form ON form.word = chain.root),
last AS (SELECT chain.word, root FROM chain WHERE root NOT IN (SELECT word FROM form))
SELECT words.word, form.form, last.root, words.n, coalesce(n_near, 0) AS n_near, form.form_n
FROM words LEFT JOIN form USING (word) LEFT JOIN best USING (word) JOIN last USING (word)"""


def op13_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by tensored MinHash: 2-word shingles, Jaccard 0.8."""
    from localpulse.llm import minhash

    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


OP13_SQL = OP8_SQL.replace("w[i:i + 3]", "w[i:i + 1]").replace("len(w) - 3", "len(w) - 1").replace(">= 85 *", ">= 80 *").replace("r.component_id\n", "r.component_id, dw.doc_id = r.component_id AS kept\n")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_reply_trees": op1_reply_trees,
        "op2_robust_outliers": op2_robust_outliers,
        "op3_hilbert": op3_hilbert,
        "op4_repair": op4_repair,
        "op5_positional_index": op5_positional_index,
        "op6_mixture_packing": op6_mixture_packing,
        "op7_site_spread": op7_site_spread,
        "op8_count_vector_rtree": op8_count_vector_rtree,
        "op9_language": op9_language,
        "op10_pattern_grammar": op10_pattern_grammar,
        "op11_divergence_stripes": op11_divergence_stripes,
        "op12_spelling_chunks": op12_spelling_chunks,
        "op13_tensored_minhash": op13_tensored_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_reply_trees": _op1_sql(),
        "op5_positional_index": OP5_SQL,
        "op7_site_spread": OP7_SQL,
        "op8_count_vector_rtree": OP8_SQL,
        "op11_divergence_stripes": OP11_SQL,
        "op12_spelling_chunks": _op12_sql(),
        "op13_tensored_minhash": OP13_SQL,
    }
