"""Reply trees to chat conversations.

Iterative self-joins enumerate all root-to-leaf paths: step k finds each node's
ancestor 2^k above and the scores on the way, so a tree of depth d takes log2(d)
joins, and only ids and scores are joined. Every leaf climbs to its root by these
jumps, which gives its branch's length and score in one row; branches are ranked
within their tree, and only the chosen ones are listed node by node. Each is
formatted as one conversation, with the spans of the assistant's texts as loss mask.

DataFrame functions only.

The template is ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>`` newline.
Inside a field a backslash is doubled, and every control string (the template's
and those of other common templates) gets a backslash after its first character;
``unescaped`` takes both back.

Defined cases: null roles and texts are empty; a parent that does not exist makes
a root; nodes whose ancestors form a cycle are on no path; a null tree id is a
tree of its own; of several rows under one id in a tree the first (by parent, role,
text and score) has the id, and the replies to it, and each other one ends a branch
of its own, so none is lost (rows equal in all are one); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from localpulse.llm.core import materialize, release_since, scratch_count

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that steer a model in common templates: fixed values.
CONTROL = (START, MIDDLE, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>")


def escaped(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda x, s: F.replace(x, F.lit(s), F.lit(s[0] + "\\" + s[1:])), CONTROL, c)


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def turns_as_tree(turns: DataFrame, *, tree: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of turns as a reply tree in which each turn answers the one before it. Equal turns are ordered by role and text."""
    place = F.row_number().over(Window.partitionBy(tree).orderBy(F.col(order), F.col(role), F.col(text))).cast("bigint")
    rows = turns.select(F.col(tree).alias("tree"), place.alias("node"), F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def jumps(nodes: DataFrame) -> list[DataFrame]:
    """Stored tables of the ancestors 1, 2, 4, ... above each node of ``nodes`` (``key, node, parent, score``).

    Columns ``key, below, above``, and sum and number of the scores (``total, rated``) from ``below`` up to, not including, ``above``.
    """
    links = nodes.where("parent IS NOT NULL").select("key", F.col("node").alias("below"), F.col("parent").alias("above"), *_score(F.col("score")))
    exists = nodes.select("key", F.col("node").alias("above"))
    levels = [materialize(links.join(exists, ["key", "above"], "left_semi").select("key", "below", "above", "total", "rated"), "jumps")]
    left = levels[0].count()
    while left:
        jump = levels[-1]
        far = jump.select(F.col("key").alias("k"), F.col("below").alias("middle"), F.col("above").alias("top"), F.col("total").alias("t"), F.col("rated").alias("r"))
        met = jump.join(far, (F.col("key") == F.col("k")) & (F.col("above") == F.col("middle")))
        jump = materialize(met.select("key", "below", F.col("top").alias("above"), (F.col("total") + F.col("t")).alias("total"), (F.col("rated") + F.col("r")).alias("rated")), "jumps")
        before, left = left, jump.count()
        if left == before:  # only cycles keep all their jumps
            break
        if left:
            levels.append(jump)
    return levels


def _score(score: Column) -> list[Column]:
    return [F.coalesce(score, F.lit(0.0)).alias("total"), score.isNotNull().cast("bigint").alias("rated")]


def branches(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``key, leaf, length`` (nodes above the leaf) and ``score`` (mean, nulls apart) of every root-to-leaf path of ``nodes``."""
    links = levels[0]
    roots = nodes.join(links.select("key", F.col("below").alias("node")), ["key", "node"], "left_anti")
    leaves = nodes.select("key", "node").join(links.select("key", F.col("above").alias("node")), ["key", "node"], "left_anti")
    at = leaves.select("key", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("length"), F.lit(0.0).alias("total"), F.lit(0).cast("bigint").alias("rated"))
    # A jump exists as long as the way up is as long, so the longest ones first, once each.
    for k, jump in reversed(list(enumerate(levels))):
        up = jump.select(F.col("key").alias("k"), "below", "above", F.col("total").alias("t"), F.col("rated").alias("r"))
        gain = lambda c, by: (F.col(c) + F.coalesce(by, F.lit(0))).alias(c)
        risen = F.when(F.col("above").isNotNull(), F.lit(2**k).cast("bigint"))
        at = at.join(up, (F.col("key") == F.col("k")) & (F.col("node") == F.col("below")), "left")
        at = at.select("key", "leaf", F.coalesce("above", "node").alias("node"), gain("length", risen), gain("total", F.col("t")), gain("rated", F.col("r")))
    top = roots.select("key", "node", *(c.alias(f"top_{n}") for n, c in zip(("total", "rated"), _score(F.col("score")), strict=True)))
    mean = (F.col("total") + F.col("top_total")) / F.nullif(F.col("rated") + F.col("top_rated"), F.lit(0))
    return at.join(top, ["key", "node"]).select("key", "leaf", "length", mean.alias("score"))


def listed(best: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Every node of the branches ``best`` (``key, leaf, length`` and others), as ``node`` at ``depth`` (0 at the root); stored."""
    held = best.withColumns({"node": F.col("leaf"), "depth": F.col("length")}).drop("length")
    for k, jump in enumerate(levels):
        held = materialize(held, "branches")
        over = jump.select(F.col("key").alias("k"), "below", "above")
        up = held.join(over, (F.col("key") == F.col("k")) & (F.col("node") == F.col("below")))
        held = held.unionByName(up.withColumns({"node": F.col("above"), "depth": F.col("depth") - 2**k}).drop("k", "below", "above"))
    return materialize(held, "branches")


def _numbered(nodes: DataFrame) -> DataFrame:
    """``nodes`` with an id for each row: of several under one id the first (by parent, role, text and score) keeps it, the others get one of their own.

    Replies to a repeated id hang on the row that keeps it; the others end branches, so none is lost.
    """
    # Rows equal in all are one.
    nodes = nodes.repartition("key", "node").groupBy("key", "node", "parent", "role", "text", "score").agg(F.first("tree").alias("tree"))
    same = Window.partitionBy("key", "node").orderBy("parent", "role", "text", "score")
    times = F.row_number().over(same)
    own = F.struct(F.col("node"), (F.col("_time") - 1).alias("time"))
    # A parent is the first row of its id.
    return nodes.withColumn("_time", times).withColumns({"node": own, "parent": F.when(F.col("parent").isNotNull(), F.struct(F.col("parent").alias("node"), F.lit(0).alias("time")))}).drop("_time")


def format_branches(nodes: DataFrame, *, per_tree: int = 1, roles_with_loss: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """The ``per_tree`` best branches of each tree of ``nodes`` (``tree, node, parent, role, text, score``) as conversations.

    A branch's score is the mean of its nodes'. Returns ``tree, leaf, branch_rank,
    score, n_turns, formatted, loss_spans`` (start and length in code points).
    """
    key = F.coalesce(F.col("tree").cast("string"), F.lit("\x00"))
    keyed = _numbered(nodes.select(key.alias("key"), "node", "tree", "parent", "role", "text", "score"))
    mark = scratch_count()
    ids = materialize(keyed.select("key", "node", "parent", F.col("score").cast("double").alias("score")), "nodes")
    levels = jumps(ids)
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc_nulls_last("score"), F.col("leaf")))
    best = branches(ids, levels).withColumn("branch_rank", rank).where(F.col("branch_rank") <= per_tree)
    paths = listed(best, levels)
    release_since(nodes.sparkSession, mark, but=1)
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(MIDDLE))
    rows = paths.join(keyed.select("key", "node", "tree", head.alias("head"), escaped(F.col("text")).alias("body"), F.coalesce(F.col("role").isin(*roles_with_loss), F.lit(False)).alias("loss")), ["key", "node"])
    piece = F.concat("head", "body", F.lit(END + "\n"))
    before = Window.partitionBy("key", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("piece", piece)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.char_length("head"))
    span = F.when(F.col("loss"), F.struct(F.col("start"), F.char_length("body").cast("bigint").alias("length")))
    turns = F.array_sort(F.collect_list(F.struct("depth", "piece", span.alias("span"))))
    out = rows.groupBy("key", "leaf").agg(F.first("tree").alias("tree"), F.first("branch_rank").alias("branch_rank"), F.first("score").alias("score"), turns.alias("turns"))
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    return out.select("tree", F.col("leaf.node").alias("leaf"), "branch_rank", "score", F.size("turns").cast("bigint").alias("n_turns"), F.concat_ws("", F.transform("turns", lambda t: t["piece"])).alias("formatted"), spans.alias("loss_spans"))


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    quoted = lambda s: "\\Q" + s + "\\E"
    pieces = F.filter(F.split(formatted, quoted(END) + "\n"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(unescaped(F.substr(F.split(p, quoted(MIDDLE))[0], F.lit(len(START) + 1))).alias("role"), unescaped(F.split(p, quoted(MIDDLE))[1]).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))))
