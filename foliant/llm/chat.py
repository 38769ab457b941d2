"""Conversations from reply trees, formatted with a loss mask. DataFrame functions only.

``reply_paths`` enumerates root-to-leaf paths by self-joins that double in reach: after round k
the path of a leaf holds its nearest 2**k ancestors, so a tree of depth d takes about log2(d)
rounds and never more rows than the paths themselves have.

Template of a turn: ``### `` role ``: `` text ``</turn>`` newline. In roles and texts ``\\`` becomes ``\\b``,
``<`` becomes ``\\l`` and ``#`` becomes ``\\h``; in roles ``:`` becomes ``\\c`` too. So no marker can occur inside, and each role and text is
found again exactly.

Cases: null role or text is empty; a node whose parent does not exist, or is null, is a root; a
circle of replies has no root and raises an error; ties of score go to the smaller leaf; repeated
rows of a conversation are turns of their own; no rows give no conversations. Further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keep, text_of

START, MIDDLE, END = "### ", ": ", "</turn>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit("#"), F.lit("\\h"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def unescape(c: Column) -> Column:
    for mark, sign in (("\\l", "<"), ("\\h", "#"), ("\\c", ":"), ("\\b", "\\")):
        c = F.replace(c, F.lit(mark), F.lit(sign))
    return c


def reply_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, node, up, rank) of each chosen path, ``up`` being the steps from the leaf.

    ``nodes``: tree, node (unique in its tree), parent, score. Branches are ranked by the sum of
    their scores; ``branches`` of the best are kept for each tree, all of them if None.
    """
    known = nodes.select("tree", F.col("node").alias("parent"))
    n = keep(
        nodes.select("tree", "node", "parent", "score")
        .join(known.withColumn("there", F.lit(True)), ["tree", "parent"], "left")
        .select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("anc"), F.coalesce("score", F.lit(0.0)).cast("double").alias("score")),
        "chat-nodes",
    )
    parents = n.where("anc is not null").select("tree", F.col("anc").alias("node")).distinct()
    leaves = n.join(parents, ["tree", "node"], "left_anti")
    lift = n.where("anc is not null").select("tree", "node", "anc")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    total, reach = None, 1
    while lift.limit(1).count():
        total = n.count() if total is None else total
        if reach > 2 * total:
            raise ValueError("replies form a circle")
        step = lift.withColumnRenamed("anc", "to")
        more = paths.join(step, ["tree", "node"]).select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + reach).alias("up"))
        paths = keep(paths.unionByName(more), "chat-paths")
        lift = keep(lift.alias("a").join(lift.select("tree", F.col("node").alias("anc"), F.col("anc").alias("next")), ["tree", "anc"]).select("tree", "node", F.col("next").alias("anc")), "chat-lift")
        reach *= 2
    if n.limit(1).count() and not leaves.limit(1).count():
        raise ValueError("replies form a circle")
    if branches is None:
        return paths.withColumn("rank", F.lit(None).cast("int"))
    scored = paths.join(n.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= branches).select("tree", "leaf", "rank")
    return paths.join(best, ["tree", "leaf"])


def format_chats(nodes: DataFrame, branches: int | None = 1, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(tree, leaf, formatted, spans) for each chosen path of ``nodes`` (tree, node, parent, score, role, text).

    ``spans`` are (start, length) of the texts under the loss mask, in code points of ``formatted``.
    """
    body = nodes.select("tree", "node", escape_role(text_of("role")).alias("role"), escape(text_of("text")).alias("text"), text_of("role").isin(*learn).alias("learn"))
    turns = reply_paths(nodes, branches).join(body, ["tree", "node"])
    head = F.concat(F.lit(START), "role", F.lit(MIDDLE))
    turns = turns.withColumn("head", head).withColumn("line", F.concat("head", "text", F.lit(END)))
    before = W.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(W.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.char_length("line")).over(before), F.lit(0)) + F.char_length("head"))
    span = F.when(F.col("learn"), F.struct(F.col("at").cast("long").alias("start"), F.char_length("text").cast("long").alias("length")))
    all_turns = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("k"), "line", span.alias("span"))))
    return turns.groupBy("tree", "leaf").agg(all_turns.alias("t")).select(
        "tree",
        "leaf",
        F.array_join(F.transform("t", lambda x: x["line"]), "").alias("formatted"),
        F.array_compact(F.transform("t", lambda x: x["span"])).alias("spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``learned`` (texts under the mask), both read from ``formatted``."""
    lines = F.split("formatted", END, -1)
    lines = F.slice(lines, 1, F.size(lines) - 1)
    place = lambda x: F.instr(x, MIDDLE)
    turn = lambda x: F.struct(
        unescape(F.substring(x, F.lit(len(START) + 1), place(x) - len(START) - 1)).alias("role"),
        unescape(F.substring(x, place(x) + len(MIDDLE), F.length(x))).alias("text"),
    )
    cut = lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))
    return formatted.withColumn("turns", F.transform(lines, turn)).withColumn("learned", F.transform("spans", cut))


def op10(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Every conversation, and the planted one of id -7, formatted and read back."""
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(own)
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    # A null conversation is one conversation: joins need a key that is not null.
    tree = F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("id"))
    nodes = keep(
        rows.select(
            tree.alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.char_length(text_of("text")).cast("double").alias("score"), "role", "text"
        ),
        "chat-rows",
    )
    chats = read_back(format_chats(nodes))
    learned = F.array_join("learned", "")
    hashed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        F.when(~F.col("tree.none"), F.col("tree.id")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(hashed, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


OP10_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '#', ''))
    + length(role) + length(role) - length(replace(replace(replace(replace(role, '\\', ''), '<', ''), '#', ''), ':', '')) + 4 + 2 + 8 AS n FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
