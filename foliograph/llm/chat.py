r"""Operator 1, chat formatting of reply trees, in DataFrame operations only.

A reply tree's messages know their parents. Paths from a root to a leaf come from self-joins that double their reach:
`hops` pairs every message with its ancestor 2^k replies up, and the paths gathered so far join it to reach twice as
far, so a path of n messages takes log2(n) rounds, and each message of a path is made once. Leaves are ranked by the
sum of scores on their path, and the chosen ones become one conversation each.

A turn is written `### role: text</turn>` and a line feed. Inside roles and texts `\`, `<`, `#` and `:` become `\b`,
`\l`, `\h` and `\c`, so no control string and no bare backslash occurs in them, and reading back is exact. The loss
mask is the spans of assistant texts, in code points of the formatted text.

Defined results. Null role or text: empty. Rows without conv_id belong to no conversation. A parent that is missing counts as none, so its child is a root. Messages of
a cycle have no root and belong to no path. Repeated message ids of one conversation: the row that sorts first by
(role, text) is kept. Ties of branch scores go to the smaller leaf. linear() makes chains of rows by (turn, role,
text), repeated rows included. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliograph.llm.common import discard, keep

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
#: Control characters and their codes; the backslash is coded first and decoded last.
CODES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escape(c: Column) -> Column:
    for plain, code in CODES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(CODES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def linear(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as reply chains: conv_id, msg_id, parent_id, role, text, score."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    n = F.row_number().over(order).cast("long")
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).select(
        "conv_id", n.alias("msg_id"), F.when(n > 1, n - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score")
    )


def paths(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """conv_id, leaf, msg_id, height (replies below it on the path): the messages of each conversation's best leaves."""
    m = messages.select("conv_id", "msg_id", "parent_id", "score")
    known = m.select("conv_id", F.col("msg_id").alias("parent_id")).distinct()
    replies = keep(m.join(known, ["conv_id", "parent_id"]).select("conv_id", "msg_id", F.col("parent_id").alias("up")), "replies")
    inner = replies.select("conv_id", F.col("up").alias("msg_id")).distinct()
    leaves = m.join(inner, ["conv_id", "msg_id"], "left_anti")
    found = keep(leaves.select("conv_id", F.col("msg_id").alias("leaf"), "msg_id", F.lit(0).cast("long").alias("height")), "paths")
    # a path longer than its conversation runs in a circle
    most = m.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    hops, reach = replies, 1
    while reach < most:
        far = found.join(hops, ["conv_id", "msg_id"]).select("conv_id", "leaf", F.col("up").alias("msg_id"), (F.col("height") + reach).alias("height"))
        longer = keep(far, "paths")
        if longer.isEmpty():
            break
        found = found.unionByName(longer)
        on = hops.select("conv_id", F.col("msg_id").alias("up"), F.col("up").alias("top"))
        doubled = keep(hops.join(on, ["conv_id", "up"]).select("conv_id", "msg_id", F.col("top").alias("up")), "hops")
        if hops is not replies:
            discard(hops)
        hops, reach = doubled, 2 * reach
    scores = found.join(m.select("conv_id", "msg_id", "score"), ["conv_id", "msg_id"])
    branches = scores.groupBy("conv_id", "leaf").agg(F.sum("score").alias("total"), F.max_by("msg_id", "height").alias("msg_id"))
    rooted = branches.join(replies, ["conv_id", "msg_id"], "left_anti")
    order = Window.partitionBy("conv_id").orderBy(F.desc_nulls_last("total"), "leaf")
    chosen = rooted.withColumn("rank", F.row_number().over(order))
    if best is not None:
        chosen = chosen.where(F.col("rank") <= best)
    return found.join(chosen.select("conv_id", "leaf", "rank"), ["conv_id", "leaf"])


def format_chats(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """conv_id, leaf, rank, formatted, loss_spans (start and end in code points of each assistant text)."""
    once = Window.partitionBy("conv_id", "msg_id").orderBy("role", "text")
    m = messages.where("conv_id is not null and msg_id is not null").select(
        "conv_id", "msg_id", "parent_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score"
    )
    m = keep(m.withColumn("__n", F.row_number().over(once)).where("__n = 1").drop("__n"), "messages")
    turn = F.struct((-F.col("height")).alias("at"), escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"), (F.col("role") == "assistant").alias("mine"))
    rows = paths(m, best).join(m.select("conv_id", "msg_id", "role", "text"), ["conv_id", "msg_id"])
    chats = rows.groupBy("conv_id", "leaf", "rank").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    head = len(OPEN) + len(MIDDLE)

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + head + F.length(t["role"])
        end = start + F.length(t["text"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"), F.when(t["mine"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")
    return chats.select("conv_id", "leaf", "rank", text.alias("formatted"), F.aggregate("turns", nothing, step)["spans"].alias("loss_spans"))


def read_chats(chats: DataFrame) -> DataFrame:
    """conv_id, turns (array of role and text), loss_text (assistant texts joined): what format_chats() wrote, read back."""
    parts = F.split("formatted", CLOSE)
    said = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda t: F.split(F.substr(t, F.lit(len(OPEN) + 1)), MIDDLE))
    turns = F.transform(said, lambda t: F.struct(unescape(t[0]).alias("role"), unescape(t[1]).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return chats.select("*", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"))


def digest(rows: DataFrame) -> DataFrame:
    """The digest of linear conversations, read back from their formatted texts."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_chats(format_chats(linear(rows))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
