"""Chat formatting: reply trees become conversations, root to leaf.

Messages answer one another, so a discussion is a tree and each way from its
root to a leaf is a conversation.  Self-joins find these ways: the table of
links "message -> the one it answers" is joined with itself, then the result
with itself, and so on, which gives the links of 1, 2, 4, 8, ... steps.  A tree
of depth d takes log2(d) rounds, each written to the shared folder.  The same
tables, longest steps first, first add up the scores of each branch, then list
the messages of the branches that were chosen.  These tables hold ids only;
texts are fetched once, for the chosen branches.

Branches of a tree are ranked by the mean score of their messages (those without
a score do not count; branches without any come last), then by the leaf's id.

A conversation is written as turns ``<turn><role>ROLE</role>\\nTEXT</turn>\\n``.
In roles and texts a backslash is doubled and one is put after the ``<`` of
each ``</``, ``<turn>`` and ``<role>``, so no text holds a mark, and taking each
backslash before another character away restores it.  ``loss`` lists the spans
to learn from, the texts of ``assistant``, in code points: ``start`` and
``length`` in the whole, beside the number of the turn and where it begins.

All of it is DataFrame functions.  One conversation is one row, so its turns meet
in one task; a tree of any size is spread by message.

Defined cases: null roles and texts count as empty, null trees as one tree; a
message without id is known by what it says; repeated rows of one message count
once, the smallest (parent, role, text) stands; a message that answers itself or
one that is not there is a root; replies that form a ring raise ``ValueError``;
further columns of any name are left out; no messages give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

OPEN, ROLE_END, TURN_END = "<turn><role>", "</role>\n", "</turn>\n"
LEARNT = "assistant"


class ReplyRing(ValueError):
    """Messages answer one another in a ring, which has no root."""


def _key(tree: Column, node: Column) -> Column:
    """16 bytes that stand for a message of a tree; null for no message."""
    said = F.concat(F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit("-")), F.lit("\x1f"), node.cast("string"))
    return F.unhex(F.substring(F.sha2(said, 256), 1, 32))


def messages_of(replies: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None = None) -> DataFrame:
    """``(key, parent_key, tree, node, role, text, score)``, one row a message."""
    words = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    up, its = F.col(parent).cast("string"), F.col(node).cast("string")
    its = F.coalesce(its, F.concat(F.lit("?"), F.sha2(F.concat_ws("\x1f", up, *words), 256)))
    given = replies.select(F.col(tree).alias("tree"), its.alias("node"), F.struct(up.alias("parent"), words[0].alias("role"), words[1].alias("text"), (F.col(score).cast("double") if score else F.lit(None).cast("double")).alias("score")).alias("said"))
    once = given.groupBy("tree", "node").agg(F.min("said").alias("said"))
    return once.select(_key(F.col("tree"), F.col("node")).alias("key"), _key(F.col("tree"), F.col("said.parent")).alias("parent_key"), "tree", "node", "said.role", "said.text", "said.score")


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as messages, each of which answers the one before; ties of a
    turn stand by role, then text, and null turns come first."""
    rows = conversations.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))))
    rows = rows.withColumn("node", F.row_number().over(Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")).cast("long"))
    before = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(_key(F.col("tree"), F.col("node")).alias("key"), _key(F.col("tree"), before).alias("parent_key"), "tree", "node", "role", "text", F.lit(None).cast("double").alias("score"))


def _steps(links: DataFrame) -> list[DataFrame]:
    """Tables ``(key, up, total, n)`` of the links of 1, 2, 4, ... steps: ``up`` is
    that many steps above ``key``; ``total`` and ``n`` add up the scores below it."""
    first = links.where("parent_key IS NOT NULL AND parent_key != key").join(links.select(F.col("key").alias("parent_key")), "parent_key", "left_semi")
    steps = [stored(first.select("key", F.col("parent_key").alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"), F.col("score").isNotNull().cast("long").alias("n")), "reply-steps")]
    most = math.ceil(math.log2(steps[0].count() + 1)) + 1
    while not steps[-1].isEmpty():
        if len(steps) > most:
            raise ReplyRing("some replies answer one another in a ring")
        a, b = steps[-1], steps[-1].select(F.col("key").alias("up"), F.col("up").alias("further"), F.col("total").alias("more"), F.col("n").alias("others"))
        steps.append(stored(a.join(b, "up").select("key", F.col("further").alias("up"), (F.col("total") + F.col("more")).alias("total"), (F.col("n") + F.col("others")).alias("n")), "reply-steps"))
    return steps[:-1]


def branches_of(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree, branch, score, leaf, key, place)``: the messages of the chosen
    branches; ``place`` rises from the root.  ``branches``: how many of a tree are
    kept, the best first; None keeps all and leaves their rank, ``branch``, to the leaf's key."""
    links = messages.select("key", "parent_key", "tree", "node", "score")
    steps = _steps(links)
    answered = steps[0].select(F.col("up").alias("key")).distinct() if steps else links.select("key").where("false")
    way = links.join(answered, "key", "left_anti").select("tree", F.col("node").alias("leaf_node"), F.col("key").alias("leaf"), F.col("key").alias("at"), F.lit(0.0).alias("total"), F.lit(0).cast("long").alias("n"))
    for step in reversed(steps):
        jump = step.select(F.col("key").alias("at"), "up", F.col("total").alias("more"), F.col("n").alias("others"))
        way = way.join(jump, "at", "left").select("tree", "leaf_node", "leaf", F.coalesce("up", "at").alias("at"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"), (F.col("n") + F.coalesce("others", F.lit(0))).alias("n"))
    top = links.select(F.col("key").alias("at"), F.col("score").alias("own"))
    n = F.col("n") + F.col("own").isNotNull().cast("long")
    way = way.join(top, "at").select("tree", "leaf_node", "leaf", F.when(n > 0, (F.col("total") + F.coalesce("own", F.lit(0.0))) / n).alias("score"))
    if branches is None:
        way = way.withColumn("branch", F.hex("leaf"))
    else:
        by = Window.partitionBy("tree").orderBy(F.col("score").desc_nulls_last(), "leaf_node", "leaf")
        way = way.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= branches).withColumn("branch", F.col("rank").cast("string")).drop("rank")
    way = stored(way.drop("leaf_node"), "reply-branches")
    path = way.select("tree", "branch", "score", "leaf", F.col("leaf").alias("at"), F.lit(0).cast("long").alias("back"))
    for k, step in reversed(list(enumerate(steps))):
        jump = step.select(F.col("key").alias("at"), "up")
        here, there = F.struct("at", "back"), F.struct(F.col("up").alias("at"), (F.col("back") + (1 << k)).alias("back"))
        places = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there))
        path = path.join(jump, "at", "left").select("tree", "branch", "score", "leaf", F.inline(places))
    return path.select("tree", "branch", "score", "leaf", F.col("at").alias("key"), (-F.col("back")).alias("place"))


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in ("</", "<turn>", "<role>"):
        text = F.replace(text, F.lit(mark), F.lit("<\\" + mark[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def rendered(messages: DataFrame, path: DataFrame) -> DataFrame:
    """``(tree, branch, score, n_turns, formatted, loss)``, a row a branch."""
    said = messages.select("key", escaped(F.col("role")).alias("shown_role"), escaped(F.col("text")).alias("shown"), (F.col("role") == LEARNT).alias("learnt"))
    rows = path.join(said, "key").withColumn("piece", F.concat(F.lit(OPEN), "shown_role", F.lit(ROLE_END), "shown", F.lit(TURN_END)))
    by = Window.partitionBy("tree", "branch").orderBy("place")
    rows = rows.select("tree", "branch", "score", "place", "piece", "learnt", F.length("shown").cast("long").alias("length"),
                       (F.row_number().over(by) - 1).cast("long").alias("turn"), F.coalesce(F.sum(F.length("piece").cast("long")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("turn_start"))
    start = F.col("turn_start") + F.length("piece") - len(TURN_END) - F.col("length")
    span = F.when(F.col("learnt"), F.struct("turn", "turn_start", start.alias("start"), "length"))
    rows = rows.withColumn("one", F.struct("turn", "piece", span.alias("span")))
    whole = rows.groupBy("tree", "branch").agg(F.first("score").alias("score"), F.count("*").alias("n_turns"), F.array_sort(F.collect_list("one")).alias("turns"))
    return whole.select("tree", "branch", "score", "n_turns", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                        F.array_compact(F.transform("turns", lambda t: t["span"])).alias("loss"))


def format_trees(replies: DataFrame, tree: str, node: str, parent: str, role: str = "role", text: str = "text", score: str | None = None, branches: int | None = 1) -> DataFrame:
    """The ``branches`` best branches of each reply tree, each as one conversation."""
    messages = stored(messages_of(replies, tree, node, parent, role, text, score), "reply-messages")
    return rendered(messages, branches_of(messages, branches))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Tables of ``(conv_id, turn, role, text)``: trees with one branch each."""
    messages = stored(turns_of(conversations), "reply-messages")
    return rendered(messages, branches_of(messages, 1))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns``, an array of (role, text), and ``learnt``, the
    text under the loss mask, both unescaped, taken from the written text only."""
    pieces = F.split("formatted", TURN_END, -1)

    def parted(piece: Column) -> Column:
        rest = F.substr(piece, F.lit(len(OPEN) + 1))
        role = F.substring_index(rest, ROLE_END, 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(rest, F.length(role) + len(ROLE_END) + 1)).alias("text"))

    out = formatted.withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    learnt = F.transform("loss", lambda s: unescaped(F.substr(F.get("pieces", s["turn"].cast("int")), (s["start"] - s["turn_start"] + 1).cast("int"), s["length"].cast("int"))))
    return out.withColumn("turns", F.transform("pieces", parted)).withColumn("learnt", F.array_join(learnt, "")).drop("pieces")
