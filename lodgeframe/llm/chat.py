"""Chat formatting of reply trees.

Messages point to the message they reply to. The root-to-leaf paths come from
iterative self-joins that double their reach: round i knows each message's
ancestor 2^i steps up, and the leaves' paths are then filled from the longest
step to the shortest, so a tree of depth d takes log2(d) rounds. Branches of a
tree are ranked by score, and each chosen path becomes one conversation.

The template marks every turn: ``<s>`` opens the conversation, a turn is
``[INST]role[/INST]text</s>``. A control string inside a role or text is kept
apart by one more backslash behind its first character (``</s>`` becomes
``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``), which reading takes away again. Loss
spans name the trained-on text (the assistant's) as code-point ranges.

All of it is DataFrame functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodgeframe.llm.common import prepare, stage, table

# fixed values: the template's control strings
BEGIN, HEAD, HEAD_END, END = "<s>", "[INST]", "[/INST]", "</s>"
#: a control string with any number of backslashes behind its first character
ESCAPABLE = r"([<\[])(\\*)(/?s>|/?INST\])"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def reply_paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, message, up) for ``messages(tree, message, parent)``: every
    message on the path from each leaf to its root, ``up`` steps above the leaf.

    A parent that is null or not in the tree makes a message a root. A reply
    cycle has no root and no leaf outside it: its messages are on no path,
    and paths that lead into one end after as many steps as there are doublings.
    """
    nodes = messages.select("tree", "message", "parent")
    known = nodes.select("tree", F.col("message").alias("parent"))
    steps = [stage(nodes.join(known, ["tree", "parent"]).select("tree", "message", F.col("parent").alias("above")), "chat-steps")]
    n = nodes.count()
    while (1 << len(steps)) <= n:
        far = steps[-1].select("tree", F.col("message").alias("above"), F.col("above").alias("top"))
        longer = stage(steps[-1].join(far, ["tree", "above"]).select("tree", "message", F.col("top").alias("above")), "chat-steps")
        if longer.isEmpty():
            break
        steps.append(longer)
    leaves = nodes.join(steps[0].select("tree", F.col("above").alias("message")).distinct(), ["tree", "message"], "left_anti")
    paths = leaves.select("tree", F.col("message").alias("leaf"), "message", F.lit(0).cast("long").alias("up"))
    for i in range(len(steps) - 1, -1, -1):
        more = (paths.join(steps[i], ["tree", "message"])
                .select("tree", "leaf", F.col("above").alias("message"), (F.col("up") + (1 << i)).alias("up")))
        paths = stage(paths.union(more), "chat-paths") if i % 3 == 0 else paths.union(more)
    return paths


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """One conversation per chosen path of ``messages(tree, message, parent, role,
    text, score)``: tree, leaf, branch (rank from 1), branch_score, n_turns,
    formatted, loss_spans (array of (begin, length) in code points).

    Branches rank by the mean score of their messages (nulls left out; a branch
    without scores last), then by longer path, then by leaf; ``branches`` of
    each tree are kept (None: all). Null roles and texts count as empty.
    Messages with a null tree or message id take no part; of rows that repeat
    an id the one of least (role, text) counts. An empty table gives an empty
    result; extra columns are ignored.
    """
    prepare(messages.sparkSession)
    unique = stage(messages.where("tree is not null and message is not null").groupBy("tree", "message")
                   .agg(F.min(F.struct(F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                                       "parent", F.col("score").cast("double").alias("score"))).alias("m"))
                   .select("tree", "message", "m.*"), "chat-messages")
    paths = reply_paths(unique)
    ranked = (paths.join(unique.select("tree", "message", "score"), ["tree", "message"]).groupBy("tree", "leaf")
              .agg(F.avg("score").alias("branch_score"), F.count("*").alias("n_turns"))
              .withColumn("branch", F.row_number().over(
                  Window.partitionBy("tree").orderBy(F.col("branch_score").desc_nulls_last(), F.desc("n_turns"), "leaf"))))
    if branches is not None:
        ranked = ranked.where(F.col("branch") <= branches)
    turns = (paths.join(ranked, ["tree", "leaf"]).join(unique.select("tree", "message", "role", "text"), ["tree", "message"])
             .groupBy("tree", "leaf", "branch", "branch_score", "n_turns")
             .agg(F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns")))
    return render(turns, "turns").drop("turns")


def render(df: DataFrame, turns: str) -> DataFrame:
    """``df`` with ``formatted`` and ``loss_spans`` from an array of (.., role, text) structs."""
    parts = F.transform(turns, lambda t: F.struct(
        t["role"].alias("role"), F.concat(F.lit(HEAD), escape(t["role"]), F.lit(HEAD_END)).alias("head"), escape(t["text"]).alias("body")))
    with_parts = df.withColumn("_parts", parts)
    body = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    # begin of each turn: the running length of what stands before it
    walk = F.aggregate("_parts", F.struct(F.lit(len(BEGIN)).alias("at"), F.array().cast("array<struct<begin:int,length:int>>").alias("spans")),
                       lambda acc, p: F.struct(
                           (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(END)).alias("at"),
                           F.when(p["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(F.struct(
                               (acc["at"] + F.length(p["head"])).alias("begin"), F.length(p["body"]).alias("length")))))
                           .otherwise(acc["spans"]).alias("spans")))
    return (with_parts.withColumn("formatted", F.concat(F.lit(BEGIN), body))
            .withColumn("loss_spans", walk["spans"]).drop("_parts"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``read_turns`` (array of (role, text)) and ``loss_text``
    (the unescaped text under the loss spans, in order) read from its output."""
    turns = F.filter(F.split(F.col("formatted").substr(len(BEGIN) + 1, 2147483647), END, -1), lambda x: x != "")
    head = lambda x: F.substring_index(x, HEAD_END, 1)
    parsed = F.transform(turns, lambda x: F.struct(
        unescape(head(x).substr(F.lit(len(HEAD) + 1), F.length(x))).alias("role"),
        unescape(x.substr(F.length(head(x)) + len(HEAD_END) + 1, F.length(x))).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr(s["begin"] + 1, s["length"]))), "")
    return formatted.withColumn("read_turns", parsed).withColumn("loss_text", loss)


def chains(conversations: DataFrame) -> DataFrame:
    """A table of turns as reply trees: each row replies to the one before it (by
    turn; repeated turns by role and text, nulls first)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (conversations.where("conv_id is not null").withColumn("message", F.row_number().over(order).cast("long"))
            .select(F.col("conv_id").alias("tree"), "message", (F.col("message") - 1).alias("parent"), "role", "text",
                    F.lit(None).cast("double").alias("score")))


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    back = read_back(format_trees(chains(rows)))
    digest = F.array_join(F.transform("read_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("tree").alias("conv_id"), F.size("read_turns").cast("long").alias("n_turns"),
                       F.sha2(digest, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
