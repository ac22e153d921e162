"""Chat formatting: reply trees, their root-to-leaf paths, and each chosen path as one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.session import settle

# The control strings. A turn is OPEN HEAD role HEAD_END text CLOSE.
OPEN, CLOSE, HEAD, HEAD_END = "<s>", "</s>", "[INST]", "[/INST]"
ANSWERS = "assistant"


def escaped(text: Column) -> Column:
    """``<``, ``[`` and the backslash each get a backslash after them, so no control string is left."""
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def reply_paths(messages: DataFrame) -> DataFrame:
    """Root-to-leaf paths of reply trees.

    ``messages`` has tree, message, parent (null for a root), role, text, score; message ids are
    unique within a tree, and a parent that is missing makes a root. Returns one row per path and
    message: tree, leaf, depth (from 0 at the leaf), message, role, text, score.

    The joins double their stride: after k of them each message knows its 2^k-th ancestor, and
    paths are filled in from the leaves with the largest stride first. So a path of n messages
    takes about 2 log n joins, and each of its messages is one row throughout. A cycle of parents
    has no leaf of its own and gives no path; one that a leaf hangs on stops the run with an error.
    """
    links = messages.select("tree", "message", F.col("parent").alias("up"))
    ids = messages.select("tree", F.col("message").alias("up"))
    step = settle(links.where("up is not null").join(ids, ["tree", "up"], "left_semi").select("tree", "message", "up"))
    leaves = messages.select("tree", "message").join(
        step.select("tree", F.col("up").alias("message")).distinct(), ["tree", "message"], "left_anti"
    )
    strides = [step]
    rows = step.count()
    most = messages.count()
    while rows:
        if 1 << len(strides) > 2 * most:
            raise ValueError("replies run in a circle")
        last = strides[-1]
        further = settle(
            last.select("tree", "message", F.col("up").alias("mid"))
            .join(last.select("tree", F.col("message").alias("mid"), "up"), ["tree", "mid"])
            .select("tree", "message", "up")
        )
        rows = further.count()
        strides.append(further)
    paths = leaves.select("tree", F.col("message").alias("leaf"), "message", F.lit(0).cast("long").alias("depth"))
    for k in reversed(range(len(strides) - 1 if len(strides) > 1 else len(strides))):
        more = paths.join(strides[k], ["tree", "message"]).select(
            "tree", "leaf", F.col("up").alias("message"), (F.col("depth") + (1 << k)).alias("depth")
        )
        paths = settle(paths.unionByName(more))
    return paths.join(messages.select("tree", "message", "role", "text", "score"), ["tree", "message"])


def best_paths(paths: DataFrame, top: int = 1) -> DataFrame:
    """Of each tree the ``top`` paths with the highest mean score; ties go to the smaller leaf."""
    scores = paths.groupBy("tree", "leaf").agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("tree").orderBy(F.col("mean").desc_nulls_last(), "leaf")
    chosen = scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return paths.join(chosen.select("tree", "leaf", "rank"), ["tree", "leaf"])


def formatted(paths: DataFrame) -> DataFrame:
    """One conversation per path: tree, leaf, rank, formatted, loss_spans.

    loss_spans are the (start, length) of the answers' texts in ``formatted``, in code points.
    """
    turn = F.concat(
        F.lit(OPEN + HEAD), escaped(F.col("role")), F.lit(HEAD_END), escaped(F.col("text")), F.lit(CLOSE)
    )
    lead = F.length(escaped(F.col("role"))) + len(OPEN + HEAD + HEAD_END)
    rows = paths.select(
        "tree", "leaf", "rank",
        F.struct((-F.col("depth")).alias("at"), turn.alias("turn"), (F.col("role") == ANSWERS).alias("answer"), lead.alias("lead")).alias("t"),
    )
    chats = rows.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    close = len(CLOSE)

    def add(done: Column, t: Column) -> Column:
        span = F.struct((done["at"] + t["lead"]).alias("start"), (F.length(t["turn"]) - t["lead"] - close).alias("length"))
        return F.struct(
            (done["at"] + F.length(t["turn"])).alias("at"),
            F.when(t["answer"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"),
        )

    return chats.select(
        "tree", "leaf", "rank",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.aggregate("turns", start, add, lambda done: done["spans"]).alias("loss_spans"),
    )


def chat_format(messages: DataFrame, top: int = 1) -> DataFrame:
    """Formats the best ``top`` paths of every reply tree, each as one conversation.

    ``messages``: tree, message, parent, role, text, score (see :func:`reply_paths`). A null role or
    text counts as empty; null scores are left out of means, and a path without any comes last. A
    row with a null message id is a root of its own that nothing replies to and is left out of the
    paths, as is one with a null tree. Repeated messages must be told apart by the caller. Extra
    columns are ignored. An empty table gives an empty result. One conversation is one text, so it
    must fit in a row; nothing else is gathered.
    """
    own = settle(messages.select(
        "tree", "message", "parent", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("score").cast("double").alias("score"),
    ).where("tree is not null and message is not null"))
    return formatted(best_paths(reply_paths(own), top))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds to formatted conversations their turns (role and text) and the text under the loss mask."""
    parts = F.slice(F.split("formatted", CLOSE, -1), 1, F.size(F.split("formatted", CLOSE, -1)) - 1)
    cut = len(OPEN + HEAD)

    def turn(x: Column) -> Column:
        head = F.split(x, r"\[/INST\]", 2)
        return F.struct(unescaped(F.substr(head[0], F.lit(cut + 1))).alias("role"), unescaped(head[1]).alias("text"))

    masked = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return chats.select("*", F.transform(parts, turn).alias("turns"), F.array_join(masked, "").alias("loss_text"))
