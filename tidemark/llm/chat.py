"""Chat formatting of reply trees.

Messages form trees by parent. Iterative self-joins double the distance that each message knows: after round i it
knows the ancestor 2**i above (or its root), and its depth and score sum to there; ceil(log2(depth)) rounds
reach every root, so a conversation of any length needs few. Leaves are ranked by mean score of their path, then length, then
smallest message id; the chosen leaves' paths are enumerated by the same jumps from the far ones to the near. Each path is formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside roles and texts ``&`` becomes
``&amp;`` and then ``<|`` becomes ``&lt;|``, so no control string can appear; roles also escape the newline, as ``&#10;``. Undone in the opposite order this
is reversible. Loss spans are the places (code points, 0-based start and length) of escaped assistant texts.

Null roles and texts are empty. A parent that is not there, or not before its child by id, makes the child
a root, so there are no cycles. Messages that repeat a (conversation, message) id all follow the same parent and are told apart by row. An
empty table gives an empty result. Other columns are ignored. Only built-in column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace
from tidemark.llm.native import starts

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(x: Column) -> Column:
    return F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(x: Column) -> Column:
    return F.replace(escape(x), F.lit("\n"), F.lit("&#10;"))


def unescape_role(x: Column) -> Column:
    return unescape(F.replace(x, F.lit("&#10;"), F.lit("\n")))


def as_messages(turns: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as messages, each answering the one before it by turn (then role, then text)."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = rows.withColumn("message_id", place.cast("long"))
    return rows.select("conv_id", "message_id", (F.col("message_id") - 1).alias("parent_id"), "role", "text", F.length("text").cast("double").alias("score"))


def chosen_paths(messages: DataFrame, ws: Workspace, branches: int = 1) -> DataFrame:
    """(conv_id, leaf, message_id, place): the messages of the best ``branches`` root-to-leaf paths of each tree's conversation; place counts from the root."""
    key = F.coalesce("conv_id", F.lit(-(2**63)))
    nodes = messages.select(key.alias("c"), "message_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    nodes = nodes.groupBy("c", "message_id").agg(F.min("parent_id").alias("parent_id"), F.max("score").alias("score"))
    there = nodes.select("c", F.col("message_id").alias("parent_id"), F.lit(True).alias("there"))
    nodes = nodes.join(there, ["c", "parent_id"], "left")
    up = F.when(F.col("there") & (F.col("parent_id") < F.col("message_id")), F.col("parent_id"))
    # up: ancestor at distance 2**i; steps and total: messages passed on the way and their scores, without it
    cur = ws.put(nodes.select("c", "message_id", up.alias("up"), F.lit(1).alias("steps"), F.col("score").alias("total")), "jump0")
    rounds = 0
    while not cur.where("up is not null").isEmpty():
        far = cur.select("c", F.col("message_id").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"), F.col("total").alias("total2"))
        step = cur.where("up is not null").join(far, ["c", "up"])  # an ancestor is always there
        step = (
            step.select("c", "message_id", F.col("up2").alias("up"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"), (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"))
        )
        cur = ws.put(step.union(cur.where("up is null")), f"jump{rounds + 1}")
        rounds += 1
    jumps = [ws.spark.read.schema(cur.schema).parquet(ws.path(f"jump{i}")) for i in range(rounds)]
    parents = (jumps[0] if jumps else cur).where("up is not null").select("c", F.col("up").alias("message_id")).distinct()
    leaves = cur.join(parents, ["c", "message_id"], "left_anti").select("c", F.col("message_id").alias("leaf"), "steps", (F.col("total") / F.col("steps")).alias("mean"))
    if branches == 1:  # a partial aggregate, whatever the number of leaves
        best = leaves.groupBy("c").agg(F.max(F.struct("mean", "steps", (-F.col("leaf")).alias("l"))).alias("x")).select("c", (-F.col("x.l")).alias("leaf"))
    else:
        rank = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("mean"), F.desc("steps"), "leaf"))
        best = leaves.withColumn("rank", rank).where(F.col("rank") <= branches).select("c", "leaf")
    path = ws.put(best.select("c", "leaf", F.col("leaf").alias("message_id")), "path")
    for i in reversed(range(rounds)):
        jump = jumps[i].where("up is not null").select("c", "message_id", "up")
        path = ws.put(path.union(path.join(jump, ["c", "message_id"]).select("c", "leaf", F.col("up").alias("message_id"))), f"path{i}")
    return path.join(cur.select("c", "message_id", F.col("steps").alias("place")), ["c", "message_id"])


def format_trees(messages: DataFrame, branches: int = 1, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, leaf, n_turns, formatted, loss_spans) for each chosen path."""
    ws = Workspace(messages.sparkSession, "chat")
    path = chosen_paths(messages, ws, branches)
    key = F.coalesce("conv_id", F.lit(-(2**63)))
    body = messages.select(key.alias("c"), "conv_id", "message_id", escape_role(F.col("role")).alias("role"), F.col("role").isin(*loss_roles).alias("loss"), escape(F.col("text")).alias("text"))
    turns = path.join(body, ["c", "message_id"])
    turn = F.struct("place", "role", "text", F.coalesce("loss", F.lit(False)).alias("loss"))
    rows = turns.groupBy("c", "leaf").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("turns"))
    head = lambda x: F.concat(F.lit(START), x["role"], F.lit("\n"))
    whole = F.concat_ws("", F.transform("turns", lambda x: F.concat(head(x), x["text"], F.lit(END))))
    begins = starts(F.col("turns"), lambda x: F.length(head(x)) + F.length(x["text"]) + F.lit(len(END)))
    each = F.zip_with("turns", begins, lambda x, at: F.struct((at + F.length(head(x))).alias("start"), F.length(x["text"]).cast("long").alias("length"), x["loss"].alias("loss")))
    spans = F.transform(F.filter(each, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["length"])).cast("array<struct<start:long,length:long>>")
    rows = rows.select("conv_id", "leaf", F.size("turns").cast("long").alias("n_turns"), whole.alias("formatted"), spans.alias("loss_spans"))
    rows = ws.put(rows, "result")
    ws.keep("result")
    return rows


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.regexp_extract(x, r"(?s)^[^\n]*\n(.*)<\|im_end\|>\n$", 1)).alias("text"),
    ))


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from ``formatted`` and ``loss_spans``."""
    loss = F.concat_ws("", F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int")))))
    rows = formatted.withColumn("back", read_turns(F.col("formatted"))).withColumn("loss", loss)
    turns = F.concat_ws("", F.transform("back", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))))
    return rows.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The query in DuckDB's SQL.
ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')) x),
e AS (SELECT *, replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;') AS er, replace(replace(text, '&', '&amp;'), '<|', '&lt;|') AS et FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || er || chr(10) || et || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""
