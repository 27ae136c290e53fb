r"""Chat formatting over reply trees (operator 3).

Messages form trees: (conv_id, node, parent, role, text, score).  A root has no
parent, or one that is not among the rows.  Ancestors 1, 2, 4, ... steps up are
found by joining the step table with itself, so a tree of depth d takes log2(d)
joins; path scores are summed on the way.  The leaves of each conversation are
ranked by the score of their path (ties: smaller node first) and the best
``branches`` are kept.  The paths of the chosen leaves are then enumerated from
the same step tables, each ancestor exactly once, and every path is formatted
as one conversation.

The template writes a turn as ``### Role: text </turn>\n``.  Inside roles and
texts the escape ``\`` goes before ``\``, before a ``#`` that begins ``###`` and
before ``</turn>``, so control strings never stand in a text unescaped and the
texts can be read back exactly.  The loss mask is a list of [begin, end) code
point spans: the texts of assistant turns.

A null text or role counts as empty.  Rows that lie on a cycle of parents, or
below one, have no root and no path.  Rows with the same conversation and node
are the same message; the smallest (parent, role, text) is taken.  A null
conv_id is a conversation of its own.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotcover.llm.common import bounded_batches, materialize, regroup

ROLES = {"user": "User", "assistant": "Assistant", "system": "System"}
SHOWN = {v: k for k, v in ROLES.items()}
ESCAPED = re.compile(r"\\|#(?=##)|<(?=/turn>)")
ESCAPE_PAIR = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\])*?) </turn>\n", re.DOTALL)
FORMATTED = "conv_id long, leaf long, formatted string, loss array<struct<begin: int, end: int>>"
DIGEST = ("conv_id long, leaf long, n_turns long, turns_sha256 string, loss_chars long, "
          "loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    return ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPE_PAIR.sub(r"\1", text)


def show_role(role: str) -> str:
    """Known roles by their name, others after ``=`` with colons escaped too."""
    return ROLES.get(role) or "=" + re.sub(r"[\\:]|#(?=##)|<(?=/turn>)", r"\\\g<0>", role)


def read_role(shown: str) -> str:
    return SHOWN.get(shown) or unescape(shown[1:])


def format_turns(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its assistant texts."""
    parts, loss, at = [], [], 0
    for role, text in turns:
        head, body = f"### {show_role(role or '')}: ", escape(text or "")
        if role == "assistant":
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, " </turn>\n"]
        at += len(head) + len(body) + 9
    return "".join(parts), loss


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; raises where it is not one."""
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((read_role(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def reply_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The chosen root-to-leaf paths: conv_id, leaf, step (0 at the leaf), node."""
    steps = (nodes.groupBy("conv_id", "node")
             .agg(F.min("parent").alias("parent"), F.max("score").alias("score")))
    known = steps.select(F.col("conv_id").alias("c"), F.col("node").alias("n"))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    steps = steps.join(known, same & (F.col("parent") == F.col("n")), "left").select(
        "conv_id", "node", F.col("n").alias("up"),
        F.coalesce("score", F.lit(0.0)).alias("total"))
    every = materialize(steps, "steps")
    most = every.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    # rows that have reached their root leave; jumps[k] leads 2^k steps up
    finished, going, jumps = every.where("up is null"), every.where("up is not null"), []
    while 1 << len(jumps) <= most and going.take(1):   # no path is longer than its conversation
        jumps.append(going)
        above = finished.unionByName(going).select(
            F.col("conv_id").alias("c"), F.col("node").alias("n"),
            F.col("up").alias("next"), F.col("total").alias("more"))
        further = materialize(
            going.join(above, same & (F.col("up") == F.col("n"))).select(
                "conv_id", "node", F.col("next").alias("up"),
                (F.col("total") + F.col("more")).alias("total")), "steps")
        finished, going = finished.unionByName(further.where("up is null")), further.where("up is not null")
    parents = every.where("up is not null").select(F.col("conv_id").alias("c"), F.col("up").alias("n"))
    # what is still going hangs on a cycle
    leaves = finished.join(parents.distinct(), same & (F.col("node") == F.col("n")), "left_anti")
    by_score = Window.partitionBy("conv_id").orderBy(F.desc("total"), "node")
    paths = (leaves.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= branches)
             .select("conv_id", F.col("node").alias("leaf"), F.lit(0).cast("long").alias("step"), "node"))
    for k in range(len(jumps) - 1, -1, -1):
        jump = jumps[k].select(
            F.col("conv_id").alias("c"), F.col("node").alias("n"), "up")
        further = paths.join(jump, same & (F.col("node") == F.col("n"))).select(
            "conv_id", "leaf", (F.col("step") + (1 << k)).alias("step"), F.col("up").alias("node"))
        paths = materialize(paths.unionByName(further), "paths")
    return paths


def format_conversations(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """conv_id, leaf, formatted, loss for the best ``branches`` paths of each
    conversation of ``nodes`` (conv_id, node, parent, role, text, score)."""
    bounded_batches(nodes.sparkSession)
    nodes = nodes.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.col("node").cast("long").alias("node"),
                         F.col("parent").cast("long").alias("parent"), "role", "text",
                         F.col("score").cast("double").alias("score"))
    paths = reply_paths(nodes, branches)
    said = nodes.groupBy(F.col("conv_id").alias("c"), F.col("node").alias("n")).agg(
        F.min(F.struct("parent", "role", "text")).alias("message"))
    turns = (paths.join(said, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n")))
             .groupBy("conv_id", "leaf")
             .agg(F.sort_array(F.collect_list(F.struct("step", "message.role", "message.text")),
                               asc=False).alias("turns")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            done = [format_turns([(t["role"], t["text"]) for t in turns])
                    for turns in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.string()),
                 pa.array([[{"begin": b, "end": e} for b, e in d[1]] for d in done],
                          pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))],
                names=["conv_id", "leaf", "formatted", "loss"])

    return turns.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from the formatted text and its mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches):
            rows = []
            for r in batch.to_pylist():
                text = r["formatted"]
                turns = parse_turns(text)
                loss = "".join(unescape(text[s["begin"]:s["end"]]) for s in r["loss"])
                rows.append((r["conv_id"], r["leaf"], len(turns),
                             _sha("".join(f"{role}\n{said}\n" for role, said in turns)),
                             len(loss), _sha(loss), len(text)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                names=[c.split()[0] for c in DIGEST.split(", ")])

    return formatted.mapInArrow(run, DIGEST)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def turn_nodes(conversations: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) as trees: each row replies
    to the one before it by turn (ties by role and text; null turns first)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return conversations.select(
        "conv_id", node.alias("node"), "role", "text").select(
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.when(F.col("role") == "assistant", 1.0).otherwise(0.0).alias("score"))
