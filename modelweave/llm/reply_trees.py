"""Chat formatting of reply trees.

Messages are rows (conversation, message, parent, role, text, score). Iterative self-joins double the
reach of every message's pointer to its ancestors, so a tree of depth d needs log2(d) joins: they give each
leaf its root, its depth and the score of its branch, and then, walked from the chosen leaves with the same
pointers, the messages of each chosen branch. Branches of a conversation are ranked by their mean score
(ties: the longer, then the smaller leaf), and the best ``branches`` are formatted, each as one
conversation.

Template of a turn: ``<s>`` role ``[INST]`` text ``</s>``. Inside roles and texts a backslash is doubled and
a control string gets a backslash behind its first character, which `parse` takes back. The loss mask
covers the texts of assistant turns, as character spans of the formatted string.

Defined results: a null text, role or score is empty or 0. A null conversation id is a conversation of its
own. A message whose parent is not in the conversation (or null) is a root; messages on a cycle have no
root and are on no branch. Equal rows are separate messages if their message ids differ; of rows with
one message id the smallest (by parent, role, text) counts. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelweave.llm.common import written

CONTROL = ("</s>", "<s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]")
OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"
_CONTROL = re.compile("|".join(f"({re.escape(c[0])})({re.escape(c[1:])})" for c in CONTROL))


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def format_turns(turns) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation of (role, text) pairs and the spans of its loss mask."""
    out, mask, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + MIDDLE, escape(text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    turns = []
    for turn in formatted.split(CLOSE)[:-1]:
        role, _, text = turn.removeprefix(OPEN).partition(MIDDLE)
        turns.append((unescape(role), unescape(text)))
    return turns


# ---------------------------------------------------------------- trees


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def branches_of(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, branch, place, msg): the best branches of every conversation, over all its trees, root first.

    ``messages`` has conv, msg, parent and score; (conv, msg) is unique.
    """
    conv = Window.partitionBy("conv")
    nodes = messages.select("conv", "msg", F.col("parent").alias("up"), F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("conv").alias("c"), F.col("msg").alias("m"))
    # A pointer (msg -> up) spans `steps` messages of sum `total`, the message itself first.
    level = written(
        nodes.join(known, _same(nodes["conv"], known["c"]) & (nodes["up"] == known["m"]), "left").select(
            "conv", "msg", F.col("m").alias("up"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")
        ),
        "reply-pointers",
    )
    longest = level.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    levels, reach = [level], 1
    while reach < longest:
        far = level.select(
            F.col("conv").alias("c"), F.col("msg").alias("m"), F.col("up").alias("up2"), F.col("steps").alias("steps2"),
            F.col("total").alias("total2"),
        )
        # a pointer that has run off its root is final
        going, final = level.filter("up is not null"), level.filter("up is null")
        joined = going.join(far, _same(going["conv"], far["c"]) & (going["up"] == far["m"]), "left").select(
            "conv", "msg", F.col("up2").alias("up"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"),
            (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
        )
        level = written(joined.unionByName(final), "reply-pointers")
        levels.append(level)
        reach *= 2
        if level.filter("up is not null").isEmpty():
            break
    # Every pointer has now run off its root, but for those on (or above) a cycle.
    parents = levels[0].filter("up is not null").select(F.col("conv").alias("c"), F.col("up").alias("m")).distinct()
    leaves = level.filter("up is null").join(
        parents, _same(level["conv"], parents["c"]) & (level["msg"] == parents["m"]), "left_anti"
    )
    best = conv.orderBy(F.desc(F.col("total") / F.col("steps")), F.desc("steps"), "msg")
    chosen = leaves.withColumn("branch", F.row_number().over(best)).filter(F.col("branch") <= branches)
    # Walk up: after the pointers of reach 2^k, the marks cover 2^(k+1) messages of each branch.
    marks = chosen.select("conv", "branch", "msg", F.lit(0).cast("long").alias("above"))
    for pointers in levels[:-1] if len(levels) > 1 else levels:
        up = pointers.filter("up is not null").select(
            F.col("conv").alias("c"), F.col("msg").alias("m"), F.col("up"), F.col("steps")
        )
        further = marks.join(up, _same(marks["conv"], up["c"]) & (marks["msg"] == up["m"])).select(
            "conv", "branch", F.col("up").alias("msg"), (F.col("above") + F.col("steps")).alias("above")
        )
        marks = written(marks.unionByName(further), "reply-marks")
    place = F.row_number().over(Window.partitionBy("conv", "branch").orderBy(F.desc("above")))
    return marks.select("conv", "branch", place.alias("place"), "msg")


def format_conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, branch, n_turns, formatted, mask array<struct<start,end>>) of the best branches.

    ``messages``: conv, msg, parent, role, text, score (others are ignored).
    """
    one = Window.partitionBy("conv", "msg").orderBy("parent", "role", "text")
    messages = messages.select(
        "conv", "msg", "parent", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), "score",
    ).withColumn("_copy", F.row_number().over(one)).filter("_copy = 1").drop("_copy")
    paths = branches_of(messages, branches).select(F.col("conv").alias("c"), "branch", "place", F.col("msg").alias("m"))
    turns = messages.join(paths, _same(messages["conv"], paths["c"]) & (messages["msg"] == paths["m"]))
    grouped = turns.groupBy("conv", "branch").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns")
    )

    def run(batches):
        for batch in batches:
            made = [
                format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column("turns").to_pylist()
            ]
            lengths = pa.array([len(x) for x in batch.column("turns").to_pylist()], pa.int64())
            mask = pa.array([[{"start": a, "end": b} for a, b in m] for _, m in made], spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("branch"), lengths, pa.array([f for f, _ in made], pa.string()), mask],
                ["conv", "branch", "n_turns", "formatted", "mask"],
            )

    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return grouped.mapInArrow(
        run, "conv long, branch int, n_turns long, formatted string, mask array<struct<start:long,end:long>>"
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the masked text, from formatted strings and masks alone."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, mask in zip(
                batch.column("formatted").to_pylist(), batch.column("mask").to_pylist(), strict=True
            ):
                turns = parse(text)
                digest = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode()).hexdigest()
                learnt = "".join(unescape(text[s["start"]:s["end"]]) for s in mask)
                rows.append((
                    len(turns), digest, len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)
                ))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("branch"),
                 *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                ["conv", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return formatted.select("conv", "branch", "formatted", "mask").mapInArrow(
        run,
        "conv long, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long",
    )


def threads(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each row answers the one before."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    return (
        conversations.select(F.col("conv_id").cast("long").alias("conv"), "turn", "role", "text")
        .withColumn("msg", F.row_number().over(order).cast("long"))
        .withColumn("parent", F.when(F.col("msg") > 1, F.col("msg") - 1))
        .withColumn("score", F.lit(0.0))
    )
