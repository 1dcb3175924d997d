"""Conversations as prefix trees.

Conversations that begin with the same turns share the nodes of those turns. Each node's
tokens are emitted once, depth first; a node carries its place in that stream, the
position of its first token within a conversation, and the intervals of the stream that
its tokens may attend to (its ancestors; its own tokens are causal).

Template: ``<|role|>`` + role + ``<|text|>`` + text + ``<|end|>``, the text under the
loss mask for assistant turns. In roles and texts a backslash becomes two and the first
character of a control string becomes backslash + ``l`` or ``b``, so no control string
survives in them and reading back restores every character.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import encoder, slices, stored

# Fixed values of the template; the last four are control strings of other templates.
CONTROLS = ("<|role|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]")
_ESCAPE = re.compile("\\\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS))
_CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_PLAIN = {"\\": "\\", "l": "<", "b": "["}
# Tokens of the stream that nodes and intervals are looked up by.
STRETCH = 4096
NODE_DDL = "node string, path array<string>, ids array<int>, loss_start int, loss_end int"


def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: _CODES[m[0]], text)


def plain(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text, flags=re.S)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Marker, text and end of one turn in the template."""
    return f"<|role|>{escaped(role)}<|text|>", escaped(text), "<|end|>"


def _line() -> Column:
    return Window.partitionBy("conv_id").orderBy("turn", "role", "text")


def tree(turns: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, members) of conversation rows (conv_id, turn, role, text).

    nodes: ``node``, ``path`` (its chain of turns), ``ids``, ``loss_start``/``loss_end``
    (tokens under the loss mask, from the node's start), ``emit_start`` (place of the first
    token in the stream), ``position_start``, ``attends`` (intervals of the stream that hold
    its ancestors, joined where they touch). members: ``conv_id``, ``k`` (turn number from
    1), ``node``.

    Null texts and roles are empty; rows of one conversation go by turn, then role and
    text (a missing turn first), repeated rows stay repeated turns; a null conv_id is a
    conversation. A node is told apart by the digests of all its turns. Tokens are
    byte-level, so any text reads back whole. Empty input gives empty tables.
    """
    clean = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    each = clean.withColumn("key", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    each = each.withColumn("path", F.collect_list("key").over(_line().rowsBetween(Window.unboundedPreceding, 0)))
    each = each.withColumn("k", F.size("path")).withColumn("node", F.md5(F.array_join("path", "")))
    members = stored(each.select("conv_id", "k", "node", "path", "role", "text"), "turns")
    distinct = members.groupBy("node").agg(F.first("path").alias("path"), F.first("role").alias("role"), F.first("text").alias("text"))

    def encode(batches):
        tokens = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, 1000):
                parts = [turn_parts(r, t) for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist())]
                counts, flat = tokens(pa.array([p for three in parts for p in three], pa.string()))
                sizes = counts.reshape(-1, 3)
                bounds = np.r_[0, np.cumsum(sizes.sum(1))]
                assistant = np.array([r == "assistant" for r in part.column("role").to_pylist()], bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node"),
                        part.column("path"),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32))),
                        pa.array(sizes[:, 0].astype(np.int32)),
                        pa.array(np.where(assistant, sizes[:, 0] + sizes[:, 1], sizes[:, 0]).astype(np.int32)),
                    ],
                    ["node", "path", "ids", "loss_start", "loss_end"],
                )

    # The order of paths is depth first: a prefix comes before what extends it.
    ordered = distinct.repartitionByRange("path").sortWithinPartitions("path")
    ordered = ordered.select("node", "path", "role", "text").mapInArrow(encode, NODE_DDL)
    emitted = stored(ordered.withColumn("part", F.spark_partition_id()), "nodes")
    size = F.size("ids").cast("long")
    before = lambda *by: (Window.partitionBy(*by) if by else Window.partitionBy()).rowsBetween(Window.unboundedPreceding, -1)
    parts = emitted.groupBy("part").agg(F.sum(size).alias("n"))  # one row per partition
    base = parts.select("part", F.coalesce(F.sum("n").over(before().orderBy("part")), F.lit(0)).alias("base"))
    local = F.coalesce(F.sum(size).over(before("part").orderBy("path")), F.lit(0))
    placed = emitted.select("node", "part", "path", size.alias("n"), local.alias("local")).join(base, "part")
    placed = placed.select("node", "n", (F.col("base") + F.col("local")).alias("emit_start"))

    # Ancestors along one conversation that holds the node, the first of them.
    owners = members.groupBy("node").agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id")).alias("owner"))
    chains = members.select("conv_id", "k", "node").join(owners, "node").join(placed, "node")
    owning = chains.where(F.col("owner.conv_id").eqNullSafe(F.col("conv_id"))).select(F.col("conv_id").alias("c")).distinct()
    chains = chains.join(owning, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    above = Window.partitionBy("conv_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    spans = F.collect_list(F.struct(F.col("emit_start").alias("start"), (F.col("emit_start") + F.col("n")).alias("stop"))).over(above)
    kind = "array<struct<start:bigint,stop:bigint>>"

    def touch(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), x["stop"].alias("stop"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.greatest(F.size(done) - 1, F.lit(0)))["stop"] == x["start"]), longer).otherwise(F.concat(done, F.array(x)))

    placed = (
        chains.withColumn("spans", spans)
        .withColumn("position_start", F.coalesce(F.sum("n").over(above), F.lit(0)))
        .where(F.col("owner.conv_id").eqNullSafe(F.col("conv_id")))
        .select("node", "emit_start", "position_start", F.aggregate("spans", F.array().cast(kind), touch).alias("attends"))
    )
    nodes = emitted.drop("part").join(placed, "node")
    return nodes, members.select("conv_id", "k", "node")


def conversations_of(nodes: DataFrame, members: DataFrame, tokenizer: str) -> DataFrame:
    """Each conversation read back from the stream: ``conv_id``, ``n_turns``, ``turns_sha256``
    (role, line feed, text, line feed per turn), ``loss_chars`` and ``loss_sha256`` (unescaped
    text under the loss mask), ``formatted_chars``.

    Of a conversation only its last node is looked up; its turns are what the stream holds in
    the intervals that node attends to, in the order of their positions. Tokens that are
    missing, or not as many turns as the conversation has, are an error.
    """

    def read(batches):
        tokens = encoder(tokenizer).tokenizer
        for batch in batches:
            for part in slices(batch, 500):
                rows = []
                for conv, n, stop, turns in zip(*(part.column(c).to_pylist() for c in ("conv_id", "n_turns", "stop", "turns"))):
                    said, loss, chars, at = hashlib.sha256(), "", 0, 0
                    for turn in sorted(turns, key=lambda t: t["position_start"]):
                        ids, a, b = turn["ids"], turn["loss_start"], turn["loss_end"]
                        if turn["position_start"] != at:
                            raise ValueError(f"conversation {conv}: position {at} is not in the intervals it attends to")
                        at += len(ids)
                        whole = tokens.decode(ids, skip_special_tokens=False)
                        role, text = whole.removeprefix("<|role|>").removesuffix("<|end|>").split("<|text|>", 1)
                        said.update(f"{plain(role)}\n{plain(text)}\n".encode())
                        loss += plain(tokens.decode(ids[a:b], skip_special_tokens=False))
                        chars += len(whole)
                    if len(turns) != n or at != stop:
                        raise ValueError(f"conversation {conv}: {len(turns)} of {n} turns, {at} of {stop} positions read back")
                    rows.append((len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
                made = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), *(pa.array(list(v), t) for v, t in zip(made, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))],
                    ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
                )

    last = members.groupBy("conv_id").agg(F.max_by("node", "k").alias("node"), F.max("k").alias("n_turns"))
    size = F.size("ids").cast("long")
    own = F.struct(F.col("emit_start").alias("start"), (F.col("emit_start") + size).alias("stop"))
    ends = nodes.select("node", (F.col("position_start") + size).alias("stop"), F.concat("attends", F.array(own)).alias("spans"))
    seen = last.join(ends, "node").select("conv_id", "n_turns", "stop", F.explode("spans").alias("span"))
    stretch = lambda c: F.floor(c / STRETCH)
    met = F.sequence(stretch(F.col("span.start")), stretch(F.col("span.stop") - 1))
    seen = seen.withColumn("stretch", F.explode(met))
    stream = nodes.select(stretch(F.col("emit_start")).alias("stretch"), "emit_start", "position_start", "ids", "loss_start", "loss_end")
    read_out = seen.join(stream, "stretch").where((F.col("emit_start") >= F.col("span.start")) & (F.col("emit_start") < F.col("span.stop")))
    turns = F.collect_list(F.struct("position_start", "ids", "loss_start", "loss_end")).alias("turns")
    grouped = read_out.groupBy("conv_id").agg(F.max("n_turns").cast("long").alias("n_turns"), F.max("stop").alias("stop"), turns)
    ddl = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kind = dict(members.dtypes)["conv_id"]
    return grouped.mapInArrow(read, f"conv_id {kind}, {ddl}")
