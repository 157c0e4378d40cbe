"""Chat formatting: conversations that begin alike share their turns in a prefix tree."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from chatpulse.llm.common import column, frozen
from chatpulse.llm.packing import Encoder

ASSISTANT = "assistant"
#: Tokens of a stretch of a tree's sequence, by which intervals find the nodes they touch.
STRETCH = 256
#: Turns' heads that a task remembers the tokens of.
_HEADS = 1000
_ESCAPED = re.compile(r"[\\<#]")
_ESCAPES = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ([^\\\n]*(?:\\.[^\\\n]*)*)\n([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)


def escaped(text: str) -> str:
    """Every character that can begin a mark of the template, and the escape itself, gets a backslash."""
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _ESCAPES.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Head, body and end of a turn. In a role a line break is written ``\\n``, as it ends the head."""
    return "### " + escaped(role).replace("\n", "\\n") + "\n", escaped(text), "</turn>\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        role = _ESCAPES.sub(lambda m: "\n" if m[1] == "n" else m[1], found[1])
        turns.append((role, unescaped(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


class Codec:
    """Token ids of a text and back: of a byte-level vocabulary, or code points if there is none."""

    def __init__(self, vocabulary: str | None = None, ranks: bytes | None = None) -> None:
        self.encoder = Encoder(vocabulary, ranks, ordinary=True) if vocabulary else None

    def encode(self, text: str) -> list[int]:
        return self.encoder.ids(text).tolist() if self.encoder else [ord(c) for c in text]

    def decode(self, ids: list[int]) -> str:
        if self.encoder is None:
            return "".join(map(chr, ids))
        return self.decode_bytes(ids).decode("utf-8")

    def decode_bytes(self, ids: list[int]) -> bytes:
        if self.encoder is None:
            return self.decode(ids).encode("utf-8", "surrogatepass")
        return self.encoder.fast.decode_bytes(ids)


@lru_cache(maxsize=1)
def _codec(vocabulary: str | None, ranks: bytes | None) -> Codec:
    """One codec a worker, whatever tasks it runs."""
    return Codec(vocabulary, ranks)


def _id_lists(ids: pa.ListArray) -> list[list[int]]:
    """A column of ids as lists, converted in one go."""
    values, ends = np.asarray(ids.flatten()).tolist(), np.asarray(ids.offsets)
    ends = (ends - ends[0]).tolist()
    return [values[i:j] for i, j in zip(ends, ends[1:])]


@dataclass(frozen=True)
class ChatForest:
    """What the conversations became.

    ``nodes``: one row a turn that some conversations share. Trees are written
    depth-first, one token sequence each: ``tree_id, node_id, parent_id, depth,
    start, length, position, attends, ids, loss_start, loss_end``. ``start`` is
    the node's place in the tree's sequence and ``position`` the position id of
    its first token, the tokens of its ancestors before it; both go on by one a
    token. Its tokens see those of the intervals ``attends`` (start, end) of the
    sequence, which are its ancestors', and their own from the node's start on.
    Tokens ``loss_start`` to ``loss_end`` of the node are under the loss mask.
    ``paths``: ``leaf_id, depth, node_id`` of each different conversation.
    ``members``: ``conv_id, n_turns, leaf_id`` of every conversation.
    """

    nodes: DataFrame
    paths: DataFrame
    members: DataFrame
    codec: tuple[str | None, bytes | None]


def _numbered(leaves: DataFrame) -> DataFrame:
    """``path, rank``: the number of each path in their order, from 0.

    A range partitioning sorts; tasks number their own rows, and the counts of
    the partitions before, one number each, make the numbers run through.
    """
    width = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = leaves.repartitionByRange(width, "path").sortWithinPartitions("path")

    def run(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            numbers = pa.array(np.arange(seen, seen + batch.num_rows), pa.int64())
            parts = pa.array(np.full(batch.num_rows, part), pa.int32())
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), parts, numbers], names=["path", "part", "nth"])

    table = frozen(ordered.mapInArrow(run, "path string, part int, nth bigint"), "chat-leaves")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = table.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row a partition.
    before = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return table.join(F.broadcast(before), "part").select("path", (F.col("before") + F.col("nth")).alias("rank"))


_HASH = 32
#: Prefix hashes are polynomials of the turns' hashes, so that those of a run of
#: turns go on from whatever came before the run.
_PRIME = (1 << 127) - 1
_BASE = 0x5D3F1C6B9A7E42D80F6B3C915E27A84D % _PRIME



def _prefixes(turns: DataFrame) -> DataFrame:
    """``conv, conv_id, depth, node_id, parent_id, turn_hash``; a node is known by its turns up to there.

    Turns are range-sorted, so a conversation may span many tasks. Each hashes
    the runs it sees; what a partition's last run leaves to the next partitions
    is one row a partition.
    """
    spark = turns.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Equal turns are told apart by a number, or all would go to one task.
    known = frozen(turns.select("conv", "conv_id", "turn", "turn_hash", F.monotonically_increasing_id().alias("row")), "chat-turns")
    order = ["conv", "turn", "turn_hash", "row"]
    ordered = known.repartitionByRange(width, *order).sortWithinPartitions(*order).select("conv", "conv_id", "turn_hash")

    def hashed(batches):
        part, conv, nth, value = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            numbers, before, after = [], [], []
            for own, turn in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                nth, value = (nth + 1, value) if own == conv else (0, 0)
                conv = own
                before.append(f"{value:032x}")
                value = (value * _BASE + int(turn, 16) + 1) % _PRIME
                numbers.append(nth)
                after.append(f"{value:032x}")
            more = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(numbers, pa.int64()), pa.array(before, pa.string()), pa.array(after, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "part", "nth", "before", "after"])

    schema = StructType([*ordered.schema.fields]).add("part", "integer").add("nth", "long").add("before", "string").add("after", "string")
    runs = frozen(ordered.mapInArrow(hashed, schema), "chat-runs")
    # One row a partition: its last run.
    last = F.max(F.struct("conv", "nth", "after")).alias("last")
    carried, carry = {}, ("", 0, 0)
    for row in runs.groupBy("part").agg(last).orderBy("part").collect():
        conv, nth, after = row["last"]
        carried[row.part] = carry
        count, value = carry[1:] if conv == carry[0] else (0, 0)
        carry = (conv, count + nth + 1, (value * pow(_BASE, nth + 1, _PRIME) + int(after, 16)) % _PRIME)
    shared = spark.sparkContext.broadcast(carried)

    def joined(batches):
        carries = shared.value
        for batch in batches:
            depths, nodes, parents = [], [], []
            conv_of, _, _, part_of, nth_of, before_of, after_of = (c.to_pylist() for c in batch.columns)
            for own, part, nth, before, after in zip(conv_of, part_of, nth_of, before_of, after_of):
                conv, count, value = carries[part]
                if own == conv and count:
                    value = value * pow(_BASE, nth, _PRIME) % _PRIME
                    before = f"{(value + int(before, 16)) % _PRIME:032x}"
                    after = f"{(value * _BASE + int(after, 16)) % _PRIME:032x}"
                    nth += count
                depths.append(nth)
                nodes.append(after)
                parents.append(before if nth else None)
            made = [pa.array(depths, pa.int64()), pa.array(nodes, pa.string()), pa.array(parents, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=[*batch.schema.names[:3], "depth", "node_id", "parent_id"])

    schema = StructType([*ordered.schema.fields]).add("depth", "long").add("node_id", "string").add("parent_id", "string")
    return frozen(runs.select("conv", "conv_id", "turn_hash", "part", "nth", "before", "after").mapInArrow(joined, schema), "chat-prefixes")


def _leaves(steps: DataFrame) -> DataFrame:
    """``leaf_id, path``: by their paths the leaves stand depth-first.

    A path names the turns after nodes that go on in several ways (or also end).
    Each such node needs a different conversation as long as the way to it, so n
    turns in all make paths of at most the root of 2n names.
    """
    nodes = steps.groupBy("node_id").agg(F.first("parent_id").alias("parent_id"))
    ways = nodes.select("parent_id").union(steps.select("leaf_id").distinct()).dropna()
    branching = ways.groupBy("parent_id").count().filter("count > 1").select("parent_id")
    named = steps.filter("depth > 0").join(branching, "parent_id", "left_semi").select("leaf_id", "depth", "turn_hash")
    named = named.union(steps.filter("depth = 0").select("leaf_id", "depth", "turn_hash"))
    names = F.sort_array(F.collect_list(F.struct("depth", "turn_hash")))
    path = F.array_join(F.transform(names, lambda t: t["turn_hash"]), "")
    return frozen(named.groupBy("leaf_id").agg(path.alias("path")), "chat-paths")


def _segments(turns: DataFrame, codec: tuple[str | None, bytes | None]) -> DataFrame:
    """Each different turn, formatted and encoded part by part, so that parts meet at token borders."""
    single = turns.groupBy("turn_hash").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    shared = turns.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        own, marks = None, {}
        for batch in batches:
            own = own or _codec(*shared.value)
            columns: tuple[list, ...] = ([], [], [], [])
            for role, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts = turn_parts(role, text)
                for mark in (parts[0], parts[2]):
                    if mark not in marks:
                        if len(marks) >= _HEADS:
                            marks.clear()
                        marks[mark] = own.encode(mark)
                head, body, end = marks.get(parts[0]) or own.encode(parts[0]), own.encode(parts[1]), marks[parts[2]]
                seen = len(body) if role == ASSISTANT else 0
                for values, value in zip(columns, (head + body + end, len(head) + len(body) + len(end), len(head), len(head) + seen)):
                    values.append(value)
            kinds = (pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["turn_hash", "ids", "length", "loss_start", "loss_end"],
            )

    return single.mapInArrow(run, "turn_hash string, ids array<int>, length bigint, loss_start bigint, loss_end bigint")


def _placed(steps: DataFrame, segments: DataFrame) -> DataFrame:
    """``node_id, owner, depth, turn_hash, length, place``: places count tokens through all trees.

    A node belongs to the first conversation on it, so that by owner and depth
    the nodes stand depth-first.
    """
    nodes = steps.groupBy("node_id").agg(
        F.min("rank").alias("owner"), F.min("depth").alias("depth"), F.first("turn_hash").alias("turn_hash")
    )
    sized = nodes.join(segments.select("turn_hash", "length"), "turn_hash")
    width = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = sized.repartitionByRange(width, "owner", "depth").sortWithinPartitions("owner", "depth")

    def run(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            ends = seen + np.cumsum(lengths)
            seen = int(ends[-1]) if len(ends) else seen
            parts = pa.array(np.full(batch.num_rows, part), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(ends - lengths, pa.int64())], names=[*batch.schema.names, "part", "within"])

    schema = StructType([*sized.schema.fields]).add("part", "integer").add("within", "long")
    table = frozen(ordered.mapInArrow(run, schema), "chat-places")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = table.groupBy("part").agg(F.sum("length").alias("size"))
    # One row a partition.
    before = sums.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    return table.join(F.broadcast(before), "part").select(
        "node_id", "owner", "depth", "turn_hash", "length", (F.col("before") + F.col("within")).alias("place")
    )


def _attending(steps: DataFrame, placed: DataFrame) -> DataFrame:
    """Tree, parent, place, position and attended intervals of every node, from its owner's path."""
    on_path = steps.select("rank", "node_id").join(placed.select("node_id", "owner", "depth", "length", "place"), "node_id")
    own = (F.col("owner") == F.col("rank")).alias("own")
    width = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_leaf = on_path.select("rank", "depth", "node_id", "length", "place", own)
    by_leaf = by_leaf.repartition(width, "rank").sortWithinPartitions("rank", "depth")
    interval = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = pa.schema(
        [("tree_id", pa.string()), ("node_id", pa.string()), ("parent_id", pa.string()), ("start", pa.int64())]
        + [("position", pa.int64()), ("attends", interval)]
    )

    def run(batches):
        leaf = None
        for batch in batches:
            made = []
            for rank, _, node, length, place, own in zip(*(c.to_pylist() for c in batch.columns)):
                if rank != leaf:
                    leaf, root, root_place, parent, position, attends = rank, node, place, None, 0, []
                start = place - root_place
                if own:
                    made.append((root, node, parent, start, position, [{"start": a, "end": b} for a, b in attends]))
                if attends and attends[-1][1] == start:
                    attends[-1] = (attends[-1][0], start + length)
                elif length:
                    attends.append((start, start + length))
                position += length
                parent = node
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), kinds)], schema=kinds)

    schema = "tree_id string, node_id string, parent_id string, start bigint, position bigint, attends array<struct<start:bigint,end:bigint>>"
    return by_leaf.mapInArrow(run, schema)


def turn_hash(role: Column, text: Column) -> Column:
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, _HASH)


def format_chats(
    conversations: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> ChatForest:
    """Formats all conversations into prefix trees; see ``ChatForest``.

    Turns go by number, null first, equal numbers by their content; a null role
    or text counts as empty, rows with a null conversation are one conversation;
    repeated rows are repeated turns; other columns are ignored; an empty table
    gives empty tables. A conversation is never held together: its turns lie in as many
    tasks as the sort makes of them and stream past one by one; a turn that many share is
    one row after a partial aggregation. The vocabulary is as for packing, but
    special strings in it are ordinary text; without it tokens are code points.
    """
    words, fast = None, None
    if vocabulary:
        with open(vocabulary, encoding="utf-8") as file:
            words = file.read()
        with open(ranks, "rb") as file:
            fast = file.read()
    codec = (words, fast)
    turns = conversations.select(
        column(conversations, conv_col).alias("conv_id"),
        column(conversations, turn_col).alias("turn"),
        F.coalesce(column(conversations, role_col), F.lit("")).alias("role"),
        F.coalesce(column(conversations, text_col), F.lit("")).alias("text"),
    ).withColumn("turn_hash", turn_hash(F.col("role"), F.col("text")))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    prefixes = _prefixes(turns.withColumn("conv", conv))
    by_conv = prefixes.groupBy("conv", "conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.max_by("node_id", "depth").alias("leaf_id")
    )
    members = frozen(by_conv, "chat-members")
    shown = members.groupBy("leaf_id").agg(F.min("conv").alias("conv"))
    walks = frozen(prefixes.drop("conv_id").join(shown, "conv").drop("conv"), "chat-walks")
    leaves = _leaves(walks)
    ranked = _numbered(leaves.select("path")).join(leaves, "path").select("leaf_id", "rank")
    steps = frozen(walks.drop("parent_id").join(ranked, "leaf_id"), "chat-steps")
    segments = frozen(_segments(turns, codec), "chat-segments")
    placed = frozen(_placed(steps, segments), "chat-nodes")
    attending = _attending(steps, placed)
    # Ids last: nothing before moves more than a row of numbers a node.
    nodes = attending.join(placed.select("node_id", "depth", "turn_hash"), "node_id").join(segments, "turn_hash")
    on_leaf = steps.select("leaf_id", "depth", "node_id")
    columns = "tree_id node_id parent_id depth start length position attends ids loss_start loss_end".split()
    return ChatForest(frozen(nodes.select(*columns), "chat-forest"), on_leaf, members.drop("conv"), codec)


def _stretches(begin: Column, end: Column) -> Column:
    return F.sequence(F.floor(begin / STRETCH), F.floor((end - 1) / STRETCH))


def attended(forest: ChatForest) -> DataFrame:
    """``leaf_id, place, node_id, begin, end``: the tokens that the last token of each conversation sees.

    Those are the ones of its leaf's intervals and of the leaf up to its end. ``place`` is
    their place in the tree's sequence, ``begin`` to ``end`` theirs in the node that
    has them. Intervals and nodes meet by the stretches of the sequence that both
    touch, so neither a tree nor a conversation is one group.
    """
    node = forest.nodes.select("tree_id", "node_id", "start", "length", "attends")
    leaves = forest.members.select(F.col("leaf_id").alias("node_id")).distinct()
    own = F.array(F.struct("start", (F.col("start") + F.col("length")).alias("end")))
    seen = node.join(leaves, "node_id").select(
        "tree_id", F.col("node_id").alias("leaf_id"), F.explode(F.concat("attends", own)).alias("s")
    )
    seen = seen.select("tree_id", "leaf_id", F.col("s.start").alias("from"), F.col("s.end").alias("to"))
    seen = seen.filter(F.col("from") < F.col("to")).withColumn("stretch", F.explode(_stretches(F.col("from"), F.col("to"))))
    there = node.select("tree_id", "node_id", "start", (F.col("start") + F.col("length")).alias("stop"))
    there = there.withColumn("stretch", F.explode(_stretches(F.col("start"), F.col("stop"))))
    met = seen.join(there, ["tree_id", "stretch"])
    place, stop = F.greatest("from", "start"), F.least("to", "stop")
    # What meets in several stretches counts in the first.
    met = met.filter((place < stop) & (F.col("stretch") == F.floor(place / STRETCH)))
    return met.select(
        "leaf_id", place.alias("place"), "node_id", (place - F.col("start")).alias("begin"), (stop - F.col("start")).alias("end")
    )


def digests(forest: ChatForest) -> DataFrame:
    """What the forest's tokens say of every conversation, read back through its attention intervals.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``. Each different conversation is read once: the tokens that
    its last one attends to stream past in the order of their places, are decoded,
    parsed and unescaped, and only digests are held.
    """
    spark = forest.nodes.sparkSession
    shared = spark.sparkContext.broadcast(forest.codec)
    node = forest.nodes.select("node_id", "ids", "loss_start", "loss_end")
    whole = (F.col("begin") == 0) & (F.col("end") == F.size("ids"))
    size = (F.col("end") - F.col("begin")).cast("int")
    ids = F.when(whole, F.col("ids")).otherwise(F.slice("ids", (F.col("begin") + 1).cast("int"), size))
    masked = (F.greatest(F.col(edge) - F.col("begin"), F.lit(0)) for edge in ("loss_start", "loss_end"))
    rows = attended(forest).join(node, "node_id").select("leaf_id", "place", ids.alias("ids"), *masked)
    rows = rows.toDF("leaf_id", "place", "ids", "loss_start", "loss_end")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(width, "leaf_id").sortWithinPartitions("leaf_id", "place")
    names = ["leaf_id", "turns_read", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        codec, leaf = None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            codec, ended = codec or _codec(*shared.value), []
            leaves, _, ids_of, *mask = batch.columns
            for own, ids, begin, end in zip(leaves.to_pylist(), _id_lists(ids_of), *(c.to_pylist() for c in mask)):
                if own != leaf:
                    if leaf is not None:
                        ended.append((leaf, count, turns.hexdigest(), seen, loss.hexdigest(), size))
                    leaf, count, seen, size, turns, loss = own, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                # The mask's borders are token borders, so the parts make up the whole.
                before, inside, after = map(codec.decode_bytes, (ids[:begin], ids[begin:end], ids[end:]))
                formatted = (before + inside + after).decode("utf-8", "surrogatepass")
                size += len(formatted)
                for role, text in read_turns(formatted):
                    count += 1
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if inside:
                    masked = unescaped(inside.decode("utf-8", "surrogatepass"))
                    seen += len(masked)
                    loss.update(masked.encode("utf-8", "surrogatepass"))
            if ended:
                yield made(ended)
        if leaf is not None:
            yield made([(leaf, count, turns.hexdigest(), seen, loss.hexdigest(), size)])

    read = ordered.mapInArrow(
        run,
        "leaf_id string, turns_read bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
    return forest.members.join(read, "leaf_id").select(
        "conv_id", F.col("turns_read").alias("n_turns"), "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )
