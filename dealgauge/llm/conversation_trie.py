"""Prefix trie of conversations by Spark SQL ROLLUP over positional turn-id columns.

A conversation becomes rows of `COLUMNS` turn ids, one row per block of positions. One aggregate with ROLLUP over
the columns makes all prefixes of all blocks at once; grouping_id tells the depth. A long conversation has further
blocks, keyed by the node that the block before ended in, so the number of jobs does not depend on its length. The
node of a prefix is named by its depth and 128 bits: the xor of hashes of (position, turn id), which a running xor
over blocks gives without walking the tree.

A second ROLLUP sums over subtrees: every node is charged to its smallest member, so the sum of a subtree is the sum
over its members of what they carry from that depth on.

No step gathers a conversation, a node's members or its children in one task: turns are numbered inside
range-partitioned slices and shifted by slice totals; members end in chunks of ids per slice, and only the SHA-256 of
one node, which is sequential by nature, reads that node's chunks in order.

Turns are ordered by turn (null first), then role, then text; equal rows are turns of their own. Null role or text is
empty. Rows without conv_id belong to no conversation and are left out. Very long texts count as one turn with a digest.
Other columns are not read, so their names cannot clash. A table without conversations has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from dealgauge.llm.mixing import word_count
from dealgauge.llm.scratch import Scratch

#: Positional columns of one block.
COLUMNS = 8
#: Blocks whose running totals one task makes.
STRETCH = 1024
#: Conversations that share a base, and the bound of the shared turns.
FAMILY, SHARED = 20, 4
CHUNK_BYTES = 1 << 18
NODE = ["depth", "k1", "k2"]


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of a turn; the length keeps role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))


# --- numbered turns -----------------------------------------------------------------------------------------


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the slice and the number of each row in its conversation's part of the slice; rows come sorted."""
    slice_no, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        sizes = np.diff(np.append(first, len(conv)))
        number = np.arange(1, len(conv) + 1) - np.repeat(first, sizes)
        if conv[0] == last:
            number[: sizes[0]] += seen
        last, seen = conv[-1], int(number[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.full(len(conv), slice_no, np.int32)), pa.array(number.astype(np.int64)),
             batch.column(1), batch.column(2)], names=["conv_id", "slice", "number", "tid", "words"])


def ordered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, slice, number (in the slice), tid, words of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        turn_id(role, text).alias("tid"))
    # only turns that share a place with different ones take their texts along to be ordered
    ties = scratch.write(
        turns.groupBy(F.col("conv_id").alias("t_conv"), F.col("turn").alias("t_turn")).agg(
            F.min("tid").alias("low"), F.max("tid").alias("high")).filter("low <> high").select("t_conv", "t_turn", F.lit(True).alias("tied")), "ties")
    same = (F.col("conv_id") == F.col("t_conv")) & F.col("turn").eqNullSafe(F.col("t_turn"))
    slim = scratch.write(turns.join(ties, same, "left").select(
        "conv_id", "turn", F.when(F.col("tied"), F.col("role")).alias("by_role"), F.when(F.col("tied"), F.col("text")).alias("by_text"),
        "tid", word_count(F.col("text")).alias("words"), F.xxhash64(F.monotonically_increasing_id()).alias("spread")), "slim")
    order = ["conv_id", "turn", "by_role", "by_text", "tid", "spread"]  # null turns come first
    sliced = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "tid", "words")
    return scratch.write(sliced.mapInArrow(
        _numbered, "conv_id long, slice int, number long, tid binary, words long"), "turns")


def rebuilt_turns(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations (conv_id, position from 1, tid, words), and conversations (conv_id, length).

    Conversation c takes the first h turns of conversation c - c % 20, then its own turns after its first h."""
    parts = scratch.write(turns.groupBy("conv_id", "slice").agg(F.max("number").alias("n")), "parts")
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("conv_id").agg(F.sum("n").alias("total"))
    convs = totals.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    bases = totals.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    convs = convs.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("base_total", F.lit(0))))
    convs = scratch.write(convs.select(
        "conv_id", "h", "base", "shared", (F.col("shared") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length")), "convs")
    places = parts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select("conv_id", "slice", "offset").join(
        convs.select("conv_id", "h", "shared"), "conv_id")
    placed = turns.join(places, ["conv_id", "slice"]).withColumn("place", F.col("number") + F.col("offset"))
    own = placed.filter("place > h").select("conv_id", (F.col("place") - F.col("h") + F.col("shared")).alias("position"), "tid", "words")
    heads = placed.filter(f"conv_id % {FAMILY} = 0 and place < {SHARED}").select(
        F.col("conv_id").alias("base"), F.col("place").alias("position"), "tid", "words")
    lent = convs.filter("shared > 0").select("conv_id", "base", "shared").join(heads, "base").filter("position <= shared")
    return own.unionByName(lent.select("conv_id", "position", "tid", "words")), convs.select("conv_id", "length")


# --- blocks -------------------------------------------------------------------------------------------------


def _xor(start: Column, seed: int, columns: int) -> Column:
    """Node hash after all turns that the row's columns hold; columns that are rolled up or beyond the end are null."""
    for k in range(1, columns + 1):
        start = start.bitwiseXOR(_mark(seed, k, columns))
    return start


def _mark(seed: int, k: int, columns: int) -> Column:
    tid = F.col(f"t{k}")
    depth = (F.col("block") * columns + k).cast("long")
    return F.when(tid.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), depth, tid))


def _running(blocks: DataFrame, values: dict[str, Column], combine, backwards: bool = False) -> DataFrame:
    """Adds near_<name> and far_<name>: the combined values of the conversation's blocks before (or after) this one,
    inside its stretch of blocks and beyond it. Stretches are combined first, so that a window holds the blocks of one
    stretch or one row per stretch."""
    marked = blocks.withColumn("stretch", F.floor(F.col("block") / STRETCH))
    turned = (lambda c: F.col(c).desc()) if backwards else F.col
    inside = Window.partitionBy("conv_id", "stretch").orderBy(turned("block")).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("conv_id").orderBy(turned("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    totals = marked.filter(F.col("block_count") > STRETCH).groupBy("conv_id", "stretch").agg(
        *[combine(v).alias(n) for n, v in values.items()])
    totals = totals.select("conv_id", "stretch", *[F.coalesce(combine(n).over(across), zero).alias(f"far_{n}") for n in values])
    near = marked.select("*", *[F.coalesce(combine(v).over(inside), zero).alias(f"near_{n}") for n, v in values.items()])
    return near.join(totals, ["conv_id", "stretch"], "left").fillna(0, [f"far_{n}" for n in values])


def turn_blocks(turns: DataFrame, convs: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """One row per conversation and block: t1.. and w1.. of its turns, the conversation's length, p1 and p2 of the node
    before the block. A conversation without turns has one block without turns."""
    place = (F.col("position") - 1) % columns
    wide = turns.withColumn("block", F.floor((F.col("position") - 1) / columns)).groupBy("conv_id", "block").agg(
        *[F.max(F.when(place == k, F.col("tid"))).alias(f"t{k + 1}") for k in range(columns)],
        *[F.max(F.when(place == k, F.col("words"))).alias(f"w{k + 1}") for k in range(columns)])
    wide = convs.join(wide, "conv_id", "left").withColumn("block", F.coalesce("block", F.lit(0))).withColumn(
        "block_count", F.greatest(F.ceil(F.col("length") / columns), F.lit(1)))
    zero = F.lit(0).cast("long")
    rows = _running(wide, {"p1": _xor(zero, 1, columns), "p2": _xor(zero, 2, columns)}, F.bit_xor)
    return rows.select(
        "conv_id", "length", "block", "block_count",
        *[F.col(f"near_{p}").bitwiseXOR(F.col(f"far_{p}")).alias(p) for p in ("p1", "p2")],
        *[f"{c}{k + 1}" for c in "tw" for k in range(columns)])


def _rollup(blocks: DataFrame, columns: int, measures: list[str]) -> DataFrame:
    """One row per node: block, level (columns that count), depth, p1, p2, t1.. and the measures over its members."""
    tids = ", ".join(f"t{k}" for k in range(1, columns + 1))
    rolled = blocks.sparkSession.sql(
        f"""SELECT block, p1, p2, {tids}, {columns} - bit_count(grouping_id()) AS level, {", ".join(measures)}
            FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP({tids})""", blocks=blocks)
    # level 0 is the node that the block before ended in; a null column is the end of shorter conversations
    is_node = F.when(F.col("level") == 0, F.col("block") == 0)
    for k in range(1, columns + 1):
        is_node = is_node.when(F.col("level") == k, F.col(f"t{k}").isNotNull())
    return rolled.filter(is_node).withColumn("depth", F.col("block") * columns + F.col("level"))


def _at_level(by_level: dict[int, Column]) -> Column:
    picked = None
    for k, value in by_level.items():
        picked = F.when(F.col("level") == k, value) if picked is None else picked.when(F.col("level") == k, value)
    return picked


def trie_nodes(blocks: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """Every node: depth, k1, k2 (its name), parent1, parent2 (its parent's), conv_id, n_convs, words, is_leaf."""
    levels = range(1, columns + 1)
    rolled = _rollup(blocks, columns, [
        "min(conv_id) AS conv_id", "count(*) AS n_convs", "max(length) AS longest", *[f"max(w{k}) AS w{k}" for k in levels]])
    own = {i: _xor(F.col(f"p{i}"), i, columns) for i in (1, 2)}
    return rolled.select(
        "depth", *[own[i].alias(f"k{i}") for i in (1, 2)],
        *[own[i].bitwiseXOR(_at_level({k: _mark(i, k, columns) for k in levels})).alias(f"parent{i}") for i in (1, 2)],
        "conv_id", "n_convs", F.coalesce(_at_level({k: F.col(f"w{k}") for k in levels}), F.lit(0)).alias("words"),
        (F.col("longest") == F.col("depth")).alias("is_leaf"))


def subtree_sums(blocks: DataFrame, nodes: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """conv_id and depth of every node with n_children, n_leaves and saved_tokens of its subtree.

    A node is charged to its smallest member: s<k> what the node in column k saves, r<k> that it is a child, leaf."""
    levels = range(1, columns + 1)
    # the root has place 0 of the first block
    place = F.when(F.col("depth") == 0, 0).otherwise((F.col("depth") - 1) % columns + 1)
    charged = nodes.select(
        "conv_id", F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / columns).alias("block"), place.cast("long").alias("place"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.col("is_leaf").cast("long").alias("leaf"))
    # the child of a node in the last column is in the first column of the next block
    ahead = charged.filter("place = 1 and block > 0").select(
        "conv_id", (F.col("block") - 1).alias("block"), F.lit(columns + 1).cast("long").alias("place"), F.lit(0).cast("long").alias("saved"),
        F.lit(0).cast("long").alias("leaf"))
    zero = F.lit(0).cast("long")
    wide = charged.unionByName(ahead).groupBy("conv_id", "block").agg(
        F.sum("leaf").alias("leaf"),
        *[F.sum(F.when(F.col("place") == k, F.col("saved")).otherwise(zero)).alias(f"s{k}") for k in levels],
        *[F.sum(F.when(F.col("place") == k, 1).otherwise(0)).alias(f"r{k}") for k in range(1, columns + 2)])
    added = ["leaf", *[f"s{k}" for k in levels], *[f"r{k}" for k in range(1, columns + 2)]]
    marked = blocks.drop(*[f"w{k}" for k in levels]).join(wide, ["conv_id", "block"], "left").fillna(0, added)
    whole = sum((F.col(f"s{k}") for k in levels), zero)
    carried = _running(marked, {"s": whole, "leaf": F.col("leaf")}, F.sum, backwards=True)
    later, leaves = F.col("near_s") + F.col("far_s"), F.col("leaf") + F.col("near_leaf") + F.col("far_leaf")
    from_level = {k: sum((F.col(f"s{j}") for j in range(k, columns + 1)), later) for k in levels}
    ready = carried.select(
        "conv_id", "block", "p1", "p2", *[f"t{k}" for k in levels], leaves.alias("leaves"),
        *[from_level[k].alias(f"s{k}") for k in levels], *[f"r{k}" for k in range(1, columns + 2)])
    rolled = _rollup(ready, columns, [
        "min(conv_id) AS conv_id", "sum(leaves) AS n_leaves", *[f"sum(s{k}) AS s{k}" for k in levels],
        *[f"sum(r{k}) AS r{k}" for k in range(1, columns + 2)]])
    return rolled.select(
        "conv_id", "depth", _at_level({k: F.col(f"r{k + 1}") for k in range(columns + 1)}).alias("n_children"), "n_leaves",
        _at_level({0: F.col("s1")} | {k: F.col(f"s{k}") for k in levels}).alias("saved_tokens"))


# --- members that end in a node -----------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the sorted ids of each node of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_BYTES // 20):
            part = batch.slice(at, CHUNK_BYTES // 20)
            keys = np.stack([part.column(k).to_numpy() for k in range(3)])
            first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
            ids = part.column(3).to_pylist()
            texts = [",".join(map(str, ids[a:b])) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(ids)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[0, first]), pa.array(keys[1, first]), pa.array(keys[2, first]),
                 pa.array([ids[a] for a in first.tolist()], pa.int64()), pa.array(texts)], names=[*NODE, "first_id", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks; rows come sorted, and only the state of one node is held."""
    key, state = None, None

    def row(key: tuple, state) -> pa.RecordBatch:
        return [*key, state.hexdigest()]

    for batch in batches:
        done = []
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
            if own != key:
                if key is not None:
                    done.append(row(key, state))
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), d)) for d in done])
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip((*NODE, "ends_sha256"), row(key, state)))])


def ending_members(blocks: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """NODE and ends_sha256 of every node in which a conversation ends."""
    ends = blocks.filter("block = block_count - 1").select(
        F.col("length").alias("depth"), *[_xor(F.col(f"p{i}"), i, columns).alias(f"k{i}") for i in (1, 2)], "conv_id")
    order = [*NODE, "conv_id"]
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "depth long, k1 long, k2 long, first_id long, ids string")
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first_id").mapInArrow(
        _digests, "depth long, k1 long, k2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns, convs = rebuilt_turns(ordered_turns(conversations, scratch), scratch)
    blocks = scratch.write(turn_blocks(turns, convs, columns), "blocks")
    nodes = scratch.write(trie_nodes(blocks, columns), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("parent1"), F.col("k2").alias("parent2"),
                           F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(parents, ["depth", "parent1", "parent2"], "left")
        .join(subtree_sums(blocks, nodes, columns), ["conv_id", "depth"])
        .join(ending_members(blocks, columns), NODE, "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
