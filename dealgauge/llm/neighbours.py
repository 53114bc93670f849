"""Approximate nearest neighbours by a hash-prefix forest.

Each of `TREES` trees gives a vector a string of 64 bits, the sides of seeded random hyperplanes; a tree is
the array of all strings in order. A query descends in every tree to the longest prefix that it shares with a row
and then ascends in all trees at once, one bit at a time, until its own level, the deepest at which the trees
together hold `need` rows (a row counts once in each tree). `need` is at least `trees * (k + 1)`, so that one tree
alone has `k` others, and large enough for `RECALL` of the true neighbours of a bounded sample of queries (`SAMPLE`),
which are found by brute force; nor does a query stay below the level that so many of them share. A query that finds fewer ascends to level 0, which is all rows. All rows
that share the prefix of the query's level in some tree are scored on their original vectors in double precision.

Rows meet queries by tree and the prefix of the level, rounded up the tree to a multiple of `STEP`; there each query takes
its own run of the sorted strings. A bucket with many rows or queries is cut into blocks of at most
`BLOCK` rows and `QUERIES` queries, so a hot bucket is many small tasks and nothing is left out. Equal vectors
have equal scores, so only the `k + 1` smallest ids of a vector are candidates. Null, zero and non-finite vectors
take no part; a null id takes no part either. Vectors of another length than the most common one take no part.
With no rows the result is empty; repeated rows of one id count as one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from dealgauge.llm.scratch import Scratch

TREES = 20
BITS = 64
SAMPLE = 100
RECALL = 0.97
BLOCK = 4096
QUERIES = 1024
#: Strings of a block when only counts are wanted, and the most bits by which they are dealt out.
STRINGS, SPREAD = 1 << 17, 10
STEP = 4
SEED = 7


def _planes(width: int, trees: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((width, trees * BITS)).astype(np.float32)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def hash_strings(x: np.ndarray, trees: int) -> np.ndarray:
    """(rows, trees) strings of 64 bits, the first plane in the highest bit; vectors are scaled first."""
    unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    sides = (unit @ _planes(x.shape[1], trees)) > 0
    packed = np.packbits(sides.reshape(len(x), trees, BITS), axis=2)
    return packed.view(">u8").astype(np.uint64).reshape(len(x), trees)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id and vector (doubles as bytes) of the rows that take part, one row per id."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.filter(
        "vec_id is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null)"
        " and not exists(v, x -> isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.concatenate([[0], np.cumsum(batch.column("width").to_numpy())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("width"), pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())],
                names=["vec_id", "width", "vector"])

    return rows.withColumn("width", F.size("v")).mapInArrow(packed, "vec_id long, width int, vector binary").dropDuplicates(["vec_id"])


def _prefixes(strings: np.ndarray, level: int) -> np.ndarray:
    return (strings >> np.uint64(BITS - level)).astype(np.int64) if level else np.zeros(len(strings), np.int64)


def _strings(rows: DataFrame, width: int, trees: int, vectors: bool = True) -> DataFrame:
    """A row for each tree: tree, string, the other columns of `rows`, with or without the vector."""
    kept = [c for c in rows.columns if vectors or c != "vector"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                h = hash_strings(_matrix(part.column("vector"), width), trees)
                n = part.num_rows
                again = part.take(pa.array(np.tile(np.arange(n), trees)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.arange(trees, dtype=np.int32), n)), pa.array(h.T.reshape(-1).view(np.int64)),
                     *(again.column(c) for c in kept)], names=["tree", "string", *kept])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in kept)
    return rows.mapInArrow(hashed, f"tree int, string long, {fields}")


def _prefix(level: int | Column) -> Column:
    """The first `level` bits of `string` as a number."""
    level = F.lit(level) if isinstance(level, int) else level
    return F.when(level == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", F.col("string"), (BITS - level).cast("int")))


def _meeting(left: DataFrame, right: DataFrame, keys: list[str], block: int, sets: int, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with `block` and `set`, so that each row of a bucket meets each query of it once.
    `counts`: keys, n and m of the buckets, written."""
    counts = counts.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("sets", F.ceil(F.col("m") / sets).cast("int")).drop("n", "m")
    rows = left.join(counts, keys).withColumn("block", F.pmod(F.xxhash64("string", "tie"), "blocks").cast("int")).withColumn(
        "set", F.explode(F.sequence(F.lit(0), F.col("sets") - 1))).drop("blocks", "sets")
    asked = right.join(counts, keys).withColumn("set", F.pmod(F.xxhash64("vec_id"), "sets").cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "sets")
    return rows, asked


def _profiles(index: DataFrame, queries: DataFrame, width: int, trees: int, scratch: Scratch) -> DataFrame:
    """vec_id, depth, n, found: the rows of all trees whose common prefix with the query has exactly `depth` bits, and at least so many."""
    left = scratch.write(_strings(index, width, trees, False).groupBy("tree", "string").agg(F.count("*").alias("tie")), "strings")
    spread = max(0, min(SPREAD, (left.count() // trees // STRINGS).bit_length()))
    left, right = left.withColumn("prefix", _prefix(spread)), _strings(queries, width, trees, False).withColumn("prefix", _prefix(spread))
    keys = ["tree", "prefix"]
    held = scratch.write(left.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("tie").alias("rows")), "held")
    counts = scratch.write(right.groupBy(*keys).agg(F.count("*").alias("m")).join(held.drop("rows"), keys, "left")
                           .withColumn("n", F.coalesce("n", F.lit(1))), "asked_counts")
    whole = np.zeros((trees, 1 << spread), np.int64)
    for row in held.select("tree", "prefix", "rows").collect():  # at most trees * 2 ** SPREAD rows
        whole[row["tree"], row["prefix"]] = row["rows"]
    above = [whole.reshape(trees, 1 << level, -1).sum(axis=2) for level in range(spread + 1)]
    shared = index.sparkSession.sparkContext.broadcast(above)

    def counted(key: tuple, found: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        q = wanted["string"].to_numpy().view(np.uint64)
        found = found.assign(string=found["string"].to_numpy().view(np.uint64)).sort_values("string")
        strings, sums = found["string"].to_numpy(), np.concatenate([[0], np.cumsum(found["tie"].to_numpy(np.int64))])
        deeper, parts = np.zeros(len(q), np.int64), []
        for depth in range(BITS, -1, -1):
            if depth >= spread:
                mask = np.uint64((1 << (BITS - depth)) - 1)
                held = sums[np.searchsorted(strings, q | mask, "right")] - sums[np.searchsorted(strings, q & ~mask, "left")]
            elif key[2] == 0:  # other buckets, told by one block only
                levels, prefix = shared.value, _prefixes(q, depth)
                held = deeper + levels[depth][key[0], prefix] - levels[depth + 1][key[0], _prefixes(q, depth + 1)]
            else:
                break
            some = np.flatnonzero(held > deeper)
            parts.append(pd.DataFrame({"vec_id": wanted["vec_id"].to_numpy()[some], "depth": np.full(len(some), depth, np.int32), "n": (held - deeper)[some]}))
            deeper = held
        return pd.concat(parts)

    rows, asked = _meeting(left, right, keys, STRINGS, STRINGS, counts)
    by = [*keys, "block", "set"]
    told = rows.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(counted, "vec_id long, depth int, n long")
    told = told.groupBy("vec_id", "depth").agg(F.sum("n").alias("n"))
    return scratch.write(told.withColumn("found", F.sum("n").over(Window.partitionBy("vec_id").orderBy(F.desc("depth")))), "profiles")


def _best(q_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the k best of a block, ties to the smaller id; its own row is left out."""
    scores = np.where(q_ids[:, None] == ids[None, :], -np.inf, scores)
    order = np.argsort(ids, kind="stable")
    ids, scores = ids[order], scores[:, order]
    if scores.shape[1] > k:
        edge = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
        keep = scores >= edge[:, None]
    else:
        keep = np.ones_like(scores, bool)
    keep &= scores > -np.inf
    row, col = np.nonzero(keep)
    value = scores[row, col]
    by = np.lexsort((ids[col], -value, row))
    row, col, value = row[by], col[by], value[by]
    nth = np.arange(len(row)) - np.searchsorted(row, row, "left")
    first = nth < k
    return q_ids[row[first]], ids[col[first]], value[first]


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, each summed over its components in their order, so that a pair's score does not
    depend on the block that it is in."""
    total = np.zeros((len(q), len(x)))
    for i in range(q.shape[1]):
        total += q[:, i, None] * x[None, :, i]
    return total


def _fit_need(index: DataFrame, queries: DataFrame, profiles: DataFrame, width: int, trees: int, k: int, recall: float, sample: int) -> tuple[int, int]:
    """How many rows the trees together have to hold at a query's level, and the deepest level of any query."""
    least = trees * (k + 1)
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    if not len(chosen):
        return least, 0
    ids = chosen["vec_id"].to_numpy()
    q = np.frombuffer(b"".join(chosen["vector"]), np.float64).reshape(-1, width)
    shared = index.sparkSession.sparkContext.broadcast((ids, q))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_x = shared.value
        q_h = hash_strings(q_x, trees)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                x, v = _matrix(part.column("vector"), width), part.column("vec_id").to_numpy()
                a, b, s = _best(q_ids, v, q_x @ x.T, k)
                qi = {i: n for n, i in enumerate(q_ids)}
                vi = {i: n for n, i in enumerate(v)}
                h = hash_strings(x, trees)
                other = h[[vi[i] for i in b]] ^ q_h[[qi[i] for i in a]] if len(a) else np.zeros((0, trees), np.uint64)
                least = other.min(axis=1) if len(a) else np.zeros(0, np.uint64)
                depth = np.array([BITS - int(z).bit_length() for z in least], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(s), pa.array(b), pa.array(depth)], names=["q", "s", "v", "depth"])

    near = index.select("vec_id", "vector").mapInArrow(scored, "q long, s double, v long, depth int")
    top = Window.partitionBy("q").orderBy(F.desc("s"), "v")
    depths = near.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k).select("q", "depth").toPandas()
    if not len(depths):
        return least, 0
    depths["nth"] = np.arange(len(depths))
    told = profiles.filter(F.col("vec_id").isin([int(i) for i in ids])).toPandas()
    # a neighbour is reached where the levels below its depth hold fewer than are needed
    below = depths.merge(told, left_on="q", right_on="vec_id", suffixes=("", "_held"))
    below["n"] = np.where(below["depth_held"] > below["depth"], below["n"], 0)
    needs = np.sort(below.groupby(["q", "nth"])["n"].sum().to_numpy()) + 1
    deepest = int(np.sort(depths["depth"].to_numpy())[int((1 - recall) * len(depths))])
    return max(least, int(needs[min(len(needs) - 1, int(recall * len(needs)))])), deepest


def nearest(index: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, recall: float = RECALL,
            sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of `index` for every row of `queries`.

    Both have the columns of `usable`. A row is no neighbour of the query with its id."""
    spark = index.sparkSession
    scratch = Scratch(spark, "neighbours")
    index = scratch.write(index, "index")
    common = index.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    out = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], out)
    width = common["width"]
    index = index.filter(F.col("width") == width)
    queries = scratch.write(queries.filter(F.col("width") == width).select("vec_id", "vector"), "queries")
    first = Window.partitionBy("vector").orderBy("vec_id")
    distinct = scratch.write(index.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1).select("vec_id", "vector"), "distinct")
    profiles = _profiles(distinct, queries, width, trees, scratch)
    need, deepest = _fit_need(distinct, queries, profiles, width, trees, k, recall, sample)
    levels = profiles.filter(F.col("found") >= need).groupBy("vec_id").agg(F.max("depth").alias("level"))
    levelled = scratch.write(
        queries.join(levels, "vec_id", "left").withColumn("level", F.least(F.coalesce("level", F.lit(0)), F.lit(deepest)))
        .withColumn("base", (F.col("level") - F.col("level") % STEP).cast("int")), "levelled")
    bases = sorted(r["base"] for r in levelled.select("base").distinct().collect())  # at most 17
    if not bases:
        return spark.createDataFrame([], out)
    keys = ["tree", "base", "prefix"]
    right = _strings(levelled, width, trees).withColumn("prefix", _prefix(F.col("base")))
    names = _strings(distinct, width, trees, False).withColumn("base", F.explode(F.array(*map(F.lit, bases)))).withColumn("prefix", _prefix(F.col("base")))
    asked_counts = _strings(levelled, width, trees, False).withColumn("prefix", _prefix(F.col("base"))).groupBy(*keys).agg(F.count("*").alias("m"))
    counts = scratch.write(names.groupBy(*keys).agg(F.count("*").alias("n")).join(asked_counts, keys), "counts")
    left = _strings(distinct, width, trees).withColumn("tie", F.col("vec_id")).withColumn(
        "base", F.explode(F.array(*map(F.lit, bases)))).withColumn("prefix", _prefix(F.col("base")))
    rows, asked = _meeting(left, right, keys, BLOCK, QUERIES, counts)
    by = [*keys, "block", "set"]

    def search(found: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(found) or not len(wanted):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = found.assign(string=found["string"].to_numpy().view(np.uint64)).sort_values("string")
        strings, ids = found["string"].to_numpy(), found["vec_id"].to_numpy()
        x = np.frombuffer(b"".join(found["vector"]), np.float64).reshape(-1, width)
        q = np.frombuffer(b"".join(wanted["vector"]), np.float64).reshape(-1, width)
        q_ids, at = wanted["vec_id"].to_numpy(), wanted["string"].to_numpy().view(np.uint64)
        level = wanted["level"].to_numpy(np.int64)
        mask = np.array([(1 << (BITS - d)) - 1 for d in range(BITS + 1)], np.uint64)[level]
        lo, hi = np.searchsorted(strings, at & ~mask, "left"), np.searchsorted(strings, at | mask, "right")
        parts = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []})]
        runs, of = np.unique(np.stack([lo, hi], axis=1), axis=0, return_inverse=True)
        of = of.ravel()
        for i, (a, b) in enumerate(runs):
            if a < b:
                own = np.flatnonzero(of == i)
                c, d, s = _best(q_ids[own], ids[a:b], _products(q[own], x[a:b]), k)
                parts.append(pd.DataFrame({"query_id": c, "vec_id": d, "score": s}))
        return pd.concat(parts[1:] or parts)

    found = rows.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
