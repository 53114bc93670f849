"""MinHash near-dedup over many short prefixes of signatures.

A text is lower-cased (A-Z) and its set is that of its 5-word shingles; with fewer words, the whole sequence.
Texts with equal sets are one class. A class has a signature of `SIGNATURE` minima. Each of `TREES` trees takes its own
`DEPTH` places of the signature; classes that agree in them are a region of the tree. That is banding: trees are not sorted, a
region has one depth, and neighbours in an order are not looked at (see README). A region with more than `REGION`
members is cut into parts by hash, and every two parts meet in a task, so all of its members are compared; the work of a
region without links grows with the square of its members. In a region, members are compared by their signatures; likely
links (a superset) give families. Links of a family are confirmed on full sets: members
that are connected already are not compared again, so copies are not expanded to pairs. Families too
large for one task are cut into parts that meet two by two, or, where that makes more copies of a text than there are
trees, confirmed region by region. Components of the confirmed links are the groups.

Null, empty and blank texts have no set and are linked with nothing. Rows without a doc_id keep a null component
and are linked with nothing. Rows of one id with different texts are judged apart; repeated rows agree. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dealgauge.llm.components import connected_components
from dealgauge.llm.scratch import Scratch
from dealgauge.llm.text_arrays import Texts, mix, prefix_sums, range_hashes, slices, window_hashes

SHINGLE = 5
SIGNATURE = 72
TREES = 24
DEPTH = 3
REGION = 512
#: Equal places of two signatures that make a likely link: five deviations below what a similarity of 0.75 gives.
LIKELY = 36
#: A family up to so many classes and shingles is confirmed in one task.
FAMILY, FAMILY_SHINGLES = 1000, 4_000_000
#: The most copies of a text for which the parts of a larger family meet two by two; beyond, all regions confirm.
COPIES = TREES
_RNG = np.random.default_rng(99)
_ODD = _RNG.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(0, 1 << 63, SIGNATURE, dtype=np.uint64)


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts end to end, sorted in each text, and where each text's begin."""
    starts, ends, owner = texts.words()
    words = texts.word_hashes(starts, ends, lower=True)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    sizes = np.diff(first)
    hashes = window_hashes(words, SHINGLE)
    inside = owner[: len(hashes)] == owner[SHINGLE - 1:] if len(hashes) else np.zeros(0, bool)
    hashes, of = hashes[inside], owner[: len(inside)][inside]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        whole = range_hashes(prefix_sums(words), first[short], first[short + 1]) + sizes[short].astype(np.uint64)
        hashes, of = np.concatenate([hashes, mix(whole)]), np.concatenate([of, short])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])]) if len(of) else np.zeros(0, bool)
    return hashes[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.empty((len(starts), SIGNATURE), np.uint32)
    for k in range(SIGNATURE):
        out[:, k] = np.minimum.reduceat((hashes ^ _FLIP[k]) * _ODD[k], starts) >> np.uint64(32)
    return out


def describe(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, set1 and set2 (a 128-bit name of the set) and signature (null without a set)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"), "text")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            hashes, first = shingle_sets(texts)
            sizes = np.diff(first)
            some = np.flatnonzero(sizes)
            names = np.zeros((len(texts), 2), np.uint64)
            signed: list[bytes | None] = [None] * len(texts)
            if len(some):
                for column, flip in enumerate((0, 0x5851F42D4C957F2D)):
                    names[some, column] = np.add.reduceat(mix(hashes ^ np.uint64(flip)), first[some])
                for i, row in zip(some, signatures(hashes, first[some])):
                    signed[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(sizes), pa.array(names[:, 0].view(np.int64)),
                 pa.array(names[:, 1].copy().view(np.int64)), pa.array(signed, pa.binary())],
                names=["doc_id", "text_key", "n_shingles", "set1", "set2", "signature"])

    return docs.mapInArrow(described, "doc_id long, text_key long, n_shingles long, set1 long, set2 long, signature binary")


def _prefix_keys(signature: np.ndarray, tree: np.ndarray, depth: int) -> np.ndarray:
    """A hash of the tree and the first `depth` places of its order."""
    key = mix(tree.astype(np.uint64) + np.uint64(depth << 16))
    rows = np.arange(len(signature))
    for d in range(depth):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ signature[rows, (tree * DEPTH + d) % SIGNATURE].astype(np.uint64))
    return key.view(np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, SIGNATURE)


def first_regions(classes: DataFrame) -> DataFrame:
    """region, tree and node: every class in every tree at the first depth."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, n = _matrix(batch.column("signature")), batch.num_rows
            tree = np.repeat(np.arange(TREES), n)
            keys = np.concatenate([_prefix_keys(sig, tree[t * n:(t + 1) * n], DEPTH) for t in range(TREES)])
            node = pa.chunked_array([batch.column("node")] * TREES).combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(tree.astype(np.int32)), node], names=["region", "tree", "node"])

    return classes.select("node", "signature").mapInArrow(rows, "region long, tree int, node long")


def in_pairs(rows: DataFrame, key: str, parts: Column) -> DataFrame:
    """`rows` (with `node`) with `key` renamed for every two of its `parts` that a row is in: all rows of a key meet."""
    part = F.pmod(F.xxhash64("node"), "parts")
    other = F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: o != F.col("part")))
    met = rows.withColumn("parts", parts.cast("long")).withColumn("part", part).withColumn("other", F.explode(other))
    return met.withColumn(key, F.when(F.col("parts") == 1, F.col(key)).otherwise(
        F.xxhash64(key, F.least("part", "other"), F.greatest("part", "other")))).drop("parts", "part", "other")


def forest_regions(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """region, tree and node of regions with at least two and at most about `REGION` members; larger ones are cut into
    parts of half of it, and every two parts are a region."""
    everywhere = first_regions(classes)
    sizes = everywhere.groupBy("region").count().filter("count > 1")
    parts = F.when(F.col("count") <= REGION, 1).otherwise(F.ceil(2 * F.col("count") / REGION))
    return in_pairs(everywhere.join(sizes, "region"), "region", parts).select("region", "tree", "node")


def by_group(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Whole groups of rows sorted by `key`, several in a table of at least `least` rows."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < least:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left")) if keys[0] <= keys[-1] else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
        count = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def _groups(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    return zip(cuts[:-1], cuts[1:])


def _reach(n: int, near: Callable[[int], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links of a spanning forest: `near(i)` are the members linked with i. Each member is asked once, and only
    those not reached yet are linked anew."""
    waiting = np.ones(n, bool)
    for root in range(n):
        if not waiting[root]:
            continue
        waiting[root] = False
        queue = [root]
        while queue and waiting.any():
            i = queue.pop()
            new = np.flatnonzero(near(i) & waiting)
            waiting[new] = False
            for j in new:
                yield i, int(j)
            queue += new.tolist()


def likely_links(regions: DataFrame, classes: DataFrame) -> DataFrame:
    """a and b: a spanning forest of the likely links of every region."""
    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _matrix(batch.column("signature")).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in sig], pa.binary())], names=["node", "low"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, "region", 4 * REGION):
            keys, node = table.column("region").to_numpy(), table.column("node").to_numpy()
            low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint8).reshape(-1, SIGNATURE)
            found = []
            for lo, hi in _groups(keys):
                own = low[lo:hi]
                if hi - lo == 2:
                    if np.count_nonzero(own[0] == own[1]) >= LIKELY:
                        found.append((node[lo], node[lo + 1]))
                elif hi - lo > 2:
                    links = _reach(hi - lo, lambda i: np.count_nonzero(own == own[i], axis=1) >= LIKELY)
                    found += [(node[lo + i], node[lo + j]) for i, j in links]
            if found:
                a, b = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    low = classes.select("node", "signature").mapInArrow(short, "node long, low binary")
    partitions = int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = regions.select("region", "node").join(low, "node").repartition(partitions, "region").sortWithinPartitions("region")
    return rows.mapInArrow(linked, "a long, b long")


def confirmed_links(members: DataFrame) -> DataFrame:
    """a and b: a spanning forest of the confirmed links of every group. `members`: group, node, text."""
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, "group", 200):
            keys = table.column("group").to_numpy()
            for lo, hi in _groups(keys):
                part = table.slice(lo, hi - lo).combine_chunks()
                node = part.column("node").to_numpy()
                sets, sizes = [], []
                for _, texts in slices(iter(part.to_batches())):
                    hashes, first = shingle_sets(texts)
                    sets.append(hashes)
                    sizes.append(np.diff(first))
                size = np.concatenate(sizes)
                _, member = np.unique(np.concatenate(sets), return_inverse=True)
                first = np.concatenate([[0], np.cumsum(size)])
                flag = np.zeros(int(member.max()) + 1 if len(member) else 1, np.int32)

                def near(i: int) -> np.ndarray:
                    own = member[first[i]:first[i + 1]]
                    flag[own] = 1
                    shared = np.add.reduceat(flag[member], first[:-1])
                    flag[own] = 0
                    return 100 * shared >= 75 * (size + size[i] - shared)

                found = [(node[i], node[j]) for i, j in _reach(hi - lo, near)]
                if found:
                    a, b = np.array(found, np.int64).T
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    partitions = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = members.select("group", "node", "text").repartition(partitions, "group").sortWithinPartitions("group")
    return rows.mapInArrow(confirmed, "a long, b long")


def near_duplicate_groups(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id and kept of every row."""
    scratch = Scratch(documents.sparkSession, "near")
    described = scratch.write(describe(documents), "described")
    classes = scratch.write(
        described.filter("n_shingles > 0 and doc_id is not null").groupBy("set1", "set2", "n_shingles")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("m"), F.first("signature").alias("signature"))
        .select("set1", "set2", "n_shingles", F.col("m.doc_id").alias("node"), F.col("m.text_key").alias("node_key"), "signature"), "classes")
    regions = scratch.write(forest_regions(classes, scratch), "regions")
    likely = scratch.write(likely_links(regions, classes).distinct(), "likely")
    families = scratch.write(connected_components(likely, scratch, "family"), "families")
    weights = families.join(classes.select("node", "n_shingles"), "node").groupBy("component").agg(
        F.count("*").alias("classes"), F.sum("n_shingles").alias("shingles"))
    large = (F.col("classes") > FAMILY) | (F.col("shingles") > FAMILY_SHINGLES)
    parts = F.when(large, F.greatest(F.ceil(2 * F.col("classes") / FAMILY), F.ceil(2 * F.col("shingles") / FAMILY_SHINGLES))).otherwise(1)
    weighed = families.join(weights.select("component", parts.alias("parts")), "component")
    small = weighed.filter(F.col("parts") <= COPIES + 1).select(F.col("component").alias("group"), "node", F.col("parts").alias("n"))
    groups = in_pairs(small, "group", F.col("n")).select("group", "node").unionByName(
        regions.join(weighed.filter(F.col("parts") > COPIES + 1).select("node").distinct(), "node", "left_semi")
        .select(F.xxhash64("region").alias("group"), "node"))
    texts = documents.select(
        F.col("doc_id").cast("long").alias("node"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("node_key"), "text")
    chosen = groups.join(classes.select("node", "node_key"), "node")
    members = chosen.join(texts, ["node", "node_key"])
    links = scratch.write(confirmed_links(members).distinct(), "links")
    components = scratch.write(connected_components(links, scratch, "component"), "components")
    scratch.drop("regions", "likely", "families", "links")
    named = classes.select("set1", "set2", "n_shingles", "node").join(components, "node", "left").select(
        "set1", "set2", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    own = described.select("doc_id", "text_key", "n_shingles", "set1", "set2").join(named, ["set1", "set2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return own.select("doc_id", "text_key", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that stay: one document of each group."""
    names = documents.columns
    gone = near_duplicate_groups(documents).filter("not kept").select(
        F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    keyed = documents.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("gone_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("gone_key"))
    return keyed.join(gone, ["gone_id", "gone_key"], "left_anti").select(*[F.col(f"row.`{c}`") for c in names])
