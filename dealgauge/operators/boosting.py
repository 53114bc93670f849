"""Boosted trees by second-order histograms, several fits in one pass over the rows.

Rows are kept as bin codes: numbers by quantile edges, categories by their place in the sorted list. A row that
belongs to several fits is an entry of each. Per tree level one job sums gradients and Hessians per (fit, node, feature,
bin) over all entries. Features with few bins are counted jointly, a few at a time, and their own sums are taken from the joint
ones. The sums of a feature meet in one task, which finds the feature's best cut of each node; only these
reach the driver, so their number follows from fits, depth and features, not from blocks or bins. A
split of a number sends low bins left; a split of a category sends that one category right, as a 0/1 column would.

Blocks of entries stay in executor memory or on disk. Margins are brought up to date after each tree, in the job of the next
tree's first level. A lost block is made again from the blocks of the trees before, back to the last written ones: all blocks
go to the checkpoint folder every ``KEPT_TREES`` trees.
"""

from __future__ import annotations

import gc
import json
import math
import pickle
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealgauge.operators.ranks import quantiles
from dealgauge.sources.stages import measured

MAX_BINS = 256
#: Entries of one block of rows, the most blocks of one task, and partitions whose sums one task takes.
BLOCK_ENTRIES = 64_000
BLOCKS_PER_TASK = 16
PARTITIONS_PER_SUM = 8
#: The most cells of a node that features are counted in together.
JOINT_CELLS = 1024
#: Splits of a level up to which each split looks at all entries of a block.
SPLITS_BY_MASK = 64
#: Trees after which blocks are written to the checkpoint folder.
KEPT_TREES = 32
UNKNOWN = "Unknown"


@dataclass(frozen=True)
class BoostSettings:
    rounds: int = 300
    depth: int = 5
    step: float = 0.1
    penalty: float = 1.0
    least_hessian: float = 1.0


@dataclass(frozen=True)
class Fit:
    """One model of a pass: its rows and their weights."""

    name: str
    rows: Column
    weight: Column


class BoostedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (of class 0 and 1) from the columns of the fit; saved and loaded like any stage."""

    trees = Param(Params._dummy(), "trees", "features, edges and trees as JSON", TypeConverters.toString)

    def __init__(self, trees: dict | None = None):
        super().__init__()
        if trees is not None:
            self._set(trees=json.dumps(trees))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        told = json.loads(self.getOrDefault(self.trees))
        coded = _coded(dataset, told)
        kinds = coded.drop(*_code_names(told)).schema.add("positive", "double")
        scored = coded.mapInArrow(partial(_scored, told=told), kinds)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("positive"), F.col("positive")))).drop("positive")


def _code_names(told: dict) -> list[str]:
    return [f"__code{k}" for k in range(len(told["features"]))]


def _coded(rows: DataFrame, told: dict) -> DataFrame:
    """Adds a column per feature: the filled number, or the place of the category (-1 if unknown to the fit)."""
    columns = {}
    for name, feature in zip(_code_names(told), told["features"]):
        if feature["kind"] == "number":
            columns[name] = F.coalesce(F.col(f"`{feature['name']}`").cast("double"), F.lit(feature["fill"]))
        else:
            known = F.coalesce(F.col(f"`{feature['name']}`"), F.lit(UNKNOWN))
            columns[name] = _place(known, feature["levels"]).cast("double")
    return rows.withColumns(columns)


def _place(value: Column, levels: Sequence[str]) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in levels]), value) - 1, F.lit(-1))


def _bins(values: np.ndarray, feature: dict) -> np.ndarray:
    if feature["kind"] == "number":
        return np.searchsorted(np.array(feature["edges"]), values, "left")
    return values.astype(np.int64)


def _kind(features: Sequence[dict]) -> type:
    """The smallest integers that hold the codes of all features, and -1."""
    return np.min_scalar_type(-max(bins_of(features), default=1) - 1)


def bins_of(features: Sequence[dict]) -> list[int]:
    return [len(f["edges"]) + 1 if f["kind"] == "number" else len(f["levels"]) for f in features]


def _scored(batches: Iterator[pa.RecordBatch], told: dict) -> Iterator[pa.RecordBatch]:
    names, kind = _code_names(told), _kind(told["features"])
    trees = [{k: np.array(v)[None] for k, v in t.items()} for t in told["trees"]]
    for batch in batches:
        codes = [_bins(batch.column(n).to_numpy(zero_copy_only=False), f).astype(kind) for n, f in zip(names, told["features"])]
        codes = np.stack(codes) if codes else np.zeros((0, batch.num_rows), int)
        margin = np.zeros(batch.num_rows)
        which, is_number = np.zeros(batch.num_rows, int), np.array([f["kind"] == "number" for f in told["features"]])
        for tree in trees:
            margin += tree["value"][0].take(_leaf(tree, which, codes, is_number, told["depth"]))
        kept = [k for k, n in enumerate(batch.schema.names) if n not in names]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in kept], pa.array(1 / (1 + np.exp(-margin)))], names=[*[batch.schema.names[k] for k in kept], "positive"])


def _leaf(tree: dict[str, np.ndarray], fit: np.ndarray, codes: np.ndarray, is_number: np.ndarray, depth: int) -> np.ndarray:
    """Node of each entry after at most ``depth`` steps; tree arrays are (fit, node), node k has children 2k + 1, 2k + 2."""
    fits = len(tree["feature"])
    node = np.zeros(codes.shape[1], np.min_scalar_type((2 << depth) - 1))
    entry = None
    for level in range(depth):
        first = (1 << level) - 1
        of_fit, place = np.nonzero(tree["feature"][:, first:2 * first + 1] >= 0)
        if len(place) > SPLITS_BY_MASK:
            entry = np.arange(len(node)) if entry is None else entry
            feature, cut = tree["feature"][fit, node], tree["cut"][fit, node]
            code = codes[feature, entry]
            right = np.where(is_number[feature], code > cut, code == cut)
            node = np.where(feature >= 0, 2 * node + 1 + right, node).astype(node.dtype)
            continue
        # 1 for entries that go left, 2 for those that go right
        turn = np.zeros(len(node), np.uint8)
        for i, k in zip(of_fit.tolist(), (first + place).tolist()):
            feature, cut = int(tree["feature"][i, k]), int(tree["cut"][i, k])
            right = codes[feature] > cut if is_number[feature] else codes[feature] == cut
            here = node == k
            if fits > 1:
                here &= fit == i
            turn += here.view(np.uint8) * (right.view(np.uint8) + np.uint8(1))
        node = np.where(turn > 0, 2 * node + turn, node)
    return node.astype(np.int64)


# --- blocks of entries ---------------------------------------------------------------------------------------


def _joints(sizes: Sequence[int]) -> list[list[int]]:
    """Features in groups whose bins multiply to at most ``JOINT_CELLS``, or of one feature."""
    groups: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        for group in groups:
            if math.prod(sizes[j] for j in group) * sizes[k] <= JOINT_CELLS:
                group.append(k)
                break
        else:
            groups.append([k])
    return groups


def _packed(batches: Iterator[pa.RecordBatch], features: list[dict], names: list[str], fits: int) -> Iterator[pa.RecordBatch]:
    """Blocks of a partition: fit, codes, joint codes, target, weight."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    whole, sizes = pa.Table.from_batches(tables), bins_of(features)
    groups = _joints(sizes)
    widest = max(math.prod(sizes[k] for k in group) for group in groups)
    for start in range(0, whole.num_rows, BLOCK_ENTRIES):
        table = whole.slice(start, BLOCK_ENTRIES)
        codes = [_bins(table.column(n).to_numpy(), f) for n, f in zip(names, features)]
        joint = np.stack([
            np.ravel_multi_index([codes[k] for k in group], [sizes[k] for k in group]).astype(np.min_scalar_type(widest)) for group in groups])
        block = {
            "fit": table.column("fit").to_numpy().astype(np.min_scalar_type(fits - 1)), "codes": np.stack(codes).astype(np.min_scalar_type(max(sizes) - 1)),
            "joint": joint, "target": table.column("target").to_numpy().astype(np.int8), "weight": table.column("weight").to_numpy()}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])


def _opened(row) -> dict:
    block = pickle.loads(bytes(row[0]))
    return block | {"margin": np.zeros(len(block["fit"]))}


def _settled() -> None:
    """A worker collects garbage after every task; what it has loaded by its first one is left out of that from then on."""
    if not gc.get_freeze_count():
        gc.freeze()


def _moved(block: dict, tree: dict, is_number: np.ndarray, depth: int) -> dict:
    """The block with the margins after one more tree."""
    return block | {"margin": block["margin"] + tree["value"][block["fit"], _leaf(tree, block["fit"], block["codes"], is_number, depth)]}


def _histograms(
    number: int, blocks: Iterator[dict], tree: dict, level: int, sizes: Sequence[int], is_number: np.ndarray,
) -> Iterator[tuple[int, tuple[int, np.ndarray]]]:
    """Per feature the gradient and Hessian sums (2, fits, nodes of the level, bins and the node's totals) of a partition."""
    _settled()
    fits, first, width = len(tree["feature"]), (1 << level) - 1, 1 << level
    groups = _joints(sizes)
    cells = [math.prod(sizes[k] for k in group) for group in groups]
    sums = [np.zeros((2, fits * width * n)) for n in cells]
    for block in blocks:
        positive = 1 / (1 + np.exp(-block["margin"]))
        values = (block["weight"] * (positive - block["target"]), block["weight"] * np.maximum(positive * (1 - positive), 1e-16))
        node = _leaf(tree, block["fit"], block["codes"], is_number, level) - first
        place, joint = block["fit"].astype(np.int64) * width + node, block["joint"]
        if (node < 0).any():
            here = np.flatnonzero(node >= 0)
            place, joint, values = place[here], joint[:, here], [v[here] for v in values]
        for out, n, code in zip(sums, cells, joint):
            key = place * n
            key += code
            for i in range(2):
                out[i] += np.bincount(key, values[i], out.shape[1])
    # one total of a node, whatever its features
    total = sums[0].reshape(2, fits, width, -1).sum(-1, keepdims=True)
    for out, group in zip(sums, groups):
        out = out.reshape(2, fits, width, *[sizes[k] for k in group])
        for at, k in enumerate(group):
            others = tuple(3 + j for j in range(len(group)) if j != at)
            yield k, (number, np.concatenate([out.sum(others), total], -1))


def _met(found: tuple[int, Iterator[tuple[int, np.ndarray]]], is_number: np.ndarray, settings: BoostSettings) -> tuple[int, dict]:
    """A feature's best cuts over all partitions, whose sums are added in one order."""
    _settled()
    k, parts = found
    return k, best_cuts(sum(s for _, s in sorted(parts, key=lambda part: part[0])), bool(is_number[k]), settings)


def best_cuts(sums: np.ndarray, is_number: bool, settings: BoostSettings) -> dict[str, np.ndarray]:
    """Per (fit, node) the cut of one feature with the largest gain, the sums of both children (left, right) and the total.

    ``sums``: (2, fits, nodes, bins); the last bin holds the node's totals."""
    total, own = sums[..., -1], sums[..., :-1]
    if is_number:
        left = np.cumsum(own, -1)[..., :-1]
        right = total[..., None] - left
    else:
        right = own
        left = total[..., None] - right
    if not left.shape[-1]:
        nothing = np.zeros(total.shape)
        return {"gain": np.full(total.shape[1:], -np.inf), "cut": np.zeros(total.shape[1:], np.int64), "left": nothing, "right": nothing, "total": total}

    def score(s: np.ndarray) -> np.ndarray:
        return s[0] ** 2 / (s[1] + settings.penalty)

    gain = score(left) + score(right) - score(total)[..., None]
    gain = np.where((left[1] >= settings.least_hessian) & (right[1] >= settings.least_hessian), gain, -np.inf)
    cut = gain.argmax(-1)
    sides = [np.take_along_axis(s, cut[None, ..., None], -1)[..., 0] for s in (left, right)]
    return {"gain": np.take_along_axis(gain, cut[..., None], -1)[..., 0], "cut": cut, "left": sides[0], "right": sides[1], "total": total}


def best_splits(found: Sequence[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Per (fit, node) the split of largest gain over the best cuts of all features; the first of equal ones."""
    shape = found[0]["gain"].shape
    best = {"gain": np.zeros(shape), "feature": np.full(shape, -1), "cut": np.zeros(shape, np.int64), "left": np.zeros((2, *shape)), "right": np.zeros((2, *shape))}
    for k, own in enumerate(found):
        better = own["gain"] > best["gain"] + 1e-9
        best["feature"] = np.where(better, k, best["feature"])
        for name in ("gain", "cut", "left", "right"):
            best[name] = np.where(better, own[name], best[name])
    return best


# --- fits ----------------------------------------------------------------------------------------------------


def _features(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], max_bins: int) -> list[dict]:
    """Quantile edges of the numbers and sorted levels of the categories over all rows."""
    probabilities = [k / max_bins for k in range(1, max_bins)]
    edges = rows.approxQuantile(list(numeric), probabilities, 0.1 / max_bins) if numeric else []
    found = rows.agg(*[F.array_sort(F.collect_set(F.coalesce(c, F.lit(UNKNOWN)))).alias(c) for c in categorical]).first() if categorical else {}
    return [
        *[{"name": c, "kind": "number", "edges": sorted(set(e))} for c, e in zip(numeric, edges)],
        *[{"name": c, "kind": "category", "levels": list(found[c])} for c in categorical]]


def fit_boosters(
    rows: DataFrame, fits: Sequence[Fit], numeric: Sequence[str], categorical: Sequence[str], target: str,
    settings: BoostSettings = BoostSettings(), max_bins: int = MAX_BINS,
) -> list[BoostedTreesModel]:
    """One model per fit. ``rows`` should be a written table. Missing numbers become the median of the fit's rows."""
    rows = rows.select(*[F.col(c).cast("double").alias(c) for c in numeric], *categorical, F.col(target).cast("double").alias("target"),
                       F.array(*[F.when(f.rows, f.weight.cast("double")) for f in fits]).alias("weights"))
    entries = measured(rows.select("*", F.posexplode("weights").alias("fit", "weight")).drop("weights").filter(
        F.col("weight").isNotNull() & F.col("target").isNotNull()))
    features = _features(entries, numeric, categorical, max_bins)
    fills = [{f["name"]: 0.0 for f in features} for _ in fits]
    for c in numeric:
        for r in quantiles(entries, c, {"m": 0.5}, by=["fit"]).collect():
            fills[r["fit"]][c] = r["m"]
    names = _code_names({"features": features})
    by_fit = {c: F.element_at(F.array(*[F.lit(f[c]) for f in fills]), F.col("fit") + 1) for c in numeric}
    coded = entries.select("fit", "target", "weight", *[
        (F.coalesce(f["name"], by_fit[f["name"]]) if f["kind"] == "number" else _place(F.coalesce(f["name"], F.lit(UNKNOWN)), f["levels"]).cast("double")).alias(n)
        for n, f in zip(names, features)])
    blocks = -(-entries.count() // BLOCK_ENTRIES)
    if not blocks:
        raise ValueError("no rows to fit")
    # a level is a short job: its tasks run at once, as far as they are not too large
    tasks = min(blocks, max(rows.sparkSession.sparkContext.defaultParallelism, -(-blocks // BLOCKS_PER_TASK)))
    packed = measured(coded.repartition(tasks).mapInArrow(partial(_packed, features=features, names=names, fits=len(fits)), "block binary"))
    trees = _grow(packed, len(fits), features, settings)
    return [
        BoostedTreesModel({
            "depth": settings.depth, "features": [f | {"fill": fills[i][f["name"]]} for f in features],
            "trees": [{k: t[k][i].tolist() for k in t} for t in trees]})
        for i in range(len(fits))]


def _grow(packed: DataFrame, fits: int, features: list[dict], settings: BoostSettings) -> list[dict[str, np.ndarray]]:
    is_number = np.array([f["kind"] == "number" for f in features])
    sizes = bins_of(features)
    depth, nodes = settings.depth, (1 << settings.depth + 1) - 1
    state = packed.rdd.map(_opened).persist(StorageLevel.MEMORY_AND_DISK)
    before, meet = None, min(len(features), -(-state.getNumPartitions() // PARTITIONS_PER_SUM))
    trees: list[dict[str, np.ndarray]] = []
    try:
        for _ in range(settings.rounds):
            tree = {"feature": np.full((fits, nodes), -1), "cut": np.zeros((fits, nodes), np.int64), "value": np.zeros((fits, nodes))}
            for level in range(depth):
                sums = state.mapPartitionsWithIndex(partial(_histograms, tree=tree, level=level, sizes=sizes, is_number=is_number))
                sums = sums.groupByKey(meet) if state.getNumPartitions() > 1 else sums.mapValues(lambda part: [part])
                found = [own for _, own in sorted(sums.map(partial(_met, is_number=is_number, settings=settings)).collect(), key=lambda f: f[0])]
                if before is not None:
                    before.unpersist()
                    before = None
                first = (1 << level) - 1
                if not level:
                    gradient, hessian = found[0]["total"][..., 0]
                    tree["value"][:, 0] = -settings.step * gradient / (hessian + settings.penalty)
                best = best_splits(found)
                fit, node = np.nonzero(best["feature"] >= 0)
                if not len(fit):
                    break
                at = first + node
                tree["feature"][fit, at], tree["cut"][fit, at] = best["feature"][fit, node], best["cut"][fit, node]
                for k, side in enumerate(("left", "right"), 1):
                    gradient, hessian = best[side][:, fit, node]
                    tree["value"][fit, 2 * at + k] = -settings.step * gradient / (hessian + settings.penalty)
            trees.append(tree)
            if len(trees) < settings.rounds:
                # the next job makes these blocks from the blocks before
                before, state = state, state.map(partial(_moved, tree=tree, is_number=is_number, depth=depth)).persist(StorageLevel.MEMORY_AND_DISK)
                if not len(trees) % KEPT_TREES:
                    state.checkpoint()
    finally:
        state.unpersist()
        if before is not None:
            before.unpersist()
    return trees


# The tasks' functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
