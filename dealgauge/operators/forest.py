"""Random forest for two classes by histograms; all trees grow together, one job a level.

Rows are kept as bin codes: numbers by quantile edges, categories by their index. A number is a column, and so is each value of a
category (0/1). Each tree draws a bag: how often a row counts is Poisson(1), from the row's id, the tree and the seed, so it does
not depend on tasks or their order. Each node draws the square root of the columns, rounded up, from seed, tree and level, and is
split where the Gini impurity falls most.

A task takes its rows through the trees one after the other: down to the open nodes, and into sums of weights per (node, class,
bin). Only the sums of drawn columns leave it. They meet in one task per tree and a few nodes, which finds the best cuts; these reach
the driver, so their number follows from the trees' nodes. Nodes of one class and nodes at full depth are leaves.
"""

from __future__ import annotations

import base64
import io
import json
import math
import pickle
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealgauge.operators.boosting import _bins, _settled, bins_of
from dealgauge.sources.stages import measured

#: Open nodes of a tree whose sums meet in one task.
NODES_PER_SUM = 256
#: Shares of a node's weight, and differences of impurity, that count as 0: sums in another order pick the same cuts.
NOTHING = 1e-10


@dataclass(frozen=True)
class ForestSettings:
    trees: int = 200
    depth: int = 12
    seed: int = 42
    max_bins: int = 32


class ForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (of class 0 and 1), the mean share over the trees' leaves; saved and loaded like any stage."""

    fitted = Param(Params._dummy(), "fitted", "inputs, edges and trees as JSON", TypeConverters.toString)

    def __init__(self, told: dict | None = None):
        super().__init__()
        if told is not None:
            self._set(fitted=json.dumps(told))

    def inputs(self) -> list[str]:
        told = json.loads(self.getOrDefault(self.fitted))
        return [told["vector"], *told["indexes"]]

    def trees(self) -> list[dict[str, np.ndarray]]:
        return _trees(json.loads(self.getOrDefault(self.fitted))["trees"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        told = json.loads(self.getOrDefault(self.fitted))
        inputs = _inputs(told["vector"], told["numbers"], told["indexes"])
        coded = dataset.withColumns(inputs)
        kinds = coded.drop(*inputs).schema.add("positive", "double")
        scored = coded.mapInArrow(partial(_scored, told=told), kinds)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("positive"), F.col("positive")))).drop("positive")


def _inputs(vector: str, numbers: int, indexes: Sequence[str]) -> dict[str, Column]:
    columns = [vector_to_array(F.col(vector))[k] for k in range(numbers)] + [F.col(c) for c in indexes]
    return {f"__code{k}": c.cast("double") for k, c in enumerate(columns)}


def _text(trees: Sequence[dict[str, np.ndarray]]) -> str:
    file = io.BytesIO()
    whole = {name: np.concatenate([t[name] for t in trees]) for name in ("feature", "cut", "left", "value")}
    np.savez_compressed(file, nodes=np.array([len(t["value"]) for t in trees]), **whole)
    return base64.b64encode(file.getvalue()).decode()


def _trees(text: str) -> list[dict[str, np.ndarray]]:
    whole = dict(np.load(io.BytesIO(base64.b64decode(text))))
    ends = np.cumsum(whole.pop("nodes"))[:-1]
    return [dict(zip(whole, parts)) for parts in zip(*[np.split(v, ends) for v in whole.values()])]


def _looping(tree: dict[str, np.ndarray], is_number: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, whether it is a number, cut, left child and value per node; a leaf is its own left child and has nothing right."""
    leaf = tree["feature"] < 0
    feature = np.where(leaf, 0, tree["feature"]).astype(np.intp)
    return (
        feature, is_number[feature], np.where(leaf, np.iinfo(np.int32).max, tree["cut"]).astype(np.int32),
        np.where(leaf, np.arange(len(leaf)), tree["left"]).astype(np.intp), tree["value"])


def _scored(batches: Iterator[pa.RecordBatch], told: dict) -> Iterator[pa.RecordBatch]:
    features = told["features"]
    is_number = np.array([f["kind"] == "number" for f in features])
    trees = [_looping(t, is_number) for t in _trees(told["trees"])]
    for batch in batches:
        size, kept = batch.num_rows, batch.num_columns - len(features)
        codes = np.stack([_bins(batch.column(kept + k).to_numpy(zero_copy_only=False), f) for k, f in enumerate(features)])
        codes, entry, positive = codes.astype(np.int32).ravel(), np.arange(size), np.zeros(size)
        for feature, number, cut, left, value in trees:
            node = np.zeros(size, np.intp)
            for _ in range(told["depth"]):
                place = feature.take(node)
                place *= size
                place += entry
                code, at = codes.take(place), cut.take(node)
                right = np.where(number.take(node), code > at, code == at)
                node = left.take(node)
                node += right
            positive += value.take(node)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(k) for k in range(kept)], pa.array(positive / len(trees))], names=[*batch.schema.names[:kept], "positive"])


# --- tasks of a level ----------------------------------------------------------------------------------------


def _packed(batches: Iterator[pa.RecordBatch], features: list[dict]) -> Iterator[pa.RecordBatch]:
    """One block per partition: codes, id hash, target, weight."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    codes = [_bins(table.column(f"__code{k}").to_numpy(), f) for k, f in enumerate(features)]
    block = {
        "codes": np.stack(codes).astype(np.min_scalar_type(max(bins_of(features)) - 1)), "drawn": table.column("drawn").to_numpy().view(np.uint64),
        "target": table.column("target").to_numpy().astype(np.int8), "weight": table.column("weight").to_numpy()}
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], names=["block"])


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Poisson(1) by its distribution function, as far as 32 bits tell it from 1.
POISSON = [np.uint32(v) for v in (
    int(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) * 2 ** 32) for k in range(13)) if v < 2 ** 32 - 1]


def bag(drawn: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row counts in a tree."""
    stream = np.random.SeedSequence([seed, tree]).generate_state(1, np.uint64)
    level = (_mixed(drawn + stream) >> np.uint64(32)).astype(np.uint32)
    count = np.zeros(len(drawn), np.uint8)
    for v in POISSON:
        count += level >= v
    return count


def drawn_columns(seed: int, tree: int, level: int, nodes: int, columns: int) -> np.ndarray:
    """Per open node of a level which columns it may be split by."""
    most = math.ceil(math.sqrt(columns))
    numbers = np.random.default_rng([seed, tree, level]).random((nodes, columns))
    drawn = np.zeros((nodes, columns), bool)
    np.put_along_axis(drawn, numbers.argpartition(most - 1, 1)[:, :most], True, 1)
    return drawn


def _by_feature(drawn: np.ndarray, features: list[dict]) -> list[np.ndarray]:
    """Of numbers who drew them, of categories who drew which values."""
    parts, first = [], 0
    for f in features:
        wide = 1 if f["kind"] == "number" else len(f["levels"])
        parts.append(drawn[:, first] if f["kind"] == "number" else drawn[:, first:first + wide])
        first += wide
    return parts


def columns_of(features: list[dict]) -> int:
    return sum(1 if f["kind"] == "number" else len(f["levels"]) for f in features)


def _turns(grown: dict, is_number: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature of each open node of a level, and the open node of the next level per (node, code). The last node of each level is
    where rows go that have reached a leaf."""
    feature, code = np.maximum(grown["feature"], 0), np.arange(wide)
    cut = grown["cut"][:, None]
    right = np.where(is_number[feature][:, None], code > cut, code == cut)
    turns = np.where(right, grown["right"][:, None], grown["left"][:, None])
    return np.append(feature, 0).astype(np.intp), np.append(turns, np.full(wide, grown["next"])).astype(np.intp)


def _sums(
    number: int, blocks: Iterator[dict], grown: Broadcast, level: int, features: list[dict], seed: int,
) -> Iterator[tuple[tuple[int, int], tuple[int, list[np.ndarray]]]]:
    """Per tree and some open nodes: their weights (node, class), and weights per bin of what they have drawn, of a partition."""
    _settled()
    blocks, sizes = list(blocks), bins_of(features)
    wide, is_number = max(sizes), np.array([f["kind"] == "number" for f in features])
    for t, levels in enumerate(grown.value):
        opened = levels[-1]["next"] if levels else 1
        if not opened:
            continue
        turns = [_turns(g, is_number, wide) for g in levels]
        sums = [np.zeros(opened * 2 * size) for size in sizes]
        for block in blocks:
            count = bag(block["drawn"], seed, t)
            here = np.flatnonzero(count)
            codes, node, entry = block["codes"].take(here, 1), np.zeros(len(here), np.intp), np.arange(len(here))
            flat = codes.ravel()
            for feature, following in turns:
                place = feature.take(node)
                place *= len(here)
                place += entry
                node *= wide
                node += flat.take(place)
                node = following.take(node)
            if turns and len(node) and node.max() == opened:
                open_still = np.flatnonzero(node < opened)
                here, node, codes = here[open_still], node[open_still], codes.take(open_still, 1)
            node *= 2
            node += block["target"].take(here)
            weight = count.take(here) * block["weight"].take(here)
            for own, size, code in zip(sums, sizes, codes):
                key = node * size
                key += code
                own += np.bincount(key, weight, len(own))
        sums = [own.reshape(opened, 2, size) for own, size in zip(sums, sizes)]
        total, drawn = sums[0].sum(-1), drawn_columns(seed, t, level, opened, columns_of(features))
        for start in range(0, opened, NODES_PER_SUM):
            some = slice(start, start + NODES_PER_SUM)
            parts = [
                own[some][who] if number_ else own[some].transpose(0, 2, 1)[who]
                for own, who, number_ in zip(sums, _by_feature(drawn[some], features), is_number)]
            yield (t, start), (number, [total[some], *parts])


def _met(found: tuple, level: int, counts: Sequence[int], features: list[dict], seed: int) -> tuple[tuple[int, int], dict]:
    """Best cuts of some open nodes over all partitions, whose sums are added in one order."""
    _settled()
    (t, start), parts = found
    parts = [p for _, p in sorted(parts, key=lambda part: part[0])]
    total, *own = [sum(p[k] for p in parts) for k in range(len(parts[0]))]
    drawn = drawn_columns(seed, t, level, counts[t], columns_of(features))[start:start + len(total)]
    return (t, start), best_cuts(total, own, _by_feature(drawn, features), features)


def best_cuts(total: np.ndarray, sums: Sequence[np.ndarray], drawn: Sequence[np.ndarray], features: list[dict]) -> dict[str, np.ndarray]:
    """Per node the cut of largest fall of the Gini impurity (the first of equal ones; feature -1 if there is none), and the
    weights (node, class) of the node and of its right side."""
    nodes, whole = len(total), total.sum(1)
    own_score = np.divide((total ** 2).sum(1), whole, out=np.zeros(nodes), where=whole > 0)
    best = {"feature": np.full(nodes, -1), "cut": np.zeros(nodes, np.int64), "total": total, "rest": np.zeros((nodes, 2))}
    most = np.zeros(nodes)
    for k, (f, own, who) in enumerate(zip(features, sums, drawn)):
        size = len(f["edges"]) + 1 if f["kind"] == "number" else len(f["levels"])
        right = np.zeros((nodes, 2, size))
        if f["kind"] == "number":
            # bins above the cut; nothing is above the last
            right[who] = own[..., ::-1].cumsum(-1)[..., ::-1] - own
        else:
            right.transpose(0, 2, 1)[who] = own
        left = total[:, :, None] - right
        sides = [(s, s.sum(1)) for s in (left, right)]
        valid = (sides[0][1] > NOTHING * whole[:, None]) & (sides[1][1] > NOTHING * whole[:, None])
        score = sum(np.divide((s ** 2).sum(1), w, out=np.zeros(w.shape), where=valid) for s, w in sides)
        fall = np.where(valid, (score - own_score[:, None]) / np.maximum(whole, NOTHING)[:, None], -np.inf)
        cut = (fall >= fall.max(1, keepdims=True) - NOTHING).argmax(1)
        fall = fall[np.arange(nodes), cut]
        better = fall > most + NOTHING
        most = np.where(better, fall, most)
        best["feature"], best["cut"] = np.where(better, k, best["feature"]), np.where(better, cut, best["cut"])
        best["rest"] = np.where(better[:, None], right[np.arange(nodes), :, cut], best["rest"])
    return best


# --- fit -----------------------------------------------------------------------------------------------------


def fit_forest(
    rows: DataFrame, vector: str, numbers: int, indexes: Sequence[str], target: str, weight: Column, key: str,
    settings: ForestSettings = ForestSettings(), blocks: int = 1,
) -> ForestModel:
    """``rows`` have the numbers in a vector column, categories as indexes, and a key that tells rows apart. Rows are kept in
    ``blocks`` parts. Rows without a target are left out."""
    inputs = _inputs(vector, numbers, indexes)
    plain = rows.filter(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("target"), weight.cast("double").alias("weight"), F.xxhash64(key).alias("drawn"),
        *[c.alias(n) for n, c in inputs.items()])
    plain = measured(plain)
    names = list(inputs)
    edges = plain.approxQuantile(
        names[:numbers], [k / settings.max_bins for k in range(1, settings.max_bins)], 0.1 / settings.max_bins) if numbers else []
    told = plain.agg(F.count(F.lit(1)).alias("n"), *[F.max(n).alias(n) for n in names[numbers:]]).first()
    if not told["n"]:
        raise ValueError("no rows to fit")
    features = [{"kind": "number", "edges": sorted(set(e))} for e in edges]
    features += [{"kind": "category", "levels": list(range(int(told[n]) + 1))} for n in names[numbers:]]
    packed = measured(plain.repartition(blocks).mapInArrow(partial(_packed, features=features), "block binary"))
    trees = _grow(packed, features, settings)
    return ForestModel({
        "vector": vector, "numbers": numbers, "indexes": list(indexes), "depth": settings.depth, "features": features, "trees": _text(trees)})


def _grow(packed: DataFrame, features: list[dict], settings: ForestSettings) -> list[dict[str, np.ndarray]]:
    context = packed.sparkSession.sparkContext
    state = packed.rdd.map(lambda row: pickle.loads(bytes(row[0]))).persist(StorageLevel.MEMORY_AND_DISK)
    grown: list[list[dict]] = [[] for _ in range(settings.trees)]
    trees = [{"feature": [], "cut": [], "left": [], "value": []} for _ in range(settings.trees)]
    opened = [np.zeros(1, np.int64) for _ in range(settings.trees)]
    meet = max(1, min(settings.trees, context.defaultParallelism))
    try:
        for level in range(settings.depth):
            if not any(len(o) for o in opened):
                break
            told = context.broadcast(grown)
            sums = state.mapPartitionsWithIndex(partial(_sums, grown=told, level=level, features=features, seed=settings.seed))
            found = dict(sums.groupByKey(meet).map(partial(
                _met, level=level, counts=[len(o) for o in opened], features=features, seed=settings.seed)).collect())
            told.destroy()
            for t, nodes in enumerate(opened):
                if len(nodes):
                    parts = [found[t, start] for start in range(0, len(nodes), NODES_PER_SUM)]
                    cuts = {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}
                    opened[t] = _add_level(trees[t], grown[t], nodes, cuts, level + 1 == settings.depth)
    finally:
        state.unpersist()
    return [{
        "feature": np.array(t["feature"], np.int16), "cut": np.array(t["cut"], np.int32), "left": np.array(t["left"], np.int32),
        "value": np.array(t["value"])} for t in trees]


def _share(weights: np.ndarray) -> list[float]:
    whole = weights.sum(-1)
    return np.divide(weights[..., 1], whole, out=np.zeros(whole.shape), where=whole > 0).tolist()


def _add_level(tree: dict[str, list], grown: list[dict], nodes: np.ndarray, cuts: dict[str, np.ndarray], last: bool) -> np.ndarray:
    """Splits the open nodes of a tree, adds their children and returns those that are open."""
    if not grown:
        for name, value in (("feature", -1), ("cut", 0), ("left", 0), ("value", _share(cuts["total"])[0])):
            tree[name].append(value)
    split = np.flatnonzero(cuts["feature"] >= 0)
    first = len(tree["value"])
    right = cuts["rest"][split]
    children = np.stack([cuts["total"][split] - right, right], 1).reshape(-1, 2)
    for k, at in enumerate(split.tolist()):
        node = int(nodes[at])
        tree["feature"][node], tree["cut"][node], tree["left"][node] = int(cuts["feature"][at]), int(cuts["cut"][at]), first + 2 * k
    tree["feature"] += [-1] * len(children)
    tree["cut"] += [0] * len(children)
    tree["left"] += [0] * len(children)
    tree["value"] += _share(children)
    # nodes of one class are leaves
    stays = (children.min(1) > NOTHING * children.sum(1)) & (not last)
    place = np.where(stays, np.cumsum(stays) - 1, stays.sum()).reshape(-1, 2)
    sides = np.full((len(nodes), 2), stays.sum())
    sides[split] = place
    grown.append({"feature": cuts["feature"], "cut": cuts["cut"], "left": sides[:, 0], "right": sides[:, 1], "next": int(stays.sum())})
    return first + np.flatnonzero(stays)


# The tasks' functions travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
