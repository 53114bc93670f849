"""Best-fit packing of tokenized documents by a grouping genetic algorithm on islands.

A document becomes token ids with an end id; only documents above the capacity are cut. Pieces of full
capacity are sequences of their own. The others are dealt into cells of about `CELL` pieces; each cell is one
packing problem. A chromosome is a list of bins. Several islands evolve a cell at the same time: crossover
injects the best filled bins of one parent into another, bins that hold an injected piece are taken apart, and
the displaced pieces are put back best-fit. After each epoch the best bins of every island migrate to the next
island of the cell (a shuffle). Bins that stay below `GOOD_FILL` in the best chromosome of a cell are taken apart,
and their pieces are packed again in cells of the next round, until one cell holds what is left or `ROUNDS` are over.

Every text has at least its end id, so null and empty texts are pieces of one token. Repeated rows are
pieces of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import gc
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from dealgauge.llm.scratch import Scratch
from dealgauge.llm.token_files import byte_letters

CAPACITY = 2048
END_ID = 0
CELL = 4000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 3
POPULATION = 3
#: Best bins of an island that travel.
ELITE_BINS = 400
GOOD_FILL = 0.995
ROUNDS = 3
#: Words whose ids a task remembers before it starts anew.
REMEMBERED = 1_200_000


class WordTokenizer:
    """Token ids of texts by words between ASCII white space. The tokenizer drops white space and never merges
    across it, so a text's ids are its words' ids one after the other, and a word is encoded once.

    The tokenizer lower-cases a word, cuts it into pieces and encodes each; pieces of words without rare characters go to
    its model one by one and are remembered too. Other words go to the tokenizer whole."""

    # fixed value: how the tokenizer cuts a word into pieces
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    #: Characters that normalization leaves as they are but for their case; white space among them is left out.
    PLAIN = re.compile("[\x21-\x7e\xa1-\u024f]*")
    SAMPLE = "Don't STOP: Él niño's 12, (we'll) go--now... Ça!"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        self.inner = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.special = re.compile("|".join(re.escape(t.content) for t in self.inner.get_added_tokens_decoder().values()) or r"(?!)")
        self.pieces: dict[str, bytes] = {}
        # pieces go to the model alone only where the tokenizer is the one that the rule above describes
        self.bare = True
        self.bare = all(self._word(w.encode()) == self._whole(w) for w in self.SAMPLE.split())
        owner = self

        class Known(dict):
            def __missing__(self, word: bytes) -> bytes:
                if len(self) >= REMEMBERED:
                    self.clear()
                ids = owner._word(word)
                if len(word) < 40:
                    self[word] = ids
                return ids

        self.known = Known()

    def _whole(self, text: str) -> bytes:
        return array("I", self.inner.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if not self.bare or not self.PLAIN.fullmatch(text) or self.special.search(text):
            return self._whole(text)
        found = []
        for piece in self.PIECES.findall(text.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                letters = codecs.charmap_decode(piece.encode(), "strict", self.letters)[0]
                ids = array("I", [t.id for t in self.inner.model.tokenize(letters)]).tobytes()
                if len(piece) < 40:
                    if len(self.pieces) >= REMEMBERED:
                        self.pieces.clear()
                    self.pieces[piece] = ids
            found.append(ids)
        return found[0] if len(found) == 1 else b"".join(found)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        for text in texts:
            yield b"".join(map(self.known.__getitem__, (text or "").encode().split()))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    # a module-level function goes to the worker by name, so its tokenizer serves all tasks there
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    tokenizer, end = _TOKENIZERS[path], np.array([END_ID], "<u4").tobytes()
    gc.disable()  # each collection would walk all remembered words; nothing here makes cycles
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), tokenizer.encode(part.column("text").to_pylist())):
                    ids += end
                    for piece, first in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[first:first + 4 * capacity]
                        rows.append((doc_id, piece, first // 4, len(own) // 4, zlib.crc32(own)))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    finally:
        gc.enable()


def cut_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of whole texts."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        partial(_pieces, path=tokenizer_path, capacity=capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- one cell -----------------------------------------------------------------------------------------------


def best_fit(items: np.ndarray, sizes: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Puts items, largest first, each into the fullest bin that has room, or into a new one."""
    room = sorted((capacity - int(sizes[b].sum()), i) for i, b in enumerate(bins))
    for item in items[np.argsort(-sizes[items], kind="stable")]:
        size = int(sizes[item])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, i = room.pop(at)
            bins[i].append(int(item))
        else:
            left, i = capacity, len(bins)
            bins.append([int(item)])
        if left > size:
            insort(room, (left - size, i))
    return bins


def fitness(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the fuller ones among equals (mean of squared fills)."""
    fills = np.array([sizes[b].sum() for b in bins]) / capacity
    return -len(bins), float((fills * fills).sum())


def crossover(donor: list[list[int]], receiver: list[list[int]], sizes: np.ndarray, capacity: int,
              share: float, rng: np.random.Generator) -> list[list[int]]:
    """A random share of the donor's well-filled bins goes in whole; the receiver's bins that hold one of
    their items go, and what they also held is put back best-fit."""
    fills = np.array([sizes[b].sum() for b in donor])
    good = np.argsort(-fills, kind="stable")[: max(1, len(donor) // 2)]
    injected = [list(donor[i]) for i in good[rng.random(len(good)) < share]]
    taken = np.zeros(len(sizes), bool)
    for b in injected:
        taken[b] = True
    kept, displaced = [], []
    for b in receiver:
        hit = taken[b]
        if hit.any():
            displaced += [i for i, h in zip(b, hit) if not h]
        else:
            kept.append(list(b))
    # the emptiest of the kept bins are opened too, so that displaced items find partners
    kept.sort(key=lambda b: -sizes[b].sum())
    for b in kept[len(kept) - len(kept) // 20:]:
        displaced += b
    kept = kept[: len(kept) - len(kept) // 20]
    return best_fit(np.array(displaced, int), sizes, injected + kept, capacity)


def random_start(sizes: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> list[list[int]]:
    """Best fit in the order of sizes that are blurred a little; without noise it is best-fit decreasing."""
    order = np.argsort(-sizes * (1 + noise * rng.standard_normal(len(sizes))), kind="stable")
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for item in order:
        size = int(sizes[item])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, i = room.pop(at)
            bins[i].append(int(item))
        else:
            left, i = capacity, len(bins)
            bins.append([int(item)])
        if left > size:
            insort(room, (left - size, i))
    return bins


def evolve(population: list[list[list[int]]], sizes: np.ndarray, capacity: int, generations: int,
           rng: np.random.Generator) -> list[list[list[int]]]:
    """Steady state: each generation's child of the best and another parent replaces the worst if it is no worse.
    It stops at the lower bound, which no packing can beat."""
    bound = -(-int(sizes.sum()) // capacity)
    ranked = sorted(population, key=lambda b: fitness(b, sizes, capacity), reverse=True)
    for _ in range(generations):
        if len(ranked[0]) <= bound:
            break
        other = ranked[int(rng.integers(1, len(ranked)))] if len(ranked) > 1 else ranked[0]
        for donor, receiver in ((ranked[0], other), (other, ranked[0])):
            child = crossover(donor, receiver, sizes, capacity, 0.5, rng)
            if fitness(child, sizes, capacity) >= fitness(ranked[-1], sizes, capacity):
                ranked[-1] = child
            ranked.sort(key=lambda b: fitness(b, sizes, capacity), reverse=True)
    return ranked


def _ordered(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.sort_values(["doc_id", "piece", "ids_crc32", "nth"], kind="stable", na_position="first").reset_index(drop=True)


def _to_labels(bins: list[list[int]], n: int) -> np.ndarray:
    labels = np.full(n, -1, np.int64)
    for i, b in enumerate(bins):
        labels[b] = i
    return labels


def _to_bins(labels: np.ndarray) -> list[list[int]]:
    order = np.argsort(labels, kind="stable")
    order = order[labels[order] >= 0]
    if not len(order):
        return []
    return [list(map(int, b)) for b in np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)]


def _seed(cell: int, island: int, epoch: int) -> np.random.Generator:
    return np.random.default_rng([abs(int(cell)), int(island), int(epoch)])


def _pack_round(pieces: DataFrame, scratch: Scratch, number: int, cells: int, capacity: int) -> DataFrame:
    """`pieces` with `bin` in their cell and `full`, whether that bin stays."""
    payload = "doc_id long, piece int, start long, length long, ids_crc32 long, nth long"
    columns = [c.split(" ")[0] for c in payload.split(", ")]
    spread = pieces.select(*columns, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "nth", F.lit(number)), F.lit(cells)).alias("cell"))
    islands = spread.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumn("own", F.lit(-1).cast("long")).withColumn(
        "guest", F.lit(-1).cast("long"))
    state = f"{payload}, cell long, island int, own long, guest long"

    def epoch_of(epoch: int):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = _ordered(rows)
            cell, island = int(rows["cell"][0]), int(rows["island"][0])
            rng, sizes = _seed(cell, island, epoch), rows["length"].to_numpy()
            population = [random_start(sizes, capacity, rng, 0.05 * i + 0.01 * island) for i in range(POPULATION)]
            own = _to_bins(rows["own"].to_numpy())
            if own:
                population[-1] = own
            guests = _to_bins(rows["guest"].to_numpy())
            if guests:  # the neighbour's best bins, injected into this island's best chromosome
                held = np.zeros(len(sizes), bool)
                for b in guests:
                    held[b] = True
                rest = np.array([i for b in (own or population[0]) for i in b if not held[i]], int)
                population[-2] = best_fit(rest, sizes, guests, capacity)
            best = evolve(population, sizes, capacity, GENERATIONS, rng)[0]
            rows["own"] = _to_labels(best, len(rows))
            fullest = sorted(best, key=lambda b: -sizes[b].sum())[:ELITE_BINS]
            rows["guest"] = _to_labels(fullest, len(rows))
            return rows

        return run

    def migrate(rows: DataFrame) -> DataFrame:
        """Guests of an island are the best bins of the island before it."""
        keys = ["cell", "doc_id", "piece", "ids_crc32", "nth"]
        to_next = F.struct("island", "own", "guest")
        held = rows.groupBy(*keys, "start", "length").agg(F.sort_array(F.collect_list(to_next)).alias("of"))
        each = held.select(*keys, "start", "length", F.explode("of").alias("x"), "of")
        before = F.element_at("of", F.pmod(F.col("x.island") - 1, F.lit(ISLANDS)) + 1)
        return each.select(*columns, "cell", "x.island", "x.own", before["guest"].alias("guest"))

    current = islands
    for epoch in range(EPOCHS):
        current = current.groupBy("cell", "island").applyInPandas(epoch_of(epoch), state)
        if epoch + 1 < EPOCHS:
            current = migrate(current)
    current = scratch.write(current, f"islands{number}")
    fills = current.groupBy("cell", "island", "own").agg(F.sum("length").alias("fill"))
    fit = fills.groupBy("cell", "island").agg(F.count("*").alias("bins"), F.sum(F.col("fill") * F.col("fill")).alias("squares"))
    best = fit.groupBy("cell").agg(F.min(F.struct("bins", -F.col("squares"), "island")).alias("b")).select("cell", F.col("b.island").alias("island"))
    chosen = current.join(best, ["cell", "island"])
    full = fills.withColumn("full", F.col("fill") >= GOOD_FILL * capacity).select("cell", "island", "own", "full")
    return chosen.join(full, ["cell", "island", "own"]).withColumnRenamed("own", "bin").select(*columns, "cell", "bin", "full")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    scratch = Scratch(pieces.sparkSession, "packing")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = scratch.write(pieces.withColumn("nth", F.monotonically_increasing_id()), "pieces")
    done = [pieces.filter(F.col("length") >= capacity).select(
        *columns, F.lit(0).alias("round"), F.lit(-1).cast("long").alias("cell"), F.col("nth").alias("bin"), F.lit(0).cast("long").alias("offset"))]
    left = pieces.filter(F.col("length") < capacity)
    for number in range(1, ROUNDS + 1):
        count = left.count()
        if not count:
            break
        cells = max(1, round(count / CELL))
        packed = scratch.write(_pack_round(left, scratch, number, cells, capacity), f"packed{number}")
        scratch.drop(f"islands{number}")
        last = number == ROUNDS or cells == 1
        done.append(_placed(packed if last else packed.filter("full"), number))
        if last:
            break
        left = packed.filter(~F.col("full")).drop("cell", "bin", "full")
    merged = done[0]
    for more in done[1:]:
        merged = merged.unionByName(more)
    # round, cell and bin are small numbers, whole pieces have their own high range
    number = F.when(F.col("round") == 0, -1 - F.col("bin")).otherwise(
        F.col("round") * F.lit(1 << 60) + F.col("cell") * F.lit(1 << 20) + F.col("bin"))
    return merged.select(*columns, number.alias("sequence_id"), "offset")


def _placed(packed: DataFrame, number: int) -> DataFrame:
    """Offsets in a bin; a bin holds at most as many pieces as its capacity."""
    before = Window.partitionBy("cell", "bin").orderBy("doc_id", "piece", "ids_crc32", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return packed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.lit(number).alias("round"), "cell", "bin", "offset")
