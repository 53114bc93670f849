"""Passages of documents that may repeat, routed so that equal windows meet in one bounded group.

A token is a word or a byte; a window is `length` consecutive tokens of one document. The anchor of a window
is the smallest hash among its grams of `gram` tokens (the leftmost of equals), so equal windows have equal anchors.
Anchors are counted over the corpus; only windows whose anchor repeats are candidates. The family of an
anchor is the smallest document that has it. Consecutive candidate windows of one family are a piece. Pieces with
the same content in the same family are one distinct piece with the smallest document and the number of
its occurrences, so copies of a text are one piece however many there are.

Families whose distinct pieces exceed `FAMILY_BYTES` are split by finer keys, which depend only on a window's
content: first the anchor, then the bytes that all windows of a block of the anchor share, with blocks of
fewer and fewer windows down to single ones. Distinct pieces of one single window are all equal, so no
group stays large. Groups are then put into shards of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dealgauge.llm.scratch import Scratch
from dealgauge.llm.text_arrays import BASE, Texts, prefix_sums, range_hashes, slices, sliding_minimum, window_hashes

FAMILY_BYTES = 1 << 21
SHARD_BYTES = 1 << 20
POSITION = np.uint64((1 << 32) - 1)


@dataclass(frozen=True)
class Scheme:
    words: bool
    length: int
    gram: int
    #: Windows of a block at each level of splitting after the anchor.
    blocks: tuple[int, ...]
    #: Whether repeats inside one document count.
    inside: bool


class Tokens:
    """Tokens of a slice of texts: hash values, the text they are in, and their bytes."""

    def __init__(self, texts: Texts, scheme: Scheme):
        self.texts, self.scheme = texts, scheme
        if scheme.words:
            self.starts, self.ends, self.owner = texts.words()
            self.values = texts.word_hashes(self.starts, self.ends)
            self.first = np.searchsorted(self.owner, np.arange(len(texts) + 1))
        else:
            self.values = texts.byte_values()
            self.owner = None
            self.first = texts.offsets

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every window inside one document: its first token, the token of its anchor and the anchor's hash."""
        n, length = len(self.values), self.scheme.length
        if n < length:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(np.uint64)
        grams = window_hashes(self.values, self.scheme.gram)
        keys = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64)
        at = (sliding_minimum(keys, length - self.scheme.gram + 1) & POSITION).astype(np.int64)
        sizes = np.diff(self.first)
        valid = np.zeros(n + 1, np.int32)
        whole = sizes >= length
        np.add.at(valid, self.first[:-1][whole], 1)
        np.add.at(valid, self.first[1:][whole] - length + 1, -1)
        start = np.flatnonzero(np.cumsum(valid)[: n - length + 1])
        at = at[start]
        return start, at, grams[at]

    def document_of(self, token: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, token, "right") - 1

    def content(self, first: int, last: int) -> bytes:
        """Bytes of tokens first to last - 1; words are joined by one space."""
        if not self.scheme.words:
            return self.texts.data[first:last].tobytes()
        raw = self.texts.data[self.starts[first]:self.ends[last - 1]].tobytes()
        return b" ".join(raw.split())


def runs(values: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of runs of equal values at consecutive places."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate([[True], (values[1:] != values[:-1]) | (places[1:] != places[:-1] + 1)])
    first = np.flatnonzero(new)
    return first, np.concatenate([first[1:], [len(values)]]) - 1


def piece_name(key: int, content: bytes) -> tuple[int, int]:
    raw = hashlib.blake2b(int(key).to_bytes(8, "little", signed=True) + content, digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def with_key(documents: DataFrame) -> DataFrame:
    """doc_id and text with text_key: rows of one id with different texts are different documents."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))


def _arrow(rows: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def anchor_rows(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """anchor, doc_id, text_key and n: the distinct anchors of each document."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            tokens = Tokens(texts, scheme)
            start, at, anchors = tokens.anchors()
            new = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
            doc, anchors = tokens.document_of(start[new]), anchors[new]
            order = np.lexsort((anchors, doc))
            doc, anchors = doc[order], anchors[order]
            first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (anchors[1:] != anchors[:-1])])) if len(doc) else np.zeros(0, int)
            times = np.diff(np.concatenate([first, [len(doc)]])).astype(np.int32)
            rows = pa.array(doc[first])
            for at_row in range(0, len(first), 50_000):
                some = slice(at_row, at_row + 50_000)
                take = rows[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors[first][some].view(np.int64)), part.column("doc_id").take(take), part.column("text_key").take(take), pa.array(times[some])],
                    names=["anchor", "doc_id", "text_key", "n"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(found, "anchor long, doc_id long, text_key long, n int")


def repeated_anchors(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """anchor and family of the anchors that more than one place has."""
    found = rows.groupBy("anchor").agg(F.min("doc_id").alias("family"), F.max("doc_id").alias("last"), F.sum("n").alias("times"))
    return found.filter("times > 1" if scheme.inside else "family < last").select("anchor", "family")


PIECE = "key long, name1 long, name2 long, doc_id long, text_key long, start long, windows int, content binary"
PIECE_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
PIECE_NAMES = [x.split(" ")[0] for x in PIECE.split(", ")]


def family_pieces(docs: DataFrame, families: DataFrame, scheme: Scheme) -> DataFrame:
    """Pieces of documents. `families`: doc_id, text_key and the arrays anchors and families."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            tokens = Tokens(texts, scheme)
            start, _, anchors = tokens.anchors()
            doc = tokens.document_of(start)
            bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
            ids, keys = part.column("doc_id").to_pylist(), part.column("text_key").to_pylist()
            rows, size = [], 0
            for i in range(len(texts)):
                lo, hi = bounds[i], bounds[i + 1]
                known = part.column("anchors")[i].values
                if known is None or hi == lo:
                    continue
                known = known.to_numpy(zero_copy_only=False)
                homes = part.column("families")[i].values.to_numpy(zero_copy_only=False)
                order = np.argsort(known)
                known, homes = known[order], homes[order]
                own = anchors[lo:hi].view(np.int64)
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                hit = np.flatnonzero(known[place] == own)
                family, at = homes[place[hit]], start[lo:hi][hit]
                for a, b in zip(*runs(family, at)):
                    first, last = int(at[a]), int(at[b]) + scheme.length
                    content = tokens.content(first, last)
                    rows.append((int(family[a]), *piece_name(family[a], content), ids[i], keys[i],
                                 first - int(tokens.first[i]), int(b - a + 1), content))
                    size += len(content)
                    if size > 4 << 20:
                        yield _arrow(rows, PIECE_NAMES, PIECE_KINDS)
                        rows, size = [], 0
            if rows:
                yield _arrow(rows, PIECE_NAMES, PIECE_KINDS)

    return docs.join(families, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "anchors", "families").mapInArrow(cut, PIECE)


SUB = "parent1 long, parent2 long, key long, name1 long, name2 long, first long, times long, shift int, windows int, content binary"
SUB_KINDS = [pa.int64()] * 7 + [pa.int32(), pa.int32(), pa.binary()]
SUB_NAMES = [x.split(" ")[0] for x in SUB.split(", ")]


def split_pieces(distinct: DataFrame, scheme: Scheme, level: int) -> DataFrame:
    """Parts of distinct pieces with finer keys: by anchor at level 0, then by blocks of windows."""
    block = scheme.blocks[level - 1] if level else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "content"):
            tokens = Tokens(texts, scheme)
            start, at, anchors = tokens.anchors()
            doc = tokens.document_of(start)
            if block is None:
                key = anchors
            else:
                # the windows of a block all hold the tokens from its last window's first to its first window's last
                place = (at - start) // block
                low, high = at - place * block, at - (place + 1) * block + 1
                key = range_hashes(prefix_sums(tokens.values), low, high + scheme.length) + place.astype(np.uint64) * BASE
            columns = {c: part.column(c).to_pylist() for c in ("name1", "name2", "first", "times")}
            rows, size = [], 0
            for a, b in zip(*runs(key, start)):
                i, first, last = int(doc[a]), int(start[a]), int(start[b]) + scheme.length
                content, own = tokens.content(first, last), int(key[a].view(np.int64))
                rows.append((columns["name1"][i], columns["name2"][i], own, *piece_name(own, content), columns["first"][i], columns["times"][i],
                             first - int(tokens.first[i]), int(b - a + 1), content))
                size += len(content)
                if size > 4 << 20:
                    yield _arrow(rows, SUB_NAMES, SUB_KINDS)
                    rows, size = [], 0
            if rows:
                yield _arrow(rows, SUB_NAMES, SUB_KINDS)

    return distinct.select("name1", "name2", "first", "times", "content").mapInArrow(cut, SUB)


def _distinct(rows: DataFrame, first: str, times: str) -> DataFrame:
    return rows.groupBy("key", "name1", "name2").agg(
        F.min(first).alias("first"), F.sum(times).alias("times"), F.first("content").alias("content"))


def repeated_spans(docs: DataFrame, scheme: Scheme, solve, scratch: Scratch, partitions: int) -> DataFrame:
    """doc_id, text_key and spans: a list of structs (start, length) in tokens, the parts of each document
    that are covered by repeated windows. Documents without any are absent.

    `solve` gets a pandas frame of distinct pieces (name1, name2, first, times, content) of one shard and
    returns name1, name2, starts and lengths of the parts that its windows' repeats cover."""
    docs = docs.filter("doc_id is not null")
    anchors = anchor_rows(docs, scheme)
    repeated = scratch.write(repeated_anchors(anchors, scheme), "anchors")
    families = anchors.select("anchor", "doc_id", "text_key").join(repeated, "anchor").groupBy("doc_id", "text_key").agg(
        F.collect_list("anchor").alias("anchors"), F.collect_list("family").alias("families"))
    occurrences = scratch.write(family_pieces(docs, families, scheme), "occurrences")
    scratch.drop("anchors")
    current = scratch.write(_distinct(occurrences.withColumn("one", F.lit(1).cast("long")), "doc_id", "one"), "distinct0")
    occurrences = occurrences.drop("content", "key")
    solved, parts, distincts = [], [], [current.select("name1", "name2", "first", "times")]
    for level in range(2 + len(scheme.blocks)):
        weights = current.groupBy("key").agg(F.sum(F.length("content")).alias("bytes"), F.count("*").alias("pieces"))
        last = level == 1 + len(scheme.blocks)
        # a piece alone in its group repeats nothing, unless windows repeat inside it
        weights = weights.filter((F.col("pieces") > 1) | (F.col("bytes") > scheme.length) if scheme.inside else F.col("pieces") > 1)
        weights = scratch.write(weights, f"weights{level}")
        light = weights if last else weights.filter(F.col("bytes") <= FAMILY_BYTES)
        total = light.agg(F.sum("bytes")).first()[0] or 0
        shards = max(partitions, -(-total // SHARD_BYTES))
        rows = current.join(light.select("key"), "key").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
        result = rows.select("shard", "name1", "name2", "first", "times", "content").groupBy("shard").applyInPandas(
            solve, "name1 long, name2 long, starts array<int>, lengths array<int>")
        solved.append(scratch.write(result, f"solved{level}"))
        if last:
            break
        heavy = weights.filter(F.col("bytes") > FAMILY_BYTES)
        if heavy.isEmpty():
            break
        cut = scratch.write(split_pieces(current.join(heavy.select("key"), "key"), scheme, level), f"parts{level}")
        parts.append(cut.drop("content", "key", "first", "times"))
        current = scratch.write(_distinct(cut, "first", "times"), f"distinct{level + 1}")
        distincts.append(current.select("name1", "name2", "first", "times"))
    return _resolve(occurrences, solved, parts, distincts, scheme)


def _resolve(occurrences: DataFrame, solved: list[DataFrame], parts: list[DataFrame], distincts: list[DataFrame], scheme: Scheme) -> DataFrame:
    """Spans of distinct pieces, from the finest level up, then of documents."""
    width = scheme.length - 1
    whole = F.array(F.struct(F.lit(0).alias("start"), (F.col("windows") + width).alias("length")))
    below: DataFrame | None = None
    for level in range(len(distincts) - 1, -1, -1):
        spans = solved[level].select("name1", "name2", _decoded().alias("spans"))
        if level < len(parts):
            joined = parts[level].join(below, ["name1", "name2"])
            covered = F.col("inner_first") < F.col("outer_first") if not scheme.inside else (F.col("inner_times") > 1)
            outer = distincts[level].select(
                F.col("name1").alias("parent1"), F.col("name2").alias("parent2"), F.col("first").alias("outer_first"), F.col("times").alias("outer_times"))
            joined = joined.join(outer, ["parent1", "parent2"])
            moved = F.transform(F.when(covered, whole).otherwise(F.col("spans")), lambda s: F.struct(
                (s["start"] + F.col("shift")).alias("start"), s["length"].alias("length")))
            spans = spans.unionByName(joined.groupBy(F.col("parent1").alias("name1"), F.col("parent2").alias("name2")).agg(
                F.flatten(F.collect_list(moved)).alias("spans")))
        below = distincts[level].join(spans, ["name1", "name2"], "left").select(
            "name1", "name2", F.col("first").alias("inner_first"), F.col("times").alias("inner_times"),
            F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"))
    joined = occurrences.join(below, ["name1", "name2"])
    covered = (F.col("inner_times") > 1) if scheme.inside else (F.col("inner_first") < F.col("doc_id"))
    moved = F.transform(F.when(covered, whole).otherwise(F.col("spans")), lambda s: F.struct(
        (s["start"] + F.col("start")).alias("start"), s["length"].cast("long").alias("length")))
    return joined.withColumn("moved", moved).filter(F.size("moved") > 0).groupBy("doc_id", "text_key").agg(
        F.flatten(F.collect_list("moved")).alias("spans"))


def _decoded() -> Column:
    return F.transform(F.arrays_zip("starts", "lengths"), lambda x: F.struct(x["starts"].alias("start"), x["lengths"].alias("length")))


def covered(spans: list | None, n: int) -> np.ndarray:
    """Which of n tokens the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    for span in spans or ():
        steps[span["start"]] += 1
        steps[span["start"] + span["length"]] -= 1
    return np.cumsum(steps)[:n] > 0
