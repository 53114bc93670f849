"""Substring dedup by suffix automata over reference shards.

A window of `LENGTH` words is removed if its words also start in a document with a smaller id. Candidate passages
are routed to shards so that equal windows meet (see `passages`). A shard keeps a suffix automaton of the
passages it has seen, in the order of document ids: each document's passages are streamed through it
first, which gives the matching statistic of every word (the longest match that ends there), and
matches above the threshold are removed; then the passages that are new join the automaton. So the
automaton of a shard always holds the reference of smaller documents, every window of it once.

An automaton of all references would grow with the corpus and could not be broadcast. Each shard's automaton is
bounded instead and lives where the documents' passages for this shard are sent.

Words are `[^\\x20\\x09-\\x0D]+`, compared byte by byte. Null text is empty; texts of fewer words than a window lose
nothing; rows without a doc_id lose nothing and remove nothing; rows of one id never remove each other's words;
repeated rows have the same result. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dealgauge.llm.passages import Scheme, covered, repeated_spans, runs, with_key
from dealgauge.llm.scratch import Scratch
from dealgauge.llm.text_arrays import slices

LENGTH = 13
SCHEME = Scheme(words=True, length=LENGTH, gram=6, blocks=(1,), inside=False)


class SuffixAutomaton:
    """Suffix automaton of several passages; words are small integers."""

    def __init__(self):
        self.following: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.following.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, source: int, word: int, target: int) -> int:
        """The state of target's suffixes that are one word longer than source; target itself if it has no longer ones."""
        following, link, length = self.following, self.link, self.length
        if length[source] + 1 == length[target]:
            return target
        copy = self._state(length[source] + 1, dict(following[target]), link[target])
        link[target] = copy
        while source >= 0 and following[source].get(word) == target:
            following[source][word] = copy
            source = link[source]
        return copy

    def add(self, words: list[int]) -> None:
        following, link, length = self.following, self.link, self.length
        last = 0
        for word in words:
            known = following[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new = self._state(length[last] + 1, {}, 0)
            at = last
            while at >= 0 and word not in following[at]:
                following[at][word] = new
                at = link[at]
            if at >= 0:
                link[new] = self._split(at, word, following[at][word])
            last = new

    def matching_statistics(self, words: list[int]) -> list[int]:
        """Length of the longest match that ends at each word."""
        following, link, length = self.following, self.link, self.length
        state = matched = 0
        out = []
        for word in words:
            to = following[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(word)
            if to is not None:
                state = to
                matched += 1
            out.append(matched)
        return out


def _stream(rows: pd.DataFrame) -> pd.DataFrame:
    """Spans of a shard's distinct passages that repeat passages of smaller documents."""
    rows = rows.sort_values(["first", "name1", "name2"], kind="stable")
    numbers: dict[bytes, int] = {}
    automaton = SuffixAutomaton()
    found, waiting, document = [], [], None
    for name1, name2, first, content in zip(rows["name1"], rows["name2"], rows["first"], rows["content"]):
        if first != document:
            for words in waiting:
                automaton.add(words)
            waiting, document = [], first
        words = [numbers.setdefault(w, len(numbers)) for w in content.split(b" ")]
        ends = np.array(automaton.matching_statistics(words)[LENGTH - 1:]) >= LENGTH
        seen, new = np.flatnonzero(ends), np.flatnonzero(~ends)
        spans = [(int(seen[a]), int(seen[b] - seen[a]) + LENGTH) for a, b in zip(*runs(np.zeros(len(seen)), seen))]
        waiting += [words[new[a]:new[b] + LENGTH] for a, b in zip(*runs(np.zeros(len(new)), new))]
        if spans:
            found.append((name1, name2, [s for s, _ in spans], [n for _, n in spans]))
    return pd.DataFrame(found, columns=["name1", "name2", "starts", "lengths"])


def removed_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return repeated_spans(docs, SCHEME, _stream, scratch, partitions)


def dedup_digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    docs = with_key(documents)
    spans = removed_spans(docs, Scratch(documents.sparkSession, "substring"))
    joined = docs.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            rows = []
            for i, (doc_id, spans) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("spans").to_pylist())):
                words = texts.text_bytes(i).split()
                gone = covered(spans, len(words))
                kept = b" ".join([w for w, g in zip(words, gone) if not g] if spans else words)
                rows.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return joined.mapInArrow(digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_substrings(documents: DataFrame) -> DataFrame:
    """`documents` with repeated passages cut out of the text; other bytes of the text stay as they are.
    Texts without a repeated passage are unchanged, null included."""
    names = documents.columns
    # the row travels as one column, so its other columns can have any names
    keyed = documents.select(
        F.struct("*").alias("row"), "text", F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_key"))
    spans = removed_spans(with_key(documents), Scratch(documents.sparkSession, "substring"))
    joined = keyed.join(spans, ["doc_id", "text_key"], "left").select("row", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            starts, ends, owner = texts.words()
            first = np.searchsorted(owner, np.arange(len(texts) + 1))
            new = part.column("text").to_pylist()
            for i, spans in enumerate(part.column("spans").to_pylist()):
                if not spans:
                    continue
                own = slice(first[i], first[i + 1])
                gone = covered(spans, first[i + 1] - first[i])
                places = np.flatnonzero(gone)
                keep = np.ones(int(texts.offsets[i + 1] - texts.offsets[i]), bool)
                for a, b in zip(*runs(np.zeros(len(places)), places)):
                    keep[starts[own][places[a]] - texts.offsets[i]:ends[own][places[b]] - texts.offsets[i]] = False
                raw = np.frombuffer(texts.text_bytes(i), np.uint8)
                new[i] = raw[keep].tobytes().decode()
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(new, pa.string())], names=["row", "new"])

    schema = StructType([StructField("row", documents.schema), StructField("new", StringType())])
    return joined.mapInArrow(cut, schema).select(*[F.col("new").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in names])
