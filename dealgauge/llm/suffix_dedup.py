"""Suffix-array dedup: bytes that are covered by a string of `LENGTH` bytes which also starts elsewhere.

Candidate passages are routed to shards so that equal strings meet (see `passages`). A shard's passages, end to end,
are sorted in two stages: only suffixes smaller than their successors are sorted directly, by the names
of the substrings between them and prefix doubling; all others are induced by one scan over the buckets
of first bytes. Common prefixes of neighbours are computed where the bytes before differ, and are one
shorter at each following position otherwise. A string repeats if it is a common prefix of neighbours.

Matches never cross documents; null text is empty; overlapping repeats count; repeated rows repeat each other.
Rows without a doc_id lose nothing and take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from dealgauge.llm.passages import Scheme, covered, repeated_spans, runs, with_key
from dealgauge.llm.scratch import Scratch
from dealgauge.llm.text_arrays import slices

LENGTH = 400
SCHEME = Scheme(words=False, length=LENGTH, gram=32, blocks=(64, 8, 1), inside=True)
#: Values before the bytes: the end of the text, and the end of a passage.
SEPARATOR, SHIFT = 1, 2
SYMBOL_BITS, SYMBOLS = 10, 6


def smaller_than_successor(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that starts a place later; the last is by definition."""
    step = np.sign(t[1:].astype(np.int32) - t[:-1].astype(np.int32))
    moves = np.flatnonzero(step)
    out = np.ones(len(t), bool)
    following = np.searchsorted(moves, np.arange(len(t) - 1))
    out[:-1] = step[moves[np.minimum(following, len(moves) - 1)]] > 0
    return out


def _regroup(rank: np.ndarray, of: np.ndarray, key: np.ndarray) -> None:
    """Splits groups of equal rank, in place: `of` are members of whole groups, `key` orders them inside.
    A rank is the number of members of smaller groups."""
    order = np.lexsort((key, rank[of]))
    ids, group, key = of[order], rank[of][order], key[order]
    place = np.arange(len(ids))
    new_group = np.concatenate([[True], group[1:] != group[:-1]])
    new = new_group | np.concatenate([[True], key[1:] != key[:-1]])
    group_at = np.maximum.accumulate(np.where(new_group, place, 0))
    at = np.maximum.accumulate(np.where(new, place, 0))
    rank[ids] = group + at - group_at


def sort_directly(t: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Positions of the small suffixes in the order of the suffixes."""
    p = np.flatnonzero(small)
    m = len(p)
    sizes = np.concatenate([np.diff(p) + 1, [1]])
    symbols = np.concatenate([t.astype(np.uint64) * np.uint64(2) + small, np.zeros(SYMBOLS, np.uint64)])
    packed = np.zeros(len(t), np.uint64)
    for i in range(SYMBOLS):
        packed = (packed << np.uint64(SYMBOL_BITS)) | symbols[i:i + len(t)]
    rank = np.zeros(m, np.int64)
    left = np.arange(m)
    done = 0
    while len(left):
        rest = np.minimum(sizes[left] - done, SYMBOLS)
        cut = (np.uint64(SYMBOL_BITS) * (SYMBOLS - rest).astype(np.uint64))
        key = (packed[p[left] + done] >> cut) << cut
        _regroup(rank, left, key)
        done += SYMBOLS
        left = left[sizes[left] > done]
    step = 1
    while True:
        times = np.bincount(rank, minlength=m)
        open_ = np.flatnonzero(times[rank] > 1)
        if not len(open_):
            break
        after = open_ + step
        key = np.where(after < m, rank[np.minimum(after, m - 1)], -1)
        _regroup(rank, open_, key)
        step *= 2
    out = np.empty(m, np.int64)
    out[rank] = p
    return out


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of small numbers that end with a single 0."""
    small = smaller_than_successor(t)
    direct = sort_directly(t, small)
    width = int(t.max()) + 1
    counts, small_counts = np.bincount(t, minlength=width), np.bincount(t[small], minlength=width)
    ends = np.cumsum(counts)
    head = ends - counts
    out = np.empty(len(t), np.int64)
    at = 0
    for c in np.flatnonzero(small_counts):
        out[ends[c] - small_counts[c]:ends[c]] = direct[at:at + small_counts[c]]
        at += small_counts[c]

    def induce(sources: np.ndarray) -> None:
        before = sources[sources > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return
        first = t[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        times = np.bincount(first, minlength=width)
        starts = np.cumsum(times) - times
        out[head[first] + np.arange(len(first)) - starts[first]] = before
        head[:] += times

    for c in np.flatnonzero(counts):
        scanned = ends[c] - counts[c]
        while scanned < head[c]:
            upto = head[c]
            induce(out[scanned:upto])
            scanned = upto
        induce(out[ends[c] - small_counts[c]:ends[c]])
    return out


def common_prefixes(t: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position its predecessor in suffix order and the length of their common prefix."""
    n = len(t)
    previous = np.zeros(n, np.int64)
    previous[order[1:]] = order[:-1]
    first = order[0]
    wide = np.concatenate([t, np.zeros(8, t.dtype)]).astype(np.uint64)
    four = wide[:n + 4] | (wide[1:n + 5] << np.uint64(16)) | (wide[2:n + 6] << np.uint64(32)) | (wide[3:n + 7] << np.uint64(48))
    i = np.arange(n)
    same = np.zeros(n, bool)
    both = (i > 0) & (previous > 0)
    same[both] = t[i[both] - 1] == t[previous[both] - 1]
    same[first] = False
    if first + 1 < n:
        same[first + 1] = False
    starts = np.flatnonzero(~same)
    found = np.zeros(len(starts), np.int64)
    live = np.flatnonzero(starts != first)
    while len(live):
        a, b = starts[live] + found[live], previous[starts[live]] + found[live]
        differ = four[np.minimum(a, n + 3)] ^ four[np.minimum(b, n + 3)]
        equal = differ == 0
        for shift in (0, 16, 32):
            go = ~equal & ((differ & np.uint64((1 << (shift + 16)) - 1)) == 0)
            found[live[go]] += 1
        found[live[equal]] += 4
        live = live[equal & (np.maximum(a, b) + 4 < n)]
    at = np.maximum.accumulate(np.where(~same, i, 0))
    value = np.zeros(n, np.int64)
    value[starts] = found
    return previous, value[at] - (i - at)


def repeated_starts(t: np.ndarray, length: int) -> np.ndarray:
    """Positions whose next `length` values also start somewhere else."""
    previous, common = common_prefixes(t, suffix_array(t))
    out = np.zeros(len(t), bool)
    hits = np.flatnonzero(common >= length)
    out[hits] = True
    out[previous[hits]] = True
    return out


def _sort_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["name1", "name2"], kind="stable")
    sizes = np.array([len(c) for c in rows["content"]])
    ends = np.cumsum(sizes + 1)
    t = np.full(int(ends[-1]) + 1, SEPARATOR, np.uint16)
    t[-1] = 0
    for content, end, size in zip(rows["content"], ends, sizes):
        t[end - 1 - size:end - 1] = np.frombuffer(content, np.uint8).astype(np.uint16) + SHIFT
    repeats = repeated_starts(t, LENGTH)
    found = []
    for name1, name2, end, size in zip(rows["name1"], rows["name2"], ends, sizes):
        at = np.flatnonzero(repeats[end - 1 - size:max(end - LENGTH, end - 1 - size)])
        if len(at):
            spans = [(int(at[a]), int(at[b] - at[a]) + LENGTH) for a, b in zip(*runs(np.zeros(len(at)), at))]
            found.append((name1, name2, [s for s, _ in spans], [n for _, n in spans]))
    return pd.DataFrame(found, columns=["name1", "name2", "starts", "lengths"])


def dedup_digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    docs = with_key(documents)
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spans = repeated_spans(docs, SCHEME, _sort_shard, Scratch(spark, "suffix"), partitions)
    joined = docs.join(spans, ["doc_id", "text_key"], "left").select("doc_id", "text", "spans")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            rows = []
            for i, (doc_id, spans) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("spans").to_pylist())):
                raw = texts.text_bytes(i)
                gone = covered(spans, len(raw))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if spans else raw
                n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((doc_id, len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
