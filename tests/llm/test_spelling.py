"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dealgauge.llm import spelling
from dealgauge.llm.scratch import Scratch

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


def brute_force(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if k >= 3 and len(w) >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def result(frame):
    got = spelling.spelling_variants(frame)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()))


def test_runs():
    assert spelling.runs_of("AbÉ× don't Āx€y 1z ÿ".encode()) == [
        w.encode() for w in ("abÉ×", "don", "t", "x", "y", "z", "ÿ")]


@pytest.mark.parametrize("seed", range(6))
def test_scan_finds_every_pair(spark, seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcéÿ"
    words = sorted({"".join(rng.choices(letters, k=rng.randrange(1, 11))) for _ in range(150)} | {"a" * k for k in range(1, 14)})
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    for most in (4, 10_000):
        got = spelling.near_pairs(frame, Scratch(spark, "test"), most).collect()
        assert sorted((r.word, r.near) for r in got) == sorted((a, b) for a in words for b in words if one_edit(a, b))
        assert all(words[r.near_n] == r.near for r in got)


def test_lists_over_batches():
    import pyarrow as pa

    words = sorted({"pre" + a + b for a in "abcdefgh" for b in "abcdefgh"})
    keys = ["k1"] * len(words) + ["k2"] * 3
    rows = words + ["prexx", "prexy", "prezz"]
    table = pa.table({
        "key": keys, "word": rows, "n": list(range(len(rows))), "short": pa.array([5] * len(rows), pa.int32()),
        "a": pa.array([3] * len(rows), pa.int32()), "b": pa.array([6] * len(rows), pa.int32())})
    found = []
    old, spelling.SCANNED = spelling.SCANNED, 10
    try:
        for batch in spelling._scanned(iter(table.to_batches(max_chunksize=7))):
            found += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
    finally:
        spelling.SCANNED = old
    parts = (words, rows[len(words):])
    assert sorted(found) == sorted((a, b) for part in parts for a in part for b in part if one_edit(a, b))


def corpus():
    rng = random.Random(3)
    words = ["spelling", "variant", "grouping", "cafés", "niños", "abcde", "ABCDE", "four", "Straße"]
    words += [w[:i] + c + w[i + 1:] for w in words[:5] for i in (0, 2, len(w) - 1) for c in "xy"]
    words += [w + "s" for w in words[:5]] + [w[1:] for w in words[:5]]
    rows = [(i if i % 50 else None, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randrange(0, 40)))) for i in range(300)]
    return rows + [(1, None), (2, ""), (3, "1 2 你好 abcde"), (4, "x" * 50_000 + " " + "x" * 50_000 + " " + "x" * 50_000)] + rows[:30] + [(
        5, "bigger " * 40 + "biggar " * 12 + "biggax " * 3)]


def test_variants_equal_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(spelling, "LIST_WORDS", 4)
    rows = corpus()
    got = result(docs([(i, t, None, None) for i, t in rows], clash=True))
    assert got == brute_force(rows)
    assert any(r[1] and r[2] != r[1] for r in got) and any(len(r[0]) == 50_000 for r in got)


def test_counting_in_several_sendings(spark, docs, monkeypatch):
    import pyarrow as pa

    rows = corpus()
    monkeypatch.setattr(spelling, "COUNTED", 7)
    totals = Counter()
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([(r[1] or "").encode() for r in rows])], names=["doc_id", "text"])
    for out in spelling._counted(iter([batch])):
        for w, n in zip(*(c.to_pylist() for c in out.columns)):
            totals[w.decode()] += n
    assert {(r[0], r[3]) for r in brute_force(rows)} == {(w, n) for w, n in totals.items() if n >= 3 and len(w) >= 5}


def test_empty_table(docs):
    frame = docs([(1, "x", None, None)])
    assert spelling.spelling_variants(frame.limit(0)).count() == 0 and spelling.spelling_variants(frame).count() == 0


def test_given_documents(spark):
    from given_tables import TESTDATA

    frame = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    assert result(frame) == brute_force([tuple(r) for r in frame.select("doc_id", "text").collect()])
