"""The prefix trie against a brute-force tree."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from dealgauge.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
        leaves[node] = sum(leaves[k] for k in children[node]) if children[node] else 1
    return sorted(
        (min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), len(children[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, ms in members.items())


def result(frame, **options):
    got = conversation_trie.prefix_trie(frame, **options)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes[:-1]} == {"bigint"}
    return sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1]))


ODD = [
    (None, 1, "user", "no conversation"), (0, None, "user", "null turn"), (0, 1, None, "no role"), (0, 2, "user", None), (0, 3, "", ""),
    (1, 0, "user", "a"), (1, 1, "user", "b"), (2, 5, "user", "only one"), (3, 1, "b", "tie"), (3, 1, "a", "tie"), (3, 1, "a", "tap"),
    (3, 1, "a", "tie"), (20, 1, "user", "x" * 3_000_000 + " end"), (21, 1, "user", "x"), (21, 2, "user", "y\t z"), (45, 1, "u", "base 40 is absent"),
    (45, 2, "u", "2"), (45, 3, "u", "3"), (45, 4, "u", "4"), (19, -1, "u", "minus"), (19, None, "z", "null"), (19, None, "a", "null too")]


@pytest.mark.parametrize("columns", [2, 8])
def test_odd_rows(spark, columns):
    frame = spark.createDataFrame(ODD, SCHEMA)
    assert result(frame, columns=columns) == brute_force(ODD)


def test_copies_long_conversations_and_repeated_rows(spark, monkeypatch):
    rng, rows = random.Random(5), []
    for c in range(160):
        kind = rng.random()
        turns = ["hi", "there", *rng.choices(["x y", "z", "w w w"], k=rng.randrange(1, 30))] if kind < 0.5 else ["same"] * 5 + ["to the end"]
        rows += [(c, t, "user" if t % 2 else "system", text) for t, text in enumerate(turns)]
    rows += [(300, t // 2, "user", f"long {t % 7}") for t in range(900)] + [(301, t // 2, "user", f"long {t % 7}") for t in range(880)]
    rows += [(320, 1, "user", "repeated row")] * 400
    monkeypatch.setattr(conversation_trie, "STRETCH", 3)
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5), columns=4) == brute_force(rows)


def test_clashing_columns_and_empty_table(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD[5:7], SCHEMA).withColumns({c: F.lit("x") for c in ("slice", "number", "tid", "block", "depth", "h")})
    assert result(frame) == brute_force(ODD[5:7])
    assert conversation_trie.prefix_trie(frame.limit(0)).count() == 0
    assert conversation_trie.prefix_trie(spark.createDataFrame(ODD[:1], SCHEMA)).count() == 0


def test_given_conversations(spark):
    from given_tables import TESTDATA

    frame = spark.read.parquet(f"{TESTDATA}/conversations.parquet")
    assert result(frame) == brute_force([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])
