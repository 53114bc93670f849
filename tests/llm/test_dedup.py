"""The three dedup operators against brute force, on odd rows and on planted copies."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from dealgauge.llm import near_dedup, passages, substring_dedup, suffix_dedup
from dealgauge.llm.components import connected_components
from dealgauge.llm.scratch import Scratch
from llm_rows import odd_rows, planted_rows

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text):
    return (text or "").encode().split()


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected_components(rows):
    kept = [(r[0], shingles(r[1])) for r in rows]
    part = list(range(len(kept)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, (a, x) in enumerate(kept):
        for j in range(i):
            b, y = kept[j]
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                part[root(i)] = root(j)
    least = defaultdict(list)
    for i, (a, _) in enumerate(kept):
        if a is not None:
            least[root(i)].append(a)
    return Counter((a, len(x), min(least[root(i)]) if a is not None else None) for i, (a, x) in enumerate(kept))


def removed_words(rows):
    first = {}
    for doc, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - 12):
            key = tuple(w[i:i + 13])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if doc is not None and first[tuple(w[i:i + 13])] < doc:
                gone[i:i + 13] = [True] * 13
        out.append((doc, len(w), sum(gone), hashlib.sha256(b" ".join(a for a, g in zip(w, gone) if not g)).hexdigest()))
    return Counter(out)


def removed_bytes(rows, length=400):
    times = Counter()
    raws = [(doc, (text or "").encode()) for doc, text, *_ in rows]
    for doc, raw in raws:
        if doc is not None:
            times.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if doc is not None and times[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("rows", [odd_rows(), planted_rows()], ids=["odd", "planted"])
def test_near_dedup_equals_all_pairs(docs, rows, clash):
    found = near_dedup.near_duplicate_groups(docs(rows, clash))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == expected_components(rows)


def test_near_dedup_keeps_one_of_each_group(docs):
    rows = planted_rows()
    kept = near_dedup.drop_near_duplicates(docs(rows, True))
    assert kept.columns == docs(rows, True).columns
    groups = {(r[0], r[2]) for r in expected_components(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted({g for _, g in groups})


def test_large_families_are_confirmed_region_by_region(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "FAMILY", 3)
    monkeypatch.setattr(near_dedup, "REGION", 4)
    rows = planted_rows()
    found = near_dedup.near_duplicate_groups(docs(rows))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == expected_components(rows)


@pytest.mark.parametrize("rows", [odd_rows(), planted_rows()], ids=["odd", "planted"])
@pytest.mark.parametrize("family_bytes", [passages.FAMILY_BYTES, 200])
def test_substring_dedup_equals_all_windows(docs, rows, family_bytes, monkeypatch):
    monkeypatch.setattr(passages, "FAMILY_BYTES", family_bytes)
    found = substring_dedup.dedup_digest(docs(rows, True)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == removed_words(rows)


@pytest.mark.parametrize("rows", [odd_rows(), planted_rows()], ids=["odd", "planted"])
@pytest.mark.parametrize("family_bytes", [passages.FAMILY_BYTES, 2000])
def test_suffix_dedup_equals_all_strings(docs, rows, family_bytes, monkeypatch):
    monkeypatch.setattr(passages, "FAMILY_BYTES", family_bytes)
    found = suffix_dedup.dedup_digest(docs(rows, True)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == removed_bytes(rows)


def test_removed_substrings_leave_the_other_words(docs):
    rows = planted_rows()
    left = substring_dedup.remove_substrings(docs(rows, True))
    assert left.columns == docs(rows, True).columns
    found = Counter((r.doc_id, hashlib.sha256(b" ".join(words(r.text))).hexdigest()) for r in left.collect())
    assert found == Counter((doc, sha) for doc, _, _, sha in removed_words(rows).elements())


def test_empty_tables(docs):
    none = docs([])
    assert near_dedup.near_duplicate_groups(none).count() == 0
    assert substring_dedup.dedup_digest(none).count() == 0
    assert suffix_dedup.dedup_digest(none).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(3)
    for _ in range(150):
        t = np.concatenate([rng.integers(1, 1 + rng.integers(1, 4), rng.integers(1, 60)), [0]]).astype(np.uint16)
        plain = t.tolist()
        order = sorted(range(len(plain)), key=lambda i: plain[i:])
        assert suffix_dedup.suffix_array(t).tolist() == order
        previous, common = suffix_dedup.common_prefixes(t, np.array(order))
        for a, b in zip(order, order[1:]):
            n = 0
            while a + n < len(plain) and b + n < len(plain) and plain[a + n] == plain[b + n]:
                n += 1
            assert (previous[b], common[b]) == (a, n)


def test_automaton_gives_longest_matches():
    rng = random.Random(5)
    for _ in range(100):
        known = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        automaton = substring_dedup.SuffixAutomaton()
        for k in known:
            automaton.add(k)
        inside = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i + 1, len(k) + 1)}
        text = [rng.randrange(4) for _ in range(15)]
        expected = [max([n for n in range(1, e + 1) if tuple(text[e - n:e]) in inside], default=0) for e in range(1, 16)]
        assert automaton.matching_statistics(text) == expected


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 200), (300, 300)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"), "c")
    by = {r.node: r.component for r in found.collect()}
    assert by == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}


def test_template_corpus_with_regions_above_the_cap(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "REGION", 16)
    monkeypatch.setattr(near_dedup, "FAMILY", 100)
    rng = random.Random(8)

    def filled(seed):
        return [f"f{i}" for i in range(340)] + [f"v{seed}x{i}" for i in range(60)]

    rows = [(i, " ".join(filled(i)), "en", "a") for i in range(300)]  # similarity 0.737
    for pair in range(40):
        text = filled(5000 + pair)
        other = text[:346] + [f"o{pair}x{i}" for i in range(54)]  # 0.76 to the first
        rows += [(2000 + 2 * pair, " ".join(text), "en", "a"), (2001 + 2 * pair, " ".join(other), "en", "a")]
    rng.shuffle(rows)
    found = {r.doc_id: r.component_id for r in near_dedup.near_duplicate_groups(docs(rows)).collect()}
    assert found == {r[0]: r[0] - r[0] % 2 if r[0] >= 2000 else r[0] for r in rows}
