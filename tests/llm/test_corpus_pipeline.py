"""The corpus pipeline and the registration of its queries."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from dealgauge.llm import queries
from llm_rows import planted_rows
from pyspark.sql import functions as F
from test_dedup import expected_components, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("size", "key", "spans", "region", "group", "distance", "text_key", "part", "nth", "score")

TESTDATA = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").cache()
    names, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TESTDATA).cache()
        assert docs.columns == names, name
        counts.append(docs.count())
    assert counts[2] < counts[1] <= counts[0] and counts[3] == counts[2]
    pytest.importorskip("public_tokenizers")
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TESTDATA)
    first = Counter(r.doc_id for r in packed.filter("piece = 0").collect())
    assert first == Counter(r.doc_id for r in docs.select("doc_id").collect())


def test_queries_are_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def targets(sizes, most=3):
    """Words that each source gives: shares by weight 1, 2, 3 over sources in order, null last, at most three times its own."""
    order = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: i % 3 + 1 for i, x in enumerate(order)}
    found, open_ = {}, set(order)
    while open_:
        left = sum(sizes.values()) - sum(found.values())
        share = {x: left * weight[x] / sum(weight[y] for y in open_) for x in open_}
        full = {x for x in open_ if share[x] > most * sizes[x]}
        if not full:
            return found | share
        found |= {x: most * sizes[x] for x in full}
        open_ -= full
    return found


def test_run_against_a_plain_version(spark, tmp_path):
    """No row has a language, so the first stage keeps documents with letters and every stage has one right result."""
    path = pytest.importorskip("public_tokenizers").path(corpus_pipeline.TOKENIZER)
    from tokenizers import Tokenizer

    rows = [(i, text, None, source) for i, text, _, source in planted_rows()]
    odd = [None, "", " \t\n", "1234 5678 !", "one two", "one two", "x " * 30, "\xe9" * 40]
    rows += [(5000 + i, text, None, "s1" if i % 2 else None) for i, text in enumerate(odd)] + [rows[0], rows[0]]
    frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).withColumns({c: F.lit("x") for c in CLASHING})
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    heads = {doc for doc, _, head in expected_components(kept) if doc == head}
    kept = [r for r in kept if r[0] in heads]
    first, texts = {}, []
    for doc, text, *_ in kept:
        w = words(text)
        for i in range(len(w) - 12):
            key = tuple(w[i:i + 13])
            first[key] = min(first.get(key, doc), doc)
    for doc, text, _, source in kept:
        w = words(text)
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < doc for j in range(i, i + 13)}
        texts.append((doc, source, [x for i, x in enumerate(w) if i not in gone]))
    sizes = Counter()
    for _, source, w in texts:
        sizes[source] += len(w)
    goal, tokenizer = targets(sizes), Tokenizer.from_file(path)

    def coded(w):
        return np.array([*tokenizer.encode(b" ".join(w).decode(), add_special_tokens=False).ids, 0], "<u4").tobytes()

    found, cut = Counter((r.doc_id, r.ids_crc32) for r in packed), Counter()
    for doc, source, w in texts:
        whole, epochs = (doc, zlib.crc32(coded(w))), int(goal[source] // sizes[source]) if sizes[source] else 0
        copies = found.pop(whole, 0)
        assert copies in ((epochs, epochs + 1) if w else (1,)), whole
        for other in [k for k in found if k[0] == doc]:
            assert found.pop(other) == 1 and other[1] in {zlib.crc32(coded(w[:n])) for n in range(1, len(w))}
            cut[source] += 1
    assert not found and all(n == 1 for n in cut.values())
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))] and sum(n for _, n in pieces) <= 2048
    assert len(bins) <= 1.1 * sum(r.length for r in packed) / 2048 + 1


def test_run_on_an_empty_table(spark, docs, tmp_path):
    pytest.importorskip("public_tokenizers")
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
