"""Mixing, language ID, packing, scores, archives, neighbours and quality rules against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealgauge.llm import language_id, lm_score, mixing, neighbours, packing, quality, warc
from dealgauge.llm.scratch import Scratch
from llm_rows import odd_rows, planted_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TESTDATA = "/root/testdata/sf0.001"


def count(text):
    return len(WORD.findall(text or ""))


def filled(sizes, most=3):
    """Targets by repeated resharing; `sizes` by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped = set()
    while True:
        free = [s for s in names if s not in capped]
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        level = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return {s: float(most * sizes[s]) if s in capped else level * weight[s] for s in names}
        capped.update(over)


@pytest.mark.parametrize("rows", [odd_rows(), planted_rows()], ids=["odd", "planted"])
def test_mixing_meets_targets(spark, docs, rows):
    sized = docs(rows).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    found = mixing.mix_sizes(sized, Scratch(spark, "test")).collect()
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += count(text)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], count(r[1])) for r in rows)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(filled(sizes)[r.source])
        taken[r.source] += r.taken
    for source, target in filled(sizes).items():
        assert abs(taken[source] - target) <= 1
    again = mixing.mix_sizes(sized, Scratch(spark, "test")).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mixed_documents_have_the_taken_words(docs):
    rows = planted_rows()
    mixed = mixing.mix_documents(docs(rows, True))
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += count(text)
    got = defaultdict(int)
    for r in mixed.collect():
        got[r.source] += count(r.text)
    assert mixed.columns == docs(rows, True).columns
    for source, target in filled(sizes).items():
        assert abs(got[source] - target) <= 1


def test_word_count_equals_the_pattern(docs):
    found = docs(odd_rows()).select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    assert all(r.n == count(r.text) for r in found)


def test_language_id_on_held_out_rows(spark):
    documents = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    model = language_id.fit(documents, "doc_id % 2 = 0")
    told = language_id.identify(documents.filter("doc_id % 2 = 1 and lang is not null"), model)
    rows = told.collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_of_odd_rows(docs):
    frame = docs(odd_rows(), True)
    model = language_id.fit(frame)
    told = language_id.identify(frame, model)
    for r in told.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
    nothing = language_id.fit(docs([(1, "abc", None, None)]))
    assert nothing is None
    assert language_id.identify(frame, nothing).filter("lang_pred <> 'und'").count() == 0
    assert language_id.identify(docs([]), model).count() == 0


@pytest.mark.parametrize("rows", [odd_rows(), planted_rows()], ids=["odd", "planted"])
def test_packing_is_exact_and_dense(docs, rows):
    tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    found = packing.pack(packing.cut_pieces(docs(rows, True), path)).collect()
    tokenizer = Tokenizer.from_file(path)
    expected = Counter()
    for doc, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at:at + 2048]
            expected[doc, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    fills = defaultdict(list)
    for r in found:
        fills[r.sequence_id].append((r.offset, r.length))
    for places in fills.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in found)
    assert len(fills) <= -(-total // 2048) + 1


def test_packing_rounds_and_crossover(monkeypatch, docs):
    monkeypatch.setattr(packing, "CELL", 8)
    tokenizers = pytest.importorskip("public_tokenizers")
    rows = planted_rows()
    found = packing.pack(packing.cut_pieces(docs(rows), tokenizers.path("word_bpe_49k.json")))
    by = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert found.count() == len(rows) and all(r.n <= 2048 for r in by)
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 900, 200)
    a, b = (packing.random_start(sizes, 2048, rng, 0.2) for _ in range(2))
    child = packing.crossover(a, b, sizes, 2048, 0.5, rng)
    assert sorted(i for x in child for i in x) == list(range(200))
    assert all(sizes[x].sum() <= 2048 for x in child)


@pytest.mark.parametrize("rows", [odd_rows(), planted_rows()], ids=["odd", "planted"])
def test_lm_scores_equal_plain_counts(docs, rows):
    found = lm_score.score_documents(docs(rows, True)).collect()
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]
    one, two = Counter(), Counter()
    for _, w in texts:
        one.update(w)
        two.update(zip(w, w[1:]))
    total, expected = sum(one.values()), []
    for doc, w in texts:
        own, pairs, value = Counter(w), Counter(zip(w, w[1:])), 0.0
        for i, x in enumerate(w):
            share = ((one[x] - own[x]) or 0.5) / max(1, total - len(w))
            seen = two[w[i - 1], x] - pairs[w[i - 1], x] if i else 0
            value += math.log(share) if not i else math.log(seen / max(1, one[w[i - 1]] - own[w[i - 1]])) if seen else math.log(0.4 * share)
        expected.append((str(doc), len(w), round(value / len(w), 9) if w else None))
    assert Counter((str(r.doc_id), r.n_words, None if r.lm_score is None else round(r.lm_score, 9)) for r in found) == Counter(expected)


def test_archives_round_trip(spark):
    long, other = "<p>é" * 400, "x" * 1200 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a", long), (2, None, long), (9, "http://b\r\nX: y", long), (3, "u", other), (4, "u", other), (5, "u", "short"),
            (6, "u", "short"), (7, "u", None), (8, "u", ""), (None, "u", long), (None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    found = warc.archive_pages(frame).collect()
    expected = Counter()
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == raw]
        refers = max(same) if page is not None and len(raw) >= 1000 and page != max(same) else None
        expected[page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected
    assert all(r.digest_holds for r in found)
    assert warc.archive_pages(frame.limit(0)).count() == 0


def test_archives_give_back_the_pages(spark):
    pages = spark.read.parquet(f"{TESTDATA}/pages.parquet")
    scratch = Scratch(spark, "test")
    warc.write_archives(warc.resolve_revisits(pages), f"{scratch.folder}/archives", 3)
    read = warc.read_archives(spark, f"{scratch.folder}/archives").filter("record_type = 'response'")
    both = read.select("page_id", F.col("html").alias("back")).join(pages, "page_id")
    assert both.filter("back <> html").count() == 0 and both.count() == read.count() > 0


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[700:900] = x[3]  # ties
    x[5] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3000, None), (3020, [1.0, None] * 8), (3040, [float("nan")] * 16), (3060, [1.0]), (None, [1.0] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("width", F.lit(1))
    usable = neighbours.usable(frame, "vec_id", "embedding")
    found = neighbours.nearest(usable, usable.filter("vec_id % 20 = 0"))
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    y = x.astype(float)
    hits = total = 0
    for q in range(0, 1500, 20):
        s = y @ y[q]
        order = [i for i in sorted(range(1500), key=lambda i: (-s[i], i)) if i != q and i != 5][:20]
        ids = [i for i, _ in got[q]]
        assert ids == sorted(ids, key=lambda i: (-dict(got[q])[i], i)) and len(ids) == 20
        hits += sum(round(v, 9) >= round(s[order[-1]], 9) for _, v in got[q])
        total += 20
    assert hits / total >= 0.9 and set(got) == set(range(0, 1500, 20))
    assert neighbours.nearest(usable.limit(0), usable.limit(0)).count() == 0


def test_few_vectors_are_all_found(spark):
    usable = neighbours.usable(spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(5)], "i long, v array<double>"), "i", "v")
    rows = neighbours.nearest(usable, usable.filter("vec_id = 0"), k=20).orderBy("rank").collect()
    assert [r.vec_id for r in rows] == [4, 3, 2, 1] and [r.score for r in rows] == [6.0, 5.0, 4.0, 3.0]


def base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered, seen, again = set(), set(), 0
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered), n < 20 or 100 * len(covered) > 30 * n


@pytest.mark.parametrize("extra", [[], [(50, prose(8, 40) + "\n" + prose(8, 40) + "\n\nx\n \n", "en", "a"), (51, "#a &b " * 30, "en", "a")]])
def test_quality_base_rules(docs, extra):
    rows = odd_rows() + extra
    found = quality.quality_rules(docs(rows, True)).collect()
    got = Counter((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == Counter((str(r[0]), *base(r[1])) for r in rows)
    assert not any(r.kept and r.base_failed for r in found)


def test_quality_rejects_outliers_and_keeps_prose(docs):
    rows = [(i, prose(i, 60 + i), "en", "a") for i in range(150)]
    junk = [(1000 + i, " ".join(f"{w}###" for w in prose(i, 80).split()), "en", "a") for i in range(10)]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs(rows + junk)).collect()}
    assert all(kept[i] for i in range(150)) and not any(kept[1000 + i] for i in range(10))
    assert quality.quality_rules(docs([])).count() == 0


def test_quality_plan_is_native(docs):
    plan = quality.base_statistics(docs(planted_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_isolated_queries_find_their_neighbours_beside_a_dense_cluster(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    x = centre + 0.05 * rng.standard_normal((3000, 16))
    lone = np.arange(0, 100, 20)
    x[lone] = rng.standard_normal((len(lone), 16)) - centre
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    usable = neighbours.usable(frame, "vec_id", "embedding")
    found = neighbours.nearest(usable, usable.filter("vec_id % 20 = 0")).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in found} == dict.fromkeys(range(0, 3000, 20), 20)


def test_language_sample_has_every_language_and_no_copies(docs):
    copied = [(i, "one text", "en", "a") for i in range(50)] + [(100 + i, prose(i, 5), "en", "a") for i in range(20)]
    many = [(1000 + i, f"word{i}", f"x{i}", "a") for i in range(70)]
    frame = docs(copied + many)
    taken = language_id.labelled_sample(frame, "true", 10).collect()
    assert len({r.text for r in taken if r.lang == "en"}) == 10
    assert Counter(r.lang for r in taken) == Counter({"en": 10} | {f"x{i}": 1 for i in range(70)})
    assert language_id.fit(frame, per_language=1).languages == sorted({"en"} | {f"x{i}" for i in range(70)})


def test_pipeline_keeps_documents_where_nothing_is_labelled(spark, docs):
    import corpus_pipeline

    rows = [(doc, text, None, source) for doc, text, _, source in odd_rows()]
    kept = corpus_pipeline.languages(spark, docs(rows, True), "")
    assert kept.columns == docs(rows, True).columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter((r[0], r[1]) for r in rows if any(c.isalpha() for c in r[1] or ""))


@pytest.mark.parametrize("order", [1, 3, 4])
def test_lm_scores_of_any_order_equal_plain_counts(docs, monkeypatch, order):
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 2000)  # several batches
    rows = odd_rows() + planted_rows()
    found = lm_score.score_documents(docs(rows), order).collect()
    texts = [(r[0], (r[1] or "").encode().split()) for r in rows]

    def grams(w):
        return Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))

    every, total, expected = sum((grams(w) for _, w in texts), Counter()), sum(len(w) for _, w in texts), []
    for doc, w in texts:
        own, value = grams(w), 0.0
        for i in range(len(w)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1:i + 1])
                seen = every[gram] - own[gram]
                if n == 1:
                    value += math.log(factor * (seen or 0.5) / max(1, total - len(w)))
                elif seen:
                    value += math.log(factor * seen / (every[gram[:-1]] - own[gram[:-1]]))
                    break
                factor *= 0.4
        expected.append((str(doc), len(w), round(value / len(w), 9) if w else None))
    assert Counter((str(r.doc_id), r.n_words, None if r.lm_score is None else round(r.lm_score, 9)) for r in found) == Counter(expected)


def test_packing_tokenizer_by_words_equals_the_whole_text():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    ours = packing.WordTokenizer(path)
    assert ours.bare
    texts = [
        None, "", " ", "Don't STOP, it's 12%", "\u0130stanbul \u01c5 \u0149 \ufb01ne x\u0301 \u00e9 \u00c0\u00c9 Stra\u00dfe \u0178", "a\xa0b \x85c x\x1cy",
        "<|endoftext|> <|startoftext|>X", "\u00bd \u00b23 \u00aa \u00ba \u00a9\u00ae\u2122", "\u4f60\u597d ok \U0001f600", "\u017f \u212a \u212b",
        "A" * 100 + " " + "b.c,d" * 30, "x\u00ady \u00b7", "tab\tand\nline  end ", "Don't STOP, it's 12%"]
    for bare in (True, False):
        ours.bare = bare
        ours.known.clear()
        for text, ids in zip(texts, ours.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == ours.inner.encode(text or "", add_special_tokens=False).ids, text


def test_language_id_sends_each_text_once(spark, docs, monkeypatch):
    """Rows stay in Spark: Python gets a text and whether it has letters, and gives back the prediction."""
    import corpus_pipeline

    frame = docs(odd_rows(), True)
    told = language_id.identify(frame, language_id.fit(frame))
    kept = corpus_pipeline.languages(spark, frame, "")
    for plan in (told, kept):
        said = plan._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in said and said.count("ArrowEvalPython") == 1
    assert kept.columns == frame.columns


def test_lm_counts_take_one_exchange_a_length(docs, monkeypatch, tmp_path):
    """The count table and the rows that it is joined to share an exchange; texts are scored in parts."""
    plans = []
    write = Scratch.write
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 2000)
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: (plans.append((name, df)), write(self, df, name))[1])
    lm_score.score_documents(docs(planted_rows()), 3)
    grams = [df for name, df in plans if name.startswith("grams")]
    assert len(grams) == 3 and sum(name.startswith("scores") for name, _ in plans) == lm_score.PASSES
    for df in grams:
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("ReusedExchange") == 1 and final.count("MapInArrow") == 1
