"""Huffman-coded token files: the code, single blocks, and the files against the tokenizer itself."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from dealgauge.llm import token_files as tf
from dealgauge.llm.scratch import Scratch
from dealgauge.llm.text_arrays import texts_of

TOKENIZER = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path(TOKENIZER)


def best_cost(counts, limit):
    """Least total bits over all length vectors that form a prefix code."""
    return min(
        sum(c * w for c, w in zip(counts, widths)) for widths in itertools.product(range(1, limit + 1), repeat=len(counts))
        if sum(2.0 ** -w for w in widths) <= 1)


@pytest.mark.parametrize("counts,limit", [
    ([1, 1], 3), ([8, 4, 2, 1, 1], 3), ([8, 4, 2, 1, 1], 5), ([100, 1, 1, 1, 1, 1], 3), ([5, 5, 5, 5, 5], 4), ([40, 20, 9, 5, 2, 1], 4)])
def test_lengths_are_the_best_under_the_limit(counts, limit):
    lengths = tf.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit and sum(2.0 ** -float(w) for w in lengths) <= 1
    assert int((lengths * np.array(counts)).sum()) == best_cost(counts, limit)


def test_canonical_order_and_prefix_freedom():
    code = tf.Code(tf.code_lengths(np.array([0, 5, 9, 5, 0, 30, 1])))
    texts = {i: format(int(code.codes[i]), f"0{w}b") for i, w in enumerate(code.lengths) if w}
    assert all(a == b or not texts[b].startswith(texts[a]) for a in texts for b in texts)
    by_place = sorted(texts, key=lambda i: (len(texts[i]), i))
    assert by_place == sorted(texts, key=lambda i: texts[i].ljust(32, "0"))
    assert tf.Code.unpack(code.pack()).codes.tolist() == code.codes.tolist()
    assert tf.code_lengths(np.zeros(3, int)).tolist() == [0, 0, 0] and tf.code_lengths(np.array([0, 7])).tolist() == [0, 1]
    with pytest.raises(ValueError):
        tf.code_lengths(np.ones(9, int), 3)


def test_blocks_stand_alone_and_read_from_checkpoints():
    rng = np.random.default_rng(0)
    documents = [rng.zipf(1.3, n).clip(1, 60000).astype(np.uint32) - 1 for n in (0, 1, tf.STRIDE, 5000, 63, 700)]
    counts = np.bincount(np.concatenate(documents))
    code = tf.Code(tf.code_lengths(counts))
    assert 16 <= code.bits <= tf.MAX_BITS or len(counts[counts > 0]) < 1 << 15
    named, bits, steps = [], [], []
    for k, ids in enumerate(documents):
        offsets, own = code.encode(ids)
        named.append((k if k != 3 else None, len(ids), len(own)))
        bits.append(own)
        steps.append(np.diff(offsets).astype("<u2").tobytes())
    together = code.encode_all(np.concatenate(documents[1:]), np.array([len(d) for d in documents[1:]]))
    assert together[1] == b"".join(bits) and together[2].tolist() == np.cumsum([len(b) for b in bits[1:]]).tolist()
    # a document without ids has no checkpoint
    data = b"before" + tf.build_block(2, 77, named[1:], bits[1:], steps[1:])
    block = tf.Block(data, 6)
    assert (block.slice, block.start, block.size) == (2, 77, len(data) - 6) and block.doc_ids == [1, 2, None, 4, 5]
    assert block.ids(code).tolist() == np.concatenate(documents[1:]).tolist()
    for first, count in ((0, 1), (63, 2), (64, 64), (1000, 333), (4990, 50), (5000, 3)):
        assert block.range(code, 2, first, count).tolist() == documents[3][first:first + count].tolist()
    with pytest.raises(ValueError):
        tf.Block(data, 0)


TEXTS = [
    None, "", " ", "a", "Hello  world", "it's  we'll\n\n x\t\n y ", "tail ", " head", "\n", "a \nb", "x\t \ny",
    "x y z", "nb sp   two", "café niño 123 45%$# 你好 \U0001f600", "say <|endoftext|> now", "word " * 9000,
    "z" * 5000, "don't 'll ' s", "a\x1cb c", "  x", "tab\tseparated\tvalues  ", "Hello  world"]


def test_tokenizer_by_words_equals_the_whole_text(path):
    from tokenizers import Tokenizer

    whole, ours = Tokenizer.from_file(path), tf.ByteTokenizer(path)
    assert ours.bare
    for text in TEXTS * 2:
        got = np.frombuffer(ours.encode((text or "").encode()), ours.kind).tolist()
        assert got == whole.encode(text or "", add_special_tokens=False).ids, text
    ours.bare = False
    ours.known.clear()
    for text in TEXTS:
        assert np.frombuffer(ours.encode((text or "").encode()), ours.kind).tolist() == whole.encode(text or "", add_special_tokens=False).ids


def expected(rows, path):
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(path), 0, {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out[doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_files_against_the_tokenizer(spark, docs, path, monkeypatch):
    monkeypatch.setattr(tf, "SLICE_IDS", 3000)
    monkeypatch.setattr(tf, "BLOCK_BYTES", 500)
    rows = [(i * 7 % 23 - 5, t) for i, t in enumerate(TEXTS)] + [(None, "no id")]
    got = tf.token_files(docs([(i, t, None, None) for i, t in rows], clash=True), path)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == expected(rows, path)


def test_repeated_rows_and_ids_come_back(spark, docs, path, tmp_path):
    rows = [(3, "same")] * 4 + [(3, "other")] + [(1, None)]
    scratch, tokens = Scratch(spark, "test"), tf.tokenize(docs([(i, t, None, None) for i, t in rows]), path)
    tf.write_ids(scratch.write(tokens, "ids"), str(tmp_path / "out"), scratch)
    read = tf.read_documents(spark, str(tmp_path / "out"))
    found = sorted((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.ids_crc32 == zlib.crc32(r.ids)) for r in read.collect())
    own = sorted((r.doc_id, np.frombuffer(r.ids, "<u2").tolist(), True) for r in tokens.collect())
    assert found == own and len(own) == 6
    starts = sorted(r.start for r in tf.with_start(read).collect())
    assert starts[0] == 0 and len(set(starts)) == 6


def test_empty_table(spark, docs, path):
    assert tf.token_files(docs([(1, "x", None, None)]).limit(0), path).count() == 0
    assert tf.token_files(docs([(1, "x", None, None)]).filter("doc_id > 5"), path).count() == 0


def test_given_documents(spark, path):
    from given_tables import TESTDATA

    documents = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    got = {r[0]: tuple(r[1:]) for r in tf.token_files(documents, path).collect()}
    assert got == expected([tuple(r) for r in documents.select("doc_id", "text").collect()], path)


def test_words_of_many_texts_are_looked_up_once(path):
    tokenizer = tf.ByteTokenizer(path)
    rows = ["foo.\nBar baz", "a\n\nB c", "a\n\n\nB c", "x y\n", "foo\t\nBar a", " \nfoo a", "a b\nc\nd. \xe9\n\xfc", "a <|endoftext|>\nb", "", " ", "a  b",
            "a\x1cb c", "　x y", "q z\n’s  x", "a\xa0b c\x85d", "abc\n1\xe9 12\n34", "don't we'll!!\n\n go", "你 好", "ab, c.. d?! e'!", " a"]
    column = pa.array([r.encode() for r in rows * 3], pa.binary())
    found = []
    for part, texts in tf.slices([pa.RecordBatch.from_arrays([column.slice(2)], names=["text"])], limit=60):
        found += tokenizer.encode_all(part.column(0), texts)
    assert found == [np.array(tokenizer.inner.encode(r, add_special_tokens=False).ids, tokenizer.kind).tobytes() for r in (rows * 3)[2:]]

    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return tokenizer._word(b" " + word)

    tokenizer.known = Counted()
    column = pa.array([b"the same few words " * 50 + b"end"] * 20, pa.binary())
    tokenizer.encode_all(column, texts_of(column))
    assert Counted.asked == 5
