"""Language-model scores by stupid backoff over n-gram counts of the whole corpus.

The n-grams of one to `order` words of each batch of documents are exploded to rows of 64-bit hash and count, one length
after the other, longest first; the count table of a length is their sum by hash, joined back to the rows in the same
exchange. A count that no other batch adds to is known in its batch, so only the others return there, where scores are
summed per document. A frequent n-gram is one row of each batch however often it occurs. Batches are numbered by split and
place; a second scan has the same batches. Their texts are scored in `PASSES` parts, so that only a part of texts and
counts is shuffled at once.

The score of a word is the count of the longest n-gram that ends in it and that other documents have, over the count
of the words before it in that n-gram, times `BACKOFF` for each longer one that they do not have; without any it is
the word's share of all words. A document is left out of the counts it is scored with;
a word that no other document has counts as seen half a time. A document's score is the mean of the logarithms.

Null and empty texts have no words and score null; a document alone in the corpus scores its words as unseen;
repeated rows count as often as they occur and score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from dealgauge.llm.scratch import Scratch
from dealgauge.llm.text_arrays import SLICE_BYTES, Texts, mix, slices, texts_of, window_hashes

BACKOFF = 0.4
UNSEEN = 0.5
#: Text of a batch.
BATCH_BYTES = 16 << 20
#: Parts of the batches that are scored one after the other.
PASSES = 3


def _words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The text and the hash of each word; bytes are hashed in slices, so that memory follows the words."""
    owners, words, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(texts):
        low = texts.offsets[at]
        to = max(at + 1, int(np.searchsorted(texts.offsets, low + SLICE_BYTES, "right")) - 1)
        part = Texts(texts.data[low:texts.offsets[to]], texts.offsets[at:to + 1] - low)
        starts, ends, owner = part.words()
        owners.append(owner + at)
        words.append(part.word_hashes(starts, ends))
        at = to
    return np.concatenate(owners), np.concatenate(words)


def _grams(owner: np.ndarray, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the n-grams of `length` words inside one text, and the word that each ends in."""
    if length == 1:
        return words, np.arange(len(words))
    at = np.arange(length - 1, len(words))
    inside = owner[at] == owner[at - length + 1]
    return mix(window_hashes(words, length))[inside], at[inside]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, Texts]]:
    """Slices of a scan with a number that follows from the scan's split and the place in it."""
    split = TaskContext.get().partitionId()
    for nth, (part, texts) in enumerate(slices(batches, limit=BATCH_BYTES)):
        yield (split << 32) + nth, part, texts


def _deal(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A batch's distinct n-grams of one length and their counts."""
    for number, _, texts in _batches(batches):
        keys, counts = np.unique(_grams(*_words(texts), length)[0], return_counts=True)
        for at in range(0, len(keys), 100_000):
            own = keys[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(own), number)), pa.array(own.view(np.int64)), pa.array(counts[at:at + 100_000].astype(np.int64))],
                names=["batch", "gram", "n"])


def _score(docs: pd.DataFrame, answers: pd.DataFrame, total: int, order: int) -> pd.DataFrame:
    """Scores of one batch from what other batches add to the counts of its n-grams."""
    docs = docs.sort_values("nth")
    texts = texts_of(pa.array(docs["text"], pa.large_string()))
    owner, words = _words(texts)
    n = np.bincount(owner, minlength=len(texts))
    score = np.full(len(texts), np.nan)
    if len(owner):
        told = answers["gram"].to_numpy(np.int64).view(np.uint64)
        by_gram = np.argsort(told)
        told, elsewhere = told[by_gram], answers["elsewhere"].to_numpy(np.int64)[by_gram]
        met = 0

        def others(length: int) -> np.ndarray:
            """For each word the corpus count of the n-gram that ends in it less its count in the document itself;
            -1 where the document has no such n-gram."""
            nonlocal met
            grams, last = _grams(owner, words, length)
            keys, place, counts = np.unique(grams, return_inverse=True, return_counts=True)
            if len(told):
                at = np.minimum(np.searchsorted(told, keys), len(told) - 1)
                hit = told[at] == keys
                counts[hit] += elsewhere[at[hit]]
                met += int(hit.sum())
            _, back, times = np.unique(owner[last] * len(keys) + place, return_inverse=True, return_counts=True)
            out = np.full(len(owner), -1, np.int64)
            out[last] = counts[place] - times[back]
            return out

        found = others(1)
        rest = np.maximum(total - n[owner], 1)
        value = np.log(np.where(found > 0, found, UNSEEN) / rest)
        for length in range(2, order + 1):
            before, found = found, others(length)
            there = np.flatnonzero(found >= 0)
            seen = np.log(np.maximum(found[there], 1) / np.maximum(before[there - 1], 1))
            value[there] = np.where(found[there] > 0, seen, np.log(BACKOFF) + value[there])
        if met != len(told):
            raise RuntimeError("the documents of a batch changed between two scans")
        sums = np.bincount(owner, weights=value, minlength=len(texts))
        score[n > 0] = sums[n > 0] / n[n > 0]
    return pd.DataFrame({"doc_id": docs["doc_id"].array, "n_words": n, "lm_score": [None if np.isnan(x) else float(x) for x in score]})


def score_documents(documents: DataFrame, order: int = 2) -> DataFrame:
    """doc_id, n_words and lm_score of every row, by n-grams of up to `order` words."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "lm")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tables = []
    for length in range(order, 0, -1):
        # table and rows use the same columns, so that one exchange serves both
        dealt = docs.mapInArrow(partial(_deal, length=length), "batch long, gram long, n long").repartition("gram")
        table = dealt.groupBy("gram").agg(
            F.sum("n").alias("total"), F.min("batch").alias("first"), F.max("batch").alias("last")).filter("first < last")
        answers = dealt.join(table.select("gram", "total").hint("shuffle_hash"), "gram").select(
            "batch", "gram", (F.col("total") - F.col("n")).alias("elsewhere"))
        tables.append(scratch.write(answers, f"grams{length}"))
        scratch.release(1.0)  # the next length shuffles as much again
    answers = tables[0]
    for table in tables[1:]:
        answers = answers.unionByName(table)

    def numbered(batches: Iterator[pa.RecordBatch], nth_pass: int) -> Iterator[pa.RecordBatch]:
        for number, part, _ in _batches(batches):
            if ((number >> 32) + number) % PASSES == nth_pass:
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number)), pa.array(np.arange(n)), part.column("doc_id"), part.column("text")],
                    names=["batch", "nth", "doc_id", "text"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([len(texts.words()[0])], pa.int64())], names=["n"])

    total = docs.select("text").mapInArrow(counted, "n long").agg(F.sum("n")).first()[0] or 0
    scores = None
    for nth_pass in range(PASSES):
        by_batch = docs.mapInArrow(partial(numbered, nth_pass=nth_pass), "batch long, nth long, doc_id long, text string")
        own = answers.filter(F.pmod(F.shiftright("batch", 32) + F.col("batch"), F.lit(PASSES)) == nth_pass)
        scored = scratch.write(by_batch.groupBy("batch").cogroup(own.groupBy("batch")).applyInPandas(
            lambda d, a: _score(d, a, total, order), "doc_id long, n_words long, lm_score double"), f"scores{nth_pass}")
        scores = scored if scores is None else scores.unionByName(scored)
    scratch.drop(*[f"grams{length}" for length in range(1, order + 1)])
    return scores
