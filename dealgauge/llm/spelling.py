"""Spelling variants: words of a corpus that are one edit from a more frequent word.

Near words are found by dynamic programming over sorted lists. All words of a list that share a prefix share the rows
of the edit matrix up to there, so a row (a band of three cells around the diagonal, enough for one edit) is made once
per query and shared prefix, known from the common prefix lengths of neighbours; a range of the list is left as soon
as its shared prefix is more than one edit from the query's. The rows of all queries of a list go down together.

Lists are made by what one edit leaves alone. Of two near words, the shorter of length L, the first difference is at
some place p of 0..L; for a range of places a <= p < b both words have the same first a and the same last L - b
characters. Words are dealt by these for the two halves of 0..L. A list of more than `LIST_WORDS` words is dealt anew by
half as wide ranges, and so on; a range of one place holds a bounded list (two free characters), so no list grows
with the corpus and none is cut. A pair is reported from the one range that holds its p.

Null texts have no words. Repeated rows count again. A text of any length is one row of work for counting, and a word of any length
one entry; words beyond `LIST_WORDS` copies are one entry with a count. Only doc_id and text are read, so other columns
cannot clash. A null doc_id is written as nothing in front of the colon. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dealgauge.llm.scratch import Scratch

#: One run in so many loses a character.
TYPO_EVERY = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: A form is at least so many times as frequent as its variant.
FORM_RATIO = 2
#: Words of a list that is scanned as it is.
LIST_WORDS = 4096
#: Words that a task counts before it sends what it has; entries that one scan holds.
COUNTED, SCANNED = 200_000, 8_000

# A letter is one byte of A-Z, a-z or two bytes from U+00C0 to U+00FF; runs are split at all else.
_OTHER = re.compile(rb"[\xc2\xc4-\xff][\x80-\xbf]*")
_TO_SPACE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b == 0xC3 or 0x80 <= b < 0xC0 else 32 for b in range(256))


def runs_of(text: bytes) -> list[bytes]:
    """Lower-cased maximal runs of letters of a UTF-8 text."""
    if not text.isascii():
        text = _OTHER.sub(b" ", text)
    return text.translate(_TO_SPACE).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: Counter[bytes] = Counter()

    def rows() -> pa.RecordBatch:
        kept = [(w, n) for w, n in totals.items() if n]
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            runs = runs_of(text)
            totals.update(runs)
            start = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
            start, crc32 = zlib.crc32(b":", start), zlib.crc32
            hit = [w for w in set(runs) if not crc32(w, start) % TYPO_EVERY]
            if hit:
                own = Counter(runs) if len(hit) > 4 else {w: runs.count(w) for w in hit}
                for run in hit:
                    letters = run.decode()
                    at = crc32(run, start) % len(letters)
                    totals[run] -= own[run]
                    totals[(letters[:at] + letters[at + 1:]).encode()] += own[run]
            if len(totals) > COUNTED:
                yield rows()
                totals.clear()
    yield rows()


def count_words(documents: DataFrame) -> DataFrame:
    """word and n: runs after the seeded typos, with enough characters and occurrences."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    counted = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(_counted, "word binary, n long")
    word = F.col("word").cast("string")
    return counted.select(word.alias("word"), "n").filter(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# --- lists --------------------------------------------------------------------------------------------------


def _dealt(entries: DataFrame) -> DataFrame:
    """Entries (word, n, len, short, a, b) with the key of what their range of places leaves alone. `short` is the length of the
    shorter word of the pairs to be found."""
    tail = F.col("short") - F.col("b")
    return entries.withColumn("key", F.concat_ws(
        " ", F.col("short").cast("string"), F.col("a").cast("string"), F.substr("word", F.lit(1), F.col("a")),
        F.when(tail > 0, F.substr("word", F.col("len") - tail + 1, tail)).otherwise("")))


def _halves(rows: DataFrame, low: str, high: str) -> DataFrame:
    middle = F.floor((F.expr(low) + F.expr(high) + 1) / 2)
    return rows.withColumn("half", F.explode(F.array(
        F.struct(F.expr(low).cast("int").alias("a"), middle.cast("int").alias("b")),
        F.struct(middle.cast("int").alias("a"), F.expr(high).cast("int").alias("b"))))).select(
            "word", "n", "len", "short", "half.a", "half.b").filter("a < b")


def near_pairs(words: DataFrame, scratch: Scratch, most: int = LIST_WORDS) -> DataFrame:
    """word, near, near_n for every ordered pair of different words (word, n) at one edit."""
    sized = words.withColumn("len", F.char_length("word")).withColumn(
        "short", F.explode(F.array(F.col("len"), F.col("len") - 1)))
    entries, found, level = _dealt(_halves(sized, "0", "short + 1")), [], 0
    while True:
        level += 1
        entries = scratch.write(entries, f"entries{level}")
        heavy = scratch.write(
            entries.filter("b - a > 1").groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > most).select("key"),
            f"heavy{level}")
        lists = entries.join(heavy, "key", "left_anti")
        # lists are dealt by key; in a partition they come one after the other, sorted
        found.append(scratch.write(
            lists.select("key", "word", "n", "short", "a", "b").repartition("key").sortWithinPartitions("key", "word")
            .mapInArrow(_scanned, "word string, near string, near_n long"), f"pairs{level}"))
        if heavy.isEmpty():
            break
        entries = _dealt(_halves(entries.join(heavy, "key", "left_semi"), "a", "b"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of whole lists, many lists at once; a list may go on in the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, SCANNED)
            at += part.num_rows
            held.append(part)
            if sum(p.num_rows for p in held) >= SCANNED:
                table = pa.Table.from_batches(held).combine_chunks()
                last = table.column("key")[-1].as_py()
                keys = table.column("key").to_pylist()
                cut = len(keys)
                while cut and keys[cut - 1] == last:
                    cut -= 1
                held = table.slice(cut).to_batches()
                if cut:
                    yield _pairs_of(table.slice(0, cut))
    if held:
        yield _pairs_of(pa.Table.from_batches(held))


def _pairs_of(table: pa.Table) -> pa.RecordBatch:
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    keys = table.column("key").to_pylist()
    query, near = scan_lists(keys, words, *(table.column(c).to_numpy() for c in ("short", "a", "b")))
    taken = np.array(words, object)
    return pa.RecordBatch.from_arrays(
        [pa.array(taken[query], pa.string()), pa.array(taken[near], pa.string()), pa.array(n[near], pa.int64())],
        names=["word", "near", "near_n"])


def scan_lists(keys: list[str], words: list[str], short: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of words and their near words in lists that come one after the other, each sorted.

    A range of a list is a run of words that share their first `depth` characters. For each open (query, range) the band
    of the edit matrix is kept: D[depth][depth - 1], D[depth][depth], D[depth][depth + 1], counted up to 2."""
    size = len(words)
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    letters = np.append(letters, 0)
    starts = np.array([k == 0 or keys[k] != keys[k - 1] for k in range(size)])
    first = np.flatnonzero(starts)
    last = np.append(first[1:], size)
    many = last - first > 1
    first, last = first[many], last[many]
    # common prefix with the word before; -1 where a list starts
    common = np.full(size, -1, np.int64)
    for k in np.flatnonzero(~starts):
        x, y = words[k - 1], words[k]
        stop, c = min(len(x), len(y)), int(low[k])
        while c < stop and x[c] == y[c]:
            c += 1
        common[k] = c
    # every word of a list is a query, and its range is the list; all share their first `low` characters
    members = last - first
    query = np.repeat(first, members) + _counting(members)
    begin, end = np.repeat(first, members), np.repeat(last, members)
    depth = low[query].astype(np.int64)
    band = np.stack([np.ones_like(depth), np.zeros_like(depth), np.ones_like(depth)])
    parted = depth.copy()  # places from which on query and range are known to be equal: the first difference
    out_query, out_near = [], []

    def letter(word: np.ndarray, place: np.ndarray) -> np.ndarray:
        inside = (place >= 0) & (place < lengths[word])
        return np.where(inside, letters[np.where(inside, begins[word] + place, 0)], -1)

    while len(query):
        # words that end here come first in their range
        ends = lengths[begin] == depth
        over = lengths[query] - depth + 1
        reach = ends & (over >= 0) & (over <= 2)
        distance = np.where(reach, band[np.clip(over, 0, 2), np.arange(len(query))], 2)
        p = parted
        told = (distance == 1) & (np.minimum(lengths[query], depth) == short[query]) & (low[query] <= p) & (p < high[query])
        out_query.append(query[told])
        out_near.append(begin[told])
        begin = begin + ends
        alive = begin < end
        query, begin, end, depth, band, parted = (
            query[alive], begin[alive], end[alive], depth[alive], band[:, alive], parted[alive])
        if not len(query):
            break
        # ranges by the next character: they start where the common prefix ends here
        opens = _ranges(begin, end, depth, common)
        of, new_begin, new_end = opens
        query, depth, band, parted = query[of], depth[of] + 1, band[:, of], parted[of]
        begin, end = new_begin, new_end
        c = letters[begins[begin] + depth - 1]
        # cells beyond the query's end can't be reached again, but count as 2 or more anyway
        n0 = np.minimum(band[0] + (letter(query, depth - 2) != c), band[1] + 1)
        n1 = np.minimum(np.minimum(band[1] + (letter(query, depth - 1) != c), band[2] + 1), n0 + 1)
        n2 = np.minimum(band[2] + (letter(query, depth) != c), n1 + 1)
        band = np.minimum(np.stack([n0, n1, n2]), 2)
        parted = np.where(n1 == 0, depth, parted)
        near = band.min(0) <= 1
        query, begin, end, depth, band, parted = (
            query[near], begin[near], end[near], depth[near], band[:, near], parted[near])
    return np.concatenate(out_query or [np.zeros(0, np.int64)]), np.concatenate(out_near or [np.zeros(0, np.int64)])


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 of each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _ranges(begin: np.ndarray, end: np.ndarray, depth: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that share one character more than the given ones: index of the given range, begin, end."""
    found = [[], [], []]
    for d in np.unique(depth):
        at = np.flatnonzero(depth == d)
        opens = np.append(np.flatnonzero(common <= d), len(common))
        a, b = np.searchsorted(opens, begin[at], "right"), np.searchsorted(opens, end[at], "left")
        parts = b - a + 1
        of = np.repeat(at, parts)
        k = _counting(parts)
        inner = np.repeat(a, parts) + k
        found[0].append(of)
        found[1].append(np.where(k == 0, begin[of], opens[inner - 1]))
        found[2].append(np.where(k == np.repeat(parts, parts) - 1, end[of], opens[np.minimum(inner, len(opens) - 1)]))
    return tuple(np.concatenate(x) for x in found)


# --- variants -----------------------------------------------------------------------------------------------


def spelling_variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus.

    A form has more occurrences than its word, so forms lead upwards and end; roots are found by doubling the steps."""
    scratch = Scratch(documents.sparkSession, "spelling")
    words = scratch.write(count_words(documents), "words")
    best = near_pairs(words, scratch).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n"))
    formed = F.col("form_n") >= FORM_RATIO * F.col("n")
    judged = scratch.write(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")), "judged")
    steps = scratch.write(judged.filter("form is not null").select("word", F.col("form").alias("root")), "steps0")
    turn = 0
    while True:
        turn += 1
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = scratch.write(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"steps{turn}")
        if steps.filter("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return judged.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
