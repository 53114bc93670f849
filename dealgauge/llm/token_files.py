"""Token ids in binary files, coded by one canonical length-limited Huffman code.

Steps: texts become token ids; the ids of all documents are counted (a table of at most one row per id of the
vocabulary); the package-merge rule gives each id a code length of at most `MAX_BITS`; lengths alone fix the
canonical code, so the code file holds lengths only. Each document is coded by itself: its bits, and the bit offset
of every `STRIDE`-th id. Coded documents, not texts or ids, are shuffled into ascending order and laid into blocks
of about `BLOCK_BYTES`. A block names its slice (a range of doc_ids), the place of its first id in the slice, and
its documents; it can be read without any other block. Decoding looks codes up in one table of 2^bits entries, at
all checkpoints of a block at once.

Files are written by Spark's text sink with a line separator that ends a block, so they go to any store that Spark
can write; block lengths, not separators, guide the reader. Layout under the path: `code/`, `blocks/`.

Null and empty texts are documents without ids but the end id. A null doc_id comes first and is read back as
null; rows of one doc_id are ordered by the hash of their ids, and equal rows are documents of their own. One very
long text is one record with checkpoints; a block holds at least one whole document. An empty table gives an empty code,
no blocks and no rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import codecs
import gc
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from dealgauge.llm.scratch import Scratch
from dealgauge.llm.text_arrays import Texts, slices

END_ID = 0
MAX_BITS = 20
STRIDE = 64
BLOCK_BYTES = 1 << 18
#: Rows of a file (blocks), and ids of a slice of the sorted documents.
FILE_BLOCKS = 64
SLICE_IDS = 8_000_000
#: Texts whose words are looked up together, in bytes.
LOOKUP_BYTES = 16 << 20
#: Words whose ids a worker remembers; of the older half those that are met again.
REMEMBERED = 1_500_000
BLOCK_END = "\x00END\x00"
MAGIC = b"TKB1"


# --- ids of texts -------------------------------------------------------------------------------------------


# fixed values: the bytes that a byte-level tokenizer writes as the character of the same number; the others follow from 256 on
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_letters() -> str:
    """The character that a byte-level tokenizer writes for each byte."""
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in PRINTABLE else chr(next(rest)) for b in range(256))


class ByteTokenizer:
    """Ids of texts under a byte-level tokenizer, a word at a time.

    The tokenizer first cuts a text into pieces and never merges across their edges. A single space before a
    character that is no white space always begins a piece, so a text is the chain of its words, each with that
    space. Words and pieces are encoded by the tokenizer once and remembered. Texts in which white space beyond ASCII
    could move an edge go to the tokenizer whole. `encode_all` looks up each distinct word of many texts once.
    """

    # fixed value: how a byte-level tokenizer cuts text into pieces
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    EDGE = re.compile(rb" (?=[^\t-\r ])")
    BLUNT = re.compile(rb" (?=[\t-\r ]|\Z)")
    #: A line end between two words is a piece of its own.
    LINE_END = re.compile(rb"(?<=[^\t-\r ])\n(?=[^\t-\r ])")
    CONTROL_SPACE = re.compile(rb"[\x1c-\x1f]")
    WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
    PLAIN = re.compile("[\x00-ɏ]*")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        self.inner = Tokenizer.from_file(path)
        self.model = self.inner.model
        self.kind = np.dtype("<u2" if self.inner.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = byte_letters()
        self.special = re.compile("|".join(re.escape(t.content) for t in self.inner.get_added_tokens_decoder().values()) or r"(?!)")
        # pieces go to the model alone only where the tokenizer is the plain one that the rule above describes
        bare = self.inner.normalizer is None and isinstance(self.inner.pre_tokenizer, pre_tokenizers.ByteLevel)
        self.bare = bare and self.inner.encode("a b'll\n\n c", add_special_tokens=False).ids == [
            t.id for p in self.PIECES.findall("a b'll\n\n c") for t in self.model.tokenize(self._mapped(p))]
        self.plain = self.bare and all(re.search("[^A-Za-z.,;:!?]", t.content) for t in self.inner.get_added_tokens_decoder().values())
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.pieces: dict[str, bytes] = {}
        owner = self

        class Known(dict):
            def __missing__(self, word: bytes) -> bytes:
                if len(self) >= REMEMBERED // 2:
                    owner.older = dict(self)
                    self.clear()
                ids = owner.older.get(word)
                if ids is not None:
                    self[word] = ids
                    return ids
                if b"\n" in word and not word.startswith(b"\n"):
                    first, *others = owner.LINE_END.split(word) if owner.bare else [word]
                    if others:
                        return self[first] + b"".join([self[b"\n" + w] for w in others])
                # a key that starts with a line end is a line's first word with it, all others have a space before them
                ids = owner._word(word if word.startswith(b"\n") else b" " + word)
                if len(word) < 40 and b"\n" not in word[1:]:
                    self[word] = ids
                return ids

        self.known = Known()
        self.older: dict[bytes, bytes] = {}

    def _mapped(self, piece: str) -> str:
        return codecs.charmap_decode(piece.encode(), "strict", self.letters)[0]

    def _mapped_ids(self, piece: bytes) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(codecs.charmap_decode(piece, "strict", self.letters)[0])]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.inner.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: bytes) -> bytes:
        if self.bare and self.plain:
            # ASCII letters are one piece, and so are the marks behind them
            letters = word.rstrip(b".,;:!?")
            if letters[1:].isalpha() and (letters[0] == 32 or letters[:1].isalpha()):
                if len(letters) == len(word):
                    return self._mapped_ids(word)
                marks = word[len(letters):].decode()
                ids = self.pieces.get(marks)
                if ids is None:
                    ids = self._piece(marks)
                    if len(marks) < 40 and len(self.pieces) < REMEMBERED:
                        self.pieces[marks] = ids
                return (self.known[letters[1:]] if letters[0] == 32 else self._mapped_ids(letters)) + ids
        text = word.decode()
        if not self.bare or not (text.isascii() or self.PLAIN.fullmatch(text)) or self.special.search(text):
            return self._whole(text)
        pieces = self.PIECES.findall(text)
        if len(pieces) == 1:
            return self._piece(text)
        found = []
        for piece in pieces:
            # a piece with its space is a word too
            store, key = (self.known, piece[1:].encode()) if piece[0] == " " else (self.pieces, piece)
            ids = store.get(key)
            if ids is None:
                ids = self._piece(piece)
                if len(piece) < 40 and len(store) < REMEMBERED:
                    store[key] = ids
            found.append(ids)
        return b"".join(found)

    def _piece(self, piece: str) -> bytes:
        return self._mapped_ids(piece.encode())

    def encode(self, data: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian numbers of `kind`."""
        if self.CONTROL_SPACE.search(data) or not data.isascii() and self.WIDE_SPACE.search(data.decode()):
            return self._whole(data.decode())
        words = self.EDGE.split(data) if self.BLUNT.search(data) else data.split(b" ")
        head = self._word(words[0]) if words[0] else b""
        return head + b"".join(map(self.known.__getitem__, words[1:]))

    # fixed values: by their first byte, the characters that `encode` treats on their own
    MARKS = np.isin(np.arange(256), [0x1c, 0x1d, 0x1e, 0x1f, 0xc2, 0xe1, 0xe2, 0xe3])
    WHITE = np.isin(np.arange(256), [*range(9, 14), 32])

    def _odd(self, texts: Texts) -> np.ndarray:
        """Which texts may hold white space beyond ASCII or control spaces, or a space with no word behind it."""
        data, ends = texts.data, texts.offsets[1:]
        odd = np.zeros(len(texts), bool)
        marks = np.flatnonzero(self.MARKS[data])
        second = data[np.minimum(marks + 1, len(data) - 1)]
        # of U+0080 to U+00BF only these two are white space
        marks = marks[(data[marks] != 0xc2) | (second == 0x85) | (second == 0xa0)]
        spaces = np.flatnonzero(data == 32)
        last = np.zeros(len(data) + 1, bool)
        last[ends] = True
        spaces = spaces[last[spaces + 1] | self.WHITE[data[np.minimum(spaces + 1, len(data) - 1)]]]
        odd[np.searchsorted(ends, np.concatenate([marks, spaces]), "right")] = True
        return odd

    def encode_all(self, column: pa.Array, texts: Texts) -> list[bytes]:
        """`encode` of every text of a binary column without nulls; `texts` are its bytes."""
        odd = self._odd(texts)
        plain = column.filter(pa.array(~odd))
        lists = pc.split_pattern(plain, " ")
        coded = lists.flatten().dictionary_encode()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        place = coded.indices.to_numpy().copy()
        # the first word of a text has no space before it
        words = coded.dictionary
        heads = words.take(pa.array(place[bounds[:-1]])).to_pylist()
        place[bounds[:-1]] = len(words) + np.arange(len(heads))
        known = self.known
        _, ends, data = words.buffers()
        cuts, raw = np.frombuffer(ends, np.int32)[:len(words) + 1].tolist() if len(words) else [0], data.to_pybytes() if data is not None else b""
        ids = [known[raw[a:b]] if b > a else b"" for a, b in zip(cuts, cuts[1:])] + [self._word(w) if w else b"" for w in heads]
        taken = pa.array(ids, pa.large_binary()).take(pa.array(place))
        _, ends, data = taken.buffers()
        cuts = np.frombuffer(ends, np.int64)[bounds].tolist() if len(heads) else [0]
        raw = memoryview(data) if data is not None else b""
        found = iter([bytes(raw[a:b]) for a, b in zip(cuts, cuts[1:])])
        return [self.encode(texts.text_bytes(i)) if own else next(found) for i, own in enumerate(odd.tolist())]


_TOKENIZERS: dict[str, ByteTokenizer] = {}


def _tokenized(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    # a module-level function goes to the worker by name, so its tokenizer serves all tasks there
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteTokenizer(path)
    tokenizer = _TOKENIZERS[path]
    end, width = np.array([END_ID], tokenizer.kind).tobytes(), tokenizer.kind.itemsize
    gc.disable()  # each collection would walk all remembered words; nothing here makes cycles
    try:
        for batch in batches:
            for part, texts in slices([batch], limit=LOOKUP_BYTES):
                ids = [i + end for i in tokenizer.encode_all(part.column(1), texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(i) // width for i in ids], pa.int64()), pa.array([width] * len(ids), pa.int32()),
                     pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "width", "ids"])
    finally:
        gc.enable()


def tokenize(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, width (bytes of an id: 2 where the vocabulary allows, else 4) and ids (little-endian), with the
    end id."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(
        partial(_tokenized, path=tokenizer_path), "doc_id long, n_tokens long, width int, ids binary")


def _numbers(ids: bytes, width: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if width == 2 else "<u4")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(0, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            ids, widths = (batch.slice(at, 256).column(c).to_pylist() for c in (0, 1))
            for width in set(widths):
                own = np.bincount(_numbers(b"".join(i for i, w in zip(ids, widths) if w == width), width))
                if len(own) > len(totals):
                    totals = np.concatenate([totals, np.zeros(len(own) - len(totals), np.int64)])
                totals[: len(own)] += own
    met = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(totals[met], pa.int64())], names=["id", "n"])


def count_ids(tokens: DataFrame) -> DataFrame:
    """id and n over all documents; every task sends one row per id that it met."""
    return tokens.select("ids", "width").mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


# --- the code -----------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Best code length of each symbol under `limit`, by package-merge; 0 for symbols that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    # level by level: single symbols merged with the pairs of the level before, by weight
    symbol, levels = np.arange(len(order)), []
    merged, is_symbol = weights, np.ones(len(order), bool)
    for _ in range(limit - 1):
        levels.append(is_symbol)
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        place = np.argsort(both, kind="stable")
        merged, is_symbol = both[place], place < len(weights)
    levels.append(is_symbol)
    # the cheapest 2n - 2 of the last level, unpacked back to the first
    taken, found = 2 * len(order) - 2, np.zeros(len(order), np.int64)
    for is_symbol in reversed(levels):
        singles = int(is_symbol[:taken].sum())
        found[symbol < singles] += 1
        taken = 2 * (taken - singles)
    lengths[order] = found
    return lengths


class Code:
    """Canonical code of given lengths: shorter codes first, equal lengths by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        self.bits = int(lengths.max()) if len(used) else 1
        self.order = used[np.lexsort((used, lengths[used]))]
        widths = self.lengths[self.order]
        # a code starts where the one before ends, on the scale of the longest
        spans = np.int64(1) << (self.bits - widths)
        starts = np.cumsum(spans) - spans
        if len(used) and int(starts[-1] + spans[-1]) > 1 << self.bits:
            raise ValueError("code lengths do not form a prefix code")
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[self.order] = (starts >> (self.bits - widths)).astype(np.uint64)
        self._starts, self._spans, self._table = starts, spans, None

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every pattern of `bits` bits."""
        if self._table is None:
            symbols = np.zeros(1 << self.bits, np.uint32)
            widths = np.ones(1 << self.bits, np.uint8)
            covered = int(self._spans.sum())
            symbols[:covered] = np.repeat(self.order, self._spans)
            widths[:covered] = np.repeat(self.lengths[self.order], self._spans)
            self._table = symbols, widths
        return self._table

    def pack(self) -> bytes:
        return zlib.compress(self.lengths.astype(np.uint8).tobytes())

    @staticmethod
    def unpack(data: bytes) -> Code:
        return Code(np.frombuffer(zlib.decompress(data), np.uint8))

    def encode_all(self, ids: np.ndarray, counts: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, bytes, np.ndarray]:
        """Codes of documents of `counts` ids, none of them 0, each from a whole byte on, highest bit first: the bit offset of every
        `stride`-th id of each document, the bytes, and where each document ends in them."""
        widths = self.lengths.take(ids)
        if not widths.all():
            raise ValueError("an id without a code")
        last = np.cumsum(counts)
        sums = np.cumsum(widths)
        sizes = -(-np.diff(sums[last - 1], prepend=0) // 8)
        ends = np.cumsum(sizes)
        # what the filled last bytes of the documents before add
        filled = 8 * (ends - sizes) - (sums[last - 1] - np.diff(sums[last - 1], prepend=0))
        starts = sums - widths + np.repeat(filled, counts)
        # codes do not overlap, so the sum of what falls into a 32-bit word is the word
        word = starts >> 5
        spread = self.codes.take(ids) << (64 - widths - (starts & 31)).view(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        joined = np.add.reduceat(spread, first)
        words = np.zeros(int(ends[-1]) // 4 + 2, ">u4")
        words[word[first]] = (joined >> np.uint64(32)).astype(np.uint32)
        words[word[first] + 1] |= (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        runs = -(-counts // stride)
        first_run = np.cumsum(runs) - runs
        marked = np.repeat(last - counts - stride * first_run, runs) + stride * np.arange(int(runs.sum()))
        return starts[marked], words.tobytes()[: int(ends[-1])], ends

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, bytes]:
        """One document: the bit offset of every `stride`-th id, and the bytes."""
        if not len(ids):
            return np.zeros(0, np.int64), b""
        offsets, bits, _ = self.encode_all(ids, np.array([len(ids)]), stride)
        return offsets, bits

    def decode(self, bits: bytes, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids from each bit offset in `starts`, `counts` of them, one run after the other. All runs go at once."""
        symbols, widths = self.table()
        raw = np.frombuffer(bits + bytes(8), np.uint8)
        # the 32 bits from each byte on
        ahead = np.zeros(len(raw) - 3, np.uint32)
        for k in range(4):
            ahead |= raw[k: len(raw) - 3 + k].astype(np.uint32) << np.uint32(24 - 8 * k)
        at = starts.astype(np.int64)
        most = int(counts.max()) if len(counts) else 0
        out = np.zeros((most, len(at)), np.uint32)
        keep, drop = np.uint32(32 - self.bits), 0
        order = np.argsort(-counts, kind="stable")
        at, left = at[order], counts[order]
        for step in range(most):
            live = len(left) - int(np.searchsorted(left[::-1], step, "right"))
            at = at[:live]
            # 32 bits hold a code of 20 behind up to 7 bits of another
            seen = (ahead[at >> 3] << (at & 7).astype(np.uint32)) >> keep
            out[step, :live] = symbols[seen]
            at = at + widths[seen]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        ids = out.T[back]
        return ids[np.arange(most)[None, :] < counts[:, None]]


# --- blocks -------------------------------------------------------------------------------------------------

# A block: magic, then little-endian: its bytes (4), slice (4), place of its first id in the slice (8), documents (4),
# bytes of the directory (4); the directory, compressed: doc_id (8 each), 0 for a null doc_id else 1 (1 each),
# ids (8 each), bytes of bits (8 each), checkpoints as steps in bits (2 each, the first of a document is left out);
# then the bits of each document from a whole byte on.
HEAD = struct.Struct("<4sIIQII")


def build_block(slice_no: int, start: int, docs: list[tuple], bits: list[bytes], steps: list[bytes]) -> bytes:
    """docs: (doc_id, ids, bytes of bits)."""
    directory = zlib.compress(
        np.array([d[0] or 0 for d in docs], "<i8").tobytes() + bytes(d[0] is not None for d in docs)
        + np.array([d[1] for d in docs], "<i8").tobytes() + np.array([d[2] for d in docs], "<i8").tobytes()
        + b"".join(steps), 1)
    size = HEAD.size + len(directory) + sum(map(len, bits))
    return HEAD.pack(MAGIC, size, slice_no, start, len(docs), len(directory)) + directory + b"".join(bits)


class Block:
    """One block, read from `data` at byte `at`."""

    def __init__(self, data: bytes, at: int = 0):
        magic, self.size, self.slice, self.start, n, packed = HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        end = at + HEAD.size + packed
        told = zlib.decompress(data[at + HEAD.size:end])
        named = np.frombuffer(told, np.uint8, n, 8 * n)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(told, "<i8", n), named)]
        self.counts = np.frombuffer(told, "<i8", n, 9 * n)
        sizes = np.frombuffer(told, "<i8", n, 17 * n)
        self.first_byte = np.cumsum(sizes) - sizes
        self.runs = -(-self.counts // STRIDE)
        steps = np.frombuffer(told, "<u2", int((self.runs - 1).sum()), 25 * n).astype(np.int64)
        # bit offsets of all checkpoints in the block
        self.first_run = np.cumsum(self.runs) - self.runs
        offsets = np.zeros(int(self.runs.sum()), np.int64)
        inner = np.ones(len(offsets), bool)
        inner[self.first_run] = False
        offsets[inner] = steps
        sums = np.cumsum(offsets)
        owner = np.repeat(np.arange(n), self.runs)
        self.checkpoints = sums - sums[self.first_run][owner] + 8 * self.first_byte[owner]
        place = np.arange(len(offsets)) - self.first_run[owner]
        self.run_counts = np.minimum(STRIDE, self.counts[owner] - STRIDE * place)
        self.bits = data[end: at + self.size]

    def ids(self, code: Code) -> np.ndarray:
        """Ids of all documents, one after the other."""
        return code.decode(self.bits, self.checkpoints, self.run_counts)

    def range(self, code: Code, doc: int, first: int, count: int) -> np.ndarray:
        """`count` ids of document number `doc` from `first` on, from the checkpoints around them alone."""
        last = min(first + count, int(self.counts[doc]))
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // STRIDE, (last - 1) // STRIDE + 1
        runs = slice(int(self.first_run[doc]) + a, int(self.first_run[doc]) + b)
        return code.decode(self.bits, self.checkpoints[runs], self.run_counts[runs])[first - a * STRIDE: last - a * STRIDE]


def _coded_batches(batches: Iterator[pa.RecordBatch], packed: bytes) -> Iterator[pa.RecordBatch]:
    code = Code.unpack(packed)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            all_ids = part.column(3).to_pylist()
            ids = [_numbers(i, w) for i, w in zip(all_ids, part.column(2).to_pylist())]
            counts = np.array([len(i) for i in ids], np.int64)
            offsets, bits, ends = code.encode_all(np.concatenate(ids), counts)
            bounds = np.concatenate([[0], ends]).tolist()
            # checkpoints of each document as steps, without the first
            runs = -(-counts // STRIDE)
            first = np.cumsum(runs) - runs
            steps = np.delete(np.diff(offsets, prepend=0), first).astype("<u2").tobytes()
            cuts = (2 * np.concatenate([[0], np.cumsum(runs - 1)])).tolist()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([zlib.crc32(i) for i in all_ids], pa.int64()), part.column(1),
                 pa.array([steps[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary()),
                 pa.array([bits[x:y] for x, y in zip(bounds, bounds[1:])], pa.binary())],
                names=["doc_id", "tie", "n_tokens", "steps", "bits"])


def _coded(tokens: DataFrame, packed: bytes) -> DataFrame:
    """Each document under the code: doc_id, tie, n_tokens, steps, bits."""
    return tokens.select("doc_id", "n_tokens", "width", "ids").mapInArrow(
        partial(_coded_batches, packed=packed), "doc_id long, tie long, n_tokens long, steps binary, bits binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slice_no, start, held = TaskContext.get().partitionId(), 0, 0
    docs, bits, steps = [], [], []

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([build_block(slice_no, start, docs, bits, steps)], pa.binary())], names=["block"])

    for batch in batches:
        columns = (batch.column(c) for c in ("doc_id", "n_tokens", "steps", "bits"))
        for doc_id, n, step, own in zip(*(c.to_pylist() for c in columns)):
            if docs and held + len(own) > BLOCK_BYTES:
                yield block()
                start += sum(d[1] for d in docs)
                docs, bits, steps, held = [], [], [], 0
            docs.append((doc_id, n, len(own)))
            bits.append(own)
            steps.append(step)
            held += len(own)
    if docs:
        yield block()


def write_ids(tokens: DataFrame, path: str, scratch: Scratch, limit: int = MAX_BITS) -> None:
    """Code and blocks of `tokens` (see `tokenize`; the table "ids" of `scratch`, which is dropped on the way) under `path`.

    The code is made on the driver from at most one count per id of the vocabulary. Coded documents are written before
    they are put in order, because the bounds of the slices take a pass of their own."""
    spark = tokens.sparkSession
    counts = count_ids(tokens).toArrow()
    ids, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
    by_id = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
    by_id[ids] = n
    packed = Code(code_lengths(by_id, limit)).pack()
    text = {"lineSep": BLOCK_END, "compression": "none"}
    spark.createDataFrame([(bytearray(packed),)], "code binary").coalesce(1).select(
        F.col("code").cast("string").alias("value")).write.options(**text).text(f"{path}/code")
    slices = max(1, -(-int(by_id.sum()) // SLICE_IDS))
    if slices > 1:
        slices = max(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
    coded = scratch.write(_coded(tokens, packed), "coded")
    scratch.drop("ids")
    ordered = coded.repartitionByRange(slices, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", F.md5("bits"))
    blocks = ordered.drop("tie").mapInArrow(_blocks, "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.options(**text).option(
        "maxRecordsPerFile", FILE_BLOCKS).text(f"{path}/blocks")


def read_code(spark: SparkSession, path: str) -> bytes:
    content = spark.read.format("binaryFile").load(f"{path}/code").select("content").first()[0]
    return bytes(content).removesuffix(BLOCK_END.encode())


def _split_files(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for content in batch.column(0):
            data, at = memoryview(content.as_buffer()), 0
            while at < len(data):
                size = HEAD.unpack_from(data, at)[1]
                yield bytes(data[at:at + size])
                at += size + len(BLOCK_END)
                if data[at - len(BLOCK_END):at] != BLOCK_END.encode():
                    raise ValueError(f"no end of the block before byte {at}")


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for data in _split_files(batches):
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["block"])


def _block_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(f"{path}/blocks").select("content")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Every block as it is in the files."""
    return _block_files(spark, path).mapInArrow(_block_rows, "block binary")


def _decoded(batches: Iterator[pa.RecordBatch], packed: bytes, names: list[str]) -> Iterator[pa.RecordBatch]:
    code = Code.unpack(packed)
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for data in _split_files(batches):
        block = Block(data)
        raw, ends = block.ids(code).astype("<u4").tobytes(), 4 * np.cumsum(block.counts)
        own = [raw[e - 4 * n:e] for e, n in zip(ends.tolist(), block.counts.tolist())]
        columns = [block.doc_ids, [block.slice] * len(own), block.start + ends // 4 - block.counts, block.counts, [zlib.crc32(o) for o in own], own]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[: len(names)], kinds)], names=names)


def read_documents(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, slice, place (ids of the slice before the document), n_tokens, ids_crc32 and, if wanted, ids
    (little-endian, 4 bytes each), decoded from the files."""
    names = ["doc_id", "slice", "place", "n_tokens", "ids_crc32"] + ["ids"] * ids
    schema = "doc_id long, slice int, place long, n_tokens long, ids_crc32 long" + ", ids binary" * ids
    return _block_files(spark, path).mapInArrow(partial(_decoded, packed=read_code(spark, path), names=names), schema)


def with_start(documents: DataFrame) -> DataFrame:
    """Adds start, the ids of all documents before this one: slice totals first, one row per slice."""
    totals = documents.groupBy("slice").agg(F.max(F.col("place") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    return documents.join(offsets, "slice").withColumn("start", F.col("offset") + F.col("place")).drop("offset")


def token_files(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes the ids of `documents`, reads the files back: doc_id, start, n_tokens, ids_crc32."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "tokens")
    tokens = scratch.write(tokenize(documents, tokenizer_path), "ids")
    write_ids(tokens, f"{scratch.folder}/files", scratch)
    scratch.drop("coded")
    scratch.release()
    read = scratch.write(read_documents(spark, f"{scratch.folder}/files", ids=False), "read")
    return with_start(read).select("doc_id", "start", "n_tokens", "ids_crc32")
