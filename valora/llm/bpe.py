"""Byte-level BPE: encode texts by a rank file, and decode the ids.

Texts are pre-tokenised many at a time without a regular expression. Every code point gets a class (letter, number, white
space, other) and, from its neighbours, a symbol; an automaton over symbols says where a token starts. Its transition functions form a
small monoid, so prefixes are composed by an associative scan over blocks of the array. The slices are merged pair by pair, lowest
rank and then leftmost first; results of repeated slices are kept. Each id's byte offset in its text is kept for decoding.

Rows: null and empty texts have no ids. Texts of any length are encoded whole. Other columns are kept; the new ones replace
columns of the same names. The vocabulary is read on the driver from a path and broadcast; it is as large as its file.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from valora.llm.common import chunks, Memo, ragged, slices

#: Characters handled at once; a longer text is handled alone.
CHUNK = 1_000_000
#: The white space of Unicode's property White_Space; fixed values.
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

LETTER, NUMBER, OTHER, SPACE, EDGE = range(5)
# Symbols: the classes, an apostrophe with one or two letters of a contraction after it, and white space by kind and by what follows.
SYM_LETTER, SYM_NUMBER, SYM_OTHER, SHORT, LONG, BLANK_BEFORE, BLANK_AMONG, WHITE_BEFORE, WHITE_AMONG, END = range(10)
# States: at a token's start, in letters, numbers, others, after a leading blank, in white space, two or one letters before a contraction's end.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACE, TWO_LEFT, ONE_LEFT = range(8)


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(state, symbol) to the next state, and whether a token starts with the symbol."""
    fresh = {SYM_LETTER: IN_LETTERS, SYM_NUMBER: IN_NUMBERS, SYM_OTHER: IN_OTHERS, SHORT: ONE_LEFT, LONG: TWO_LEFT,
             BLANK_BEFORE: AFTER_BLANK, BLANK_AMONG: IN_SPACE, WHITE_BEFORE: START, WHITE_AMONG: IN_SPACE, END: START}
    goes_on = {(IN_LETTERS, SYM_LETTER): IN_LETTERS, (IN_NUMBERS, SYM_NUMBER): IN_NUMBERS, (AFTER_BLANK, SYM_LETTER): IN_LETTERS,
               (AFTER_BLANK, SYM_NUMBER): IN_NUMBERS, (TWO_LEFT, SYM_LETTER): ONE_LEFT, (ONE_LEFT, SYM_LETTER): START,
               (IN_SPACE, BLANK_AMONG): IN_SPACE, (IN_SPACE, WHITE_AMONG): IN_SPACE}
    goes_on |= {(state, symbol): IN_OTHERS for state in (IN_OTHERS, AFTER_BLANK) for symbol in (SYM_OTHER, SHORT, LONG)}
    after, starts = np.zeros((8, 10), np.uint8), np.zeros((8, 10), bool)
    for state, symbol in product(range(8), range(10)):
        after[state, symbol] = goes_on.get((state, symbol), fresh[symbol])
        starts[state, symbol] = (state, symbol) not in goes_on
    return after, starts


class Scanner:
    """Starts of tokens in an array of code points."""

    BLOCK = 256

    def __init__(self, classes: np.ndarray):
        self.classes = classes
        self.after, self.starts = automaton()
        # The monoid that the symbols' transition functions make; 0 is the identity.
        functions, todo = {tuple(range(8)): 0}, [tuple(range(8))]
        letters = [tuple(int(x) for x in self.after[:, s]) for s in range(10)]
        while todo:
            f = todo.pop()
            for g in letters:
                h = tuple(g[x] for x in f)
                if h not in functions:
                    functions[h] = len(functions)
                    todo.append(h)
        every = list(functions)
        self.element = np.array([functions[f] for f in letters], np.uint16)
        self.applied = np.array(every, np.uint8)
        self.size = len(every)
        self.then = np.array([functions[tuple(g[x] for x in f)] for f in every for g in every], np.uint16)

    def prefixes(self, elements: np.ndarray) -> np.ndarray:
        """The composition of all elements before each one."""
        n = len(elements)
        if n <= 1:
            return np.zeros(n, np.uint16)
        blocks = -(-n // self.BLOCK)
        grid = np.zeros(blocks * self.BLOCK, np.uint16)
        grid[:n] = elements
        grid = np.ascontiguousarray(grid.reshape(blocks, self.BLOCK).T)
        out, total = np.empty_like(grid), np.zeros(blocks, np.intp)
        for row, into in zip(grid, out):
            into[:] = total
            total = self.then[total * self.size + row].astype(np.intp)
        if blocks > 1:
            before = self.prefixes(total.astype(np.uint16)).astype(np.intp) * self.size
            for into in out:
                into[:] = self.then[before + into]
        return out.T.reshape(-1)[:n]

    def token_starts(self, points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Whether a token starts at each code point; the points at ``edges`` stand between texts."""
        kind = self.classes[points]
        kind[edges] = EDGE
        nextly = np.append(kind[1:], EDGE)
        before = nextly <= OTHER
        symbol = kind.copy()
        blank = points == 0x20
        white = kind == SPACE
        symbol[white] = np.where(blank, np.where(before, BLANK_BEFORE, BLANK_AMONG), np.where(before, WHITE_BEFORE, WHITE_AMONG))[white]
        symbol[edges] = END
        quotes = np.flatnonzero(points[:-2] == 0x27) if len(points) > 2 else np.empty(0, np.intp)
        one, two = points[quotes + 1], points[quotes + 2]
        is_in = lambda x, letters: np.isin(x, [ord(c) for c in letters])
        symbol[quotes[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))]] = LONG
        symbol[quotes[is_in(one, "stmd")]] = SHORT
        symbol[edges] = END
        state = self.applied[self.prefixes(self.element[symbol]), START]
        return self.starts[state, symbol]


def code_point_classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    classes = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    classes[SPACES] = SPACE
    return classes


class Vocabulary:
    def __init__(self, data: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        most = max(self.ranks.values()) + 1
        tokens = [b""] * most
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, most)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one slice: merge the pair of lowest rank, the leftmost of equals, until no pair has one."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n, ranks = len(piece), self.ranks
        end, back = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins here; the part before it
        heap = [(ranks[piece[i:i + 2]], i, i + 2) for i in range(n - 1) if piece[i:i + 2] in ranks]
        heapq.heapify(heap)
        gone = bytearray(n + 1)
        while heap:
            _, i, upto = heapq.heappop(heap)
            middle = end[i]
            if gone[i] or middle >= n or end[middle] != upto or gone[middle]:
                continue
            gone[middle] = 1
            end[i] = upto
            if upto < n:
                back[upto] = i
                if (r := ranks.get(piece[i:end[upto]])) is not None:
                    heapq.heappush(heap, (r, i, end[upto]))
            if (h := back[i]) >= 0 and (r := ranks.get(piece[h:upto])) is not None:
                heapq.heappush(heap, (r, h, upto))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i:end[i]]])
            i = end[i]
        return ids

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        return ragged(self.bytes, self.begins[ids], self.lengths[ids])


def encoded(texts: list[str], scanner: Scanner, vocabulary: Vocabulary, memo: Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, byte offset of each in its text, ids by text) of texts handled at once."""
    whole = "\n".join(texts) + "\n"
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    begins = np.flatnonzero(scanner.token_starts(points, edges))
    first = np.searchsorted(begins, np.append(0, edges[:-1] + 1))
    bounds = begins.tolist()
    values = list(map(memo.__getitem__, map(whole.__getitem__, map(slice, bounds, bounds[1:] + [len(whole)]))))
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    # Between two texts stands a slice of one character, which is no token.
    drop = np.searchsorted(begins, edges)
    for i in drop:
        values[i] = b""
    sizes[drop] = 0
    ids = np.frombuffer(b"".join(values), np.int32)
    counts = np.add.reduceat(sizes, first)
    ends = np.cumsum(vocabulary.lengths[ids])
    offsets = ends - vocabulary.lengths[ids]
    upto = np.cumsum(counts)
    base = np.where(upto - counts < len(ids), offsets[np.minimum(upto - counts, max(len(ids) - 1, 0))] if len(ids) else 0, 0)
    return ids, offsets - np.repeat(base, counts), counts


def listed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values.astype(np.int32)))


def shared_vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(documents: DataFrame, path: str, *, text_col: str = "text", ids_col: str = "ids", offsets_col: str = "offsets") -> DataFrame:
    """The documents with ``ids_col`` and ``offsets_col``: the ids of each text and the byte where each starts."""
    spark = documents.sparkSession
    ranks, kinds = shared_vocabulary(spark, path), spark.sparkContext.broadcast(code_point_classes().tobytes())
    kept = [c for c in documents.columns if c not in (ids_col, offsets_col)]
    names = [*kept, ids_col, offsets_col]

    def run(batches):
        vocabulary, scanner = Vocabulary(ranks.value), Scanner(np.frombuffer(kinds.value, np.uint8))
        memo = Memo(lambda piece: np.array(vocabulary.merged(piece.encode("utf-8", "surrogatepass")), np.int32).tobytes())
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            for a, b in chunks([len(t) + 1 for t in texts], CHUNK):
                ids, offsets, counts = encoded(texts[a:b], scanner, vocabulary, memo)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), listed(ids, counts), listed(offsets, counts)], names=names)

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField(ids_col, ints), T.StructField(offsets_col, ints)])
    return documents.select(*kept).mapInArrow(run, schema)


def decode(documents: DataFrame, path: str, *, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The documents with ``bytes_col``: the bytes that each row's ids stand for; null ids are no bytes."""
    ranks = shared_vocabulary(documents.sparkSession, path)
    kept = [c for c in documents.columns if c != bytes_col]

    def run(batches):
        vocabulary = Vocabulary(ranks.value)
        for batch in slices(batches):
            lists = batch.column(ids_col)
            counts = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            for a, b in chunks((counts + 1).tolist(), CHUNK):
                part = batch.slice(a, b - a)
                ids = np.asarray(part.column(ids_col).flatten())
                sizes = vocabulary.lengths[ids]
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts[a:b])])]
                data = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(vocabulary.decoded(ids))])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), data.cast(pa.binary())], names=[*kept, bytes_col])

    schema = T.StructType([*(documents.schema[c] for c in kept), T.StructField(bytes_col, T.BinaryType())])
    return documents.select(*kept).mapInArrow(run, schema)
