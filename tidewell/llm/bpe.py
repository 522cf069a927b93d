"""Byte-level BPE encoding and decoding by a public rank file.

Texts are cut before the merges without a regular expression. Every character gets a class, which also says what
follows it where the cut depends on that: a contraction's apostrophe, the last white space before a word. A class
is a function from the state before the character (what kind of slice is open) to the state after it; functions
compose associatively, so the states of all characters come from a scan over blocks. A slice starts where state
and class say so. The distinct slices of a batch are merged once, through a cache, and every token keeps the
byte offset of its place in the text.
"""

from __future__ import annotations

import base64
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewell.llm.base import LETTER, NUMBER, SPACE, char_classes, code_points, groups_of, tune

#: Characters of one scan; a longer text is cut where a slice starts.
STEP = 1 << 20
#: Slices whose ids are remembered, and the bytes up to which a slice is.
CACHE, CACHED_BYTES = 1 << 19, 48

# The letters that make a contraction with an apostrophe before them.
ONE_LETTER, TWO_LETTERS = ("s", "t", "m", "d"), ("re", "ve", "ll")

# --- slices -----------------------------------------------------------------------------------------------------

# Classes of characters. SHORT, LONG: an apostrophe that one or two letters of a contraction follow. GAP: white
# space before white space or the end. BLANK, BREAK: the last white space before something else, U+0020 or not.
_LETTER, _NUMBER, _OTHER, _SHORT, _LONG, _GAP, _BLANK, _BREAK = range(8)
# States: the slice that is open after a character. JOIN: a blank that the next slice takes in. LAST, MORE: one or
# two letters of a contraction to come. NONE: the next character starts a slice whatever it is.
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, JOIN, LAST, MORE = range(8)
STATES = 8


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Tables by class (plus 8 for the first character of a text) and state: the next state, and whether a slice
    starts at the character."""
    alone = {
        _LETTER: IN_LETTERS, _NUMBER: IN_NUMBERS, _OTHER: IN_OTHERS, _SHORT: LAST, _LONG: MORE, _GAP: IN_GAP, _BLANK: JOIN, _BREAK: NONE,
    }
    goes_on = {
        (_LETTER, IN_LETTERS): IN_LETTERS, (_LETTER, JOIN): IN_LETTERS, (_LETTER, LAST): NONE, (_LETTER, MORE): LAST,
        (_NUMBER, IN_NUMBERS): IN_NUMBERS, (_NUMBER, JOIN): IN_NUMBERS, (_GAP, IN_GAP): IN_GAP,
        **{(c, s): IN_OTHERS for c in (_OTHER, _SHORT, _LONG) for s in (IN_OTHERS, JOIN)},
    }
    after, starts = np.zeros((16, STATES), np.uint8), np.ones((16, STATES), bool)
    for c, s in itertools.product(range(8), range(STATES)):
        after[c, s], starts[c, s] = goes_on.get((c, s), alone[c]), (c, s) not in goes_on
        after[c + 8, s] = alone[c]
    return after, starts


_AFTER, _STARTS = _machine()
_BLOCK = 128


def _classes(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Class of every character of texts that follow each other; firsts: where texts start."""
    kinds = char_classes()[points]
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[firsts] = True
    first[n] = True
    out = np.full(n, _OTHER, np.uint8)
    out[kinds == LETTER] = _LETTER
    out[kinds == NUMBER] = _NUMBER
    space = kinds == SPACE
    last = np.zeros(n, bool)  # white space with something else after it in the same text
    last[:-1] = space[:-1] & ~space[1:]
    last &= ~first[1:]
    out[space] = _GAP
    out[last] = _BREAK
    out[last & (points == 32)] = _BLANK
    marks = np.flatnonzero(points == 39)
    if len(marks):
        padded = np.append(points, [0, 0])
        one, two = padded[marks + 1], padded[marks + 2]
        inner = ~first[np.minimum(marks + 1, n)]
        short = inner & np.isin(one, [ord(c) for c in ONE_LETTER])
        long = inner & ~first[np.minimum(marks + 2, n)] & np.logical_or.reduce([(one == ord(a)) & (two == ord(b)) for a, b in TWO_LETTERS])
        out[marks[short]] = _SHORT
        out[marks[long]] = _LONG
    return out + (first[:n] * np.uint8(8))


def slice_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Positions where slices start. A text's first character always starts one."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    blocks = -(-n // _BLOCK)
    padded = np.full(blocks * _BLOCK, _OTHER, np.uint8)
    padded[:n] = _classes(points, firsts)
    columns = np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T).astype(np.intp) * STATES
    table = _AFTER.ravel()
    # The function of each block, for every state it may begin in.
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))
    for c in columns:
        whole = table[c[:, None] + whole]
    # Their scan: after k rounds a block's function spans the 2^k blocks that end with it.
    step = 1
    while step < blocks:
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].copy(), axis=1)
        step *= 2
    state = np.append(np.uint8(NONE), whole[:-1, NONE])
    begins = np.empty((_BLOCK, blocks), bool)
    flags = _STARTS.ravel()
    for k, c in enumerate(columns):
        at = c + state
        begins[k] = flags[at]
        state = table[at]
    return np.flatnonzero(begins.T.ravel()[:n])


# --- merges -----------------------------------------------------------------------------------------------------


class _Pairs:
    """What two neighbouring tokens become, as an open-addressing table that numpy looks up many pairs in at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.base = max(ranks.values(), default=0) + 1
        joins = {a * self.base + b: i for t, i in ranks.items() for k in range(1, len(t)) if (a := ranks.get(t[:k])) is not None and (b := ranks.get(t[k:])) is not None}
        keys, values = np.fromiter(joins, np.int64, len(joins)), np.fromiter(joins.values(), np.int64, len(joins))
        self.mask = (1 << (4 * len(joins) + 16).bit_length()) - 1
        self.keys, self.values = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NEVER, np.int64)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several for one slot the last stays
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & self.mask

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token of each pair, NEVER where there is none; a or b may be -1, for no token."""
        out = np.full(a.shape, NEVER, np.int64)
        at = np.nonzero((a >= 0) & (b >= 0))
        keys = a[at] * self.base + b[at]
        slots = self._slots(keys)
        found, open_ = np.full(len(keys), NEVER, np.int64), np.arange(len(keys))
        while len(open_):
            there = self.keys[slots]
            hit = there == keys[open_]
            found[open_[hit]] = self.values[slots[hit]]
            going = ~hit & (there != -1)
            open_, slots = open_[going], (slots[going] + 1) & self.mask
        out[at] = found
        return out


NEVER = 1 << 60
#: Slices that are merged side by side.
SIDE_BY_SIDE = 4096


class Encoder:
    """Ranks by token bytes, with what is built from them on first use in each process."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._cache: dict[bytes, tuple[int, ...]] = {}
        self._tokens: pa.Array | None = None
        self._joins: _Pairs | None = None

    def __getstate__(self):
        return self.ranks

    def __setstate__(self, ranks):
        self.__init__(ranks)

    @property
    def tokens(self) -> pa.Array:
        if self._tokens is None:
            by_id = {i: t for t, i in self.ranks.items()}
            self._tokens = pa.array([by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)], pa.binary())
        return self._tokens

    @property
    def pairs(self) -> _Pairs:
        if self._joins is None:
            self._joins = _Pairs(self.ranks)
        return self._joins

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each slice: a token as it is, one met before from the cache, the others merged side by side."""
        ranks, cache = self.ranks, self._cache
        out: list[tuple[int, ...] | None] = [(r,) if (r := ranks.get(p)) is not None else cache.get(p) for p in pieces]
        missing = sorted((i for i, ids in enumerate(out) if ids is None), key=lambda i: len(pieces[i]))
        short = [i for i in missing if len(pieces[i]) <= CACHED_BYTES]
        for i in missing[len(short) :]:
            out[i] = self._merge_long(pieces[i])
        for a in range(0, len(short), SIDE_BY_SIDE):
            some = short[a : a + SIDE_BY_SIDE]
            if len(cache) + len(some) > CACHE:
                cache.clear()
            for i, ids in zip(some, self._merge_many([pieces[i] for i in some])):
                out[i] = cache[pieces[i]] = ids
        return out

    def _merge_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """In every slice at once, again and again: join the neighbours of least rank, the leftmost of equals."""
        single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        filled = np.arange(width) < lengths[:, None]
        tokens = np.full((len(pieces), width + 1), -1, np.int64)
        tokens[:, :width][filled] = single[np.frombuffer(b"".join(pieces), np.uint8)]
        joins = self.pairs.joined(tokens[:, :-1], tokens[:, 1:])
        out: list[tuple[int, ...]] = [()] * len(pieces)
        rows, sizes = np.arange(len(pieces)), lengths.copy()
        places = np.arange(width + 1)
        while len(rows):
            at = joins.argmin(axis=1)
            line = np.arange(len(rows))
            token = joins[line, at]
            done = token == NEVER
            for k in np.flatnonzero(done):
                out[rows[k]] = tuple(tokens[k, : sizes[k]].tolist())
            rows, sizes, at, token, tokens, joins = (x[~done] for x in (rows, sizes, at, token, tokens, joins))
            if not len(rows):
                break
            line = np.arange(len(rows))
            tokens[line, at] = token
            # Everything after the joined pair moves up by one.
            source = np.minimum(places + (places > at[:, None]), width)
            tokens = np.take_along_axis(tokens, source, axis=1)
            tokens[:, width] = -1
            sizes -= 1
            joins = np.take_along_axis(joins, np.minimum(source[:, :width], width - 1), axis=1)
            joins[:, width - 1] = NEVER
            joins[line, at] = self.pairs.joined(token, tokens[line, at + 1])
            inner = at > 0
            left = line[inner], at[inner] - 1
            joins[left] = self.pairs.joined(tokens[left], token[inner])
        return out

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same by a heap over linked parts, for slices of any length."""
        get, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here; 0: no part starts here any more
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or get(piece[i : end[j]]) != rank:
                continue  # one of the two has been joined since
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
                if (r := get(piece[i : end[end[i]]])) is not None:
                    heapq.heappush(heap, (r, i))
            if i and (r := get(piece[before[i] : end[i]])) is not None:
                heapq.heappush(heap, (r, before[i]))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode_group(self, texts: list[str], stop: int | None = None, count_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, byte offsets within their text, number of ids of each text); with ``stop``, a place where a slice
        starts, of the slices before it; with ``count_only`` the numbers only, ids and offsets are empty."""
        lengths = np.array([len(t) for t in texts])
        filled = np.flatnonzero(lengths)
        data = "".join(texts)
        if not data:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        firsts = np.concatenate([[0], np.cumsum(lengths[filled])[:-1]])
        points = code_points(data)
        starts = slice_starts(points, firsts)
        sizes = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        at_byte = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        starts = starts if stop is None else starts[starts < stop]
        cuts = np.append(at_byte[starts], at_byte[len(data) if stop is None else stop])
        raw = pa.py_buffer(data.encode("utf-8", "surrogatepass"))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), raw]).dictionary_encode()
        per_piece = self.merged(pieces.dictionary.to_pylist())
        counts = np.fromiter(map(len, per_piece), np.int64, len(per_piece))
        index = pieces.indices.to_numpy()
        until = np.append(0, np.cumsum(counts[index]))  # ids before each slice
        text_at = np.append(until[np.searchsorted(starts, firsts)], until[-1])
        numbers = np.zeros(len(texts), np.int64)
        numbers[filled] = np.diff(text_at)
        if count_only:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), numbers
        flat = np.fromiter(itertools.chain.from_iterable(per_piece), np.int32, int(counts.sum()))
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts))), pa.array(flat))
        ids = lists.take(pa.array(index)).flatten().to_numpy()
        width = np.diff(self._token_offsets())[ids]
        offsets = np.cumsum(width) - width
        return ids, offsets - np.repeat(at_byte[firsts], numbers[filled]), numbers

    def _token_offsets(self) -> np.ndarray:
        return np.frombuffer(self.tokens.buffers()[1], np.int32)[: len(self.tokens) + 1].astype(np.int64)

    def encode(self, texts: list[str], count_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode_group``, a step of characters at a time."""
        parts = []
        for a, b in groups_of(texts, STEP):
            long = b == a + 1 and len(texts[a]) > 2 * STEP
            parts.append(self._encode_long(texts[a], count_only) if long else self.encode_group(texts[a:b], None, count_only))
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _encode_long(self, text: str, count_only: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One text in pieces. A piece ends where a slice starts, far enough from the characters read so far that
        what comes next can't change it: contractions look two characters ahead, white space one."""
        ids, offsets, done, size = [], [], 0, STEP
        at = at_byte = 0
        while at < len(text):
            piece, cut = text[at : at + size], None
            if at + size < len(text):
                starts = slice_starts(code_points(piece), np.zeros(1, int))
                cut = int(starts[starts <= size - 4][-1])
                if not cut:  # one slice longer than the piece
                    size *= 2
                    continue
            part, where, number = self.encode_group([piece], cut, count_only)
            ids.append(part)
            offsets.append(where + at_byte)
            piece = piece[:cut]
            at_byte += len(piece.encode("utf-8", "surrogatepass"))
            done += int(number[0])
            at, size = at + len(piece), STEP
        return np.concatenate(ids), np.concatenate(offsets), np.array([done])

    def decode(self, ids: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
        """The bytes of all ids, and where each one's bytes start in them."""
        found = self.tokens.cast(pa.large_binary()).take(ids)
        where = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
        return found.buffers()[2] or pa.py_buffer(b""), where


# --- on DataFrames ----------------------------------------------------------------------------------------------


def load(rank_file: str) -> Encoder:
    with open(rank_file, "rb") as lines:
        return Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def encode(docs: DataFrame, rank_file: str, text: str = "text", out: tuple[str, str] = ("ids", "offsets")) -> DataFrame:
    """``docs`` without its text, with the token ids of the whole text and their byte offsets in it.

    A null or empty text has no ids. Columns of ``docs`` named as in ``out`` are replaced. The rank file is read
    by the driver and sent to the executors: its size is that of the vocabulary.
    """
    spark = tune(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load(rank_file))
    keep = [f for f in docs.schema.fields if f.name not in (text, *out)]
    schema = T.StructType([*keep, T.StructField(out[0], T.ArrayType(T.IntegerType())), T.StructField(out[1], T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for b in batches:
            ids, offsets, numbers = encoder.encode([t or "" for t in b.column("_text").to_pylist()])
            ends = pa.array(np.append(0, np.cumsum(numbers)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (ids, offsets)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *lists], schema.names)

    rows = docs.select(*[docs[f"`{f.name}`"].alias(f"_c{i}") for i, f in enumerate(keep)], docs[f"`{text}`"].cast("string").alias("_text"))
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, rank_file: str, ids: str = "ids", offsets: str = "offsets", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes its ids stand for. Each token must start at its retained offset, else the ids are not
    those that were encoded and the task fails. Null ids give null."""
    spark = tune(encoded.sparkSession)
    shared = spark.sparkContext.broadcast(load(rank_file))
    keep = [f for f in encoded.schema.fields if f.name != out]
    schema = T.StructType([*keep, T.StructField(out, T.BinaryType())])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for b in batches:
            lists, places = b.column(names.index(ids)), b.column(names.index(offsets))
            data, where = encoder.decode(lists.flatten())
            ends = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            retained = places.flatten().to_numpy()
            starts = where[:-1] - np.repeat(where[ends[:-1]], np.diff(ends))
            if len(retained) != len(starts) or (retained != starts).any():
                raise ValueError("ids and offsets are not of one encoding")
            body = memoryview(data)
            texts = [bytes(body[where[s] : where[e]]) for s, e in zip(ends[:-1], ends[1:])]
            valid = lists.is_valid().to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([t if v else None for t, v in zip(texts, valid)], pa.binary())], schema.names)

    rows = encoded.select(*[encoded[f"`{n}`"] for n in names])
    return rows.mapInArrow(run, schema)


def token_counts(docs: DataFrame, rank_file: str, text: str, out: str) -> DataFrame:
    """``docs`` without its text, with the number of tokens of the whole text (null or empty: 0). A column of
    ``docs`` named ``out`` is replaced."""
    spark = tune(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load(rank_file))
    keep = [f for f in docs.schema.fields if f.name not in (text, out)]
    schema = T.StructType([*keep, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for b in batches:
            numbers = encoder.encode([t or "" for t in b.column("_text").to_pylist()], count_only=True)[2]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(numbers)], schema.names)

    rows = docs.select(*[docs[f"`{f.name}`"].alias(f"_c{i}") for i, f in enumerate(keep)], docs[f"`{text}`"].cast("string").alias("_text"))
    return rows.mapInArrow(run, schema)
