"""Numbers of tokens by heap-and-linked-list byte-pair merging, for the JSON files of byte-level BPE tokenizers.

A text is cut at the added tokens of the file (one token each), then into slices by the byte-level pattern. The
pattern runs over one byte per character, its class, so Unicode tables are those of ``base``. The symbols of a slice
are its bytes, linked to their neighbours; a heap holds the adjacent pairs that the file merges, lowest rank first,
the leftmost of equals. Each merge takes one symbol away, so the number of tokens is that of the bytes less the
number of merges: no token is ever looked up or kept.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.base import LETTER, NUMBER, SPACE, char_classes, code_points, tune

#: Slices whose number is remembered, and the characters up to which a slice is.
REMEMBERED, REMEMBERED_CHARS = 1 << 18, 40

# The parts of the byte-level pattern, over classes: a-z letters, 0 numbers, ! and ' others.
_SLICE = re.compile(rb"'(?:s|t|re|ve|m|ll|d)| ?[a-z]+| ?0+| ?[!']+|[ \n]+(?![a-z0!'])|[ \n]+")
_CONTRACTION = "strevmld"


def _class_bytes() -> np.ndarray:
    kinds = char_classes()
    out = np.full(len(kinds), ord("!"), np.uint8)
    for kind, byte in ((LETTER, "x"), (NUMBER, "0"), (SPACE, "\n")):
        out[kinds == kind] = ord(byte)
    for c in (*_CONTRACTION, " ", "'"):
        out[ord(c)] = ord(c)
    return out


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: a visible Latin-1 one for itself, the others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(rest)) for b in range(256)]


class HeapCounter:
    """Merge ranks of one tokenizer file, with what each process builds from them on first use."""

    def __init__(self, symbols: list[int], width: int, merges: dict[int, tuple[int, int]], added: list[str]):
        #: Symbol of each byte (-1: none, the byte is dropped); pair a * width + b -> (rank, joined symbol).
        self.symbols, self.width, self.merges, self.added = symbols, width, merges, added
        self._seen: dict[str, int] = {}
        self._classes: np.ndarray | None = None
        self._cut = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def __getstate__(self):
        return self.symbols, self.width, self.merges, self.added

    def __setstate__(self, state):
        self.__init__(*state)

    def merge_count(self, symbols: list[int]) -> int:
        """Merges made in one slice."""
        get, width, n = self.merges.get, self.width, len(symbols)
        heap = [(*pair, i) for i in range(n - 1) if (pair := get(symbols[i] * width + symbols[i + 1]))]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            rank, joined, i = heapq.heappop(heap)
            a, j = symbols[i], after[i]
            if a < 0 or j >= n or get(a * width + symbols[j]) != (rank, joined):
                continue  # a symbol of the pair has been merged since
            merges += 1
            symbols[i], symbols[j] = joined, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if pair := get(joined * width + symbols[k]):
                    heapq.heappush(heap, (*pair, i))
            h = before[i]
            if h >= 0 and (pair := get(symbols[h] * width + joined)):
                heapq.heappush(heap, (*pair, h))
        return merges

    def _slice(self, piece: str) -> int:
        symbols = [s for b in piece.encode("utf-8", "surrogatepass") if (s := self.symbols[b]) >= 0]
        start = len(symbols)
        number = start - self.merge_count(symbols)
        if len(piece) <= REMEMBERED_CHARS:
            if len(self._seen) >= REMEMBERED:
                self._seen.clear()
            self._seen[piece] = number
        return number

    def _plain(self, text: str) -> int:
        if self._classes is None:
            self._classes = _class_bytes()
        classes = self._classes[code_points(text)].tobytes()
        seen, slow, number, at = self._seen.get, self._slice, 0, 0
        for found in _SLICE.finditer(classes):
            end = found.end()
            piece = text[at:end]
            at = end
            number += seen(piece) or slow(piece)
        return number

    def count(self, text: str) -> int:
        """Tokens of a text."""
        if self._cut is None or not self._cut.search(text):
            return self._plain(text)
        parts = self._cut.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def load(tokenizer_file: str) -> HeapCounter:
    """Merge ranks of a byte-level BPE tokenizer in a JSON file. One whose rules are not those stated above (another
    model or pre-tokenizer, dropout, affixes, added tokens that take white space in) is refused."""
    with open(tokenizer_file, encoding="utf-8") as lines:
        told = json.load(lines)
    model, cutter, added = told["model"], told["pre_tokenizer"] or {}, told["added_tokens"] or []
    plain = (
        model.get("type") == "BPE"
        and cutter.get("type") == "ByteLevel"
        and cutter.get("use_regex", True)
        and not cutter.get("add_prefix_space")
        and not told.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback", "unk_token"))
        and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        raise ValueError(f"{tokenizer_file} is no plain byte-level BPE tokenizer")
    vocabulary = model["vocab"]
    width = max(vocabulary.values(), default=0) + 1
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocabulary[a] * width + vocabulary[b]] = (rank, vocabulary[a + b])
    symbols = [vocabulary.get(c, -1) for c in _byte_symbols()]
    return HeapCounter(symbols, width, merges, [t["content"] for t in added])


def count_tokens(docs: DataFrame, tokenizer_file: str, text: str = "text", out: tuple[str, str] = ("n_bytes", "n_tokens")) -> DataFrame:
    """``docs`` without its text, with the bytes of its UTF-8 and the tokens of the whole text.

    A null or empty text has 0 of both. Rows are counted one by one, so repeated rows and null ids stay as they are;
    an empty table gives an empty one. Columns of ``docs`` named as in ``out`` are replaced. The file is read by the
    driver and sent to the executors: its size is that of the vocabulary. A task holds one batch of texts and one
    slice's heap at a time.
    """
    spark = tune(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load(tokenizer_file))
    keep = [f for f in docs.schema.fields if f.name not in (text, *out)]
    schema = T.StructType([*keep, *(T.StructField(name, T.LongType()) for name in out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared.value
        for b in batches:
            numbers = [counter.count(t) if t else 0 for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(numbers, pa.int64())], schema.names)

    whole = docs[f"`{text}`"].cast("string")
    rows = docs.select(
        *[docs[f"`{f.name}`"].alias(f"_c{i}") for i, f in enumerate(keep)], F.coalesce(F.octet_length(whole), F.lit(0)).cast("long").alias("_bytes"), whole.alias("_text")
    )
    return rows.mapInArrow(run, schema)
