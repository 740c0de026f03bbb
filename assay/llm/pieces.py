"""SentencePiece BPE, exactly, by backtracking over longest matches.

The model merges neighbouring characters, best piece first and leftmost among
equals, over a whole text.  The result is the one row of pieces in which every
two neighbours are compatible: re-merging the characters of just these two gives
them back.  (A merge inside two neighbours goes by the same order as in the whole
text, so the first merge across a border of the row would also be one of the two
alone; this holds for equal scores too, as place decides there.)

An Aho-Corasick automaton finds the longest piece at each place.  From the left,
the longest that is compatible with the piece before goes in, else its next
shorter prefix; when none is left the last piece is taken back and the place is
marked in a field of one bit a place, so that no place fails twice.  Characters
without a piece stand for themselves, never merge, and become byte pieces.

No piece of such a vocabulary holds a space mark after another character, so
nothing merges across the border before a run of marks and texts are encoded word
by word; where a vocabulary has such a piece a text is one word.
"""

from __future__ import annotations

import codecs
import gc
import itertools
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assay.llm.staging import hold, ship

MARK = "▁"
#: Words, and pairs of pieces, that a worker process remembers; the longest word of them.
REMEMBER, REMEMBER_CHARS = 600_000, 64
#: Rows and characters of a result batch; characters up to which the words of a text are listed at once.
BATCH_ROWS, BATCH_CHARS, AT_ONCE = 1000, 1 << 22, 1 << 20
#: Fixed values of the model file: message fields, piece types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
TEXT, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MODEL_TYPE, BPE, SUFFIX_MARK, BYTE_FALLBACK, UNKNOWN_SURFACE = 3, 2, 24, 35, 44
CHARSMAP, DUMMY_PREFIX, SQUEEZE, ESCAPE = 2, 3, 4, 5


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value, shift, at = value | (data[at] & 127) << shift, shift + 7, at + 1
            if data[at - 1] < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, data[at:at + size]
            at += size


def _each_byte(error: UnicodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("assay_each_byte", _each_byte)


class Model:
    """``path``: a BPE model file with byte fallback and no text normalisation."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            fields = list(message(f.read()))
        trainer = dict(message(b"".join(v for k, v in fields if k == TRAINER)))
        shape = dict(message(b"".join(v for k, v in fields if k == NORMALIZER)))
        found = [dict(message(v)) for k, v in fields if k == PIECES]
        kinds = [x.get(TYPE, NORMAL) for x in found]
        if (trainer.get(MODEL_TYPE) != BPE or not trainer.get(BYTE_FALLBACK) or trainer.get(SUFFIX_MARK) or shape.get(CHARSMAP)
                or shape.get(SQUEEZE, 1) or not shape.get(ESCAPE, 1) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError(f"{path}: not a BPE model with byte fallback, identity normalisation and normal pieces")
        self.prefix = MARK if shape.get(DUMMY_PREFIX, 1) else ""
        self.piece = [x[TEXT].decode() for x in found]
        self.id = {p: i for i, (p, k) in enumerate(zip(self.piece, kinds)) if k == NORMAL}
        self.score = {p: struct.unpack("<f", found[i].get(SCORE, bytes(4)))[0] for p, i in self.id.items()}
        self.byte = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.piece, kinds)) if k == BYTE}
        shown = {NORMAL: lambda p: p.replace(MARK, " ").encode(), CONTROL: lambda p: b"",
                 UNKNOWN: lambda p: trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode()), BYTE: lambda p: bytes([int(p[1:-1], 16)])}
        #: Bytes that an id stands for.  A piece is whole characters, so bytes left alone by byte pieces beside it stay alone.
        self.raw = {i: shown[k](p) for i, (p, k) in enumerate(zip(self.piece, kinds))}
        self.silent = {i for i, raw in self.raw.items() if not raw}         # they part the bytes on either side
        self.marked = {i for p, i in self.id.items() if p.startswith(MARK)}
        self.size = [len(p) for p in self.piece]
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, (i, len(p) - 1))
        self.automaton.make_automaton()
        whole = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.id)
        self.words = re.compile("(?s).+" if whole else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.other = len(self.piece)
        #: For a piece, the longest other that it starts with, or else its first character.
        self.shorter = [0] * self.other
        for p, i in self.id.items():
            if len(p) > 1:
                self.shorter[i] = next((self.id[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id), self.other + ord(p[0]))
        self.pairs: dict[int, bool] = {}
        self.word = lru_cache(REMEMBER)(lambda w: tuple(self.encode_word(w)))

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging, best first and leftmost among equals."""
        row = list(text)
        while len(row) > 1:
            best = min(((-self.score[a + b], i) for i, (a, b) in enumerate(zip(row, row[1:])) if a + b in self.score), default=None)
            if best is None:
                break
            i = best[1]
            row[i:i + 2] = [row[i] + row[i + 1]]
        return row

    def fits(self, a: int, b: int) -> bool:
        """Whether re-merging two neighbours gives them back."""
        if len(self.pairs) >= REMEMBER:
            self.pairs.clear()
        left, right = self.text(a), self.text(b)
        known = self.pairs[a << 21 | b] = self.merged(left + right) == [left, right]
        return known

    def text(self, token: int) -> str:
        return self.piece[token] if token < self.other else chr(token - self.other)

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word.  A token is the id of a piece, or ``other`` and the
        code point of a character without one; 0 stands for none."""
        n, other, size, shorter, pairs = len(word), self.other, self.size, self.shorter, self.pairs
        longest = [0] * n if n <= REMEMBER_CHARS else array("i", bytes(4 * n))      # piece at each place
        for end, (i, last) in self.automaton.iter(word):
            longest[end - last] = i                            # later ends are of longer pieces
        failed, any_failed = bytearray((n >> 3) + 1), False
        row: list[int] = []
        at, before, token = 0, 0, longest[0] or other + ord(word[0])
        while True:
            while token:
                end = at + (size[token] if token < other else 1)
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    if before:
                        good = pairs.get(before << 21 | token)
                        if self.fits(before, token) if good is None else good:
                            break
                    elif end < n or self.merged(word) == [word]:
                        break
                token = shorter[token] if token < other else 0
            if token:
                row.append(token)
                if end == n:
                    break
                at, before, token = end, token, longest[end] or other + ord(word[end])
            else:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed, token = True, row.pop()
                at -= size[token] if token < other else 1
                before, token = row[-1] if row else 0, shorter[token] if token < other else 0
        if max(row) < other:
            return row
        return [i for token in row for i in ([token] if token < other else map(self.byte.__getitem__, chr(token - other).encode()))]

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        text = self.prefix + text.replace(" ", MARK)
        words = self.words.findall(text) if len(text) <= AT_ONCE else (m.group() for m in self.words.finditer(text))
        if isinstance(words, list) and max(map(len, words)) <= REMEMBER_CHARS:
            ids = map(self.word, words)
        else:
            ids = (self.word(w) if len(w) <= REMEMBER_CHARS else self.encode_word(w) for w in words)
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD, each.
        Raises ``ValueError`` on an id outside the vocabulary."""
        try:
            parts = [ids] if self.silent.isdisjoint(ids) else (list(g) for quiet, g in itertools.groupby(ids, self.silent.__contains__) if not quiet)
            text = "".join(b"".join(map(self.raw.__getitem__, part)).decode("utf-8", "assay_each_byte") for part in parts)
        except KeyError as e:
            raise ValueError(f"not an id of the vocabulary: {e}") from None
        first = next((i for i in ids if self.raw[i]), None) if self.prefix else None
        return text[1:] if first in self.marked else text      # without the mark set before a text


_models: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of this process."""
    if path not in _models:
        _models[path] = Model(path)
        gc.freeze()            # its tables need no further visits by the garbage collector
    return _models[path]


def forget() -> None:
    if _models:
        _models.clear()
        gc.unfreeze()          # they refer to themselves, and the collector frees nothing that is frozen
        gc.collect()


def encode(docs: DataFrame, path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` without ``text``, with ``ids`` (array of int) and, if asked
    for, ``decoded`` (string): the text that the ids stand for.

    Map-only, without begin and end ids.  Null counts as the empty text, which
    has no ids.  A text keeps its characters but for the space mark U+2581, which
    comes back as a space.  Beside a text itself, memory follows its longest run
    without a space, with some 5 bytes a character.  Other columns stay as they
    are but for those named like an output.  ``path`` must exist on all nodes.
    """
    ship(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name not in (text, "ids", "decoded")]
    schema = T.StructType([*others, T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           *[T.StructField("decoded", T.StringType())] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("pieces")
        own = model(path)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids, back, chars, start = [], [], 0, at
                while at < batch.num_rows and at - start < BATCH_ROWS and chars < BATCH_CHARS:
                    value = batch.column(len(others))[at].as_py() or ""
                    ids.append(own.encode(value))
                    if decoded:
                        back.append(own.decode(ids[-1].tolist()))
                    chars += len(value)
                    at += 1
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(start, at - start) for c in batch.columns[:len(others)]] + made + [pa.array(back, pa.string())] * decoded,
                    names=schema.names)

    return docs.select(*[f"`{f.name}`" for f in others], f"`{text}`").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``ids`` replaced by ``decoded`` (string); null ids are
    the empty text, a null or unknown id within them fails the job."""
    ship(encoded.sparkSession)
    others = [f for f in encoded.schema.fields if f.name not in (ids, "decoded")]
    schema = T.StructType([*others, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("pieces")
        own = model(path)
        for batch in batches:
            back = [own.decode(x.as_py() or []) for x in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(back, pa.string())], names=schema.names)

    return encoded.select(*[f"`{f.name}`" for f in others], f"`{ids}`").mapInArrow(run, schema)
