"""Byte-level BPE in linear time by backtracking over longest matches.

A text is split by the vocabulary's pattern and every piece encoded by itself.
The bytes of a piece are read as Latin-1 characters, so that an Aho-Corasick
automaton over the vocabulary finds all tokens in it in one pass; kept is the
longest that starts at each place.  From the left, the longest token goes in if
it may stand beside the token before it; else its next shorter prefix token is
tried, and when none is left the last token is taken back and its end is marked
as a dead end, which is never tried again.  Two tokens may stand side by side
if the merges would leave the border between them alone; that is worked out by
taking the merges apart on either side of it, and remembered for each pair.
The result is the one that the merges by rank give.

Python style: automaton and backtracking have no counterpart in SQL.  Tables
are built once in each worker process; the memory for remembered pieces and
pairs is bounded by ``REMEMBER``.
"""

from __future__ import annotations

import base64
import gc
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assay.llm.staging import hold, ship

#: Pieces, and pairs, that a worker process remembers; the longest piece of them.
REMEMBER, REMEMBER_CHARS = 600_000, 64
#: Characters up to which the pieces of a text are listed at once; rows and bytes of a result batch.
AT_ONCE, BATCH_ROWS, BATCH_CHARS = 1 << 20, 1000, 1 << 22


class _Remembered(dict):
    """Results by argument.  When half the bound is reached, those asked for
    since then replace the older ones."""

    def __init__(self, compute, keep):
        self.compute, self.keep, self.older, self.most = compute, keep, {}, REMEMBER

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if not self.keep(key):
                return value
        if len(self) >= self.most // 2:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """``path``: a rank file, a line for each token with its bytes in base64
    and its rank, which is its id; ``pattern``: what splits a text into pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.token = {r: b for b, r in self.ranks.items()}
        self.size = {r: len(b) for r, b in self.token.items()}
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for b, r in self.ranks.items():
            self.automaton.add_word(b.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.search = self.automaton.iter("")
        #: For a token, the longest other token that it starts with.
        self.shorter = {r: next((self.ranks[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.ranks), None)
                        for r, b in self.token.items()}
        self.halves: dict[int, tuple[int, int]] = {}      # the merge that makes a token
        self.made: dict[tuple[int, int], int] = {}        # the same, by its halves
        for r in sorted(self.token):
            self._learn_merge(r)
        self.side_by_side = _Remembered(lambda pair: self._border_holds(*pair), lambda pair: True)
        self.pieces = _Remembered(lambda piece: tuple(self.encode_piece(piece.encode())), lambda p: len(p) <= REMEMBER_CHARS)

    def _learn_merge(self, r: int) -> None:
        whole, left = self.token[r], self.shorter[r]
        while left is not None:
            right = self.ranks.get(whole[self.size[left]:], r)
            if left < r and right < r and self._border_holds(left, right):
                self.halves[r], self.made[left, right] = (left, right), r
                return
            left = self.shorter[left]

    def _border_holds(self, a: int, b: int) -> bool:
        """Whether the merges leave the border between tokens ``a`` and ``b``.

        Going back in time, the token that was merged last comes apart first.
        Whatever then touches the border must have no merge of an earlier rank;
        at equal rank the merge further left comes first.
        """
        before = len(self.token) + max(a, b) + 1
        while self.made.get((a, b), before) >= before:
            a_first = a > b if a in self.halves and b in self.halves else a in self.halves
            if a_first:
                before, a = a, self.halves[a][1]
            elif b in self.halves:
                before, b = b + 1, self.halves[b][0]
            else:
                return True
        return False

    def encode_piece(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        size, shorter, fits = self.size, self.shorter, self.side_by_side
        longest: list[int | None] = [None] * (n + 1)
        self.search.set(piece.decode("latin-1"), True)
        for end, r in self.search:
            longest[end + 1 - size[r]] = r        # later ends are of longer tokens
        dead, out, at, token = bytearray(n + 1), [], 0, longest[0]
        while at < n:
            while token is not None:
                end = at + size[token]
                if not dead[end] and (not out or fits[out[-1], token]):
                    break
                token = shorter[token]
            if token is not None:
                out.append(token)
                at, token = end, longest[end]
            else:
                dead[at] = 1
                token = out.pop()
                at -= size[token]
        return out

    def encode(self, text: str) -> np.ndarray:
        ids = self.pieces.__getitem__
        if len(text) <= AT_ONCE:
            return np.fromiter(itertools.chain.from_iterable(map(ids, self.pattern.findall(text))), np.int32)
        found = (m.group() for m in self.pattern.finditer(text))
        return np.fromiter(itertools.chain.from_iterable(map(ids, found)), np.int32)

    def decode(self, ids: np.ndarray | list) -> bytes:
        """Raises ``ValueError`` on a null id or one outside the vocabulary."""
        try:
            return b"".join(map(self.token.__getitem__, ids if isinstance(ids, list) else ids.tolist()))
        except KeyError as e:
            raise ValueError(f"not an id of the vocabulary: {e}") from None


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this process."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
        gc.freeze()            # its tables need no further visits by the garbage collector
    return _encoders[path, pattern]


def forget() -> None:
    if _encoders:
        _encoders.clear()
        gc.unfreeze()          # they refer to themselves, and the collector frees nothing that is frozen
        gc.collect()


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False,
           remember: int = REMEMBER) -> DataFrame:
    """``docs`` without ``text``, with ``ids`` (array of int) and, if asked
    for, ``decoded`` (binary): the bytes that the ids stand for.  ``remember``:
    pieces, and pairs, that a worker process keeps; fewer take more time.

    Map-only.  Null counts as the empty text, which has no ids.  Other columns
    stay as they are but for those named like an output.  Beside a text, memory
    follows its longest piece by the pattern, with 8 bytes for each of its bytes.
    """
    ship(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name not in (text, "ids", "decoded")]
    schema = T.StructType([*others, T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                           *[T.StructField("decoded", T.BinaryType())] * decoded])
    columns = [f"`{f.name}`" for f in others] + [f"`{text}`"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("bpe")
        own = encoder(path, pattern)
        own.pieces.most = own.side_by_side.most = remember
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                ids, back, chars, start = [], [], 0, at
                while at < batch.num_rows and at - start < BATCH_ROWS and chars < BATCH_CHARS:
                    value = batch.column(len(others))[at].as_py() or ""
                    ids.append(own.encode(value))
                    if decoded:
                        back.append(own.decode(ids[-1]))
                    chars += len(value)
                    at += 1
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(start, at - start) for c in batch.columns[:len(others)]] + made + [pa.array(back, pa.binary())] * decoded,
                    names=schema.names)

    return docs.select(*columns).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``ids`` replaced by ``decoded`` (binary).  Null ids are
    empty; a null or unknown id within them fails the job with its value."""
    ship(encoded.sparkSession)
    others = [f for f in encoded.schema.fields if f.name not in (ids, "decoded")]
    schema = T.StructType([*others, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("bpe")
        own = encoder(path, pattern)
        for batch in batches:
            back = [own.decode(x.as_py() or []) for x in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(others)], pa.array(back, pa.binary())], names=schema.names)

    return encoded.select(*[f"`{f.name}`" for f in others], f"`{ids}`").mapInArrow(run, schema)
