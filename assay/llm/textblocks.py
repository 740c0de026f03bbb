"""Vectorised word work on Arrow text columns inside a task.

Texts stay the UTF-8 bytes that Arrow delivers.  A block is a run of whole
documents of about ``BLOCK`` bytes; word and substring hashes come from one
prefix sum per block, so nothing here loops over words in Python and memory
follows the block, not the batch.  Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20

_rng = np.random.default_rng(20240229)
#: One random 64-bit value per byte, and per byte after lower-casing A-Z.
BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]
#: Odd multipliers for sequences of words.
WORD_AT = _rng.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


@dataclass
class Block:
    first: int            # row of the first document
    data: np.ndarray      # bytes of the documents
    bounds: np.ndarray    # document i has data[bounds[i]:bounds[i + 1]]


def blocks(column: pa.Array) -> Iterator[Block]:
    data, off = utf8(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + BLOCK, "right")) - 1)
        yield Block(i, data[off[i]:off[j]], off[i:j + 1] - off[i])
        i = j


def prefix_hash(b: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    p = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(table[b] * powers(len(b))[0], out=p[1:])
    return p


def span_hash(p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every ``b[start:end]``, wherever it stands in the block."""
    inverse = powers(len(p))[1]
    return mix((p[ends] - p[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_spans(b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without white space), and the index
    of each document's first word, with the number of words at the end."""
    if not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    word = ~SPACE[b]
    cut = np.zeros(len(b) + 1, bool)
    cut[bounds] = True
    before = cut[:-1].copy()
    before[1:] |= ~word[:-1]
    after = cut[1:].copy()
    after[:-1] |= ~word[1:]
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(block: Block, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a block and the first word of each document.  A
    document far beyond ``BLOCK`` is worked off in pieces cut at white space."""
    b, bounds = block.data, block.bounds
    table = BYTE_LOWER if lower else BYTE
    if len(b) <= 2 * BLOCK:
        starts, ends, first = word_spans(b, bounds)
        return span_hash(prefix_hash(b, table), starts, ends), first
    parts, at = [], 0        # a block of over BLOCK bytes is one document
    while at < len(b):
        to = min(len(b), at + BLOCK)
        while to < len(b) and not (space := np.flatnonzero(SPACE[b[to:to + BLOCK]])).size:
            to = min(len(b), to + BLOCK)
        if to < len(b):
            to += int(space[0])
        piece = b[at:to]
        starts, ends, _ = word_spans(piece, np.array([0, len(piece)]))
        parts.append(span_hash(prefix_hash(piece, table), starts, ends))
        at = to
    words = np.concatenate(parts)
    return words, np.array([0, len(words)])


def sequences(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that start at each word; the last ``k - 1``
    words of the block start none."""
    n = max(0, len(words) - k + 1)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total += words[i:i + n] * WORD_AT[i]
    return mix(total + np.uint64(k))


def per_document(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of set flags of each document."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[bounds[1:]] - c[bounds[:-1]]
