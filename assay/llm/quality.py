"""Quality rules: zstandard compression bands.

A text that compresses far better than prose of its length repeats itself, one
that hardly compresses is noise (keys, encoded data).  The ratio compressed /
raw bytes is taken over the whole text and over its chunks, equal parts of about
``chunk_bytes`` that cover all of it; each has a band of accepted ratios that
depends on the length, as short texts compress worse.  A text fails if its own
ratio is outside its band, or if more than ``max_bad_bytes`` of its bytes are in
chunks outside theirs.  The given bands are wide enough for any prose; a table of
labels narrows them to what good texts of like length have.

Beside the verdict stand plain counts of words, symbols, repeated lines and
repeated 3-word windows, with two base limits on them.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm import textblocks as tb
from assay.llm.staging import hold, ship


@dataclass(frozen=True)
class Bands:
    """``limits``: (bytes up to which it holds, lowest ratio, highest ratio)
    by length; beyond the last, ``rest`` holds.  ``fitted``, in the same form, and
    ``chunk``, (lowest, highest) for chunks, narrow them."""

    level: int = 3
    chunk_bytes: int = 1536
    max_bad_bytes: float = 0.2      # share of the text
    limits: tuple[tuple[int, float, float], ...] = (
        (200, 0.0, 9.0), (400, 0.30, 0.92), (1_000, 0.25, 0.84), (4_000, 0.18, 0.73), (16_000, 0.14, 0.68))
    rest: tuple[float, float] = (0.12, 0.66)
    fitted: tuple[tuple[int, float, float], ...] = ()
    chunk: tuple[float, float] = (0.0, 9.0)

    def band(self, size: int, chunk: bool = False) -> tuple[float, float]:
        low, high = next((x[1:] for x in self.limits if size < x[0]), self.rest)
        if chunk:
            least, most = self.chunk
        else:
            at = bisect.bisect_right(self.fitted, size, key=lambda x: x[0])
            least, most = self.fitted[at][1:] if at < len(self.fitted) else (0.0, 9.0)
        return max(low, least), min(high, most)


@dataclass(frozen=True)
class Fit:
    """How bands are fitted to labelled texts."""

    per_doubling: int = 4       # length bands
    least: int = 30             # good texts in a band and its neighbours, else it is not narrowed
    margin: float = 0.01        # of the ratio, beyond what good texts have

    def upto(self, k: int) -> int:
        return math.ceil(2 ** ((k + 1) / self.per_doubling))

    def index(self, size: int) -> int:
        k = max(0, int(math.log2(max(1, size)) * self.per_doubling) - 1)
        while size >= self.upto(k):
            k += 1
        return k


PRODUCTION = Bands()
FIT = Fit()
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def outside(data: bytes, bands: Bands, pack: zstandard.ZstdCompressor, chunk: bool = False) -> bool:
    if not data:
        return False
    low, high = bands.band(len(data), chunk)
    return high < 9 and not low <= len(pack.compress(data)) / len(data) <= high


def chunks(data: bytes, bands: Bands) -> list[bytes]:
    """Chunks of one size that cover a text; none if it would be one."""
    n = round(len(data) / bands.chunk_bytes)
    cuts = [len(data) * i // n for i in range(n + 1)] if n > 1 else []
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def compression_verdict(data: bytes, bands: Bands, pack: zstandard.ZstdCompressor) -> bool:
    """True if the text is kept."""
    if outside(data, bands, pack):
        return False
    bad = sum(len(c) for c in chunks(data, bands) if outside(c, bands, pack, chunk=True))
    return bad <= bands.max_bad_bytes * len(data)


def measures(data: bytes, bands: Bands, pack: zstandard.ZstdCompressor) -> tuple[float, float, float]:
    """The ratio of a text, and the narrowest band of chunks that it passes
    with half of the bytes it may have outside on either side."""
    found = sorted((len(pack.compress(c)) / len(c), len(c)) for c in chunks(data, bands))
    spare = bands.max_bad_bytes / 2 * len(data)

    def limit(ordered, none: float) -> float:
        seen = 0
        for ratio, size in ordered:
            seen += size
            if seen > spare:
                return ratio
        return none

    return len(pack.compress(data)) / len(data), limit(found, 9.0), limit(reversed(found), 0.0)


def _distinct_of(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    _, first = np.unique(keys, return_index=True)
    return np.bincount(owner[first], minlength=n)


def block_counts(block: tb.Block) -> np.ndarray:
    """One row of ``COUNTS`` for each document of the block."""
    b, bounds, n = block.data, block.bounds, len(block.bounds) - 1
    words, first = tb.word_hashes(block)
    out = np.zeros((n, len(COUNTS)), np.int64)
    if not len(b):
        return out
    ink = ~tb.SPACE[b]
    out[:, 0] = np.diff(first)
    out[:, 1] = tb.per_document(ink & ((b & 0xC0) != 0x80), bounds)
    out[:, 2] = tb.per_document(_SYMBOL[b], bounds)

    salt = tb.mix(np.arange(1, n + 1, dtype=np.uint64))       # equal lines of two documents differ
    feed = np.flatnonzero(b == 10)
    starts = np.union1d(feed + 1, bounds[:-1][np.diff(bounds) > 0])
    starts = starts[starts < len(b)]
    ends = np.append(starts[1:], len(b))
    ends = ends - (b[ends - 1] == 10)
    inked = np.zeros(len(b) + 1, np.int64)
    np.cumsum(ink, out=inked[1:])
    full = inked[ends] > inked[starts]
    starts, ends = starts[full], ends[full]
    if len(starts):
        owner = np.searchsorted(bounds, starts, "right") - 1
        lines = tb.span_hash(tb.prefix_hash(b), starts, ends) ^ salt[owner]
        out[:, 3] = np.bincount(owner, minlength=n) - _distinct_of(lines, owner, n)

    owner = np.repeat(np.arange(n), out[:, 0])
    triples = tb.sequences(words, 3)
    if len(triples):
        whole = owner[:len(triples)] == owner[2:]
        at = np.flatnonzero(whole)
        _, inverse, count = np.unique(triples[at] ^ salt[owner[at]], return_inverse=True, return_counts=True)
        again = at[count[inverse] > 1]
        covered = np.zeros(len(words), bool)
        for i in range(3):
            covered[again + i] = True
        out[:, 4] = tb.per_document(covered, first)
    return out


def base_fails(c: np.ndarray) -> np.ndarray:
    return (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > MAX_REPEAT_PERCENT * c[:, 0])


def fit_bands(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
              fit: Fit = FIT, bands: Bands = PRODUCTION) -> Bands:
    """``bands`` narrowed by length to the texts that ``labels`` calls good
    (``label`` is 1): what remains outside lies beyond all good texts of like
    length by ``fit.margin``.

    Fitted on all labelled documents, whole texts.  An id that has a label other
    than 1, or null, is not good; null ids, null texts and texts that fail the base
    rules do not count, repeated rows do.  Lengths with fewer than ``fit.least`` good
    texts keep their band, so empty tables change nothing.  Texts are measured where
    they are read, so that the join with the labels moves a few numbers for each; to
    the driver comes one row for each length band.
    """
    spark = docs.sparkSession
    ship(spark)
    good = (labels.select(F.col(f"`{doc_id}`").alias("id"), (F.col(f"`{label}`") == 1).alias("good")).where("id is not null")
            .groupBy("id").agg(F.bool_and(F.coalesce("good", F.lit(False))).alias("good")).where("good").select("id"))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("id is not null and text is not null")
    schema = T.StructType([texts.schema["id"], T.StructField("k", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in ("ratio", "low", "high")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        pack = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            ids, at = batch.column(0), 0
            for block in tb.blocks(batch.column(1)):
                raw, failed = block.data.tobytes(), base_fails(block_counts(block))
                fine = ids.slice(at, len(failed)).filter(pa.array(~failed))
                at += len(failed)
                own = [raw[s:e] for s, e, f in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), failed) if not f]
                rows = [(fit.index(len(d)), *measures(d, bands, pack)) for d in own]
                yield pa.RecordBatch.from_arrays(
                    [fine, *[pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), *[pa.float64()] * 3))]], names=schema.names)

    found = {r.k: r for r in texts.mapInArrow(run, schema).join(good, "id", "left_semi").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("ratio").alias("least"), F.max("ratio").alias("most"),
        F.min("low").alias("low"), F.max("high").alias("high")).collect()}
    limits = []
    for k in range(max(found, default=-2) + 2):
        near = [found[j] for j in (k - 1, k, k + 1) if j in found]
        enough = sum(r.n for r in near) >= fit.least
        limits.append((fit.upto(k), min(r.least for r in near) - fit.margin, max(r.most for r in near) + fit.margin) if enough
                      else (fit.upto(k), 0.0, 9.0))
    if sum(r.n for r in found.values() if r.low < 9) < fit.least:
        return replace(bands, fitted=tuple(limits))
    return replace(bands, fitted=tuple(limits), chunk=(min(r.low for r in found.values()) - fit.margin,
                                                       max(r.high for r in found.values()) + fit.margin))


def quality(docs: DataFrame, text: str = "text", bands: Bands = PRODUCTION) -> DataFrame:
    """The counts and verdict of every row of ``docs``, beside its other
    columns but ``text``: ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept``.

    Map-only: no shuffle.  Null and empty texts have counts of 0 and fail the
    base rule on words.  Repeated rows get the same answer each.  A column of
    ``docs`` named like an output is left out.
    """
    ship(docs.sparkSession)
    made = [*COUNTS, "base_failed", "kept"]
    others = [f for f in docs.schema.fields if f.name != text and f.name not in made]
    schema = T.StructType(others + [T.StructField(c, T.LongType()) for c in COUNTS]
                          + [T.StructField(c, T.BooleanType()) for c in made[-2:]])
    return docs.select(*[f"`{f.name}`" for f in others], f"`{text}`").mapInArrow(_judge(bands, made), schema)


def keep_quality(docs: DataFrame, text: str = "text", bands: Bands = PRODUCTION) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged."""
    ship(docs.sparkSession)
    return docs.mapInArrow(_filter(docs.columns.index(text), bands), docs.schema)


def _verdicts(column: pa.Array, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pack = zstandard.ZstdCompressor(level=bands.level)
    counts, verdict = [np.zeros((0, len(COUNTS)), np.int64)], []
    for block in tb.blocks(column):
        counts.append(block_counts(block))
        raw = block.data.tobytes()
        verdict += [compression_verdict(raw[s:e], bands, pack)
                    for s, e in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist())]
    c = np.concatenate(counts)
    failed = base_fails(c)
    return c, failed, ~failed & np.array(verdict, bool)


def _judge(bands: Bands, made: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        for batch in batches:
            k = batch.num_columns - 1
            c, failed, kept = _verdicts(batch.column(k), bands)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:k] + [pa.array(c[:, i]) for i in range(len(COUNTS))] + [pa.array(failed), pa.array(kept)],
                names=batch.schema.names[:k] + made)
    return run


def _filter(k: int, bands: Bands):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        for batch in batches:
            yield batch.filter(pa.array(_verdicts(batch.column(k), bands)[2]))
    return run
