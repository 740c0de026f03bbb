"""Spelling variants among the words of a corpus, by Bloom-guided neighbourhoods.

All words are counted.  Of each word of the vocabulary the edits of one code
point are generated as hashes (a polynomial in the place, so an edit costs a few
operations whatever the length) and probed against blocked Bloom filters of the
vocabulary, one shard for each length.  Only the edits that the filters let pass
become strings; they shuffle to an exact join with the vocabulary, which removes
the false positives.  An insertion is the other word's deletion, and a
replacement is generated from the side with the smaller code point only, so each
pair of neighbours is found once.

The filters are built in tasks and broadcast.  They take ``bits`` bits a word
and ``filter_bytes`` at most: a larger vocabulary goes in slices by hash, one
broadcast after another, each probed with the edits that fall into the slice.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm import textblocks as tb
from assay.llm.staging import ship, stage


@dataclass(frozen=True)
class Params:
    shortest: int = 5               # code points of a word
    least: int = 3                  # occurrences of a word
    typos: int = 97                 # one run of so many loses a code point; 0: none
    factor: int = 2                 # a form is so many times as frequent at least
    bits: int = 16                  # of a filter, for each word
    filter_bytes: int = 32 << 20    # of the filters of one broadcast


PRODUCTION = Params()
_RUN, _BREAK = re.compile("[A-Za-zÀ-ÿ]+"), re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
#: Code points that a run has after lower-casing.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
#: Characters of a text that are cut into runs at once, words that a task adds up before it passes them on, edits probed at once.
AT_ONCE, ADDED_UP, PROBES = 1 << 20, 200_000, 1 << 20
WORDS_OF_A_TASK = 20_000
#: Bits of a filter block, bits set for a word, fewest blocks of a shard.
BLOCK_BITS, SET_BITS, LEAST_BLOCKS = 512, 6, 64


def runs(text: str) -> Counter:
    """Occurrences of the lower-cased runs of a whole text."""
    total: Counter = Counter()
    at = 0
    while at < len(text):
        gap = _BREAK.search(text, at + AT_ONCE) if len(text) - at > AT_ONCE else None
        to = gap.start() if gap else len(text)
        total.update(_RUN.findall(text, at, to))
        at = to
    lowered: Counter = Counter()
    for run, n in total.items():
        lowered[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    return lowered


def word_of(run: str, start: int, typos: int) -> str:
    """The run, or what is left of it; ``start``: crc32 of what stands before it."""
    h = zlib.crc32(run.encode(), start)
    return run[:h % len(run)] + run[h % len(run) + 1:] if typos and h % typos == 0 else run


def vocabulary(docs: DataFrame, doc_id: str, text: str, p: Params) -> DataFrame:
    """``word, n`` of all words of at least ``shortest`` code points and ``least`` occurrences."""
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                key, typos = key.as_py(), p.typos
                start, typos = (0, 0) if key is None else (zlib.crc32(f"{key}:".encode()), p.typos)
                for each, n in runs(value.as_py() or "").items():
                    if len(each) >= p.shortest:
                        word = word_of(each, start, typos)
                        if len(word) >= p.shortest:
                            counts[word] += n
                if len(counts) >= ADDED_UP:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    counted = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= p.least)


def shard(length: np.ndarray) -> np.ndarray:
    """One shard for each length; long ones share theirs by powers of two."""
    return np.where(length < 64, length, 58 + np.floor(np.log2(np.maximum(length, 1))).astype(np.int64))


@dataclass
class Filters:
    """Blocked Bloom filters: the blocks of shard ``s`` start at ``first[s]``."""
    first: np.ndarray
    blocks: np.ndarray      # of each shard, 0 for none
    data: np.ndarray        # 64-bit words, eight to a block

    @staticmethod
    def place(keys: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(32)) % blocks.astype(np.uint64)).astype(np.int64)

    @staticmethod
    def bit(keys: np.ndarray, i: int) -> np.ndarray:
        """The ``i``-th bit of each key within its block."""
        return (tb.mix(keys + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(9 * i)) & np.uint64(BLOCK_BITS - 1)

    def hits(self, keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Indexes of the keys (of shards ``of``) that may be in the vocabulary."""
        at = np.flatnonzero(self.blocks[of])
        block = self.first[of[at]] + self.place(keys[at], self.blocks[of[at]])
        for i in range(SET_BITS):
            bit = self.bit(keys[at], i)
            good = (self.data[block * 8 + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
            at, block = at[good], block[good]
        return at


def matrices(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes and code points (a row each) of the words of each length, few enough at once."""
    length = np.array([len(w) for w in words], np.int64)
    for size in np.unique(length).tolist():
        which = np.flatnonzero(length == size)
        some = max(1, PROBES // (size * len(ALPHABET)))
        for k in range(0, len(which), some):
            part = which[k:k + some]
            points = np.frombuffer("".join(words[i] for i in part.tolist()).encode("utf-32-le"), np.uint32)
            yield part, points.reshape(len(part), size).astype(np.uint64)


def hash_sums(points: np.ndarray) -> np.ndarray:
    """Of each word, the sums that its hash and those of its edits come from."""
    sums = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    np.cumsum(points * tb.powers(points.shape[1] + 1)[0][:points.shape[1]], axis=1, out=sums[:, 1:])
    return sums


def key_of(total: np.ndarray, size: int) -> np.ndarray:
    return tb.mix(total + np.uint64(size * 0xD6E8FEB86659FD93 % 2**64))


def build_filters(vocab: DataFrame, sizes: dict[int, int], slices: int, nth: int, p: Params) -> Filters:
    """Filters of the words of slice ``nth``; ``sizes``: words of each shard."""
    last = max(sizes)
    blocks = np.zeros(last + 2, np.int64)
    for s, n in sizes.items():
        blocks[s] = max(LEAST_BLOCKS, math.ceil(n * p.bits / slices / BLOCK_BITS))
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    schema = T.StructType([T.StructField("block", T.LongType()), *[T.StructField(f"w{i}", T.LongType()) for i in range(8)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, points in matrices(batch.column(0).to_pylist()):
                size = points.shape[1]
                keys = key_of(hash_sums(points)[:, -1], size)
                keys = keys[keys % np.uint64(slices) == nth]
                of = shard(np.full(len(keys), size))
                block = first[of] + Filters.place(keys, blocks[of])
                set_ = np.zeros((len(keys), 8), np.uint64)
                for i in range(SET_BITS):
                    bit = Filters.bit(keys, i)
                    set_[np.arange(len(keys)), (bit >> np.uint64(6)).astype(np.int64)] |= np.uint64(1) << (bit & np.uint64(63))
                yield pa.RecordBatch.from_arrays([pa.array(block), *[pa.array(set_[:, i].copy().view(np.int64)) for i in range(8)]], names=schema.names)

    data = np.zeros(int(blocks.sum()) * 8, np.uint64)
    for row in vocab.select("word").mapInArrow(run, schema).groupBy("block").agg(*[F.bit_or(f"w{i}") for i in range(8)]).toLocalIterator():
        data[row[0] * 8:row[0] * 8 + 8] = np.array(row[1:], np.int64).view(np.uint64)
    return Filters(first, blocks, data)


def edits(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``key, row, place, code point`` of the edits of words of one length: all
    deletions (0 for the code point; of equal neighbours the first only), then
    the replacements by a larger code point."""
    size = points.shape[1]
    sums = hash_sums(points)
    power, inverse = tb.powers(size + 1)
    gone = (sums[:, -1:] - sums[:, 1:]) * inverse[1] + sums[:, :-1]
    row, place = np.nonzero(np.concatenate([np.ones((len(points), 1), bool), points[:, 1:] != points[:, :-1]], axis=1))
    yield key_of(gone[row, place], size - 1), row, place, np.zeros(len(row), np.uint64)
    some = max(1, PROBES // (len(points) * len(ALPHABET)))
    for k in range(0, size, some):
        row, place, letter = np.nonzero(ALPHABET[None, None, :] > points[:, k:k + some, None])
        to, place = ALPHABET[letter], place + k
        yield key_of(sums[row, -1] + (to - points[row, place]) * power[place], size), row, place, to


def candidates(vocab: DataFrame, filters: Filters, slices: int, nth: int) -> DataFrame:
    """``word, n, other``: edits of the vocabulary that the filters let pass."""
    spark = vocab.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(filters)
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("other", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        top = len(known.blocks) - 1                            # a shard that holds nothing
        for batch in batches:
            words = batch.column(0).to_pylist()
            for which, points in matrices(words):
                for key, row, place, to in edits(points):
                    mine = np.flatnonzero(key % np.uint64(slices) == nth)
                    of = np.where(to[mine] > 0, shard(np.full(len(mine), points.shape[1])), shard(np.full(len(mine), points.shape[1] - 1)))
                    at = mine[known.hits(key[mine], np.minimum(of, top))]
                    index = which[row[at]]
                    found = [words[i][:j] + (chr(c) if c else "") + words[i][j + 1:]
                             for i, j, c in zip(index.tolist(), place[at].tolist(), to[at].tolist())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(index)), batch.column(1).take(pa.array(index)),
                                                      pa.array(found, pa.string())], names=schema.names)

    made = stage(vocab.select("word", "n").mapInArrow(run, schema), "edits")
    sent.destroy()
    return made


def neighbours(vocab: DataFrame, p: Params) -> DataFrame:
    """``word, n, other, other_n``: every pair of near words, once."""
    spark = vocab.sparkSession
    ship(spark)
    length = F.length("word").cast("long")
    of = F.when(length < 64, length).otherwise(58 + F.floor(F.log2(length)))
    sizes = {r.s: r["count"] for r in vocab.groupBy(of.alias("s")).count().collect()}
    if not sizes:
        return vocab.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).where("false")
    slices = max(1, math.ceil(sum(sizes.values()) * p.bits / 8 / p.filter_bytes))
    # By words, not bytes: an edit costs far more than its row weighs.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(sizes.values()) // WORDS_OF_A_TASK)
    dealt = vocab.repartition(parts, "word")
    found = [candidates(dealt, build_filters(vocab, sizes, slices, i, p), slices, i) for i in range(slices)]
    return reduce(DataFrame.union, found).join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


def roots(form: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the end of each chain of forms.  Every
    round doubles the steps taken; occurrences grow with each step, so a
    chain has at most some 60."""
    at = stage(form.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = stage(at.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        at = further.select("word", "root")
        if further.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = PRODUCTION) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row for each word.

    Every row of ``docs`` counts, repeated rows and rows that share an id too.
    Null and empty texts have no words; rows without an id lose no code point.
    Of near words with equal occurrences the smallest is the form.  Other
    columns play no part.
    """
    vocab = stage(vocabulary(docs, doc_id, text, params), "vocabulary")
    once = stage(neighbours(vocab, params), "near")
    both = once.union(once.select("other", "other_n", "word", "n"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    known = vocab.join(near, "word", "left")
    fits = F.col("best").isNotNull() & (-F.col("best.less") >= params.factor * F.col("n"))
    known = stage(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                               F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
