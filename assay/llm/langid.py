"""Language identification by unigram pieces, summed over all segmentations.

A fixed public vocabulary of byte pieces is shared by all languages; a language
is a probability for each piece.  A word, with a space before it, has the sum of
the probabilities of all its segmentations into pieces, which a forward pass
adds up from left to right; a text has the product over its words.  The language
that makes the text most probable is predicted.

The pieces' probabilities are learnt by expectation maximisation: in each round
a forward and a backward pass count how often a piece is expected in the words
of a language.  That is fitted on about ``sample`` texts of each language
(``PRODUCTION.sample``), drawn evenly from all labelled rows; whole texts are
used, and every text is scored whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm import textblocks as tb
from assay.llm.staging import hold, ship, stage

UNDETERMINED = "und"


@dataclass(frozen=True)
class Params:
    sample: int = 600         # texts of a language that are learnt from, about
    rounds: int = 2
    longest: int = 12         # bytes of a piece
    learnt_word: int = 48     # bytes of a word that is learnt from whole; a longer one is cut at character borders
    floor: float = 0.05       # expected count that every piece has beside its own
    remember: int = 400_000   # words that a worker process remembers


PRODUCTION = Params()


@dataclass
class Vocabulary:
    keys: np.ndarray          # hashes of the pieces, sorted
    longest: int

    @classmethod
    def read(cls, path: str, longest: int) -> Vocabulary:
        with open(path, "rb") as f:
            pieces = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
        pieces = sorted({p.lower() for p in pieces if 0 < len(p) <= longest} | {bytes([i]) for i in range(256)})
        size = np.array([len(p) for p in pieces])
        b = np.frombuffer(b"".join(pieces), np.uint8)
        ends = size.cumsum()
        return cls(np.unique(tb.span_hash(tb.prefix_hash(b), ends - size, ends)), longest)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each piece; ``len(self)`` for what is none."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, len(self.keys))


def spaced(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words ``b[start:end]`` one after the other, each behind a space; and
    where each begins."""
    size = ends - starts + 1
    begin = np.concatenate([[0], size.cumsum()])
    out = b[np.minimum(np.repeat(starts - 1 - begin[:-1], size) + np.arange(begin[-1]), len(b) - 1)] if len(size) else b[:0]
    out[begin[:-1]] = 32
    return out, begin


def by_length(begin: np.ndarray) -> Iterator[np.ndarray]:
    size = np.diff(begin)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    yield from (g for g in np.split(order, cuts) if len(g))


def forward(words: np.ndarray, begin: np.ndarray, vocabulary: Vocabulary, probability: np.ndarray) -> np.ndarray:
    """Log probability of each word (bytes ``words[begin[i]:begin[i + 1]]``)
    under each language; ``probability`` has a row for each piece and one of
    zeros.  Sums are rescaled every few bytes, so words may have any length."""
    prefix = tb.prefix_hash(words)
    out = np.zeros((len(begin) - 1, probability.shape[1]))
    for group in by_length(begin):
        at, n = begin[group], int(begin[group[0] + 1] - begin[group[0]])
        last: list[np.ndarray] = [np.ones((len(group), probability.shape[1]))]      # sums up to the last places
        scale = np.zeros_like(last[0])
        for j in range(1, n + 1):
            total = np.zeros_like(last[0])
            for size in range(1, min(j, vocabulary.longest) + 1):
                piece = vocabulary.find(tb.span_hash(prefix, at + j - size, at + j))
                total += last[-size] * probability[piece]
            last.append(total)
            del last[:-vocabulary.longest]
            if j % 8 == 0:
                top = np.maximum.reduce(last)
                scale += np.log(top)
                last = [x / top for x in last]
        out[group] = np.log(last[-1]) + scale
    return out


def expected(words: np.ndarray, begin: np.ndarray, times: np.ndarray, vocabulary: Vocabulary, probability: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece in words of one language, which
    occur ``times`` each; ``probability`` is that language's column."""
    prefix = tb.prefix_hash(words)
    counts = np.zeros(len(vocabulary) + 1)
    for group in by_length(begin):
        at, n = begin[group], int(begin[group[0] + 1] - begin[group[0]])
        spans = {(j - size, j): vocabulary.find(tb.span_hash(prefix, at + j - size, at + j))
                 for j in range(1, n + 1) for size in range(1, min(j, vocabulary.longest) + 1)}
        unit = 16.0          # keeps the sums of usual words in range
        left = [np.ones(len(group))] + [np.zeros(len(group)) for _ in range(n)]
        right = [np.zeros(len(group)) for _ in range(n)] + [np.ones(len(group))]
        for (i, j), piece in sorted(spans.items(), key=lambda x: x[0][1]):
            left[j] += left[i] * probability[piece] * unit ** (j - i)
        for (i, j), piece in sorted(spans.items(), key=lambda x: -x[0][0]):
            right[i] += right[j] * probability[piece] * unit ** (j - i)
        weight = np.divide(times[group], left[n], out=np.zeros(len(group)), where=left[n] > 0)
        for (i, j), piece in spans.items():
            counts += np.bincount(piece, left[i] * probability[piece] * unit ** (j - i) * right[j] * weight, len(counts))
    return counts[:-1]


@dataclass
class Model:
    languages: list[str]
    probability: np.ndarray       # pieces + 1 rows, a column for each language
    vocabulary: Vocabulary


def learn(labelled: DataFrame, path: str, text: str, lang: str, key: Column, p: Params) -> Model:
    """``labelled``: the rows to learn from.  The driver holds one number for
    each piece and language."""
    spark = labelled.sparkSession
    ship(spark)
    vocabulary = Vocabulary.read(path, p.longest)
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), key.alias("draw"))
    each = {r["lang"]: r["n"] for r in rows.where("text is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # An even draw: the share of a language's texts that gives about p.sample of them.
    share = F.create_map(*[F.lit(x) for k, n in each.items() for x in (k, p.sample / n)]) if each else F.lit(None)
    drawn = (rows.where(F.pmod("draw", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20) if each else F.lit(False))
             .select("lang", F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''"))
    # Scripts without spaces write long runs: these are learnt from in pieces, all of them.
    cut = F.regexp_extract_all("word", F.lit(f"(?s).{{1,{max(1, p.learnt_word // 4)}}}"), F.lit(0))
    whole = F.octet_length("word") <= p.learnt_word
    drawn = drawn.select("lang", F.explode(F.when(whole, F.array("word")).otherwise(cut)).alias("word"))
    words = stage(drawn.groupBy("lang", "word").agg(F.count("*").alias("times")), "words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    probability = np.ones((len(vocabulary) + 1, len(languages))) / len(vocabulary)
    probability[-1] = 0
    column = {x: i for i, x in enumerate(languages)}
    for _ in range(p.rounds if languages else 0):
        now = spark.sparkContext.broadcast((vocabulary, probability))

        def count(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums: dict[str, np.ndarray] = {}
            vocabulary, probability = now.value
            for batch in batches:
                for name in set(batch.column(0).to_pylist()):
                    part = batch.filter(pc.equal(batch.column(0), name))
                    for at in range(0, part.num_rows, 20_000):
                        some = part.slice(at, 20_000)
                        b, off = tb.utf8(some.column(1))
                        spaced_words, begin = spaced(b, off[:-1], off[1:])
                        found = expected(spaced_words, begin, some.column(2).to_numpy().astype(float), vocabulary, probability[:, column[name]])
                        sums[name] = sums.get(name, 0) + found
            for name, found in sums.items():
                piece = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(piece)), pa.array(piece), pa.array(found[piece])], names=["lang", "piece", "n"])

        counts = np.full((len(vocabulary), len(languages)), p.floor)
        summed = words.mapInArrow(count, "lang string, piece bigint, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        where = np.array([column[x] for x in summed["lang"].to_pylist()], np.int64)
        counts[summed["piece"].to_numpy(), where] += summed["n"].to_numpy()
        probability[:-1] = counts / counts.sum(axis=0)
        now.unpersist()
    return Model(languages, probability, vocabulary)


class _Words:
    """Scores of the words that this process has met."""

    def __init__(self, model: Model, remember: int):
        self.model, self.remember = model, remember
        self.keys = np.zeros(0, np.uint64)
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def of(self, block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the word scores of each document, and its number of words."""
        starts, ends, first = tb.word_spans(block.data, block.bounds)
        hashes = tb.span_hash(tb.prefix_hash(block.data), starts, ends)
        keys, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = keys[~np.isin(keys, self.keys, assume_unique=True)]
        if len(new):
            if len(self.keys) > self.remember:
                self.keys, self.scores, new = self.keys[:0], self.scores[:0], keys
            at = where[np.searchsorted(keys, new)]
            words, begin = spaced(block.data, starts[at], ends[at])
            found = forward(words, begin, self.model.vocabulary, self.model.probability)
            all_keys = np.concatenate([self.keys, new])
            order = np.argsort(all_keys, kind="stable")
            self.keys, self.scores = all_keys[order], np.concatenate([self.scores, found.astype(np.float32)])[order]
        score = self.scores[np.searchsorted(self.keys, keys)].astype(float)[inverse]
        total = np.concatenate([np.zeros((1, score.shape[1])), score.cumsum(axis=0)])
        return total[first[1:]] - total[first[:-1]], np.diff(first)


_known: dict[str, _Words] = {}


def forget() -> None:
    _known.clear()


def predict(docs: DataFrame, model: Model, text: str = "text", p: Params = PRODUCTION) -> DataFrame:
    """``docs`` without ``text``, with ``lang_pred`` and ``score``.

    ``score`` is the share of the predicted language in the probability of the
    text, all languages being as likely beforehand.  A text that is null or has
    no letter is ``und`` with score 0, as is every text if the model has learnt
    no language.  Of equally probable languages the first in code-point order is
    predicted; repeated rows get the same answer.  Columns named like an output
    are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    others = [f for f in docs.schema.fields if f.name not in (text, "lang_pred", "score")]
    schema = T.StructType([*others, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)
    name = f"{spark.sparkContext.applicationId}-{id(model)}-{np.random.default_rng().integers(2**63)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from assay.llm.langid import _Words, _known

        hold("langid")
        if name not in _known:
            _known.clear()
            _known[name] = _Words(shared.value, p.remember)
        words = _known[name]
        languages = np.array(words.model.languages or [UNDETERMINED], object)
        for batch in batches:
            k = len(others)
            lowered = pc.utf8_lower(batch.column(k))
            has_letter = pc.fill_null(batch.column(k + 1), False).to_numpy(zero_copy_only=False)
            for block in tb.blocks(lowered):
                n = len(block.bounds) - 1
                best, score = np.full(n, UNDETERMINED, object), np.zeros(n)
                if words.model.languages:
                    sums, _ = words.of(block)
                    top = sums.argmax(axis=1)
                    share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                    lettered = has_letter[block.first:block.first + n]
                    best, score = np.where(lettered, languages[top], UNDETERMINED), np.where(lettered, share, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(block.first, n) for c in batch.columns[:k]] + [pa.array(best, pa.string()), pa.array(score)], names=schema.names)

    letters = F.col(f"`{text}`").rlike(r"\p{L}")
    return docs.select(*[F.col(f"`{f.name}`") for f in others], F.col(f"`{text}`"), letters.alias("__letters")).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 1 by 3; not for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", p: Params = PRODUCTION) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs``; learnt
    from the texts and languages of the rows that are not held out.  Null texts
    and languages are not learnt from, a null id is not held out; rows that share
    an id are rows of their own.  Other columns play no part."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
                       held_out(F.col(doc_id)).alias("held_out"))
    model = learn(rows.where("not held_out"), path, "text", "lang", F.xxhash64("doc_id", "text"), p)
    return predict(rows.select("doc_id", "held_out", "text"), model, p=p)
