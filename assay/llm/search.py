"""Ranked lexical search, the other way round.

The stated items are few and the documents many, so the index is over the items:
their terms, each with the items that hold it, are broadcast, and every document
streams its term counts through it.  A document adds up the scores of all items
that share a term with it at once; each task keeps the best documents of an item
in a heap of ``keep`` places, and the heaps of all tasks are merged.

A first pass counts the items' terms in every text and writes the counts; the
numbers of documents behind the weights come from that table.  An index holds
about ``postings`` pairs of term and item: more items than that go in blocks, one
broadcast after another, each against all documents.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from assay.llm.staging import ship, stage


@dataclass(frozen=True)
class Params:
    keep: int = 10                  # documents of an item
    postings: int = 500_000         # pairs of term and item of one broadcast index, about 6 MB


PRODUCTION = Params()
#: What a term is, of characters (items) and of UTF-8 bytes after lower-casing (documents).
TERM, UPPER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM, _BREAK = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
#: Bytes of a text that are cut into terms at once, rows of a result batch, scores worked out at once.
AT_ONCE, BATCH_ROWS, CELLS = 1 << 20, 1000, 1 << 20
_LAST = -(2 ** 63)                  # stands for a null id: after all others

_COUNTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                        T.StructField("terms", T.ArrayType(T.IntegerType(), False)), T.StructField("tfs", T.ArrayType(T.IntegerType(), False))])


def counted(text: bytes) -> Counter:
    """Occurrences of the terms of a whole text."""
    total: Counter = Counter()
    at = 0
    while at < len(text):
        gap = _BREAK.search(text, at + AT_ONCE) if len(text) - at > AT_ONCE else None
        to = gap.start() if gap else len(text)
        total.update(_TERM.findall(text[at:to].translate(_LOWER)))
        at = to
    return total


def term_counts(docs: DataFrame, doc_id: str, text: str, terms: list[str]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every row: all its terms, and the numbers
    and occurrences of those of ``terms`` that it holds."""
    spark = docs.sparkSession
    ship(spark)
    number = spark.sparkContext.broadcast({t.encode(): i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = number.value
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                total, ends, ids, tfs = [], [0], [], []
                for value in part.column(1).cast(pa.binary()):
                    counts = counted(value.as_py() or b"")
                    total.append(counts.total())
                    known = [(of[t], c) for t, c in counts.items() if t in of]
                    ids += [i for i, _ in known]
                    tfs += [c for _, c in known]
                    ends.append(len(ids))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (ids, tfs)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), *lists], names=_COUNTS.names)

    made = stage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _COUNTS), "counts")
    number.destroy()
    return made


@dataclass(frozen=True)
class Index:
    items: list            # ids
    first: np.ndarray      # term t is in the items at[first[t]:first[t + 1]]
    at: np.ndarray
    weight: np.ndarray     # of each term
    documents: int         # with a term
    occurrences: int       # of all terms


class Heaps:
    """The best documents of each item of an index, ``keep`` at most."""

    def __init__(self, index: Index, keep: int):
        self.index, self.keep = index, keep
        self.best: list[list[tuple[int, int]]] = [[] for _ in index.items]      # (score, minus the id)
        self.least = np.ones(len(index.items), np.int64)                        # score that may still enter

    def take(self, ids: list, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        """Documents with ``sizes`` terms each, one after another in ``terms``."""
        x = self.index
        m = np.array([10 + 90 * k * x.documents // x.occurrences for k in n.tolist()], np.int64)
        row, tf = np.repeat(np.arange(len(ids)), sizes), tfs.astype(np.int64)
        part = x.weight[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
        fan = x.first[terms + 1] - x.first[terms]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        reach = np.concatenate([[0], np.cumsum(fan)])[bounds]
        rows, start = max(1, CELLS // len(x.items)), 0
        while start < len(ids):
            end = max(start + 1, min(start + rows, int(np.searchsorted(reach, reach[start] + CELLS, "right")) - 1))
            of = slice(bounds[start], bounds[end])
            width = fan[of]
            place = np.repeat(x.first[terms[of]] - np.cumsum(width) + width, width) + np.arange(width.sum())
            scores = np.zeros((end - start) * len(x.items), np.int64)
            np.add.at(scores, np.repeat((row[of] - start) * len(x.items), width) + x.at[place], np.repeat(part[of], width))
            self._enter(ids[start:end], scores.reshape(end - start, len(x.items)))
            start = end

    def _enter(self, ids: list, scores: np.ndarray) -> None:
        least = self.least
        if len(ids) > self.keep:
            least = np.maximum(least, np.partition(scores, len(ids) - self.keep, axis=0)[len(ids) - self.keep])
        for i, j in zip(*(a.tolist() for a in np.nonzero(scores >= least))):
            heap, found = self.best[j], (int(scores[i, j]), _LAST if ids[i] is None else -ids[i])
            if len(heap) < self.keep:
                heapq.heappush(heap, found)
            elif found > heap[0]:
                heapq.heapreplace(heap, found)
            if len(heap) == self.keep:
                self.least[j] = max(1, heap[0][0])


def _best(counts: DataFrame, index: Index, offset: int, id_type: T.DataType, p: Params) -> DataFrame:
    """``item, item_id, doc_id, score``: the heaps of each task, as rows."""
    spark = counts.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(index)
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    kind = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(sent.value, p.keep)
        for batch in batches:
            if batch.num_rows:
                terms, tfs = (batch.column(k).flatten().to_numpy() for k in (2, 3))
                heaps.take(batch.column(0).to_pylist(), batch.column(1).to_numpy(),
                           batch.column(2).value_lengths().to_numpy(), terms, tfs)
        for j, heap in enumerate(heaps.best):
            if heap:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([offset + j] * len(heap), pa.int64()), pa.array([heaps.index.items[j]] * len(heap), kind),
                     pa.array([None if k == _LAST else -k for _, k in heap], pa.int64()), pa.array([s for s, _ in heap], pa.int64())],
                    names=schema.names)

    made = stage(counts.mapInArrow(run, schema), "heaps")
    sent.destroy()
    return made


def _block(counts: DataFrame, rows: list, terms: list[str]) -> Index | None:
    """The index of ``rows`` (``item_id, terms``) with the weights of the counted documents."""
    total = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("occurrences")).first()
    if not total.documents:
        return None
    holding = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weight = [math.floor(1000 * math.log((2 * total.documents + 2) / (2 * holding.get(t, 0) + 1))) for t in range(len(terms))]
    number = {t: i for i, t in enumerate(terms)}
    pairs = np.array([(number[t], j) for j, r in enumerate(rows) for t in r.terms], np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    first = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    return Index([r.item_id for r in rows], first, pairs[:, 1].copy(), np.array(weight, np.int64), total.documents, total.occurrences)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", params: Params = PRODUCTION) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``keep`` best rows of ``docs`` for each item.

    Every row of ``docs`` is a document of its own, also where rows share an id
    (an integer); equal scores go by ascending id, null ids last.  A null or
    empty text has no terms: such a document is not counted, such an item has no
    rows, and neither has an item whose terms no document holds.  Repeated rows
    of ``items`` count once; items that share an id but not the text are ranked
    apart.  Other columns of either table play no part, whatever their names.
    """
    spark = docs.sparkSession
    terms = F.array_distinct(F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()), F.lit(TERM), F.lit(0)))
    known = stage(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
                  .select("item_id", terms.alias("terms"), F.xxhash64("item_id", "text").alias("deal")).where(F.size("terms") > 0), "items")
    blocks = max(1, math.ceil((known.agg(F.sum(F.size("terms"))).first()[0] or 0) / params.postings))
    id_type, offset, found = known.schema["item_id"].dataType, 0, []
    for b in range(blocks):
        rows = known.where(F.pmod("deal", F.lit(blocks)) == b).select("item_id", "terms").collect()
        terms = sorted({t for r in rows for t in r.terms})
        counts = term_counts(docs, doc_id, text, terms)
        index = _block(counts, rows, terms)
        if rows and index:
            found.append(_best(counts, index, offset, id_type, params))
            offset += len(rows)
    if not found:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()),
                                                       T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.keep)
            .select("item_id", "rank", "doc_id", "score"))
