"""Ranked search equals a brute-force ranking of every document for every item."""

import math
import re
from collections import Counter

import pytest
from llm_cases import DOCS, edge_docs, edge_rows, no_docs, prose, scratch  # noqa: F401

from assay.llm import search
from assay.llm.queries import op11

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def terms(text):
    return TERMS.findall((text or "").translate(LOWER))


def brute_force(docs, items, keep=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    documents, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    w = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
    rows = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * documents // total
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        rows += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:keep], 1)]
    return sorted(rows, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(i % 23, 20 + i % 60, 300) + " ÀÉ É中 a1-B2" * (i % 3)) for i in range(400)]
    rows += [(500 + i, prose(3, 40, 300)) for i in range(40)]                    # equal scores
    return rows, spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS).repartition(7)


def some_items():
    return [(1, prose(3, 30, 300)), (2, "É中 b2 A1, a1"), (3, None), (4, " .,- "), (5, "nowhereatall"), (6, prose(5, 200, 300)), (None, prose(9, 20, 300))]


@pytest.mark.parametrize("postings", [search.PRODUCTION.postings, 60])
def test_same_as_ranking_all(spark, corpus, postings):
    rows, docs = corpus
    got = found(search.search(docs, items_of(spark, some_items()), params=search.Params(postings=postings)))
    assert got == brute_force(rows, some_items())
    assert {r[0] for r in got} == {1, 2, 6, None}


def test_long_texts_and_small_blocks(spark, corpus, monkeypatch):
    rows, _ = corpus
    monkeypatch.setattr(search, "CELLS", 8)
    monkeypatch.setattr(search, "AT_ONCE", 16)
    index = None
    text = rows[7][1]
    assert search.counted(text.encode()) == Counter(t.encode() for t in terms(text))
    # The heaps alone, in the smallest steps.
    import numpy as np

    words = sorted({t for _, x in some_items() for t in terms(x)})
    counts = [(i, Counter(terms(t))) for i, t in rows]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    pairs = sorted((words.index(t), j) for j, (_, x) in enumerate(some_items()) for t in set(terms(x)))
    index = search.Index([i for i, _ in some_items()], np.searchsorted([a for a, _ in pairs], np.arange(len(words) + 1)), np.array([b for _, b in pairs]),
                         np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in words]), n, total)
    heaps = search.Heaps(index, 10)
    for k in range(0, len(counts), 50):
        part = counts[k:k + 50]
        known = [[(words.index(t), f) for t, f in c.items() if t in df and t in words] for _, c in part]
        flat = np.array([x for row in known for x in row]).reshape(-1, 2)
        heaps.take([i for i, _ in part], np.array([sum(c.values()) for _, c in part]), np.array([len(x) for x in known]), flat[:, 0], flat[:, 1])
    want = brute_force(rows, some_items())
    assert sorted([(item, r, -k, s) for item, heap in zip(index.items, heaps.best) for r, (s, k) in enumerate(sorted(heap, reverse=True), 1)], key=repr) == want


def test_edges(spark, edge_docs, edge_rows, no_docs):
    items = [(1, "One"), (1, "one"), (1, "one"), (2, edge_rows[0][1]), (3, None), (4, "")]
    wide = items_of(spark, items).selectExpr("*", "text as rank", "text as doc_id", "1 as score", "2 as item", "'x' as n")
    got = found(search.search(edge_docs.withColumnRenamed("lang", "terms").withColumnRenamed("source", "score"), wide))
    want = brute_force([(r[0], r[1]) for r in edge_rows], [(1, "One"), (1, "one"), (2, edge_rows[0][1])])
    assert got == want
    assert found(search.search(no_docs, items_of(spark, items))) == []
    assert found(search.search(edge_docs, items_of(spark, []))) == []
    assert op11(no_docs, items_of(spark, items)).columns == ["item_id", "rank", "doc_id", "score"]
