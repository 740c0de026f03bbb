"""Variants equal a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import DOCS, edge_docs, edge_rows, no_docs, prose, sample, scratch  # noqa: F401

from assay.llm import spelling
from assay.llm.queries import op12

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_force(rows):
    words = brute_words(rows)
    by = {w: [o for o in words if abs(len(o) - len(w)) <= 1 and near(w, o)] for w in words}
    form = {}
    for w, others in by.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= 2 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted([(w, form.get(w), root(w), n, len(by[w]), words.get(form.get(w))) for w, n in words.items()], key=repr)


def found(frame):
    return sorted(map(tuple, frame.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.fixture(scope="module")
def typos():
    r = random.Random(4)
    pool = ["".join(r.choice("abé") for _ in range(r.randint(5, 8))) for _ in range(400)] + ["Überzahl", "ÜBERzahl", "überzahl", "aaaaaa", "aaaaa", "x" * 70, "x" * 69, "y" + "x" * 69]
    weight = [r.paretovariate(0.9) for _ in pool]
    return [(i, "".join(w + r.choice(" .,1-\n") for w in r.choices(pool, weight, k=100))) for i in range(200)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)


def test_same_as_all_pairs(spark, typos):
    got = found(op12(frame(spark, typos)))
    assert got == brute_force(typos)
    assert sum(g[1] is not None for g in got) > 20 and any(g[1] != g[2] and g[1] for g in got)


def test_slices_and_small_steps(spark, typos, monkeypatch):
    """A vocabulary beyond one broadcast."""
    few = spelling.Params(filter_bytes=60)
    assert found(spelling.variants(frame(spark, typos), params=few)) == brute_force(typos)


def test_whole_table(sample):
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    assert found(op12(sample)) == brute_force(rows)


def test_long_texts_in_steps(monkeypatch):
    monkeypatch.setattr(spelling, "AT_ONCE", 10)
    monkeypatch.setattr(spelling, "PROBES", 100)
    assert spelling.runs("One two, ONE é two three " * 9) == Counter({"one": 18, "two": 18, "é": 9, "three": 9})
    for part, points in spelling.matrices(["abcde", "abcdef", "bbcde"]):
        assert points.shape == (len(part), points.shape[1])
        for key, row, place, to in spelling.edits(points):
            for k, i, j, c in zip(key.tolist(), row.tolist(), place.tolist(), to.tolist()):
                w = "".join(map(chr, points[i].tolist()))
                w = w[:j] + (chr(c) if c else "") + w[j + 1:]
                (_, other), = spelling.matrices([w])
                assert spelling.key_of(spelling.hash_sums(other)[:, -1], len(w)).tolist() == [k]


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = [(r[0], r[1]) for r in edge_rows] + [(20 + i, "x" * 50_000) for i in range(4)] + [(30 + i, "x" * 49_999 + " " + "x" * 49_999 + "y") for i in range(4)]
    docs = frame(spark, rows).withColumnRenamed("lang", "word").withColumnRenamed("source", "n")
    assert found(op12(docs)) == brute_force(rows)
    assert found(op12(no_docs)) == []
