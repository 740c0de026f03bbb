import hashlib
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import edge_docs, edge_rows, no_docs, sample, scratch  # noqa: F401

from assay.llm import mixing


def water(sizes, weights=mixing.WEIGHTS):
    """Targets by handing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        total = sum(weight[s] for s in rest)
        share = {s: left * weight[s] / total for s in rest}
        over = [s for s in rest if share[s] >= 2 * sizes[s]]
        if not over:
            return goal | share
        for s in over:
            goal[s] = 2.0 * sizes[s]
            left -= goal[s]
            full.add(s)
        if len(full) == len(names):
            return goal


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 50, "d": 7}, {"x": 5}, {"b": 3, None: 300, "a": 0, "é": 80, "Z": 10}, {"a": 0}):
        rows = spark.createDataFrame([("=" + s if s else "", s, n) for s, n in sizes.items()], "queue string, source string, size long")
        got = {r.queue: r.target for r in mixing.targets(rows).collect()}
        assert got == {"=" + s if s else "": pytest.approx(t) for s, t in water(sizes).items()}


def sources_of(rows):
    sizes, doc = defaultdict(int), {}
    for i, t, _, s, _ in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    return dict(sizes)


def test_edges(edge_docs, edge_rows, no_docs):
    got = mixing.mix_plan(edge_docs.withColumnRenamed("lang", "queue").withColumnRenamed("n_chars", "size")).collect()
    sizes = sources_of(edge_rows)
    goal = water(sizes)
    assert len(got) == len(edge_rows)
    assert Counter(r.size for r in got) == Counter(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in edge_rows)
    assert {r.source_size: r.target for r in got} == {sizes[s]: pytest.approx(t) for s, t in goal.items()}
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    assert mixing.mix_plan(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_taken_comes_near_the_targets(sample):
    got = mixing.mix_plan(sample).collect()
    assert sorted(got) == sorted(mixing.mix_plan(sample.repartition(5)).collect())
    source = {r.doc_id: r.source for r in sample.collect()}
    taken, target, most = Counter(), {}, Counter()
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        most[s] = max(most[s], r.size)
    assert sum(taken.values()) <= sum(target.values())
    assert all(abs(taken[s] - target[s]) <= 2 * most[s] for s in target)


def test_taken_is_the_fair_queue(sample):
    """Brute force: all documents in one order of finish times."""
    rows = sample.select("doc_id", "source", "text").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    total = Counter()
    for r in rows:
        total[r.source] += size[r.doc_id]
    goal = water(dict(total))
    line = []
    for s in goal:
        mine = sorted((hashlib.md5(f"{s}:{r.doc_id}".encode()).hexdigest(), r.doc_id) for r in rows if r.source == s)
        cum = 0
        for nth in range(2):
            for key, i in mine:
                cum += size[i]
                line.append((cum / goal[s], "=" + s, nth, key, i))
    taken, spent = Counter(), 0
    for finish, _, _, _, i in sorted(line):
        spent += size[i]
        if spent > sum(goal.values()) or finish > 2:
            break
        taken[i] += size[i]
    assert {r.doc_id: r.taken for r in mixing.mix_plan(sample).collect()} == {i: taken[i] for i in size}


def test_mixed_rows(sample):
    times = {r.doc_id: r.times for r in mixing.mix_plan(sample).collect()}
    made = mixing.mixed(sample)
    assert made.columns == sample.columns
    assert Counter(r.doc_id for r in made.select("doc_id").collect()) == Counter({i: n for i, n in times.items() if n})


def test_more_sources_than_are_broadcast(spark, sample, monkeypatch):
    want = sorted(mixing.mix_plan(sample).collect())
    monkeypatch.setattr(mixing, "SOURCES", 0)
    assert sorted(mixing.mix_plan(sample).collect()) == want
    assert mixing.mixed(sample).count() == sum(r.times for r in want)
