import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from llm_cases import DOCS, edge_docs, edge_rows, no_docs, prose, sample, scratch  # noqa: F401

from assay.llm import neardup
from assay.llm.components import components


def brute(rows):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by[x].append(k)
    pairs = {(a, b) for ks in by.values() for i, a in enumerate(ks) for b in ks[i + 1:]}
    for a, b in pairs:
        x, y = rows[a][0], rows[b][0]
        both = len(sets[a] & sets[b])
        if x is not None and y is not None and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
    return sorted(repr((r[0], len(s), None if r[0] is None else find(r[0]), r[0] is None or find(r[0]) == r[0])) for r, s in zip(rows, sets))


def found(docs, **kw):
    return sorted(repr(tuple(r)) for r in neardup.near_dedup(docs, **kw).collect())


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else f"w{r.randrange(10**9)}" for w in text.split(" "))


def test_edges(edge_docs, edge_rows, no_docs):
    assert found(edge_docs.withColumnRenamed("lang", "node").withColumnRenamed("source", "path")) == brute(edge_rows)
    assert neardup.near_dedup(no_docs).count() == 0
    kept = neardup.drop_near(edge_docs)
    assert kept.columns == edge_docs.columns
    gone = {int(x.split(",")[0][1:]) for x in brute(edge_rows) if x.endswith("False)")}
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r[0]) for r in edge_rows if r[0] not in gone)


def test_whole_table(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    assert found(sample) == brute(rows)


def test_groups_larger_than_a_leaf(spark):
    """Copies around a hub, tight copies, and unrelated texts with a passage in common, in leaves of 4."""
    base, tight, passage = prose(1, 300), prose(2, 300), prose(3, 80)
    texts = [base] + [edited(base, 0.02, i) for i in range(40)] + [edited(tight, 0.004, 100 + i) for i in range(40)]
    texts += [prose(50 + i, 150) + " " + passage for i in range(40)] + [prose(200 + i, 200) for i in range(40)] + [base] * 5
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    assert found(docs, params=neardup.Params(leaf=4, whole=2, deepest=6)) == brute(rows)
    assert found(docs, params=neardup.Params(load=3000)) == brute(rows)


def test_hub_of_edited_copies(spark):
    """Copies that are near the base text only, none of them near another: first-level nodes are large and mixed."""
    base = [f"b{i}" for i in range(300)]
    texts = [" ".join(base)]
    for i in range(2500):
        r, words = random.Random(i), list(base)
        for k in r.sample(range(5, 295, 6), 8):         # one edit spoils 5 of 296 shingles: 256 / 336 are shared
            words[k] = f"w{i}x{k}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    assert {r.component_id for r in neardup.near_dedup(docs).collect()} == {0}


def test_components(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(60)] + [(300, i) for i in range(301, 340)] + [(500, 500)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == {x: find(x) for x in list(root) if x in {y for p in links if p[0] != p[1] for y in p}}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_signature_estimates_similarity():
    import numpy as np

    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 9000, dtype=np.uint64))
    x, y = neardup.signature(a[:8000], 1024), neardup.signature(a[1000:], 1024)
    assert (x == y).mean() == pytest.approx(7 / 9, abs=0.05)


def test_blocks_let_two_components_meet(spark):
    root = {i: 0 if i < 40 else 1 if i < 49 else i for i in range(53)}
    rows = spark.createDataFrame([(7, i.to_bytes(2), r.to_bytes(2), 5) for i, r in root.items()], "path long, node binary, root binary, n long")
    groups = defaultdict(set)
    for r in neardup._blocks(rows, neardup.Params(leaf=8)).collect():
        groups[r.path].add(int.from_bytes(r.node))
    met = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    assert {(a, b) for a in root for b in root if a < b and root[a] != root[b]} <= met
    assert sum(map(len, groups.values())) < 53 * 7          # fewer rows than all blocks against all


def test_groups_of_full_sets():
    """What the links of a leaf connect, by component, in no more rows than there are components."""
    import numpy as np

    r = random.Random(3)
    base = list(range(40))
    sets = [np.array(sorted(set(base) - set(r.sample(base, k % 9)) | {1000 * k + j for j in range(k % 4)}), np.uint64) for k in range(60)]
    root = np.array([k if k < 50 else 50 for k in range(60)])
    groups, most = neardup.joined(sets, root, 75)
    alike = lambda a, b: 100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b))
    pairs = [(a, b) for a in range(60) for b in range(60) if root[a] != root[b] and alike(sets[a], sets[b])]
    of = list(range(51))
    for a, b in pairs:
        x, y = of[root[a]], of[root[b]]
        of = [x if z == y else z for z in of]
    want = [[i for i in range(51) if of[i] == x] for x in set(of)]
    assert sorted(map(sorted, groups)) == sorted(g for g in want if len(g) > 1)
    assert most.tolist() == [max(sum(1 for a, b in pairs if a == k) for k in range(60) if root[k] == x) for x in range(51)]
    both = neardup.common(sets)
    assert all(both[a, b] == len(set(sets[a]) & set(sets[b])) for a in range(60) for b in range(60) if a != b)


def test_wanted_ids_are_never_left_out(spark):
    ids = spark.range(0, 5000, 7).select(F.col("id"), F.lit(1).alias("x"))
    docs = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    got = neardup.texts_of(ids, docs, "k", "t")
    assert sorted((r.id, r.text) for r in got.collect()) == [(i, f"t{i}") for i in range(0, 5000, 7)]


def test_rows_that_share_an_id(spark):
    """Of two rows with one id only the near copy goes."""
    text = prose(7, 200)
    rows = [(1, text), (2, edited(text, 0.01, 1)), (2, prose(8, 200)), (2, None), (None, text)]
    docs = spark.createDataFrame([(*x, None, None, None) for x in rows], DOCS)
    assert sorted(map(repr, [(r.doc_id, r.text) for r in neardup.drop_near(docs).collect()])) == sorted(map(repr, [rows[0], *rows[2:]]))


def test_family_below_the_threshold_makes_few_rows(spark):
    """Texts pairwise about 0.62 alike: compared in full, no link, and no table of pairs."""
    base = [f"b{i}" for i in range(300)]
    texts = []
    for i in range(600):
        r, words = random.Random(i), list(base)
        for k in r.sample(range(5, 295, 6), 8):
            words[k] = f"w{i}x{k}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    p = neardup.PRODUCTION
    assert neardup.near_dedup(docs).where("not kept").count() == 0
    classes = neardup.sketches(docs, "doc_id", "text", p).selectExpr("node", "doc_id as id", "n_shingles as n", "sketch", "paths")
    rows = classes.selectExpr("explode(paths) as path", "node", "node as root")
    assert neardup.look_alikes(rows, classes, p).count() <= rows.count()


def test_the_filter_of_wanted_ids_takes_few_jobs(spark):
    """However many partitions the shuffle has, and its words all reach the filter."""
    ids = spark.range(0, 4000, 3).select("id")
    docs = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("t"))
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("filter of wanted ids", "")
        got = neardup.texts_of(ids, docs, "k", "t")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("filter of wanted ids")
        assert 0 < len(jobs) <= 8 and got.count() == 1334
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in was.items():
            spark.conf.set(k, v)
