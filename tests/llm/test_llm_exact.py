import hashlib
import re

from pyspark.sql import functions as F
from llm_cases import edge_docs, edge_rows, no_docs, prose, scratch  # noqa: F401

from assay.llm import exact


def brute(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out, seen = [], set()
    for i, n in norm:
        ids = [j for j, m in norm if m == n]
        keep = min((j for j in ids if j is not None), default=None)
        kept = i == keep and (i, n) not in seen
        seen.add((i, n))
        out.append((i, keep, len(ids), kept, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(map(repr, out))


def test_edges(edge_docs, edge_rows, no_docs):
    clash = edge_docs.withColumnRenamed("lang", "recipe").withColumnRenamed("source", "kept")
    assert sorted(repr(tuple(r)) for r in exact.exact_dedup(clash).collect()) == brute([r[:2] for r in edge_rows])
    assert exact.exact_dedup(no_docs).count() == 0 and exact.drop_exact(no_docs).count() == 0


def test_filter_keeps_one_row_of_each_text(edge_docs, edge_rows):
    clash = edge_docs.withColumnsRenamed({"lang": "_id", "source": "copies", "n_chars": "row"})
    assert sorted(map(repr, exact.drop_exact(clash).select("doc_id", "text").collect())) == sorted(map(repr, exact.drop_exact(edge_docs).select("doc_id", "text").collect()))
    kept = exact.drop_exact(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in edge_rows})


def test_chunks_are_the_text_and_shared(spark):
    passage, texts = prose(8, 2000), ["", " ", "x" * 10_000, "中" * 9000]
    passage = " ".join(w + "les" if i % 17 == 0 else w for i, w in enumerate(passage.split(" ")))
    texts += [prose(1, 700) + " " + passage, "Other start. " + passage + prose(2, 50)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", exact.chunks(F.col("t")).alias("c")).collect()
    by = {r.i: r.c for r in rows}
    assert all("".join(r.c) == r.t for r in rows)
    assert all(len(c) <= exact.MAX_CHARS for r in rows for c in r.c)
    assert len(set(by[4]) & set(by[5])) >= 3


def test_ambiguous_hashes_get_their_digests(spark, edge_docs, edge_rows, monkeypatch):
    # A short hash of one bit: every identifier is ambiguous.
    real = F.xxhash64
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(2)))
    assert sorted(repr(tuple(r)) for r in exact.exact_dedup(edge_docs).collect()) == brute([r[:2] for r in edge_rows])


def test_recipes_decide(spark, monkeypatch):
    """Without the rest of its chunks a text counts as equal to another: groups come from recipes alone."""
    a, b = prose(1, 900), prose(2, 900)
    docs = spark.createDataFrame([(1, a), (2, a + " more"), (3, b), (4, a)], "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in exact.exact_dedup(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}
    real = exact.chunks
    monkeypatch.setattr(exact, "chunks", lambda norm: F.slice(real(norm), 1, 1))
    assert {r.doc_id: r.keep_id for r in exact.exact_dedup(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 1}
