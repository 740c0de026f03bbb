import re

import corpus_pipeline as cp
import public_tokenizers as P
import pytest
from test_llm_neardup import brute as near
from test_llm_quality import brute as counts
from test_llm_quality import brute_bands
from llm_cases import edge_docs, edge_rows, no_docs, sample, scratch  # noqa: F401

from assay.llm import bpe, mixing, quality
from assay.llm.staging import stage
from assay.llm.queries import BPE_RANKS

SF = "/root/testdata/sf0.001"


def test_order_and_names():
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "tokenise"]
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is cp.run and "pipeline" not in entry.oracle_sql()


@pytest.fixture(scope="module")
def stages(spark, sample):
    out, docs = [], sample
    for _, step in cp.STAGES:
        made = step(spark, docs, SF)
        out.append((docs, made))
        docs = stage(made, "test")
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_each_stage_against_brute_force(spark, stages, sample):
    import zstandard

    pack = zstandard.ZstdCompressor(level=quality.PRODUCTION.level)
    rated = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    bands = brute_bands([(r.doc_id, r.text) for r in sample.collect()], rated, quality.FIT)
    for before, after in stages[:-1]:
        assert after.columns == sample.columns
    rows = [tuple(r) for r in sample.collect()]
    kept = [r for r in rows if not counts(r[1])[-1] and quality.compression_verdict(r[1].encode(), bands, pack)]
    assert ids(stages[0][1]) == sorted(r[0] for r in kept)
    norm = {}
    for r in sorted(kept):
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1]), r)
    kept = list(norm.values())
    assert ids(stages[1][1]) == sorted(r[0] for r in kept)
    stay = {int(x.split(",")[0][1:]) for x in near(kept) if x.endswith("True)")}
    assert ids(stages[2][1]) == sorted(stay)
    times = {r.doc_id: r.times for r in mixing.mix_plan(stages[2][1]).collect()}
    assert ids(stages[3][1]) == sorted(i for i, n in times.items() for _ in range(n))
    text = {r[0]: r[1] for r in rows}
    own = bpe.encoder(P.path(BPE_RANKS), P.PATTERN)
    assert sorted((r.doc_id, list(r.ids)) for r in stages[4][1].collect()) == sorted((i, own.encode(text[i]).tolist()) for i, n in times.items() for _ in range(n))


def test_stages_take_edge_rows(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, step in cp.STAGES:
            got = step(spark, docs, SF)
            assert got.count() <= 2 * docs.count()
            if name != "tokenise":
                assert got.columns == docs.columns


def test_run(spark):
    got = cp.run(spark, SF)
    assert got.columns == ["doc_id", "lang", "source", "ids", "text"] and got.count() > 50


def test_last_stage_decodes_and_checks(spark, sample, monkeypatch):
    got = cp.tokenise(spark, sample, SF)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted((r.doc_id, r.text or "") for r in sample.collect())
    real = bpe.encode
    monkeypatch.setattr(cp.bpe, "encode", lambda docs, *a, **k: real(docs, *a, **k).withColumn("decoded", cp.F.lit(b"other")))
    with pytest.raises(Exception, match="do not give the text back"):
        cp.tokenise(spark, sample, SF).collect()


def test_a_worker_holds_the_tables_of_one_operator(spark):
    from assay.llm import langid, pieces, staging

    own = bpe.encoder(P.path(BPE_RANKS), P.PATTERN)
    own.encode("some words")
    pieces.model(P.path("piece_bpe_32k.model"))
    langid._known["x"] = None
    staging.hold("bpe")
    assert bpe._encoders and not pieces._models and not langid._known
    staging.hold()
    assert not bpe._encoders


def test_forgotten_tables_are_freed():
    """Encoders refer to themselves and are frozen for the garbage collector: a worker kept one for each stage that used it."""
    import weakref

    from assay.llm import pieces, staging

    for make in (lambda: bpe.encoder(P.path(BPE_RANKS), P.PATTERN), lambda: pieces.model(P.path("piece_bpe_32k.model"))):
        staging.hold()
        known = weakref.ref(make())
        assert known() is not None
        staging.hold()
        assert known() is None
