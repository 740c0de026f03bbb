import re
from collections import Counter

import zstandard
from llm_cases import edge_docs, edge_rows, no_docs, prose, sample, scratch  # noqa: F401

from assay.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def counts(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_counts_match_brute_force(spark, sample):
    want = {r.doc_id: brute(r.text) for r in sample.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in quality.quality(sample).collect()}
    assert {i: counts(r) for i, r in got.items()} == want
    assert all(not r.kept for r in got.values() if r.base_failed)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = quality.quality(edge_docs.withColumnRenamed("n_chars", "kept")).collect()
    assert got[0].__fields__[:3] == ["doc_id", "lang", "source"]
    assert sorted(repr((r.doc_id, counts(r))) for r in got) == sorted(repr((r[0], brute(r[1]))) for r in edge_rows)
    assert quality.quality(no_docs).count() == 0 and quality.keep_quality(no_docs).count() == 0
    kept = sorted((r.doc_id or -1) for r in got if r.kept)
    assert sorted((r.doc_id or -1) for r in quality.keep_quality(edge_docs).collect()) == kept


def test_texts_beyond_a_block_and_ties(monkeypatch, spark):
    from assay.llm import textblocks

    monkeypatch.setattr(textblocks, "BLOCK", 100)
    import pyarrow as pa

    texts = [prose(3, 400), "same line\nsame line\n\n \nsame line \nsame line", "", None, "a b c a b c", "y" * 700, "\n\n", prose(4, 30)]
    c, failed, _ = quality._verdicts(pa.array(texts), quality.PRODUCTION)
    assert [(*map(int, row), bool(f)) for row, f in zip(c, failed)] == [brute(t) for t in texts]


def test_compression_bands():
    pack = zstandard.ZstdCompressor(level=3)

    def verdict(text):
        return quality.compression_verdict(text.encode(), quality.PRODUCTION, pack)

    import base64
    import random

    noise = base64.b64encode(random.Random(1).randbytes(30_000)).decode()
    assert all(verdict(prose(s, n)) for s in range(3) for n in (60, 300, 2000, 20_000))
    assert not verdict(noise) and not verdict(noise[:3000])
    assert not verdict("buy now cheap pills " * 60) and not verdict((prose(9, 40) + "\n") * 300)
    assert not verdict(prose(2, 3000) + noise)              # most chunks are noise


def test_chunks_of_typical_lengths(sample):
    import base64
    import random

    pack = zstandard.ZstdCompressor(level=3)
    noise = base64.b64encode(random.Random(1).randbytes(30_000))
    good = [d for d in (r.text.encode() for r in sample.where("text is not null").collect()) if not brute(d.decode())[-1]]
    assert all(quality.compression_verdict(d, quality.PRODUCTION, pack) for d in good)
    whole = b"\n".join(good)
    for size in (2_400, 6_000, 14_001, 16_401, 40_000):
        for share in (0.3, 0.5):
            n = int(size * share)
            for text in (whole[:size - n] + noise[:n], noise[:n] + whole[:size - n]):
                assert not quality.compression_verdict(text, quality.PRODUCTION, pack)
                assert not quality.outside(text, quality.PRODUCTION, pack) or share == 0.5
    assert not quality.compression_verdict(whole[:9_000] + noise[:4_000], quality.PRODUCTION, pack)       # the end counts, too


def brute_bands(docs, labels, fit):
    """The fitted bands, text by text."""
    from dataclasses import replace

    base, pack = quality.PRODUCTION, zstandard.ZstdCompressor(level=quality.PRODUCTION.level)
    rated = {}
    for i, q in labels:
        rated.setdefault(i, []).append(q)
    good = [t.encode() for i, t in docs if i is not None and set(rated.get(i, [0])) == {1} and t is not None and not brute(t)[-1]]
    whole = {}
    lows, highs = [], []
    for d in good:
        k = next(k for k in range(400) if len(d) < fit.upto(k))
        whole.setdefault(k, []).append(len(pack.compress(d)) / len(d))
        n = round(len(d) / base.chunk_bytes)
        if n > 1:
            parts = [d[len(d) * i // n:len(d) * (i + 1) // n] for i in range(n)]
            ratios = [(len(pack.compress(x)) / len(x), len(x)) for x in parts]
            spare = base.max_bad_bytes / 2 * len(d)
            lows.append(min(r for r, _ in ratios if sum(s for q, s in ratios if q <= r) > spare))
            highs.append(max(r for r, _ in ratios if sum(s for q, s in ratios if q >= r) > spare))
    limits = []
    for k in range(max(whole, default=-2) + 2):
        near = [r for j in (k - 1, k, k + 1) for r in whole.get(j, [])]
        limits.append((fit.upto(k), min(near) - fit.margin, max(near) + fit.margin) if len(near) >= fit.least else (fit.upto(k), 0.0, 9.0))
    made = replace(base, fitted=tuple(limits))
    # As in the operator, the texts of all length bands that hold a text of several chunks are counted.
    several = sum(len(v) for k, v in whole.items() if any(round(len(d) / base.chunk_bytes) > 1 for d in good if fit.index(len(d)) == k))
    return replace(made, chunk=(min(lows) - fit.margin, max(highs) + fit.margin)) if several >= fit.least else made


def test_fitted_bands_match_brute_force(spark, sample, edge_docs, edge_rows, no_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows, rated = [(r.doc_id, r.text) for r in sample.collect()], [(r.doc_id, r.quality) for r in labels.collect()]
    for least in (1, 5, 30, 10_000):
        fit = quality.Fit(least=least)
        assert quality.fit_bands(sample, labels, fit=fit) == brute_bands(rows, rated, fit)
    fit = quality.Fit(least=1)
    own = [(1, 1), (2, 1), (2, 0), (6, 1), (6, 1), (None, 1), (3, 1), (4, 1), (7, None), (10, 1), (10, None), (99, 1)]
    given = spark.createDataFrame(own, "doc_id long, quality int")
    assert quality.fit_bands(edge_docs, given, fit=fit) == brute_bands([r[:2] for r in edge_rows], own, fit)
    renamed = given.selectExpr("doc_id as text", "quality as ratio")
    odd = edge_docs.selectExpr("doc_id as text", "text as low", "lang as id", "source as k")
    assert quality.fit_bands(odd, renamed, "text", "low", "ratio", fit=fit) == quality.fit_bands(edge_docs, given, fit=fit)
    assert quality.fit_bands(no_docs, given).fitted == () == quality.fit_bands(edge_docs, given.limit(0)).fitted
    for size in (1, 2, 3, 4, 5, 199, 200, 1023, 1024, 1025, 1 << 20, 12345):
        k = quality.FIT.index(size)
        assert size < quality.FIT.upto(k) and (k == 0 or size >= quality.FIT.upto(k - 1))


def test_bands_are_fitted_to_all_labelled_texts(spark):
    """Few documents beside very many labels: each labelled text counts."""
    rows = [(i, prose(i, 60 + i)) for i in range(120)]
    labels = spark.range(300_000).selectExpr("id doc_id", "1 quality")
    assert quality.fit_bands(spark.createDataFrame(rows, "doc_id long, text string"), labels) == brute_bands(rows, [(i, 1) for i in range(120)], quality.FIT)


def test_fitted_bands_decide(spark):
    """Fitted on half of the labels, judged on the other half."""
    at = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    side = "pmod(crc32(cast(doc_id as string)), 2) = "
    for half in (0, 1):
        bands = quality.fit_bands(docs, labels.where(side + str(half)))
        held = quality.quality(docs.join(labels.where(side + str(1 - half)), "doc_id").select("doc_id", "text", "quality"), bands=bands)
        got = Counter((r.quality, r.kept) for r in held.where("not base_failed").select("quality", "kept").collect())
        assert got[0, False] >= 0.4 * (got[0, False] + got[0, True]) and got[1, False] <= 0.01 * got[1, True], got
    plain = quality.quality(docs.join(labels, "doc_id")).where("not base_failed and quality = 0").groupBy("kept").count().collect()
    assert [r.kept for r in plain] == [True]           # by the bands as given, none goes


def test_fitted_chunks_decide():
    """Texts that hold repeated chunks, their whole ratio within its band."""
    pack = zstandard.ZstdCompressor(level=3)
    text = prose(3, 4000).encode()
    ratio, low, high = quality.measures(text, quality.PRODUCTION, pack)
    whole = dict(limits=((1 << 40, 0.0, 8.0),), rest=(0.0, 8.0))
    assert quality.compression_verdict(text, quality.Bands(**whole, chunk=(low, high)), pack)
    assert not quality.compression_verdict(text, quality.Bands(**whole, chunk=(high, 9.0)), pack)
    assert not quality.compression_verdict(text, quality.Bands(**whole, fitted=((1 << 40, ratio + 0.001, 9.0),)), pack)
    spoilt = text + b"the same words again " * (len(text) // 60)
    assert quality.compression_verdict(spoilt, quality.Bands(**whole), pack)
    assert not quality.compression_verdict(spoilt, quality.Bands(**whole, chunk=(low, high)), pack)
