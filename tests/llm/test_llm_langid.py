import math
import zlib

import numpy as np
import public_tokenizers as P
from llm_cases import edge_docs, edge_rows, no_docs, sample, scratch  # noqa: F401

from assay.llm import langid
from assay.llm import textblocks as tb
from assay.llm.queries import BPE_RANKS

PATH = P.path(BPE_RANKS)


def test_forward_sums_all_segmentations():
    vocabulary = langid.Vocabulary.read(PATH, 6)
    rng = np.random.default_rng(1)
    probability = rng.random((len(vocabulary) + 1, 2)) ** 4 / 1000
    probability[-1] = 0

    def brute(word, k):
        sums = [1.0] + [0.0] * len(word)
        for j in range(1, len(word) + 1):
            for i in range(max(0, j - 6), j):
                b = np.frombuffer(word[i:j], np.uint8)
                piece = vocabulary.find(tb.span_hash(tb.prefix_hash(b), np.array([0]), np.array([len(b)])))[0]
                sums[j] += sums[i] * probability[piece, k]
        return math.log(sums[-1])

    words = [b" the", b" a", " größe".encode(), b" information", " 中文".encode(), b" " + b"internationalisation" * 3]
    begin = np.cumsum([0, *map(len, words)])
    got = langid.forward(np.frombuffer(b"".join(words), np.uint8), begin, vocabulary, probability)
    assert np.allclose(got, [[brute(w, 0), brute(w, 1)] for w in words])
    # Every segmentation covers the word: expected pieces add up to its bytes.
    sizes = {}
    counts = langid.expected(np.frombuffer(b"".join(words), np.uint8), begin, np.ones(len(words)), vocabulary, probability[:, 0])
    for w in words:
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + 6) + 1):
                b = np.frombuffer(w[i:j], np.uint8)
                sizes[int(vocabulary.find(tb.span_hash(tb.prefix_hash(b), np.array([0]), np.array([j - i])))[0])] = j - i
    assert np.isclose(sum(counts[k] * n for k, n in sizes.items() if k < len(vocabulary)), sum(map(len, words)))


def test_long_words_do_not_underflow():
    vocabulary = langid.Vocabulary.read(PATH, 12)
    probability = np.full((len(vocabulary) + 1, 1), 1e-7)
    probability[-1] = 0
    word = np.frombuffer(b" " + bytes(range(128, 256)) * 40, np.uint8)
    assert np.isfinite(langid.forward(word, np.array([0, len(word)]), vocabulary, probability)).all()


def test_held_out_accuracy(sample):
    truth = {r.doc_id: r.lang for r in sample.collect()}
    got = langid.identify(sample, PATH).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    out = [r for r in got if r.held_out]
    assert len(out) > 40 and sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(edge_docs, edge_rows, no_docs):
    got = langid.identify(edge_docs.withColumnRenamed("n_chars", "score"), PATH).collect()
    assert len(got) == len(edge_rows)
    assert {r.lang_pred for r in got} <= {"en", "fr", "de", "und"}
    want = sorted(repr(r[0]) for r in edge_rows if r[1] is None or not any(c.isalpha() for c in r[1]))
    assert sorted(repr(r.doc_id) for r in got if r.lang_pred == "und") == want
    assert all(r.held_out is False for r in got if r.doc_id is None)
    assert langid.identify(no_docs, PATH).count() == 0
    assert {(r.lang_pred, r.score) for r in langid.identify(edge_docs.selectExpr("doc_id", "text", "cast(null as string) lang"), PATH).collect()} == {("und", 0.0)}


def test_predictions_do_not_see_the_label(sample):
    """Labels of held-out rows make no difference."""
    changed = sample.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 'zz' else lang end lang")
    a, b = (sorted((r.doc_id, r.lang_pred) for r in langid.identify(d, PATH).collect()) for d in (sample, changed))
    assert a == b


def test_scripts_without_spaces_are_learnt(spark):
    import random

    import public_tokenizers as P
    from assay.llm.queries import BPE_RANKS

    r = random.Random(2)
    pools = {"zh": "的一是不了人我在有他这中大来上国", "ja": "のにはをたがでてとしれさあいうえ", "en": "abcdefghijklmnop"}
    rows = [(i, "".join(r.choice(pools[lang]) for _ in range(300)), lang) for i in range(60) for lang in pools]
    docs = spark.createDataFrame([(k, t, lang) for k, (_, t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.identify(docs, P.path(BPE_RANKS)).collect()}
    assert all(got[k].lang_pred == lang for k, (_, _, lang) in enumerate(rows))
