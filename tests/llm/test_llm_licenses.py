import re
from llm_cases import DOCS, edge_docs, edge_rows, no_docs, prose, sample, scratch  # noqa: F401

from assay.llm import licenses


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = words_of(text)
    places = [(i, label) for phrase, label in licenses.PHRASES for p in [phrase.split()] for i in range(len(w)) if w[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


def got_base(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels


def test_base_matches_brute_force(spark, sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    extra = {10_001: "MIT License. The mit-license; MITLICENSE mit  license", 10_002: "GNU General Public LICENSE, general public\nlicense general public",
             10_003: "license", 10_004: "mit mit license license apache_license apache license", 10_005: "(the) général public license"}
    rows = [(i, t, None, None, None) for i, t in (texts | extra).items()]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert {i: got_base(r) for i, r in got.items()} == {i: base(t) for i, t, *_ in rows}
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got.values())
    assert got[10_004].labels == "apache,mit" and got[10_004].score == 1.0


def test_passages_by_neighbouring_diagonals(spark):
    passage = licenses.PASSAGES[0][0].split()
    cut = passage[:8] + ["indeed"] + passage[8:15] + passage[16:]
    rows = {1: prose(1, 500) + " " + " ".join(cut).upper() + " " + prose(2, 300), 2: " ".join(passage[:9]),
            3: " ".join(x for w in passage for x in (w, "um", "er", "hm", "oh", "ah")), 4: prose(3, 400), 5: " ".join(passage) + ". " + " ".join(passage)}
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(i, t, None, None, None) for i, t in rows.items()], DOCS)).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["mit", "", "", "", "mit"]
    assert got[1].n_base == 0 and 0.6 <= got[1].score < 1 and got[5].score == 1.0
    assert (got[1].spans[0].start, got[1].spans[0].end) == (500, 500 + len(cut)) and len(got[5].spans) == 2


def test_edges(edge_docs, edge_rows, no_docs):
    got = licenses.scan(edge_docs.withColumnRenamed("lang", "label").withColumnRenamed("source", "digest")).collect()
    assert sorted(repr((r.doc_id, got_base(r))) for r in got) == sorted(repr((r[0], base(r[1]))) for r in edge_rows)
    assert licenses.scan(no_docs).count() == 0


def test_repeated_rows_do_not_add_up(spark):
    rows = [(None, "mit license", None, None, None)] * 3 + [(1, "mit license", None, None, None)] * 2
    got = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r.n_base, r.first_word, r.labels) for r in got] == [(1, 0, "mit")] * 5


def scanned(spark, rows, **kw):
    return {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(i, t, None, None, None) for i, t in rows.items()], DOCS), **kw).collect()}


def test_bands_that_chain_stray_votes_are_taken_apart(spark):
    passage = licenses.PASSAGES[0][0]
    rows = {1: "permission is " * 60 + passage, 2: passage + " permission is" * 60, 3: "permission is " * 200,
            4: "permission is " * 40 + passage + " permission is" * 40 + " " + passage, 5: passage}
    got = scanned(spark, rows)
    assert [got[i].labels for i in range(1, 6)] == ["mit", "mit", "", "mit", "mit"] and all(got[i].score == 1.0 for i in (1, 2, 4, 5))
    assert len([s for s in got[4].spans if s.share == 1.0]) == 2 and all(s.end - s.start <= 1.5 * len(passage.split()) for i in got for s in got[i].spans or [] if s.share == 1.0)


def test_whole_texts_and_own_templates(spark):
    whole = {i: (label, t) for i, (t, label) in enumerate(licenses.TEXTS)}
    cut = {i + 10: " ".join(t.split()[20:]) for i, (_, t) in whole.items()}            # their opening words are missing
    got = scanned(spark, {i: t.upper() for i, (_, t) in whole.items()} | cut)
    assert all(label in got[i].labels.split(",") and label in got[i + 10].labels.split(",") and got[i].score == 1.0 for i, (label, _) in whole.items())
    own = prose(77, 5000)
    table = spark.createDataFrame([("it's ours", own), ("o'one", "word"), ("it's ours", own), ("none", None)], "label string, text string")
    got = scanned(spark, {1: prose(1, 50) + " " + own, 2: own[:200], 3: "word"}, templates=table)
    assert [got[i].labels for i in (1, 2, 3)] == ["it's ours", "", ""]


def test_labels_by_brute_force(spark, sample):
    """A template of which enough 2-grams stand in one place gives its label, one of which too few stand anywhere does not."""
    rows = {r.doc_id: r.text for r in sample.collect()}
    templates = [(t.split(), label) for t, label in licenses.PASSAGES + licenses.TEXTS]
    for i, (t, _) in enumerate(templates):
        rows[20_000 + i] = " ".join([prose(i, 40), *t[: int(len(t) * 0.8)], prose(i + 50, 40)])
        rows[21_000 + i] = " ".join([prose(i, 40), *t[: int(len(t) * 0.3)], prose(i + 50, 40)])
    got = scanned(spark, rows)
    for k, text in rows.items():
        w = words_of(text)
        grams = set(zip(w, w[1:]))
        most = {label: max(sum(g in grams for g in zip(t, t[1:])) / (len(t) - 1) for t, name in templates if name == label) for _, label in templates}
        labels = set(filter(None, got[k].labels.split(","))) - set(filter(None, got[k].base_labels.split(",")))
        assert labels <= {label for label, share in most.items() if share >= licenses.PRODUCTION.covered}
        if 20_000 <= k < 21_000:
            assert templates[k - 20_000][1] in labels | set(got[k].base_labels.split(","))
