import hashlib
import re
import sys
from llm_cases import DOCS, edge_docs, edge_rows, no_docs, prose, sample, scratch  # noqa: F401

from assay.llm import pii
from assay.llm.queries import op5

sys.set_int_max_str_digits(0)       # for int() of the brute force

#: The base patterns as given.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(number):
    digits = [int(c) for c in number][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def brute(text):
    text = text or ""
    out = []
    for k, pattern in enumerate((EMAIL, IP, CARD, PHONE)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (True, all(int(x) <= 255 for x in m.group().split(".")) if k == 1 else True,
                    14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[k]
            if good:
                out.append((m.start(), k, m.end()))
    out.sort()
    said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in out)
    return [sum(x[1] == k for x in out) for k in range(4)] + [hashlib.sha256(said.encode()).hexdigest()], said


TRICKY = ["a@b@c.de x@y.z.", "@a.b a@.b a@b. a@b.c.@d.ee", "..@a.b-c%+x@1.2", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.0003.4 1.1.1.1.1", "4111 1111 1111 1111 4111111111111111",
          "4111-1111 1111-1112", "49927398716 0 0 0", "+1 (555) 123-4567 +1-2", "+12 345 678 901 234 567", "+49.30.123456-7 ++4930123456789", "é4😀 +4930 1234 5678 a@ü.de ü@b.de",
          "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "9" * 3000, "1." * 2000, "a" * 3000 + "@" * 50, "x@" + "a." * 300 + "b", "0" * 5000 + ".1.1.1"]


def test_base_spans_match_the_patterns(sample):
    for text in TRICKY + [r.text for r in sample.select("text").collect()]:
        assert pii.base_spans(text) == [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in brute(text)[1].split(",") if x)], text[:80]


def test_query(spark, edge_docs, edge_rows, no_docs):
    docs = edge_docs.union(spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(TRICKY)], DOCS))
    got = op5(docs.withColumnRenamed("lang", "spans").withColumnRenamed("source", "digest")).collect()
    want = [(i, *brute(t)[0]) for i, t, *_ in edge_rows] + [(100 + i, *brute(t)[0]) for i, t in enumerate(TRICKY)]
    assert sorted(repr(tuple(r)[:6]) for r in got) == sorted(map(repr, want))
    assert op5(no_docs).count() == 0 and pii.sanitise(no_docs).count() == 0


def planted(spark):
    """``zorblat`` stands by one address in three texts and nowhere else, ``the`` by it and everywhere; ``quux`` is in two texts, once by it."""
    texts = [f"{prose(i, 30)} the {prose(90 + i, 30)}" for i in range(40)]
    for i in (3, 5, 8):
        texts[i] += f" ask Zorblat the boss at jo.doe{0}@mail.example.com today {prose(200 + i, 10)}"
    texts[3] += " quux"
    texts[9] += " call hapax +49 30 1234567 now quux"
    return texts, spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)


def test_disclosing_terms(spark):
    texts, docs = planted(spark)
    found = {r.doc_id: [(s.start, pii.KINDS[s.kind], s.end) for s in r.spans] for r in pii.find(docs).collect()}
    terms = {i: {texts[i][s:e].lower() for s, k, e in spans if k == "term"} for i, spans in found.items()}
    assert all("zorblat" in terms[i] and "the" not in terms[i] for i in (3, 5, 8))
    assert "hapax" not in terms[9] and "quux" not in terms[9]
    assert all(not spans for i, spans in found.items() if i not in (3, 5, 8, 9))


def test_shares_match_brute_force(spark):
    import math

    texts, docs = planted(spark)
    scanned = pii.scan(docs, "doc_id", "text", pii.PRODUCTION)
    got = sorted(round(r.share, 9) for r in pii.disclosing(docs, scanned, "text", pii.Params(disclosure=-9)).collect())
    near, words = {}, [set(t.lower().split()) for t in texts]
    for i, t in enumerate(texts):
        spans = pii.base_spans(t)
        for k, s, e in pii.contexts(t, spans, pii.PRODUCTION.near):
            near.setdefault((t[spans[k][0]:spans[k][2]], t[s:e].lower()), set()).add(i)
    holders = {}
    for (entity, _), at in near.items():
        holders.setdefault(entity, set()).update(at)
    want = []
    for (entity, term), at in near.items():
        if len(at) >= 2:
            n, h = sum(term in w for w in words), len(holders[entity])
            want.append(round(math.log2(len(texts) * len(at) / (h * n)) / math.log2(len(texts) / h), 9))
    assert got == sorted(want) and len(got) >= 4


def test_copies_weigh_the_same_in_all_counts(spark):
    import math

    texts, _ = planted(spark)
    texts += [texts[3]] * 30 + [texts[20]] * 10
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    scanned = pii.scan(docs, "doc_id", "text", pii.PRODUCTION)
    got = sorted(round(r.share, 9) for r in pii.disclosing(docs, scanned, "text", pii.Params(disclosure=-9)).collect())
    near, holders = {}, {}
    for i, t in enumerate(texts):
        spans = pii.base_spans(t)
        for k, s, e in pii.contexts(t, spans, pii.PRODUCTION.near):
            entity = t[spans[k][0]:spans[k][2]]
            near.setdefault((entity, t[s:e].lower()), set()).add(i)
            holders.setdefault(entity, set()).add(i)
    words = [set(t.lower().split()) for t in texts]
    want = sorted(round(math.log2(len(texts) * len(at) / (len(holders[x]) * sum(term in w for w in words))) / math.log2(len(texts) / len(holders[x])), 9)
                  for (x, term), at in near.items() if len({texts[i] for i in at}) >= 2)
    assert got == want and got[-1] == 1
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    for i in (3, 5, 8, 45):
        assert "zorblat" in {texts[i][s.start:s.end].lower() for s in spans[i] if pii.KINDS[s.kind] == "term"}


def test_sanitise(spark):
    _, docs = planted(spark)
    got = {r.doc_id: r.text for r in pii.sanitise(docs.withColumnRenamed("lang", "spans2")).collect()}
    assert "ask [term] the" in got[3] and "[email]" in got[3] and "@" not in "".join(got.values())
    assert "call hapax [phone] now" in got[9]


def test_a_name_far_from_its_value(spark):
    """``Zorblat`` stands thirty and more words away from the address, in three unlike texts and nowhere else."""
    texts = [f"{prose(i, 60)} the {prose(90 + i, 60)}" for i in range(60)]
    for i in (3, 5, 8):
        texts[i] = f"{prose(300 + i, 20)} {i}th Zorblat {i}nd {prose(400 + i, 40)} at jo.doe@mail.example.com today {prose(200 + i, 10)} zorblat"
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, texts[3], None, None, None)], DOCS)
    rows = pii.find(docs).collect()
    for r in rows:
        terms = [texts[r.doc_id if r.doc_id is not None else 3][s.start:s.end].lower() for s in r.spans if pii.KINDS[s.kind] == "term"]
        assert terms.count("zorblat") == (2 if r.doc_id in (3, 5, 8, None) else 0) and "the" not in terms
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "zorblat" not in clean[5].lower()


def test_copies_of_a_text_keep_their_words(spark):
    """Two texts that differ a little hold an address: their rare words are not taken for its disclosure."""
    import random

    base = prose(500, 200, 100_000).split(" ")
    texts = [f"{prose(i, 60)} {prose(90 + i, 60)}" for i in range(60)]
    for i in (3, 5):
        words = [w if random.Random(i * 1000 + k).random() > 0.05 else f"edit{i}x{k}" for k, w in enumerate(base)]
        texts[i] = " ".join([*words[:100], "jo.doe@mail.example.com", *words[100:]])
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: [s for s in r.spans if pii.KINDS[s.kind] == "term"] for r in pii.find(docs).collect()}
    assert all(len(found[i]) <= 8 for i in (3, 5)) and not any(found[i] for i in found if i not in (3, 5))


def test_shares_anywhere_match_brute_force(spark):
    import math

    texts = [f"{prose(i, 40)} {prose(90 + i, 40)}" for i in range(40)]
    for i, extra in {3: "alpha x beta a@b.de", 5: "y alpha z +49 30 1234567 a@b.de", 8: "gamma alpha u beta v a@b.de", 9: "w beta gamma t +49 30 1234567", 12: "beta"}.items():
        texts[i] += " " + extra
    texts += [texts[3]] * 3
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    p = pii.Params(disclosure=0.5, alike=99)
    got = sorted(round(r.share, 9) for r in pii.disclosing_anywhere(docs, pii.scan(docs, "doc_id", "text", p), "text", p).collect())
    words, entities, beside = [], [], []
    for t in texts:
        spans = pii.base_spans(t)
        w, free, _ = pii.free_words(t, spans) if spans else ([m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)], None, [])
        words.append({t[s:e].lower() for i, (s, e) in enumerate(w) if free is None or free[i]})
        entities.append({t[s:e].lower() for s, _, e in spans})
        every = [None, *(t[s:e].lower() for s, e in w), None]
        first: dict = {}
        for i in range(len(w)):
            if free is None or free[i]:
                first.setdefault(every[i + 1], (every[i], every[i + 2]))
        beside.append(first)
    plain = [set(t.lower().split()) for t in texts]
    want = []
    for entity in set().union(*entities):
        held = [i for i, e in enumerate(entities) if entity in e]
        if len({texts[i] for i in held}) >= 2:
            for term in set().union(*(words[i] for i in held)):
                at = [i for i in held if term in words[i]]
                n = sum(term in w for w in plain)
                share = math.log2(len(texts) * len(at) / (len(held) * n)) / math.log2(len(texts) / len(held))
                unlike = all(len({beside[i][term][side] for i in at}) > 1 for side in (0, 1))
                if len({texts[i] for i in at}) >= 2 and share >= 0.5 and unlike:
                    want.append(round(share, 9))
    assert got == sorted(want) and len(got) >= 4


def test_frequent_terms_leave_before_most_rows_are_counted(spark, monkeypatch):
    """``often`` is in all rows, ``alpha`` in three: only the rare one is counted in the last three quarters."""
    from dataclasses import replace

    texts = [f"often {prose(i, 30)} row{i}" for i in range(200)]
    for i in (3, 50, 120):
        texts[i] = f"{i}a often {i}b {prose(300 + i, 20)} {i}c alpha {i}d jo.doe@mail.example.com"
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([*texts, None])], DOCS)
    p = replace(pii.PRODUCTION, first=8)
    asked, real = [], pii.term_counts
    monkeypatch.setattr(pii, "term_counts", lambda docs, text, wanted, p: asked.append((docs.count(), wanted.count())) or real(docs, text, wanted, p))
    wanted = spark.createDataFrame([(int(t), most) for t, most in zip(pii.word_terms("often alpha none", [(0, 5), (6, 11), (12, 16)]), (9.7, 9.7, 9.7))], "term long, most double")
    got = {r.term: r.n for r in pii.counts_up_to(docs, "text", wanted, docs.count(), p).collect()}
    often, alpha, none = (int(t) for t in pii.word_terms("often alpha none", [(0, 5), (6, 11), (12, 16)]))
    assert got[alpha] == 3 and 9.7 < got[often] < 200 and none not in got
    assert sum(n for n, _ in asked) == docs.count() and [n for _, n in asked][0] == 3 and [n for _, n in asked][-1] == 2
    monkeypatch.undo()
    scanned = pii.stage(pii.scan(docs, "doc_id", "text", p), "pii")
    for told in (pii.disclosing, pii.disclosing_anywhere):
        once, sliced = (sorted(map(tuple, told(docs, scanned, "text", x).collect())) for x in (pii.PRODUCTION, p))
        assert once == sliced and once
