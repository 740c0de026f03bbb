"""Ids and texts are those of the library."""

import hashlib
import random

import public_tokenizers as P
import pytest
import sentencepiece
from llm_cases import edge_docs, edge_rows, no_docs, prose, sample, scratch  # noqa: F401

from assay.llm import pieces
from assay.llm.queries import PIECES, op13


@pytest.fixture(scope="module")
def pair():
    return pieces.model(P.path(PIECES)), sentencepiece.SentencePieceProcessor(model_file=P.path(PIECES))


def texts():
    r = random.Random(1)
    letters = "ab eé\n\t  \x1c\x85　中文字кир😀0123'stre#$.,ABC​́ﬁ\x00▁�"
    yield from ("".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(3000))
    words = ["the", "ing", "tion", "  ", "\t", "er", "▁▁", "un", "0", "über", "ation"]
    yield from ("".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(2000))
    yield from ["", " ", "a" * 5000, " " * 3000 + "x", "ab" * 3000, "<s></s><unk><0x41>", "the" * 2000, "😀" * 500, " " * 40 + "1", "▁" * 33]


def test_same_as_library(pair):
    own, other = pair
    for t in texts():
        ids = own.encode(t).tolist()
        assert ids == other.encode(t), t
        assert own.decode(ids) == other.decode(ids)


def test_one_long_word_and_small_steps(pair, monkeypatch):
    own, other = pair
    r = random.Random(2)
    t = "".join(r.choice("etaoinsrhl") for _ in range(60_000))
    assert own.encode(t).tolist() == other.encode(t)
    monkeypatch.setattr(pieces, "AT_ONCE", 10)
    assert own.encode("It's 42 o'clock in the morning.").tolist() == other.encode("It's 42 o'clock in the morning.")


def test_any_ids_decode_as_the_library_decodes_them(pair):
    own, other = pair
    r = random.Random(3)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), 0, 1, 2, 29871, 259, 3 + 0xE4, 3 + 0xB8, 3 + 0xAD]) for _ in range(r.randint(0, 12))]
        assert own.decode(ids) == other.decode(ids), ids
    for bad in ([-1], [32000], [None]):
        with pytest.raises(ValueError):
            own.decode(bad)


def test_every_piece_and_pair_by_merging(pair):
    """Neighbours are compatible where merging leaves the border alone."""
    own, other = pair
    r = random.Random(4)
    names = list(own.id)
    for _ in range(4000):
        a, b = r.choice(names), r.choice(names)
        merged = own.merged(a + b)
        ids = [i for p in merged for i in ([own.id[p]] if p in own.id else map(own.byte.__getitem__, p.encode()))]
        text = (a + b).replace("▁", " ")
        if text.startswith(" "):
            assert other.encode(text[1:]) == ids


def test_table(spark, edge_docs, edge_rows, no_docs, pair):
    other = pair[1]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t, *_ in edge_rows:
        ids = other.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(other.decode(ids).encode())))
    assert sorted(map(repr, map(tuple, op13(edge_docs).collect()))) == sorted(map(repr, want))
    clash = edge_docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    made = pieces.encode(clash, P.path(PIECES))
    assert made.columns == ["doc_id", "n_chars", "ids"]
    assert sorted(r.decoded for r in pieces.decode(made, P.path(PIECES)).collect()) == sorted(t or "" for _, t, *_ in edge_rows)
    assert pieces.encode(no_docs, P.path(PIECES), decoded=True).count() == 0


def test_whole_table(sample, pair):
    other = pair[1]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in op13(sample).collect()}
    for r in sample.select("doc_id", "text").collect():
        ids = other.encode(r.text or "")
        assert got[r.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "m"
    path.write_bytes(b"\x12\x02\x18\x01")          # a trainer message of another model type
    with pytest.raises(ValueError):
        pieces.Model(str(path))
