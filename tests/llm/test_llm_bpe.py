import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from llm_cases import edge_docs, edge_rows, no_docs, scratch  # noqa: F401

from assay.llm import bpe
from assay.llm.queries import BPE_RANKS, op8


@pytest.fixture(scope="module", params=[BPE_RANKS, "byte_bpe_50k.tiktoken"])
def pair(request):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(request.param), "rb"))}
    return bpe.encoder(P.path(request.param), P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_as_merges_by_rank(pair):
    own, other = pair
    r = random.Random(1)
    letters = "ab eé\n\t  \x1c\x85\u3000中文字кир😀0123'stre#$.,ABC\u200b\u0301ﬁ"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(3000)]
    texts += ["", "a" * 5000, " " * 3000 + "x", "ab" * 3000, "<|endoftext|>", "the" * 2000]
    for t in texts:
        ids = own.encode(t)
        assert ids.tolist() == other.encode_ordinary(t)
        assert own.decode(ids).decode() == t


def test_long_texts_are_not_listed_at_once(pair, monkeypatch):
    own, other = pair
    monkeypatch.setattr(bpe, "AT_ONCE", 10)
    assert own.encode("It's 42 o'clock in the morning.").tolist() == other.encode_ordinary("It's 42 o'clock in the morning.")


def test_remembering_is_bounded(pair, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBER", 8)
    own = bpe._Remembered(lambda x: x + 1, lambda x: x != 3)
    assert [own[x] for x in [*range(20), 3, 0, 19]] == [*range(1, 21), 4, 1, 20]
    assert len(own) <= 4 and 3 not in own


def test_table(spark, edge_docs, edge_rows, no_docs, pair):
    own, other = pair
    path = P.path(BPE_RANKS)
    got = op8(edge_docs).collect()
    ids = lambda t: other.encode_ordinary(t or "")
    if own is bpe.encoder(path, P.PATTERN):
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want = [(i, len(ids(t)), sha(",".join(map(str, ids(t))).encode()), sha((t or "").encode())) for i, t, *_ in edge_rows]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    clash = edge_docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    made = bpe.encode(clash, path, P.PATTERN)
    assert made.columns == ["doc_id", "n_chars", "ids"]
    back = bpe.decode(made, path, P.PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((t or "").encode() for _, t, *_ in edge_rows)
    assert bpe.encode(no_docs, path, P.PATTERN, decoded=True).count() == 0


def test_ids_outside_the_vocabulary(pair):
    own, _ = pair
    for bad in ([50_256 + 9], [None], [-1]):
        with pytest.raises(ValueError):
            own.decode(bad)
    assert own.decode([]) == b""
