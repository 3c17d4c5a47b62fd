"""Prefix encoding against the tiktoken library, and its appends and edits."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from lendgrade.llm import bpe, registry

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def data():
    with open(RANKS, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def reference(data):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(data), special_tokens={})


def test_random_texts(data, reference):
    enc = bpe.worker_encoder(data, public_tokenizers.PATTERN)
    random.seed(1)
    signs = "aábc  \n\t\x1c\x85\u3000 'tsre!?1２3éß漢字🙂\r\0"
    for k in range(4000):
        text = "".join(random.choice(signs) for _ in range(random.randint(0, 30)))
        if k % 3 == 0:
            text = "".join(random.choice("abcdefthenio ") for _ in range(random.randint(0, 60)))
        assert enc.encode(text) == reference.encode_ordinary(text), text
        assert enc.decode(enc.encode(text)) == text.encode()
    text = "a" * 3000 + " " * 1000 + "x" + "=-" * 800 + "the" * 500
    assert enc.encode(text) == reference.encode_ordinary(text)


def test_appends_and_edits(data):
    voc = bpe.worker_encoder(data, public_tokenizers.PATTERN).vocabulary
    random.seed(2)
    for _ in range(300):
        n = random.randint(0, 600)
        raw = bytes(random.choice(b"abcdetheninreon") for _ in range(n))
        enc = bpe.PrefixEncoder(voc, raw)
        a = random.randint(0, n)
        b = random.randint(a, min(n, a + 5))
        new = bytes(random.choice(b"theinr") for _ in range(random.randint(0, 5)))
        computed = enc.replace(a, b, new)
        assert enc.last == bpe.PrefixEncoder(voc, raw[:a] + new + raw[b:]).last
        assert computed <= len(new) + 3 * voc.longest  # not the whole rest
        before = list(enc.last)
        assert enc.append(b"tion") == 4 and enc.last[: len(before)] == before
        assert voc.merged(enc.data[:40]) == bpe.PrefixEncoder(voc, enc.data[:40]).ids()


def test_query_and_edge_rows(spark, sf_small, odd_docs, no_docs, reference):
    def expected(text):
        ids = reference.encode_ordinary(text or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode())

    got = registry.op4_byte_bpe(spark, sf_small)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = {r.doc_id: r.text for r in registry.table(spark, sf_small, "documents").collect()}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == {k: expected(t) for k, t in texts.items()}
    got = bpe.encode_digests(odd_docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id", "score"])
    assert sorted(map(repr, got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(
        map(repr, [type(r)(**dict(zip(("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), (r.doc_id, *expected(r.text))))) for r in odd_docs.collect()])
    )
    assert bpe.encode_texts(no_docs, RANKS, public_tokenizers.PATTERN, keep=["doc_id"]).collect() == []
    one = bpe.encode_texts(odd_docs.where("doc_id = 6"), RANKS, public_tokenizers.PATTERN).first()
    assert list(one.ids) == reference.encode_ordinary(odd_docs.where("doc_id = 6").first().text)
