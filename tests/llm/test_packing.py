"""The packing plan, token ids against the tokenizers library, whole queries."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lendgrade.llm import packing, registry

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(FILE)


def laid_out(runs):
    places = defaultdict(list)
    for length, _, n, first, per, offset in runs:
        for i in range(n):
            places[first + i // per].append((offset + length * (i % per), length))
    return places


def check_plan(histogram, capacity):
    runs, sequences = packing.plan_runs(histogram, capacity)
    places = laid_out(runs)
    assert set(places) == set(range(sequences))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    for length, n in histogram.items():  # every piece once, numbered without gaps
        at = 0
        for first, m in sorted((r[1], r[2]) for r in runs if r[0] == length):
            assert first == at
            at += m
        assert at == n
    return sequences, -(-sum(k * v for k, v in histogram.items()) // capacity)


def test_plans():
    random.seed(2)
    for _ in range(60):
        capacity = random.choice([8, 16, 50, 200])
        check_plan(Counter(random.randint(1, capacity) for _ in range(random.randint(0, 300))), capacity)
    many = Counter(min(4096, int(random.lognormvariate(6.5, 1.3)) + 1) for _ in range(50_000))
    got, least = check_plan(many, 4096)
    assert got <= 1.01 * least
    # three groups that only fit together: the linear program finds them
    got, least = check_plan({50: 300, 30: 300, 20: 300}, 100)
    assert got == least == 300
    assert packing.plan_runs({}, 10) == ([], 0)
    assert check_plan({10: 5}, 10) == (5, 5)


def test_chunked_ids(reference):
    with open(FILE, "rb") as f:
        tok = packing.ChunkTokenizer(f.read())
    random.seed(3)
    signs = "aáÁbc  \n\t\x1c\u3000 'tsre!?1２3éß漢字🙂\r\u0301ΣΑΣİ\x85 "
    for _ in range(100):
        texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 40))) + random.choice(["", "<|endoftext|>x <|startoftext|>"]) for _ in range(20)]
        for t, raw in zip(texts, tok.encode(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == reference.encode(t, add_special_tokens=False).ids, t


def check_rows(rows, texts, reference, capacity):
    """``rows`` of the result against ids by the library, repeats included."""
    wanted = Counter()
    for key, text in texts:
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for n, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            wanted[(key, n, s, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    spots = defaultdict(list)
    for r in rows:
        spots[r.sequence_id].append((r.offset, r.length))
    for s in spots.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spots)


def test_query_and_edge_rows(spark, sf_small, odd_docs, no_docs, reference):
    rows = registry.op5_best_fit_packing(spark, sf_small).collect()
    texts = [(r.doc_id, r.text) for r in registry.table(spark, sf_small, "documents").collect()]
    sequences = check_rows(rows, texts, reference, 4096)
    assert sequences <= 1.05 * sum(r.length for r in rows) / 4096 + 1
    odd = packing.pack(odd_docs, FILE, capacity=64, with_ids=True)
    rows = odd.collect()
    check_rows(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], reference, 64)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert packing.pack(no_docs, FILE).collect() == []
