"""Threshold joins and hard negatives against all pairs written out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrade.llm import hardneg, registry

SCHEMA = "vec_id bigint, embedding array<double>, label int, no int, x string, windows int"


def plain(rows, anchors, k=5, n=10, low=30, high=90):
    ok = [(i, lab, [math.floor(256 * c) for c in v]) for i, v, lab in rows if i is not None and lab is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, lab, x in ok:
        if not anchors(i):
            continue
        score = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in ok if len(y) == len(x))
        close = [(j, -s) for s, j, other in score if other == lab and j != i][:k]
        for j, p in close:
            far = [(m, -s) for s, m, other in score if other != lab and 30 * p <= -100 * s <= 90 * p][:n]
            out += [(i, j, r + 1, m, p, s) for r, (m, s) in enumerate(far)]
    return sorted(out)


def mined(spark, rows, anchors):
    df = spark.createDataFrame([(i, v, lab, 1, "x", 2) for i, v, lab in rows], SCHEMA)
    got = hardneg.mine(df, anchors).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.fixture(scope="module")
def crowd():
    """Groups of copies and near copies, ties, odd rows and lengths."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=20).tolist(), int(rng.integers(0, 3))) for i in range(150)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(100)]  # copies, a third of all
    rows += [(2000 + i, (np.array(rows[1][1]) * 0.9 + rng.normal(size=20) * 0.05).tolist(), 1 + i % 2) for i in range(40)]
    rows += [(3000 + i, (rng.integers(-1, 2, 20) / 2).tolist(), i % 3) for i in range(60)]  # ties
    rows += [(4000, [0.0] * 20, 1), (4010, [0.0] * 20, 1), (4001, None, 1), (4002, [], 1), (4003, [None] + [1.0] * 19, 1), (4004, [float("nan")] * 20, 1), (4005, [float("inf")] * 20, 1)]
    rows += [(4006, rows[2][1], None), (None, rows[3][1], 1), (4020, [1.0, 2.0], 0), (4021, [1.0, 1.5], 0), (4022, [0.5, 0.5], 2)]
    return rows


def test_whole_result_on_crowded_rows(spark, crowd, monkeypatch):
    want = plain(crowd, lambda i: i % 10 == 0)
    assert want and mined(spark, crowd, F.col("id") % 10 == 0) == want
    # many shards, blocks and rounds give the same
    for name, value in (("SHARD", 64), ("BLOCK", 16), ("STEP", 7), ("AIMS", (1, 2)), ("SAMPLE", 30)):
        monkeypatch.setattr(hardneg, name, value)
    assert mined(spark, crowd, F.col("id") % 10 == 0) == want


def test_edges(spark, crowd):
    assert mined(spark, [], F.col("id") % 10 == 0) == []
    assert mined(spark, crowd[:1], F.col("id") % 10 == 0) == []
    assert mined(spark, crowd, F.lit(False)) == []
    both = mined(spark, [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5], 2)], F.col("id") == 0)
    assert both == [(0, 1, 1, 2, 131072, 65536)] * 2  # rows of one id stand for themselves


@pytest.mark.parametrize("seed", range(8))
def test_index_finds_all_pairs_at_the_level(seed):
    rng = np.random.default_rng(seed)
    dim = int(rng.choice([3, 16, 17, 64]))
    x = np.floor(rng.normal(size=(200, dim)) * 100 * rng.choice([0.01, 1, 3], dim))
    q = np.floor(rng.normal(size=(40, dim)) * 100)
    scores = q @ x.T
    least = np.quantile(scores, rng.choice([0.0, 0.5, 0.9, 0.999]), axis=1)
    index = hardneg.Index(x, (least / np.sqrt((q * q).sum(axis=1))).min())
    i, j, s = index.reaching(q, least)
    assert sorted(zip(i.tolist(), j.tolist())) == [tuple(p) for p in np.argwhere(scores >= least[:, None]).tolist()]
    assert (s == scores[i, j]).all()


def test_index_leaves_out_covered_dimensions():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(500, 64)) * 2.0 ** -np.arange(64) * 1e6)
    index = hardneg.Index(x, 1e5)
    assert index.sizes[0] > 0 and index.sizes[1:] == [0, 0, 0]  # the first dimensions hold the energy


def test_query_matches_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = registry.table(spark, sf, "embeddings").collect()
    labelled = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]
    got = sorted(tuple(r) for r in registry.op11_hard_negatives(spark, sf).collect())
    assert got == plain(labelled, lambda i: i % 100 == 0)
