"""Top-k search and embedding near-duplicates against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lendgrade.llm import pivots, registry, topk

DDL = "vec_id bigint, embedding array<float>, label int, id bigint, code string, n_links bigint"


def same_as_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    cur = con.execute(registry.ORACLE_SQL[name])
    cols = [c[0] for c in cur.description]
    got = registry.QUERIES[name](spark, sf_dir).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())


def test_queries_match_sql(spark, sf_small):
    same_as_sql(spark, sf_small, "op8_exact_topk")
    same_as_sql(spark, sf_small, "op7_embedding_near_dedup")


def odd_vectors(spark, rng, n=300, dim=20):
    x = rng.normal(0, 1, (n, dim)).round(3)
    x[50:120] = x[50]  # copies
    x[120:150] = x[120] + rng.normal(0, 0.02, (30, dim))
    rows = [(i, [float(v) for v in x[i]], i % 2 if i >= 50 else None, 0, "c", 9) for i in range(n)]
    rows += [
        (900, None, 1, 0, "c", 9),
        (901, [], 1, 0, "c", 9),
        (902, [0.0] * dim, 1, 0, "c", 9),
        (903, [float("nan")] + [1.0] * (dim - 1), 1, 0, "c", 9),
        (904, [float("inf")] + [1.0] * (dim - 1), 1, 0, "c", 9),
        (905, [None] + [1.0] * (dim - 1), 1, 0, "c", 9),
        (906, [1.0, 2.0], 1, 0, "c", 9),
        (907, [2.0, 4.0], 1, 0, "c", 9),
        (299, rows[299][1], rows[299][2], 0, "c", 9),  # a repeated row
        (None, rows[60][1], rows[60][2], 0, "c", 9),
    ]
    return spark.createDataFrame(rows, DDL)


def test_links_of_odd_vectors(spark):
    frame = odd_vectors(spark, np.random.default_rng(6))
    rows = frame.collect()
    sound = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    unit = [np.array(r.embedding) / np.linalg.norm(r.embedding) if sound(r.embedding) and r.label is not None else None for r in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i].label == rows[j].label and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98] for i in range(n)]
    least = list(range(n))
    for _ in range(n):
        new = [min([least[i], *[least[j] for j in near[i]]]) for i in range(n)]
        if new == least:
            break
        least = new
    first = {}
    for i in range(n):
        known = [x for x in (first.get(least[i]), rows[i].vec_id) if x is not None]
        first[least[i]] = min(known, default=None)
    wanted = sorted(repr((rows[i].vec_id, len(near[i]), first[least[i]])) for i in range(n))
    got = pivots.near_duplicates(frame).collect()
    assert sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in got) == wanted
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert pivots.near_duplicates(frame.limit(0)).collect() == []


def test_recall_of_the_index(spark, sf_small):
    frame = registry.table(spark, sf_small.replace("sf0.001", "sf0.1"), "embeddings")
    rows = frame.collect()
    x = np.array([r.embedding for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r.label for r in rows])
    links = ((x @ x.T >= 0.98) & (label[:, None] == label[None, :])).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(frame).collect()}
    found = np.array([got[r.vec_id] for r in rows])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum()


def test_recall_in_a_dense_group(spark):
    rng = np.random.default_rng(9)
    n, dim = 20_000, 64
    x = rng.normal(0, 1, (n, dim))
    x[: n // 3] = x[0] / np.linalg.norm(x[0]) + rng.normal(0, 0.0154, (n // 3, dim))  # cosines of about 0.985 in a third
    frame = spark.createDataFrame([(i, v, 1, 0, "c", 0) for i, v in enumerate(x.tolist())], DDL.replace("float", "double"))
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = np.concatenate([(x[i : i + 500] @ x.T >= 0.98).sum(axis=1) - 1 for i in range(0, n, 500)])
    got = pivots.near_duplicates(frame).toPandas().set_index("vec_id")["n_links"].sort_index().to_numpy()
    assert links.sum() > 20_000_000 and (got <= links).all() and got.sum() >= 0.999 * links.sum()


@pytest.mark.parametrize("most", [64, 8])
def test_recall_of_deeper_lists(spark, monkeypatch, most):
    """Classes of more rows than the pivots give short lists for."""
    monkeypatch.setattr(pivots, "MOST_PIVOTS", most)
    rng = np.random.default_rng(10)
    n, dim = 5000, 64
    x = rng.normal(0, 1, (n, dim))
    x[: n // 3] = x[0] / np.linalg.norm(x[0]) + rng.normal(0, 0.0154, (n // 3, dim))  # one dense group
    for i in range(n // 3 + 1, n, 5):  # and many small ones
        x[i] = x[i - 1] / np.linalg.norm(x[i - 1]) + rng.normal(0, 0.012, dim)
    frame = spark.createDataFrame([(i, v, 1, 0, "c", 0) for i, v in enumerate(x.astype(np.float32).tolist())], DDL)
    x = x.astype(np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = np.concatenate([(x[i : i + 500] @ x.T >= 0.98).sum(axis=1) - 1 for i in range(0, n, 500)])
    got = pivots.near_duplicates(frame).toPandas().set_index("vec_id")["n_links"].sort_index().to_numpy()
    small = np.arange(n) > n // 3
    print("recall", most, got.sum() / links.sum(), got[small].sum() / links[small].sum())
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum() and got[small].sum() >= 0.95 * links[small].sum()


def test_classes_of_all_sizes_have_the_same_lists(spark, monkeypatch):
    monkeypatch.setattr(pivots, "MOST_PIVOTS", 8)
    kept = {}
    land = pivots.landed
    monkeypatch.setattr(pivots, "landed", lambda df, label: kept.setdefault(label, land(df, label)))
    rng = np.random.default_rng(11)
    sizes = {0: 100, 1: 500, 2: 7000}  # to 384 rows, to 6,144 and beyond
    rows = [(v, label) for label, n in sizes.items() for v in rng.normal(0, 1, (n, 16)).tolist()]
    frame = spark.createDataFrame([(i, v, label, 0, "c", 0) for i, (v, label) in enumerate(rows)], DDL)
    assert pivots.near_duplicates(frame).count() == len(rows)
    lists = kept["orders"].selectExpr("label", "size(keys) AS n", "asks").distinct().collect()
    assert len(lists) == 3 and len({(r.n, r.asks) for r in lists}) == 1
    # one pivot: one list of all
    keys, asks = pivots.list_keys(np.zeros((4, 1), dtype=np.int64), np.array([True, False, True, False]))
    assert asks == 1 and len(set(keys[:, 0].tolist())) == 1 and keys.shape == (4, 1)


def test_many_lists_are_one_group(spark, monkeypatch):
    """Lists grow faster than the rows as long as classes get more pivots; groups do not."""
    calls, real, kept = spark.sparkContext.accumulator(0), pivots.linked, {}

    def counted(*args):
        calls.add(1)
        return real(*args)

    land = pivots.landed
    monkeypatch.setattr(pivots, "linked", counted)
    monkeypatch.setattr(pivots, "landed", lambda df, label: kept.setdefault(label, land(df, label)))
    x = np.random.default_rng(12).normal(0, 1, (4000, 16))
    x[2000:] = x[:2000] + 0.01
    frame = spark.createDataFrame([(i, v, 1, 0, "c", 0) for i, v in enumerate(x.tolist())], DDL)
    assert pivots.near_duplicates(frame).count() == 4000
    lists = kept["orders"].select(F.explode("keys")).distinct().count()
    assert lists > 1000 and 1 <= calls.value <= 4000 * 11 * 16 // pivots.GROUP + 1


def test_blocks_and_groups_change_no_link(spark, monkeypatch):
    rng = np.random.default_rng(13)
    n, dim = 2000, 32
    x = rng.normal(0, 1, (n, dim))
    x[:400] = x[0] / np.linalg.norm(x[0]) + rng.normal(0, 0.02, (400, dim))
    for i in range(401, n, 4):
        x[i] = x[i - 1] + rng.normal(0, 0.05, dim)
    x[n - 100 :] = x[n - 100]  # copies
    frame = spark.createDataFrame([(i, v, i % 2 if i > 1000 else 0, 0, "c", 0) for i, v in enumerate(x.tolist())], DDL)
    wanted = sorted(map(tuple, pivots.near_duplicates(frame).collect()))
    monkeypatch.setattr(pivots, "BLOCK", 16)
    monkeypatch.setattr(pivots, "GROUP", 1 << 12)
    monkeypatch.setattr(pivots, "PAIRS", 100)
    assert sorted(map(tuple, pivots.near_duplicates(frame).collect())) == wanted
    assert sum(r[1] for r in wanted) > 100_000


def test_spanning_forest():
    rng = np.random.default_rng(14)
    a, b = rng.integers(0, 500, (2, 600))
    root = np.arange(500)
    some = np.concatenate([pivots.spanning(root, a[:300], b[:300]), 300 + pivots.spanning(root, a[300:], b[300:])])
    assert len(some) == 500 - len(set(root.tolist()))  # no circle
    assert (root[a] == root[b]).all()
    again = np.arange(500)
    pivots.spanning(again, a[some], b[some])
    assert (again == root).all()


def test_only_drawn_vectors_are_dealt_by_class(spark, sf_small, monkeypatch):
    plans = []
    land = pivots.landed
    monkeypatch.setattr(pivots, "landed", lambda df, label: plans.append((label, df._jdf.queryExecution().executedPlan().toString())) or land(df, label))
    pivots.near_duplicates(registry.table(spark, sf_small, "embeddings")).count()
    plan = dict(plans)
    # classes are counted on numbers, without a vector in sight
    assert "array" not in plan["classes"] and "hashpartitioning(label" in plan["classes"]
    # vectors are joined by number; what is dealt by class is drawn already
    drawn = plan["pivots"]
    assert drawn.index("collect_list") < drawn.index("Join [e#")


def test_nearest_of_odd_vectors(spark):
    frame = odd_vectors(spark, np.random.default_rng(7))
    bits = {r.vec_id: tuple(x > 0 for x in r.embedding) for r in frame.collect() if r.vec_id is not None and r.embedding and all(x is not None and x == x for x in r.embedding)}
    got = {}
    for r in topk.nearest(frame, F.col("id") % 25 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.id))
    for q in [k for k in bits if k % 25 == 0]:
        far = sorted((sum(a != b for a, b in zip(bits[q], c)), i) for i, c in bits.items() if i != q and len(c) == len(bits[q]))
        assert sorted(got.pop(q)) == [(n + 1, d, i) for n, (d, i) in enumerate(far[:5])]
    assert got == {}
    assert topk.nearest(frame.limit(0), F.col("id") >= 0).collect() == []


def test_a_search_stops_when_covered():
    rng = np.random.default_rng(8)
    code = rng.integers(0, 1 << 16, (4000, 4), dtype=np.uint16)
    code[:50] = code[0] ^ (rng.random((50, 4)) < 0.3).astype(np.uint16)
    shard = topk.Shard(np.arange(4000), code)
    for own in (0, 7, 900):
        far = np.bitwise_count(code ^ code[own]).sum(axis=1).astype(int)
        wanted = [i for _, i in sorted((d, i) for i, d in enumerate(far) if i != own)[:10]]
        ids, d = shard.nearest(code[own], own, 10)
        assert ids.tolist() == wanted and d.tolist() == far[wanted].tolist()
