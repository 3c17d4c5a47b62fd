"""Histograms, distinct counts and sketches against plain counts."""

from collections import Counter

from pyspark.sql import functions as F

from lendgrade.operators import profile

DDL = "a string, n int, d double, t timestamp"


def _rows(spark):
    rows = [(None if i % 5 == 0 else f"v{i % 7}", i % 3 if i % 4 else None, i / 8, None) for i in range(200)]
    return spark.createDataFrame(rows, DDL), rows


def test_histogram_and_distinct_counts(spark):
    df, rows = _rows(spark)
    got = profile.value_histogram(df, {"x": {"first": "a", "num": "n"}, "y": {"again": "a", "d": "d", "t": "t"}})
    want = Counter()
    for a, n, d, _ in rows:
        want[("x", "first", a, None)] += 1
        want[("y", "again", a, None)] += 1
        want[("x", "num", None, None if n is None else float(n))] += 1
        want[("y", "d", None, d)] += 1
        want[("y", "t", None, None)] += 1
    assert {(r.table_name, r.column_name, r.value, r.number): r.total for r in got.collect()} == dict(want)
    counts = {(r.table_name, r.column_name): (r.row_count, r.distinct_count) for r in profile.distinct_counts(got).collect()}
    assert counts == {("x", "first"): (200, 7), ("y", "again"): (200, 7), ("x", "num"): (200, 3), ("y", "d"): (200, 200), ("y", "t"): (200, 0)}
    assert profile.value_histogram(df.limit(0), profile.own_columns(df, "x")).count() == 0


def test_histogram_is_one_scan_combined_before_its_shuffle(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = profile.value_histogram(df, profile.own_columns(df, "o", ["o_orderstatus", "o_orderpriority"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_count" in plan
    assert "o_comment" not in plan  # only the columns shown are read


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).selectExpr("CAST(id % 20000 AS STRING) wide", "CAST(CASE WHEN id % 3 = 0 THEN -1 ELSE id % 50 END AS INT) hot", "CAST(NULL AS DOUBLE) none")
    parts = [profile.column_sketches(df.where(F.col("hot") % 2 == i), profile.own_columns(df, "t")) for i in (0, 1)]
    parts.append(profile.column_sketches(df.where("hot = -1"), profile.own_columns(df, "t")))
    got = {r.column_name: r for r in profile.sketch_estimates(profile.merge_sketches(*parts), k=1).collect()}
    assert abs(got["wide"].distinct_estimate - 20000) <= 20000 * profile.DISTINCT_ERROR
    assert got["hot"].distinct_estimate == 51 and got["none"].distinct_estimate == 0
    assert {r.row_count for r in got.values()} == {60_000}
    top = got["hot"].top_values[0]  # every third row has this value
    assert top.value == "-1" and abs(top.total - 20_000) <= 60_000 * 3.5 / profile.ITEMS
    # a sketch does not grow with its rows
    size = lambda rows: profile.column_sketches(df.limit(rows), {"t": {"wide": "wide"}}).select(F.length("values")).first()[0]
    assert size(60_000) <= 4 * 2**profile.LG_REGISTERS
