import hashlib

from pyspark.sql import functions as F

from lendgrade.functions import (
    EMPTY_IDENTITY_KEY,
    band_points,
    digits_to_int,
    longer_than,
    member_key,
    null_if_zero_text,
)


def _sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_member_key_skips_nulls_and_hashes_like_sha256(spark):
    df = spark.createDataFrame([("a", None, "b"), (None, "a", "b"), (None, None, None)], "x string, y string, z string")
    out = [r.k for r in df.select(member_key(["x", "y", "z"]).alias("k")).collect()]
    assert out[0] == out[1] == _sha("a||b")  # NULLs are skipped, so these collide
    assert out[2] == EMPTY_IDENTITY_KEY == _sha("")


def test_member_key_null_token_separates_collisions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    out = [r.k for r in df.select(member_key(["x", "y"], null_token="\u0000").alias("k")).collect()]
    assert out[0] != out[1]


def test_member_key_double_text_form(spark):
    df = spark.createDataFrame([(20037.0,)], "v double")
    assert df.select(member_key(["v"]).alias("k")).first().k == _sha("20037.0")


def test_digits_to_int(spark):
    df = spark.createDataFrame([("10+ years",), ("< 1 year",), ("n/a",), (None,), ("3 years",)], "e string")
    assert [r.v for r in df.select(digits_to_int("e").alias("v")).collect()] == [10, 1, None, None, 3]


def test_null_if_zero_text(spark):
    df = spark.createDataFrame([("0.0",), ("0",), ("Jan-2019",), ("2015-01-01",), (None,)], "d string")
    assert [r.v for r in df.select(null_if_zero_text("d").alias("v")).collect()] == [
        None,
        None,
        "Jan-2019",
        "2015-01-01",
        None,
    ]


def test_longer_than_keeps_null(spark):
    df = spark.createDataFrame([("CA",), ("NATION_3",), (None,), ("NYC",)], "s string")
    assert [r.v for r in df.select(longer_than("s", 2, "NA").alias("v")).collect()] == ["CA", "NA", None, "NA"]


def test_band_points_first_match_and_default(spark):
    df = spark.createDataFrame([(1,), (5,), (10,), (None,)], "x int")
    x = F.col("x")
    with_default = band_points([(x < 6, 1), (x < 3, 2)], default=0)
    no_default = band_points([(x < 6, 1)])
    rows = df.select(with_default.alias("a"), no_default.alias("b")).collect()
    assert [r.a for r in rows] == [1, 1, 0, 0]
    assert [r.b for r in rows] == [1, 1, None, None]


def test_cluster_conf_sizes_partitions():
    from lendgrade.session import cluster_conf

    # no silent cap: partitions keep their size at any input
    assert cluster_conf(100 * 2**40)["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 * 2**20))
    assert cluster_conf(100 * 2**40, max_shuffle_partitions=100_000)["spark.sql.shuffle.partitions"] == "100000"
    assert cluster_conf(100 * 2**40, shuffled_bytes=2**40)["spark.sql.shuffle.partitions"] == str(2**40 // (256 * 2**20))
    assert cluster_conf(1 * 2**40)["spark.sql.shuffle.partitions"] == str(2**40 // (256 * 2**20))
    assert cluster_conf(10)["spark.sql.shuffle.partitions"] == "200"
