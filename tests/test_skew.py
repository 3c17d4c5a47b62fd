"""A key holding a third of all rows: exclusion and duplicate detection stay
split across tasks (no single task takes the hot key's rows)."""

from contextlib import contextmanager

from lendgrade.operators import quarantine


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed(spark, n=60_000):
    # a third of the rows share one member key
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('m', CAST(id AS STRING)) END AS member_id",
        "id AS v",
    )


def test_anti_join_splits_hot_key(spark):
    big = _skewed(spark)
    bad = spark.range(5000).selectExpr("concat('m', CAST(id * 7 AS STRING)) AS member_id").unionByName(
        spark.createDataFrame([("hot",)], "member_id string")
    )
    with conf(
        spark,
        **{
            # the quarantine list is "too large to broadcast": force the shuffle path
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            # many partitions, as on a cluster: the hot one is far above the median
            "spark.sql.shuffle.partitions": "32",
        },
    ):
        out = quarantine.exclude_members(big, bad)
        kept = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    expected = 60_000 - 20_000 - len([i for i in range(5000) if (i * 7) % 3 != 0 and i * 7 < 60_000])
    assert kept == expected
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "skew" in plan.lower(), plan


def test_duplicate_count_is_partial_before_shuffle(spark):
    d = quarantine.duplicate_members(_skewed(spark))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert [r.member_id for r in d.collect()] == ["hot"]


def test_customer_join_is_left_to_measured_sizes(spark, sf_small):
    # no hint: beyond the broadcast threshold customer is joined by sort-merge
    from lendgrade.sources.fixture import raw_applications

    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        raw = raw_applications(spark, sf_small)
        assert raw.count() == spark.read.parquet(f"{sf_small}/orders.parquet").count()
        plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    assert "BroadcastHashJoin" in raw_applications(spark, sf_small)._jdf.queryExecution().executedPlan().toString()


def test_registered_anti_joins_split_a_hot_identity(spark, sf_small):
    """The stages' own frames: a third of the applications share one identity."""
    from pyspark.sql import functions as F

    from lendgrade.plans.stages import Stages
    from lendgrade.sources.fixture import raw_applications
    from lendgrade.sources.schemas import IDENTITY_COLUMNS

    raw = raw_applications(spark, sf_small)
    raw = raw.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(29)))).withColumn("id", F.col("id") * 30 + F.col("copy"))
    raw = raw.withColumn("emp_title", F.concat("emp_title", F.col("id").cast("string"))).drop("copy")
    hot = F.xxhash64("id") % 3 == 0
    raw = raw.withColumns({c: F.when(hot, F.lit(None)).otherwise(F.col(c)) for c in IDENTITY_COLUMNS})
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "200",
    }
    with conf(spark, **small):
        s = Stages(raw, materialize=True)
        hot_key = s.bad.where(F.col("member_id") == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")
        assert hot_key.count() == 1
        for name in ("detail_new", "delinq_new", "payment_points", "loan_score"):
            df = getattr(s, name)
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            anti = [line for line in plan.split("Initial Plan")[0].splitlines() if "LeftAnti" in line]
            assert any("skew=true" in line for line in anti), (name, plan)


def test_one_customers_distinct_in_a_plan(spark, sf_small):
    """Branches share the written customers: no plan repeats their distinct,
    an aggregate on whole rows, which the plan that writes them has."""
    from lendgrade.plans import queries

    def distincts(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return [line for line in plan.splitlines() if "Aggregate [" in line and "verification_status_joint" in line]

    assert len(distincts(queries.QUERIES["clean_customers"](spark, sf_small))) >= 1
    for name in ("exclude_customers", "loan_score"):
        df = queries.QUERIES[name](spark, sf_small)
        assert "Relation" in df._jdf.queryExecution().optimizedPlan().toString() and distincts(df) == [], name
