"""Bucketed tables join without a shuffle of their own."""

from test_skew import conf

from lendgrade.plans import catalog, queries


def test_bucketed_relation_shuffles_one_side_once(spark, sf_small):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        out = queries.customer_loan_bucketed(spark, sf_small)
        n = out.count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        plain = queries.customer_loan_relation(spark, sf_small)
        assert n == plain.count()
        assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # loans with their repayments go to their member once; the four others stay
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "Exchange hashpartitioning(_l_member" in plan, plan
    assert plan.count("SortMergeJoin") == 4


def test_bucketed_table_can_be_written_again(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS lg_buckets")
    for n in (10, 20):
        df = spark.range(n).selectExpr("concat('m', id % 5) AS member_id", "id AS v")
        t = catalog.materialise_bucketed(spark, df, "lg_buckets.t", "member_id", 4, str(tmp_path / "t"))
        assert t.count() == n
        # a group on the bucketing key needs no exchange
        assert "Exchange" not in t.groupBy("member_id").count()._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP DATABASE lg_buckets CASCADE")
