from lendgrade.operators import quarantine


def test_duplicates_union_and_exclusion(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "member_id string, v int")
    b = spark.createDataFrame([("y", 1), ("y", 1), ("z", 1)], "member_id string, v int")
    c = spark.createDataFrame([("x", 1), ("x", 1)], "member_id string, v int")
    dups = [quarantine.duplicate_members(t) for t in (a, b, c)]
    assert sorted(r.member_id for r in quarantine.quarantine_all_rows(*dups).collect()) == ["x", "x", "y"]
    bad = quarantine.quarantine(*dups)
    assert sorted(r.member_id for r in bad.collect()) == ["x", "y"]
    kept = quarantine.exclude_members(a.unionByName(b), bad)
    assert sorted(r.member_id for r in kept.collect()) == ["z"]
    ranked = quarantine.duplicate_keys_ranked(a.unionByName(c))
    assert [(r.member_id, r.total) for r in ranked.collect()] == [("x", 4)]


def test_anti_join_plan_has_no_cartesian_or_broadcast_hint(spark):
    big = spark.range(1000).selectExpr("cast(id % 10 as string) as member_id")
    bad = spark.createDataFrame([("1",)], "member_id string")
    plan = quarantine.exclude_members(big, bad)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    assert quarantine.exclude_members(big, bad).count() == 900


def test_value_counts_top_cut_is_deterministic(spark):
    from lendgrade.operators import profile

    # a, b, c and null tie at 2 rows; the top-3 cut keeps the most frequent value
    # and breaks the tie by value, nulls last
    df = spark.createDataFrame([(v,) for v in "dddabcabc"] + [(None,), (None,)], "v string")
    assert [tuple(r) for r in profile.value_counts(df, "v", top=3).collect()] == [("d", 3), ("a", 2), ("b", 2)]


def test_latest_policy_keeps_one_application_of_each_member(spark):
    import pytest

    from lendgrade.functions.columns import EMPTY_IDENTITY_KEY as BLANK

    rows = [("a", 1, "x"), ("a", 7, "y"), ("a", 3, "z"), ("b", 2, "x"), (BLANK, 4, "x"), (BLANK, 5, "x"), ("c", None, "x"), ("c", 6, "y"), ("d", 9, "p"), ("d", 9, "q"), ("d", 9, "q")]
    df = spark.createDataFrame(rows, "member_id string, id int, __place string")
    assert quarantine.resolve(df).count() == len(rows)  # as published
    got = sorted(tuple(r) for r in quarantine.resolve(df, "latest").collect())
    assert [g for g in got if g[0] != "d"] == sorted([("a", 7, "y"), ("b", 2, "x"), ("c", 6, "y"), (BLANK, 4, "x"), (BLANK, 5, "x")])
    assert len([g for g in got if g[0] == "d"]) == 1  # ties: one, the same every time
    assert got == sorted(tuple(r) for r in quarantine.resolve(df.repartition(5), "latest").collect())
    assert quarantine.resolve(df.limit(0), "latest").count() == 0
    with pytest.raises(ValueError):
        quarantine.resolve(df, "first")


def test_latest_policy_sends_one_row_of_a_hot_member_per_task(spark):
    n = 60_000
    df = spark.range(n, numPartitions=6).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS member_id", "id")
    out = quarantine.resolve(df, "latest")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the limit of one row per member comes before the shuffle, and after it again
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert "Partial" in limits[-1] and "Final" in limits[0], plan
    assert plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning")) > plan.index("Exchange hashpartitioning")
    kept = {r.member_id: r.id for r in out.collect()}
    assert len(kept) == n - n // 3 + 1 and kept["hot"] == n - 3


def test_stages_under_the_latest_policy_follow_it(spark, sf_small):
    from lendgrade.config import ScoreConfig
    from lendgrade.plans.stages import Stages

    s = Stages.shared(spark, sf_small, ScoreConfig(record_policy="latest"))
    published = Stages.shared(spark, sf_small)
    assert s.applications.groupBy("member_id").count().where("count > 1").count() <= 1  # but the blank identity
    assert s.bad.count() <= 1 < published.bad.count()
    assert s.loan_score.count() > published.loan_score.count()


def test_older_frames_survive_a_change_of_the_input(spark, sf_small, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from lendgrade.plans.stages import Stages

    for t in ("orders", "customer", "nation"):
        shutil.copy(f"{sf_small}/{t}.parquet", tmp_path / f"{t}.parquet")
    old = Stages.shared(spark, str(tmp_path)).bad
    n = old.count()
    pq.write_table(pq.read_table(f"{sf_small}/orders.parquet").slice(0, 300), tmp_path / "orders.parquet")
    new = Stages.shared(spark, str(tmp_path))
    assert new.keyed.count() == 300
    assert old.count() == n  # its files are still there


def test_filtered_exclusion_equals_the_plain_one(spark):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 1001 = 0 THEN NULL ELSE concat('m', id) END AS member_id", "id AS v")
    bad = spark.range(3000).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE concat('m', id * 7) END AS member_id")
    plain = quarantine.exclude_members(df, bad)
    key = lambda d: sorted((r.v, r.member_id or "") for r in d.collect())
    want = key(plain)
    assert key(quarantine.exclude_members_filtered(df, bad)) == want
    for words in (1, 2, 64):  # one word: false positives all over
        assert key(quarantine.exclude_members_filtered(df, bad, words=words)) == want
    assert key(quarantine.exclude_members_filtered(df, bad.limit(0))) == key(df)
    # no listed key is ruled out, and few others get through
    words = quarantine.filter_words(bad.count())
    maybe = quarantine.may_be_listed(bad, words)
    assert bad.where(~maybe).count() == 0
    others = df.where("member_id <> 'hot'").join(bad, "member_id", "left_anti")
    assert others.where(maybe).count() < 0.02 * others.count()
    # a list too long for the filter: the plain join
    assert quarantine.filter_words(3000, 2) == 0 and quarantine.filter_words(0) == 1


def test_filtered_exclusion_shuffles_no_row_that_the_filter_rules_out(spark, tmp_path):
    from test_skew import conf

    spark.range(50_000).selectExpr("concat('m', id) AS member_id", "id AS v").write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    spark.range(2000).selectExpr("concat('m', id * 5) AS member_id").write.parquet(str(tmp_path / "bad"))
    bad = spark.read.parquet(str(tmp_path / "bad"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        out = quarantine.exclude_members_filtered(big, bad)
        assert out.count() == 48_000
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        logical = out._jdf.queryExecution().optimizedPlan().toString()
    # only the join's two sides are dealt by member, and its left side is filtered
    # below the exchange
    assert plan.count("Exchange hashpartitioning(member_id") == 2, plan
    passing, joined = logical[logical.index("Union") :].split("Join LeftAnti", 1)
    assert "Filter" in passing and "Join" not in passing.replace("Join LeftOuter", "")
    assert joined.lstrip(", (member_id#0123456789=)\n :+-").startswith("Filter"), joined
