"""Rows of members that do not repeat stay where they are, and steps keep to
bounded files, buckets and rows as the input grows."""

import pytest

from lendgrade.config import ScoreConfig
from lendgrade.operators import profile, quarantine
from lendgrade.plans import catalog, queries
from lendgrade.plans.stages import Stages
from lendgrade.sources.fixture import raw_applications

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def rows(df):
    return sorted(map(str, df.drop("ingest_date").collect()))


@pytest.mark.parametrize("policy", quarantine.POLICIES)
def test_stages_with_the_filter_equal_plain_ones(spark, sf_small, policy):
    raw = raw_applications(spark, sf_small)
    raw = raw.unionByName(raw.where("id % 50 < 3")).unionByName(raw.where("id % 70 = 5").selectExpr("* EXCEPT (id)", "id + 100000 AS id"))
    cfg = ScoreConfig(record_policy=policy)
    s, plain = Stages(raw, cfg, materialize=True), Stages(raw, cfg)
    for name in ("customers", "bad", "loan_score"):
        assert rows(getattr(s, name)) == rows(getattr(plain, name)), name
        assert getattr(s, name).columns == getattr(plain, name).columns, name


def test_single_members_pass_in_place(spark):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 10 = 0 THEN concat('r', id % 300) ELSE concat('m', id) END AS member_id", "id")
    maybe = quarantine.may_repeat(quarantine.repeated_hashes(df))
    some = df.where(maybe)
    assert some.where("id % 10 = 0").count() == 2000 and some.count() < 2400
    kept = quarantine.resolve(df, "latest", maybe=maybe)
    assert rows(kept) == rows(quarantine.resolve(df, "latest"))
    assert rows(quarantine.duplicate_members(df, maybe=maybe)) == rows(quarantine.duplicate_members(df))
    bad = df.where("id % 10 = 0").select("member_id").distinct()
    out = quarantine.exclude_members(df, bad, maybe=maybe)
    assert rows(out) == rows(quarantine.exclude_members(df, bad))
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
    # too long a list for the filter: all go the plain way
    assert quarantine.may_repeat(quarantine.repeated_hashes(df), words=0) is None


def test_view_deals_no_row_of_several_tables_by_loan(spark, sf_small):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    try:
        plan = queries.customer_loan_view(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    by_loan = [line for line in plan.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning(loan_id" in line]
    assert len(by_loan) == 2, plan
    # loans with repayments are dealt once more, to their customer; nothing is after that
    assert plan.count("Exchange hashpartitioning(member_id") <= 6, plan


def test_landing_files_and_buckets_follow_the_input(spark, sf_small, monkeypatch):
    plain, seen = rows(queries.landing_quarantine(spark, sf_small)), []
    real = queries.landing.quarantine_landing

    def follow(spark, source, *args, **kw):
        seen.append((len(spark.read.parquet(source).inputFiles()), kw["max_files_per_trigger"]))
        return real(spark, source, *args, **kw)

    monkeypatch.setattr(queries.landing, "quarantine_landing", follow)
    size = sum(n for _, n, _ in queries.file_state(spark, f"{sf_small}/orders.parquet"))
    monkeypatch.setattr(queries, "LANDING_BYTES", -(-size // 12))
    assert rows(queries.landing_quarantine(spark, sf_small)) == plain
    assert seen == [(12, 4)]

    made, write = [], catalog.materialise_bucketed
    monkeypatch.setattr(catalog, "materialise_bucketed", lambda spark, df, name, by, n, path: made.append(n) or write(spark, df, name, by, n, path))
    keyed = sum(n for _, n, _ in queries.file_state(spark, queries._mst(spark, sf_small).stored("keyed")))
    monkeypatch.setattr(queries, "BUCKET_BYTES", -(-keyed // 10))
    out = queries.customer_loan_bucketed(spark, sf_small)
    assert out.count() == queries.customer_loan_relation(spark, sf_small).count()
    assert set(made) == {10}


def test_sketches_of_parts_come_from_one_scan(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS few")
    tables = profile.own_columns(df, "t")
    parts = profile.column_sketches(df, tables, by=df.id % 2)
    assert parts.count() == 4
    assert parts._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    merged = {r.column_name: r for r in profile.sketch_estimates(profile.merge_sketches(parts)).collect()}
    assert all(r.row_count == 5000 for r in merged.values())
    assert merged["few"].distinct_estimate == 7 and abs(merged["id"].distinct_estimate - 5000) < 200
