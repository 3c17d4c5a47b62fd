"""End-to-end staged job at sf0.001: tables, catalog, invariants."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lendgrade.config import Layout
from lendgrade.plans.batch import run_batch
from lendgrade.plans.stages import Stages
from lendgrade.sources.fixture import raw_applications


@pytest.fixture(scope="module")
def batch(spark, sf_small):
    root = tempfile.mkdtemp(prefix="lendgrade-batch-")
    res = run_batch(spark, raw_applications(spark, sf_small), Layout(root), ingest_ts="2024-01-01 00:00:00", database="lg_test")
    return res


def test_batch_score_equals_lazy_plan(spark, sf_small, batch):
    staged = batch.table(spark, "loan_score")
    lazy = Stages.from_testdata(spark, sf_small).loan_score
    assert staged.count() == lazy.count() == 1208
    assert staged.exceptAll(lazy).count() == 0 and lazy.exceptAll(staged).count() == 0


def test_batch_invariants(spark, batch):
    bad = batch.table(spark, "bad_customer_data_final")
    for t in ("customers_new", "loans_defaulters_delinq_new", "loans_defaulters_detail_rec_enq_new", "loan_score"):
        assert batch.table(spark, t).join(bad, "member_id", "left_semi").count() == 0, t
    for t in ("customers_new", "loans_defaulters_delinq_new", "loans_defaulters_detail_rec_enq_new"):
        assert batch.table(spark, t).groupBy("member_id").count().where("count > 1").count() == 0, t
    s = batch.table(spark, "loan_score")
    assert s.where((F.col("loan_score") < 0) | (F.col("loan_score") > 2745)).count() == 0
    # grade is monotone in score: each grade's score range lies above the next one's
    ranges = {
        r.loan_final_grade: (r.lo, r.hi)
        for r in s.where("loan_score is not null").groupBy("loan_final_grade").agg(F.min("loan_score").alias("lo"), F.max("loan_score").alias("hi")).collect()
    }
    order = [g for g in "ABCDEF" if g in ranges]
    for hi_g, lo_g in zip(order, order[1:]):
        assert ranges[hi_g][0] > ranges[lo_g][1]
    assert s.where("loan_score is null and loan_final_grade <> 'F'").count() == 0


def test_batch_quarantine_audit(spark, batch):
    reasons = spark.read.parquet(batch.tables["bad_customer_data_final"].replace("_final", "_reasons"))
    final = batch.table(spark, "bad_customer_data_final")
    assert reasons.count() == final.count() == 45
    assert reasons.where("reasons = ''").count() == 0


def test_batch_view_and_csv_copies(spark, batch):
    v = spark.table("lg_test.customers_loan_v")
    t = batch.table(spark, "customers_loan_t")
    assert len(v.columns) == 35 and v.count() == t.count() == batch.table(spark, "customers_new").count()
    from lendgrade.sources.readers import read_written_csv
    from lendgrade.sources.schemas import CLEAN_CUSTOMERS_DDL

    csv = read_written_csv(spark, batch.tables["customers"].replace("_parquet", "_csv"), CLEAN_CUSTOMERS_DDL)
    stored = batch.table(spark, "customers")
    assert csv.count() == stored.count()
    # both copies hold the same rows, the ingestion timestamp included
    assert csv.exceptAll(stored).count() == 0 and stored.exceptAll(csv).count() == 0
    assert csv.select("ingest_date").distinct().count() == 1


def test_second_root_is_scored_from_its_own_tables(spark, sf_small, tmp_path):
    """Same database, another root, half the input: no table of the first run
    is read, and the catalog follows."""
    raw = raw_applications(spark, sf_small)
    run_batch(spark, raw, Layout(str(tmp_path / "a")), database="lg_two", csv_copies=False)
    half = run_batch(spark, raw.where("id % 2 = 0"), Layout(str(tmp_path / "b")), database="lg_two", csv_copies=False)
    lazy = Stages(raw.where("id % 2 = 0")).loan_score
    assert half.table(spark, "loan_score").count() == lazy.count() < 1208
    assert spark.table("lg_two.customers").count() == spark.read.parquet(half.tables["customers"]).count()
    # without a time given, one time holds for the whole run
    times = {
        r[0]
        for t in ("customers", "loans", "loans_repayments")
        for r in spark.read.parquet(half.tables[t]).select("ingest_date").distinct().collect()
    }
    assert len(times) == 1
    # a managed table of the name is never dropped
    from lendgrade.plans import catalog

    spark.sql("CREATE TABLE lg_two.own (x int) USING parquet")
    with pytest.raises(ValueError):
        catalog.register_external_table(spark, "lg_two.own", "member_id string", half.tables["customers"])
    spark.sql("DROP DATABASE lg_two CASCADE")


def test_csv_copies_lose_nothing(spark, tmp_path):
    from lendgrade.plans import sinks
    from lendgrade.sources.readers import CORRUPT, read_written_csv

    texts = ["", " lead", "trail ", 'a "quote"', "comma,semi;", "line\nbreak\r\n", "back\\slash", "\\n", "\\N", "\\s", "\ttab", None, "ünï", "''", '"']
    ddl = "id int, t string, v double, w timestamp"
    df = spark.createDataFrame([(i, t, None if i % 3 else i / 7, None) for i, t in enumerate(texts)], ddl)
    df = df.withColumn("w", F.timestamp_micros(F.lit(1700000000123456)))
    sinks.write_csv(df, str(tmp_path / "c"))
    back = read_written_csv(spark, str(tmp_path / "c"), ddl)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    # broken rows fail the read, or are set aside with their text
    spark.createDataFrame([("id,t,v,w",), ("x,y",)], "value string").coalesce(1).write.text(str(tmp_path / "broken"))
    with pytest.raises(Exception):
        read_written_csv(spark, str(tmp_path / "broken"), ddl).collect()
    odd = read_written_csv(spark, str(tmp_path / "broken"), ddl, corrupt=True)
    assert [r[CORRUPT] for r in odd.collect()] == ["x,y"]


def test_batch_rerun_is_idempotent(spark, sf_small, batch):
    root = batch.tables["loan_score"].rsplit("/processed/", 1)[0]
    res2 = run_batch(spark, raw_applications(spark, sf_small), Layout(root), ingest_ts="2024-01-01 00:00:00", database="lg_test", csv_copies=False)
    assert res2.table(spark, "loan_score").count() == 1208


def test_stage_folder_cleanup(spark, sf_small):
    import os

    s = Stages.from_testdata(spark, sf_small, materialize=True)
    assert s.keyed.count() == 1500
    local = s.run_dir.replace("file:", "")
    assert os.path.isdir(local)
    s.cleanup()
    assert not os.path.exists(local)


def _files(root):
    import os

    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if not f.startswith(".")}


def test_failed_run_is_taken_up_and_readers_never_see_a_gap(spark, sf_small, tmp_path, monkeypatch):
    import os

    from lendgrade.plans import batch as job
    from lendgrade.plans import sinks

    root = str(tmp_path / "r")
    raw = raw_applications(spark, sf_small)
    run = lambda df: run_batch(spark, df, Layout(root), database="lg_restart", csv_copies=False)

    # the fourth stage fails: three are committed, nothing is published
    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(job.view, "customer_loan", broken)
        with pytest.raises(RuntimeError):
            run(raw)
    assert not spark.catalog.databaseExists("lg_restart")
    before = _files(root)
    first = run(raw)
    assert (first.skipped, first.written) == (["land", "clean", "quarantine"], ["relate", "score"])
    after = _files(root)
    assert all(after[f] == t for f, t in before.items() if f.endswith(".parquet"))  # the committed stages are untouched
    assert len({r[0] for t in ("customers", "loans") for r in spark.read.parquet(first.tables[t]).select("ingest_date").distinct().collect()}) == 1
    assert first.table(spark, "loan_score").count() == 1208

    # a run over other rows: whoever reads while it writes sees the old tables
    seen = []
    put = sinks.write_parquet

    def watched(df, path, *a, **k):
        seen.append((spark.table("lg_restart.loan_score").count(), spark.table("lg_restart.customers").count()))
        put(df, path, *a, **k)
        seen.append((spark.table("lg_restart.loan_score").count(), spark.table("lg_restart.customers").count()))

    old = (1208, spark.table("lg_restart.customers").count())
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_parquet", watched)
        second = run(raw.where("id % 2 = 0"))
    assert second.written == ["land", "clean", "quarantine", "relate", "score"] and set(seen) == {old}
    assert spark.table("lg_restart.loan_score").count() < 1208
    assert spark.table("lg_restart.customers_loan_v").count() == spark.table("lg_restart.customers_loan_t").count()

    # a published run is not taken up again; of the runs before, one stays
    third = run(raw)
    assert third.skipped == []
    assert not os.path.exists(first.tables["loan_score"]) and os.path.exists(second.tables["loan_score"])
    spark.sql("DROP DATABASE lg_restart CASCADE")


def test_stage_with_missing_folders_is_written_again(spark, tmp_path):
    from lendgrade.plans import commits

    run = commits.open_run(spark, str(tmp_path), "s", "2024-01-01 00:00:00")
    wrote = []

    def write():
        path = run.versioned(f"{tmp_path}/t")
        spark.range(3).write.mode("overwrite").parquet(path)
        wrote.append(path)
        return [path]

    run.stage("one", write)
    run.stage("one", write)
    assert len(wrote) == 1 and run.skipped == ["one"]
    (tmp_path / "t" / f"run={run.id}" / "_SUCCESS").unlink()  # a folder that is not whole
    run.stage("one", write)
    assert len(wrote) == 2
    # the run is known by its input; another input, or none, opens another
    assert commits.open_run(spark, str(tmp_path), "s", "x").id == run.id
    assert commits.open_run(spark, str(tmp_path), "s", "x").ingest_ts == "2024-01-01 00:00:00"
    assert len({commits.open_run(spark, str(tmp_path), s, "x").id for s in ("t", None, None)} | {run.id}) == 4
    frame = spark.createDataFrame([(1,)], "x int")
    assert commits.input_state(frame) is None


def test_batch_follows_the_record_policy(spark, sf_small, tmp_path):
    from lendgrade.config import ScoreConfig

    latest = ScoreConfig(record_policy="latest")
    res = run_batch(spark, raw_applications(spark, sf_small), Layout(str(tmp_path)), latest, database="lg_latest", csv_copies=False)
    want = Stages.shared(spark, sf_small, latest).loan_score
    got = res.table(spark, "loan_score")
    assert got.count() == want.count() > 1208 and got.exceptAll(want).count() == 0
    # another policy over the same input is another run
    again = run_batch(spark, raw_applications(spark, sf_small), Layout(str(tmp_path)), database="lg_latest", csv_copies=False)
    assert again.skipped == [] and again.table(spark, "loan_score").count() == 1208
    spark.sql("DROP DATABASE lg_latest CASCADE")
