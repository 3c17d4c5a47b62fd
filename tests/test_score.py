"""Band edges, NULL and unreachable branches of every score component."""

from decimal import Decimal

from lendgrade.config import ScoreConfig
from lendgrade.operators import score


def _one(spark, expr, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    return [r.v for r in df.select(expr.alias("v")).collect()]


def test_last_payment_bands(spark):
    inst = 100.0
    amounts = [10.0, 50.0, 99.0, 100.0, 120.0, 150.0, 151.0, None]
    out = _one(
        spark,
        score.last_payment_pts("a", "i"),
        [(a, inst) for a in amounts],
        "a float, i float",
    )
    assert out == [100, 100, 100, 500, 650, 650, 800, 0]


def test_total_payment_bands(spark):
    out = _one(
        spark,
        score.total_payment_pts("t", "f"),
        [(t, 100.0) for t in (50.0, 49.0, 0.01, 0.0, None, -5.0)],
        "t float, f float",
    )
    assert out == [650, 500, 500, 0, 0, None]


def test_counter_bands(spark):
    vals = [0, 1, 2, 3, 5, 6, None, -1]
    rows = [(v,) for v in vals]
    assert _one(spark, score.delinq_pts("c"), rows, "c int") == [800, 250, 250, 100, 100, 750, 750, None]
    assert _one(spark, score.public_records_pts("c"), rows, "c int") == [800, 250, 250, 100, 100, 100, 100, None]
    assert _one(spark, score.enquiry_pts("c"), rows, "c int") == [800, 250, 250, 100, 100, 0, 0, None]


def test_delinq_overflow_override(spark):
    cfg = ScoreConfig(delinq_overflow_pts=0)
    assert _one(spark, score.delinq_pts("c", cfg), [(9,)], "c int") == [0]


def test_loan_status_bands(spark):
    statuses = [
        "Fully Paid",
        "Current",
        "In Grace Period",
        "Late (16-30 days)",
        "Late (31-120 days)",
        "Charged Off",
        "Default",
        "Does not meet the credit policy. Status:Fully Paid",
        None,
    ]
    out = _one(spark, score.loan_status_pts("s"), [(s,) for s in statuses], "s string")
    assert out == [800, 500, 250, 100, 100, 0, 0, 800, 0]


def test_home_bands(spark):
    homes = ["OWN", "RENT", "MORTGAGE", "ANY", None, "NONE", "OTHER"]
    out = _one(spark, score.home_pts("h"), [(h,) for h in homes], "h string")
    assert out == [800, 500, 250, 100, 100, None, None]


def test_credit_limit_bands(spark):
    limit = 1000.0
    funded = [100.0, 101.0, 200.0, 300.0, 500.0, 700.0, 701.0]
    rows = [(f, limit) for f in funded] + [(100.0, None)]
    out = _one(spark, score.credit_limit_pts("f", "l"), rows, "f float, l float")
    assert out == [800, 650, 650, 500, 250, 100, 0, 0]


def test_grade_bands(spark):
    out = _one(spark, score.grade_pts("g"), [("F",), ("G",), ("A",), (None,)], "g string")
    assert out == [0, 0, 500, 500]


def test_grade_cutoffs_and_null(spark):
    scores = [2745.0, 2500.01, 2500.0, 2000.0, 1500.0, 1000.0, 750.01, 750.0, 0.0, None]
    out = _one(spark, score.grade_column("s"), [(s,) for s in scores], "s double")
    assert out == ["A", "A", "B", "C", "D", "E", "E", "F", "F", "F"]


def test_weighted_score_max_and_exact(spark):
    cols = list(score.PAYMENT_COMPONENTS + score.DEFAULTER_COMPONENTS + score.HEALTH_COMPONENTS)
    best = [800, 650, 800, 800, 800, 800, 800, 800, 800, 500]
    df = spark.createDataFrame([("m", "l", *best)], "member_id string, loan_id string, " + ", ".join(f"{c} int" for c in cols))
    r = score.weighted_score(df).first()
    assert (r.payment_history_pts, r.defaulters_history_pts, r.financial_health_pts) == (290.0, 1440.0, 1015.0)
    assert r.loan_score == 2745.0
    # exact decimal arithmetic before the cast: 0.20 * 1 etc. do not drift
    assert Decimal(str(r.loan_score)) == Decimal("2745")


def test_null_component_makes_grade_f_or_is_filled(spark):
    cols = list(score.PAYMENT_COMPONENTS + score.DEFAULTER_COMPONENTS + score.HEALTH_COMPONENTS)
    vals = [800, 650, 800, 800, 800, 800, 800, None, 800, 500]  # home_pts NULL
    df = spark.createDataFrame([("m", "l", *vals)], "member_id string, loan_id string, " + ", ".join(f"{c} int" for c in cols))
    r = score.final_grade(score.weighted_score(df)).first()
    assert r.loan_score is None and r.loan_final_grade == "F"


def _tables(spark):
    loans = spark.createDataFrame(
        [("L1", "m1", 1000.0, 100.0, "Fully Paid"), ("L2", "m2", 1000.0, 100.0, "Current"), ("L3", "bad", 1000.0, 100.0, "Current")],
        "loan_id string, member_id string, funded_amount float, monthly_installment float, loan_status string",
    )
    reps = spark.createDataFrame(
        [("L1", 160.0, 600.0), ("L2", 100.0, 100.0), ("L3", 100.0, 100.0)],
        "loan_id string, last_payment_amount float, total_payment_received float",
    )
    cust = spark.createDataFrame(
        [("m1", "OWN", 20000.0, "A"), ("m2", "NONE", 20000.0, "B")],
        "member_id string, home_ownership string, total_high_credit_limit float, grade string",
    )
    delinq = spark.createDataFrame([("m1", 0)], "member_id string, delinq_2yrs int")
    detail = spark.createDataFrame([("m1", 0, 0, 0), ("m2", 1, 0, 6)], "member_id string, pub_rec int, pub_rec_bankruptcies int, inq_last_6mths int")
    bad = spark.createDataFrame([("bad",)], "member_id string")
    return reps, loans, cust, delinq, detail, bad


def test_loan_score_chain_and_population_option(spark):
    reps, loans, cust, delinq, detail, bad = _tables(spark)
    out = {r.member_id: r for r in score.loan_score(reps, loans, cust, delinq, detail, bad).collect()}
    # m2 has no delinquency row -> dropped under the published population
    assert sorted(out) == ["m1"]
    assert out["m1"].loan_score == 2745.0 and out["m1"].loan_final_grade == "A"
    allpop = ScoreConfig(population="all", null_component="unacceptable")
    out2 = {r.member_id: r for r in score.loan_score(reps, loans, cust, delinq, detail, bad, allpop).collect()}
    assert sorted(out2) == ["m1", "m2"]
    # m2: last=500 total=500 -> 200; delinq 0->800, pub 1->250, bankr 0->800, enq 6->0 -> 1850*0.45=832.5
    # status current 500, home NONE -> unacceptable 0, credit 100/20000 -> 800, grade B 500 -> 1800*0.35=630
    assert out2["m2"].loan_score == 200.0 + 832.5 + 630.0
