"""Score components on random inputs vs a direct Python evaluation of the
published rules (first match wins; float columns compared in double)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lendgrade.operators import score

P = dict(unacceptable=0, very_bad=100, bad=250, good=500, very_good=650, excellent=800)


def f32(x):
    return None if x is None else float(np.float32(x))


def ref_last(a, i):
    if a is None or i is None:
        return 0
    if a < i * 0.5:
        return 100
    if a >= i * 0.5 and a < i:
        return 100
    if a == i:
        return 500
    if a > i and a <= i * 1.5:
        return 650
    if a > i * 1.5:
        return 800
    return 0


def ref_total(t, f):
    if t is not None and f is not None and t >= f * 0.5:
        return 650
    if t is not None and f is not None and t < f * 0.5 and t > 0:
        return 500
    if t is None or t == 0:
        return 0
    return None


def ref_credit(f, lim):
    if f is None or lim is None:
        return 0
    for share, pts in ((0.10, 800), (0.20, 650), (0.30, 500), (0.50, 250), (0.70, 100)):
        if f <= lim * share:
            return pts
    return 0


def ref_counter(c, overflow):
    if c is None or c > 5:
        return overflow
    if c == 0:
        return 800
    if 1 <= c <= 2:
        return 250
    if 3 <= c <= 5:
        return 100
    return None


money = st.one_of(st.none(), st.integers(-50, 4000).map(lambda x: x / 4))
count = st.one_of(st.none(), st.integers(-2, 9))
row = st.tuples(money, money, money, money, money, count)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=20, max_size=80))
def test_components_match_rules(spark, rows):
    # add exact band edges: installment multiples and credit-limit shares
    edges = [(50.0, 100.0, 50.0, 100.0, 10.0, 0), (150.0, 100.0, 0.0, 100.0, 1000.0, 5), (100.0, 100.0, 70.0, 0.0, 100.0, 6)]
    rows = [tuple(f32(v) if i < 5 else v for i, v in enumerate(r)) for r in rows + edges]
    df = spark.createDataFrame(rows, "a float, i float, t float, f float, lim float, c int")
    out = df.select(
        score.last_payment_pts("a", "i").alias("last"),
        score.total_payment_pts("t", "f").alias("total"),
        score.credit_limit_pts("f", "lim").alias("credit"),
        score.delinq_pts("c").alias("delinq"),
        score.enquiry_pts("c").alias("enq"),
    ).collect()
    for r, o in zip(rows, out):
        a, i, t, f, lim, c = r
        assert o.last == ref_last(a, i), r
        assert o.total == ref_total(t, f), r
        assert o.credit == ref_credit(f, lim), r
        assert o.delinq == ref_counter(c, 750), r
        assert o.enq == ref_counter(c, 0), r
