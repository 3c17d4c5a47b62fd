"""Loan score: three weighted point groups and an A-F grade.

Join plan (all equi-joins, Catalyst/AQE choose the physical strategy):

* payment history: repayments ⋈ loans on ``loan_id`` (a unique key), minus
  quarantined members (left-anti);
* defaulters history: detail ⋈ delinquency ⋈ payment history on
  ``member_id``; the quarantined inputs are unique per member, so every join
  has a unique key on one side and the output stays linear;
* financial health: joins the member's customer row on ``member_id`` and
  takes loan status and funded amount from the same loan (carried through
  by ``loan_id``), instead of joining all loans of the member again, which
  would multiply rows for members with several loans.

Band tables are SQL CASE text (one parsed expression per component), with
thresholds as decimal literals that Spark coerces to double next to float
columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoreConfig
from ..functions.bands import band_sql, counter_bands
from .quarantine import exclude_members

PAYMENT_COMPONENTS = ("last_payment_pts", "total_payment_pts")
DEFAULTER_COMPONENTS = ("delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts")
HEALTH_COMPONENTS = ("loan_status_pts", "home_pts", "credit_limit_pts", "grade_pts")
SCORE_COLUMNS = ("payment_history_pts", "defaulters_history_pts", "financial_health_pts", "loan_score")

# Last payment against shares of the installment.
LAST_PAYMENT_BANDS = (
    ("<", "0.5", "very_bad"),
    ("<", "1.0", "very_bad"),
    ("<=", "1.0", "good"),
    ("<=", "1.5", "very_good"),
    (">", "1.5", "excellent"),
)
# At least half of the funded amount paid back, something of a
# known amount, or nothing.
TOTAL_PAYMENT_BANDS = (
    ("{paid} >= {lent} * 0.5", "very_good"),
    ("{paid} > 0 AND {lent} IS NOT NULL", "good"),
    ("coalesce({paid}, 0) = 0", "unacceptable"),
)
# Loan-status phrases (matched inside the lower-cased status).
STATUS_BANDS = (
    (("fully paid",), "excellent"),
    (("current",), "good"),
    (("in grace period",), "bad"),
    (("late (16-30 days)", "late (31-120 days)"), "very_bad"),
    (("charged off",), "unacceptable"),
)
# Home-ownership suffixes (lower-cased); NULL joins the last.
HOME_BANDS = (("own", "excellent"), ("rent", "good"), ("mortgage", "bad"), ("any", "very_bad"))
# Funded amount as a share of the credit limit.
CREDIT_LIMIT_BANDS = (
    ("0.10", "excellent"),
    ("0.20", "very_good"),
    ("0.30", "good"),
    ("0.50", "bad"),
    ("0.70", "very_bad"),
)
# Loan grades that score unacceptable.
POOR_GRADES = ("F", "G")


def _c(name: str) -> str:
    """A column name as SQL text (expressions and quoted names pass through)."""
    return name if name.startswith("`") or "(" in name else f"`{name}`"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- band expressions (SQL text) -----------------------------------------------

def _share_sql(amount: str, base: str, table, cfg: ScoreConfig, default) -> str:
    """Bands of an amount against shares of a base; the first that fits."""
    a, b = _c(amount), _c(base)
    rows = [(f"{a} {op} {b} * {share}", getattr(cfg.points, level)) for op, share, level in table]
    return band_sql(rows, default=default)


def last_payment_sql(amount: str, installment: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    return _share_sql(amount, installment, LAST_PAYMENT_BANDS, cfg, cfg.points.unacceptable)


def total_payment_sql(total: str, funded: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    names = {"paid": _c(total), "lent": _c(funded)}
    return band_sql([(rule.format(**names), getattr(cfg.points, level)) for rule, level in TOTAL_PAYMENT_BANDS])


def delinq_sql(c: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    return band_sql(counter_bands(_c(c), cfg.points, cfg.delinq_overflow))


def public_records_sql(c: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    return band_sql(counter_bands(_c(c), cfg.points, cfg.points.very_bad))


def enquiry_sql(c: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    return band_sql(counter_bands(_c(c), cfg.points, cfg.points.unacceptable))


def loan_status_sql(status: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    s = f"lower({_c(status)})"
    bands = []
    for phrases, level in STATUS_BANDS:
        cond = " OR ".join(f"contains({s}, {_lit(ph)})" for ph in phrases)
        bands.append((f"({cond})", getattr(cfg.points, level)))
    return band_sql(bands, default=cfg.points.unacceptable)


def home_sql(home: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    h = _c(home)
    bands = [(f"endswith(lower({h}), {_lit(sfx)})", getattr(cfg.points, lvl)) for sfx, lvl in HOME_BANDS]
    last_pred, last_pts = bands[-1]
    bands[-1] = (f"({last_pred} OR {h} IS NULL)", last_pts)
    return band_sql(bands)


def credit_limit_sql(funded: str, limit: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    f, l = _c(funded), _c(limit)
    bands = [(f"{f} <= ({l} * {share})", getattr(cfg.points, lvl)) for share, lvl in CREDIT_LIMIT_BANDS]
    return band_sql(bands, default=cfg.points.unacceptable)


def grade_sql(grade: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    poor = ", ".join(_lit(g) for g in POOR_GRADES)
    return band_sql([(f"{_c(grade)} IN ({poor})", cfg.points.unacceptable)], default=cfg.points.good)


# Column versions of the band expressions (for use in any select).
def last_payment_pts(amount: str, installment: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(last_payment_sql(amount, installment, cfg))


def total_payment_pts(total: str, funded: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(total_payment_sql(total, funded, cfg))


def delinq_pts(c: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(delinq_sql(c, cfg))


def public_records_pts(c: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(public_records_sql(c, cfg))


def enquiry_pts(c: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(enquiry_sql(c, cfg))


def loan_status_pts(status: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(loan_status_sql(status, cfg))


def home_pts(home: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(home_sql(home, cfg))


def credit_limit_pts(funded: str, limit: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(credit_limit_sql(funded, limit, cfg))


def grade_pts(grade: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    return F.expr(grade_sql(grade, cfg))


def _fill(sql: str, cfg: ScoreConfig) -> str:
    if cfg.null_component == "unacceptable":
        return f"coalesce({sql}, CAST({int(cfg.points.unacceptable)} AS INT))"
    return sql


def _as(sql: str, name: str, cfg: ScoreConfig) -> str:
    return f"{_fill(sql, cfg)} AS {name}"


# ---- point tables -----------------------------------------------------------------

def payment_history_points(
    repayments: DataFrame,
    loans: DataFrame,
    bad: DataFrame | None = None,
    cfg: ScoreConfig = DEFAULT_CONFIG,
    carry: tuple[str, ...] = (),
    maybe: Column | None = None,
) -> DataFrame:
    """member_id, loan_id, last_payment_pts, total_payment_pts (+ ``carry``
    loan columns) for every repaid loan of a non-quarantined member."""
    if bad is not None:
        loans = exclude_members(loans, bad, maybe=maybe)
    needed = ["loan_id", "member_id", "monthly_installment", "funded_amount"]
    l = loans.select(*needed, *[c for c in carry if c not in needed])
    p = repayments.select("loan_id", "last_payment_amount", "total_payment_received")
    j = p.join(l, "loan_id", "inner")
    return j.selectExpr(
        "member_id",
        "loan_id",
        _as(last_payment_sql("last_payment_amount", "monthly_installment", cfg), "last_payment_pts", cfg),
        _as(total_payment_sql("total_payment_received", "funded_amount", cfg), "total_payment_pts", cfg),
        *[_c(c) for c in carry],
    )


def default_history_points(
    detail: DataFrame,
    delinq: DataFrame,
    ph: DataFrame,
    cfg: ScoreConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Quarantined (one row per member) detail and delinquency tables give
    payment points plus delinquency, public record, bankruptcy and
    enquiry points, for members present in all three inputs (or, with
    ``population="all"``, also members without delinquency rows)."""
    d = delinq.select("member_id", "delinq_2yrs")
    if cfg.population == "delinquent":
        j = detail.join(d, "member_id", "inner").join(ph, "member_id", "inner")
        delinq_count = "delinq_2yrs"
    else:  # members without a delinquency row have none
        j = detail.join(d, "member_id", "left").join(ph, "member_id", "inner")
        delinq_count = "coalesce(`delinq_2yrs`, 0)"
    return j.selectExpr(
        *[_c(c) for c in ph.columns],
        _as(delinq_sql(delinq_count, cfg), "delinq_pts", cfg),
        _as(public_records_sql("pub_rec", cfg), "public_records_pts", cfg),
        _as(public_records_sql("pub_rec_bankruptcies", cfg), "public_bankruptcies_pts", cfg),
        _as(enquiry_sql("inq_last_6mths", cfg), "enq_pts", cfg),
    )


def financial_health_points(
    pts: DataFrame,
    loans: DataFrame | None,
    customers: DataFrame,
    cfg: ScoreConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """Adds loan status, home ownership, credit limit and grade points.

    Loan columns come from ``pts`` when carried there, else from ``loans``
    joined on ``loan_id``; the customer row is joined on ``member_id``.
    """
    base_cols = [c for c in pts.columns if c not in ("loan_status", "funded_amount")]
    if loans is not None and not {"loan_status", "funded_amount"} <= set(pts.columns):
        pts = pts.join(loans.select("loan_id", "loan_status", "funded_amount"), "loan_id", "inner")
    a = customers.select("member_id", "home_ownership", "total_high_credit_limit", "grade")
    j = pts.join(a, "member_id", "inner")
    return j.selectExpr(
        *[_c(c) for c in base_cols],
        _as(loan_status_sql("loan_status", cfg), "loan_status_pts", cfg),
        _as(home_sql("home_ownership", cfg), "home_pts", cfg),
        _as(credit_limit_sql("funded_amount", "total_high_credit_limit", cfg), "credit_limit_pts", cfg),
        _as(grade_sql("grade", cfg), "grade_pts", cfg),
    )


def _weighted_sql(cols, weight) -> str:
    # exact decimal arithmetic: int points x decimal weight literal
    return f"(({' + '.join(_c(c) for c in cols)}) * {weight})"


def weighted_score(pts: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG, keys=("member_id", "loan_id")) -> DataFrame:
    """Weighted point groups (``decimal(13,2)``) and their sum
    (``decimal(15,2)``), exact."""
    w = cfg.weights
    ph = _weighted_sql(PAYMENT_COMPONENTS, w.payment_history)
    dh = _weighted_sql(DEFAULTER_COMPONENTS, w.defaulters_history)
    fh = _weighted_sql(HEALTH_COMPONENTS, w.financial_health)
    keys = [k for k in keys if k in pts.columns]
    return pts.selectExpr(
        *[_c(k) for k in keys],
        f"CAST({ph} AS DECIMAL(13,2)) AS payment_history_pts",
        f"CAST({dh} AS DECIMAL(13,2)) AS defaulters_history_pts",
        f"CAST({fh} AS DECIMAL(13,2)) AS financial_health_pts",
        f"CAST({ph} + {dh} + {fh} AS DECIMAL(15,2)) AS loan_score",
    )


def grade_sql_text(score: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> str:
    c = cfg.cutoffs
    s = _c(score)
    return (
        f"CASE WHEN {s} > {c.very_good} THEN 'A' WHEN {s} > {c.good} THEN 'B' "
        f"WHEN {s} > {c.bad} THEN 'C' WHEN {s} > {c.very_bad} THEN 'D' "
        f"WHEN {s} > {c.unacceptable} THEN 'E' ELSE 'F' END"
    )


def grade_column(score: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> Column:
    """A-F by strict cut-offs; a NULL score falls through to F."""
    return F.expr(grade_sql_text(score, cfg))


def final_grade(scored: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """Adds the grade, and ``score_incomplete``: the score is NULL since a
    component had no band, so its F is not a judgement of the loan."""
    return scored.withColumns(
        {"loan_final_grade": grade_column("loan_score", cfg), "score_incomplete": F.col("loan_score").isNull()}
    )


def loan_score(
    repayments: DataFrame,
    loans: DataFrame,
    customers_new: DataFrame,
    delinq_new: DataFrame,
    detail_new: DataFrame,
    bad: DataFrame,
    cfg: ScoreConfig = DEFAULT_CONFIG,
) -> DataFrame:
    """The whole scoring chain over cleaned, quarantined tables.

    ``customers_new``, ``delinq_new`` and ``detail_new`` already exclude
    quarantined members, so the only anti join needed is on loans.
    """
    ph = payment_history_points(repayments, loans, bad, cfg, carry=("loan_status", "funded_amount"))
    ldh = default_history_points(detail_new, delinq_new, ph, cfg)
    fh = financial_health_points(ldh, None, customers_new, cfg)
    return final_grade(weighted_score(fh, cfg), cfg)
