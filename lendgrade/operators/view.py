"""Consolidated customer-loan relation (one row per customer and loan).

Built over the quarantined tables: after quarantine every member has at most
one customer, delinquency and detail row, so the left-join chain grows
linearly with the data. Over the raw tables the same chain would pair every
customer row of a repeated member with every loan, delinquency and detail
row of it (n^4 rows for n applications), which we do not build.

Loans of quarantined members are removed with a left-anti join before the
left join: the anti join can split a hot member across tasks (AQE skew
handling on its streamed side), while a left outer join cannot split its
build side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quarantine import exclude_members

# Columns of the consolidated relation, by source table.
CUSTOMER_VIEW_COLUMNS = (
    "member_id",
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_income",
    "address_state",
    "address_zipcode",
    "address_country",
    "grade",
    "sub_grade",
    "verification_status",
    "total_high_credit_limit",
    "application_type",
    "join_annual_income",
    "verification_status_joint",
)
LOAN_VIEW_COLUMNS = (
    "loan_amount",
    "funded_amount",
    "loan_term_years",
    "interest_rate",
    "monthly_installment",
    "issue_date",
    "loan_status",
    "loan_purpose",
)
REPAYMENT_VIEW_COLUMNS = (
    "total_principal_received",
    "total_interest_received",
    "total_late_fee_received",
    "last_payment_date",
    "next_payment_date",
)
DELINQ_VIEW_COLUMNS = ("delinq_2yrs", "delinq_amnt", "mths_since_last_delinq")
DETAIL_VIEW_COLUMNS = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")

VIEW_COLUMNS = (
    "loan_id",
    *CUSTOMER_VIEW_COLUMNS,
    *LOAN_VIEW_COLUMNS,
    *REPAYMENT_VIEW_COLUMNS,
    *DELINQ_VIEW_COLUMNS,
    *DETAIL_VIEW_COLUMNS,
)


def customer_loan(
    customers: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    delinq: DataFrame,
    detail: DataFrame,
    bad: DataFrame,
    maybe: Column | None = None,
) -> DataFrame:
    """customers ⟕ loans ⟕ repayments ⟕ delinquency ⟕ detail, 35 columns.

    ``customers``, ``delinq`` and ``detail`` are the quarantined tables (one
    row per member); loans of the members in ``bad`` are left out here.
    """
    return customer_loan_of(customers, exclude_members(loans, bad, maybe=maybe), repayments, delinq, detail)


def customer_loan_of(customers: DataFrame, loans: DataFrame, repayments: DataFrame, delinq: DataFrame, detail: DataFrame) -> DataFrame:
    """``customer_loan`` of tables that hold no quarantined member. Loans meet
    their repayments first, then all tables meet on the member: tables that
    are bucketed by these keys stay where they are (``catalog.materialise_bucketed``)."""
    c = customers.select(*CUSTOMER_VIEW_COLUMNS)
    l = loans.select("loan_id", F.col("member_id").alias("_l_member"), *LOAN_VIEW_COLUMNS)
    r = repayments.select(F.col("loan_id").alias("_r_loan"), *REPAYMENT_VIEW_COLUMNS)
    d = delinq.select(F.col("member_id").alias("_d_member"), *DELINQ_VIEW_COLUMNS)
    e = detail.select(F.col("member_id").alias("_e_member"), *DETAIL_VIEW_COLUMNS)
    j = (
        c.join(l.join(r, l.loan_id == r._r_loan, "left"), c.member_id == l._l_member, "left")
        .join(d, c.member_id == d._d_member, "left")
        .join(e, c.member_id == e._e_member, "left")
    )
    return j.select(*VIEW_COLUMNS)
