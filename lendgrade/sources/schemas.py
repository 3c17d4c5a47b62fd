"""Declared schemas of the raw application table and the entity tables.

Entity CSVs are read with these schemas, which bind by position (the header
line is skipped, not matched), so the loans and repayments readers rename
columns as they read.
"""

from __future__ import annotations

# Identity columns hashed into the member key, in hashing order (fixed).
IDENTITY_COLUMNS = (
    "emp_title",
    "emp_length",
    "home_ownership",
    "annual_inc",
    "zip_code",
    "addr_state",
    "grade",
    "sub_grade",
    "verification_status",
)

# Raw application columns each entity takes, with output names (fixed).
CUSTOMER_SPLIT = (
    ("member_id", "member_id"),
    ("emp_title", "emp_title"),
    ("emp_length", "emp_length"),
    ("home_ownership", "home_ownership"),
    ("annual_inc", "annual_inc"),
    ("addr_state", "addr_state"),
    ("zip_code", "zip_code"),
    ("country", "country"),
    ("grade", "grade"),
    ("sub_grade", "sub_grade"),
    ("verification_status", "verification_status"),
    ("tot_hi_cred_lim", "tot_hi_cred_lim"),
    ("application_type", "application_type"),
    ("annual_inc_joint", "annual_inc_joint"),
    ("verification_status_joint", "verification_status_joint"),
)
LOAN_SPLIT = (
    ("id", "loan_id"),
    ("member_id", "member_id"),
    ("loan_amnt", "loan_amnt"),
    ("funded_amnt", "funded_amnt"),
    ("term", "term"),
    ("int_rate", "int_rate"),
    ("installment", "installment"),
    ("issue_d", "issue_d"),
    ("loan_status", "loan_status"),
    ("purpose", "purpose"),
    ("title", "title"),
)
REPAYMENT_SPLIT = (
    ("id", "loan_id"),
    ("total_rec_prncp", "total_rec_prncp"),
    ("total_rec_int", "total_rec_int"),
    ("total_rec_late_fee", "total_rec_late_fee"),
    ("total_pymnt", "total_pymnt"),
    ("last_pymnt_amnt", "last_pymnt_amnt"),
    ("last_pymnt_d", "last_pymnt_d"),
    ("next_pymnt_d", "next_pymnt_d"),
)
DEFAULTER_SPLIT = (
    ("member_id", "member_id"),
    ("delinq_2yrs", "delinq_2yrs"),
    ("delinq_amnt", "delinq_amnt"),
    ("pub_rec", "pub_rec"),
    ("pub_rec_bankruptcies", "pub_rec_bankruptcies"),
    ("inq_last_6mths", "inq_last_6mths"),
    ("total_rec_late_fee", "total_rec_late_fee"),
    ("mths_since_last_delinq", "mths_since_last_delinq"),
    ("mths_since_last_record", "mths_since_last_record"),
)

# Typed entity schemas as the cleaning stage reads them (fixed DDL).
CUSTOMERS_DDL = (
    "member_id string, emp_title string, emp_length string, home_ownership string, "
    "annual_inc float, addr_state string, zip_code string, country string, grade string, "
    "sub_grade string, verification_status string, tot_hi_cred_lim float, "
    "application_type string, annual_inc_joint float, verification_status_joint string"
)
LOANS_DDL = (
    "loan_id string, member_id string, loan_amount float, funded_amount float, "
    "loan_term_months string, interest_rate float, monthly_installment float, "
    "issue_date string, loan_status string, loan_purpose string, loan_title string"
)
REPAYMENTS_DDL = (
    "loan_id string, total_principal_received float, total_interest_received float, "
    "total_late_fee_received float, total_payment_received float, last_payment_amount float, "
    "last_payment_date string, next_payment_date string"
)
DEFAULTERS_DDL = (
    "member_id string, delinq_2yrs float, delinq_amnt float, pub_rec float, "
    "pub_rec_bankruptcies float, inq_last_6mths float, total_rec_late_fee float, "
    "mths_since_last_delinq float, mths_since_last_record float"
)

ENTITY_DDL = {
    "customers": CUSTOMERS_DDL,
    "loans": LOANS_DDL,
    "repayments": REPAYMENTS_DDL,
    "defaulters": DEFAULTERS_DDL,
}

# Cleaned (catalog) table schemas (fixed DDL).
CLEAN_CUSTOMERS_DDL = (
    "member_id string, emp_title string, emp_length int, home_ownership string, "
    "annual_income float, address_state string, address_zipcode string, address_country string, "
    "grade string, sub_grade string, verification_status string, total_high_credit_limit float, "
    "application_type string, join_annual_income float, verification_status_joint string, "
    "ingest_date timestamp"
)
CLEAN_LOANS_DDL = (
    "loan_id string, member_id string, loan_amount float, funded_amount float, "
    "loan_term_years int, interest_rate float, monthly_installment float, issue_date string, "
    "loan_status string, loan_purpose string, loan_title string, ingest_date timestamp"
)
CLEAN_REPAYMENTS_DDL = (
    "loan_id string, total_principal_received float, total_interest_received float, "
    "total_late_fee_received float, total_payment_received float, last_payment_amount float, "
    "last_payment_date string, next_payment_date string, ingest_date timestamp"
)
DELINQ_DDL = "member_id string, delinq_2yrs int, delinq_amnt float, mths_since_last_delinq int"
DETAIL_DDL = "member_id string, pub_rec int, pub_rec_bankruptcies int, inq_last_6mths int"

CATALOG_DDL = {
    "customers": CLEAN_CUSTOMERS_DDL,
    "loans": CLEAN_LOANS_DDL,
    "loans_repayments": CLEAN_REPAYMENTS_DDL,
    "loans_defaulters_delinq": DELINQ_DDL,
    "loans_defaulters_detail_rec_enq": DETAIL_DDL,
}


# Columns of few values, raw or cleaned: their histograms are exact. The others
# (ids, amounts, free text) have sketches.
CODED_COLUMNS = (
    "emp_length",
    "home_ownership",
    "addr_state",
    "address_state",
    "country",
    "address_country",
    "grade",
    "sub_grade",
    "verification_status",
    "verification_status_joint",
    "application_type",
    "term",
    "loan_term_years",
    "issue_d",
    "issue_date",
    "loan_status",
    "purpose",
    "loan_purpose",
    "last_pymnt_d",
    "last_payment_date",
    "next_pymnt_d",
    "next_payment_date",
    "delinq_2yrs",
    "pub_rec",
    "pub_rec_bankruptcies",
    "inq_last_6mths",
    "mths_since_last_delinq",
    "mths_since_last_record",
)
