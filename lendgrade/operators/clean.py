"""Cleaning operators for the four entity tables.

Each is a lazy ``DataFrame -> DataFrame`` chain of built-in expressions. The
only shuffles are the whole-row ``distinct`` of customers (hash aggregate with
map-side combine, so a hot duplicated row collapses before the exchange) and
the scalar mean used to fill ``emp_length`` (a one-row partial/final
aggregate planned as a scalar subquery; no driver round trip).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import digits_to_int, in_lookup, longer_than, null_if_zero_text
from ..sources.schemas import CUSTOMERS_DDL, DEFAULTERS_DDL, LOANS_DDL, REPAYMENTS_DDL

# The loan purposes kept as they are; any other purpose
# becomes "other".
LOAN_PURPOSES = (
    "debt_consolidation",
    "credit_card",
    "home_improvement",
    "other",
    "major_purchase",
    "medical",
    "small_business",
    "car",
    "vacation",
    "moving",
    "house",
    "wedding",
    "renewable_energy",
    "educational",
)

# Customer column renames (source -> cleaned name).
CUSTOMER_RENAMES = {
    "annual_inc": "annual_income",
    "addr_state": "address_state",
    "zip_code": "address_zipcode",
    "country": "address_country",
    "tot_hi_cred_lim": "total_high_credit_limit",
    "annual_inc_joint": "join_annual_income",
}

# Columns without which a row is dropped (loans, repayments), and
# the counters of the detail table.
LOAN_REQUIRED = (
    "loan_amount",
    "funded_amount",
    "loan_term_months",
    "interest_rate",
    "monthly_installment",
    "issue_date",
    "loan_status",
    "loan_purpose",
)
REPAYMENT_REQUIRED = (
    "total_principal_received",
    "total_interest_received",
    "total_late_fee_received",
    "total_payment_received",
    "last_payment_amount",
)
DETAIL_COUNTERS = ("pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")


def _ddl_fields(ddl: str) -> list[tuple[str, str]]:
    """Names and types of a DDL schema; commas inside types do not part fields."""
    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl).fields]


def typed(df: DataFrame, ddl: str) -> DataFrame:
    """Bind columns by position to a DDL schema, like a CSV read with a schema.

    Unparsable values become NULL (permissive), never an error.
    """
    fields = _ddl_fields(ddl)
    if len(fields) != len(df.columns):
        raise ValueError(f"expected {len(fields)} columns for schema, got {len(df.columns)}: {df.columns}")
    exprs = []
    for (src, have), (name, typ) in zip(df.dtypes, fields):
        c = f"`{src}`" if have == typ else f"try_cast(`{src}` AS {typ})"
        exprs.append(f"{c} AS `{name}`")
    return df.selectExpr(*exprs)


def rename_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Rename columns; with ``strict`` an unknown source name is an error
    (Spark's own rename silently ignores it)."""
    missing = [old for old in mapping if old not in df.columns]
    if strict and missing:
        raise KeyError(f"cannot rename missing columns {missing}; have {df.columns}")
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def ingest_column(ingest_ts: _dt.datetime | str | None = None) -> Column:
    """One ingestion timestamp for the whole run; pass it in to make reruns
    and multiple sinks agree."""
    if ingest_ts is None:
        return F.current_timestamp()
    return F.lit(ingest_ts).cast("timestamp")


def run_timestamp(spark) -> str:
    """The time now, as text that ``ingest_column`` takes: fixed once, it is
    the same in every table of a run."""
    return spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]


def impute_mean_floor(df: DataFrame, column: str) -> DataFrame:
    """Fill NULLs of ``column`` with floor(mean(column)) over ``df``.

    The mean is a scalar subquery: Spark runs a one-row partial/final
    aggregate and inlines the value, without collecting to Python. An
    all-NULL column leaves NULLs in place.
    """
    dtype = dict(df.dtypes)[column]
    mean = df.select(F.floor(F.avg(column))).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean.cast(dtype)))


def customers_deduplicated(df: DataFrame, maybe: Column | None = None) -> DataFrame:
    """Typed and renamed customers, whole-row duplicates removed, rows
    without income dropped (emp_length and state still raw). Rows that
    ``maybe`` (``quarantine.may_repeat``) rules out equal no other."""
    out = typed(df, CUSTOMERS_DDL)
    out = rename_columns(out, CUSTOMER_RENAMES)
    out = out.distinct() if maybe is None else out.where(maybe).distinct().unionByName(out.where(~maybe))
    return out.where(F.col("annual_income").isNotNull())


def clean_customers(df: DataFrame, ingest_ts=None, maybe: Column | None = None) -> DataFrame:
    """Typed, renamed, de-duplicated customers with income, numeric
    employment length (NULL -> floor of mean) and 2-letter states."""
    out = customers_deduplicated(df, maybe)
    out = out.withColumn("emp_length", digits_to_int("emp_length"))
    out = impute_mean_floor(out, "emp_length")
    out = out.withColumn("address_state", longer_than("address_state", 2, "NA"))
    return out.withColumn("ingest_date", ingest_column(ingest_ts))


def clean_loans(df: DataFrame, purposes: Iterable[str] = LOAN_PURPOSES, ingest_ts=None) -> DataFrame:
    """Typed loans without NULLs in required columns, term in whole years,
    purposes outside the lookup folded into 'other'."""
    out = typed(df, LOANS_DDL)
    out = out.na.drop(how="any", subset=list(LOAN_REQUIRED))
    years = F.floor(digits_to_int("loan_term_months") / 12).cast("int")
    out = rename_columns(out.withColumn("loan_term_months", years), {"loan_term_months": "loan_term_years"})
    out = out.withColumn("loan_purpose", in_lookup("loan_purpose", purposes, "other"))
    return out.withColumn("ingest_date", ingest_column(ingest_ts))


def repaired_total_payment() -> Column:
    """Total payment, rebuilt from its parts when it is 0 but principal is not."""
    return F.expr(
        "CASE WHEN total_principal_received != 0.0 AND total_payment_received = 0.0 "
        "THEN total_principal_received + total_interest_received + total_late_fee_received "
        "ELSE total_payment_received END"
    )


def clean_repayments(df: DataFrame, ingest_ts=None) -> DataFrame:
    """Typed repayments: no NULL amounts, repaired totals, zero totals
    dropped, '0.0' placeholder dates turned into NULL."""
    out = typed(df, REPAYMENTS_DDL)
    out = out.na.drop(how="any", subset=list(REPAYMENT_REQUIRED))
    out = out.withColumn("total_payment_received", repaired_total_payment())
    out = out.where(F.col("total_payment_received") != 0.0)
    out = out.withColumn("last_payment_date", null_if_zero_text("last_payment_date"))
    out = out.withColumn("next_payment_date", null_if_zero_text("next_payment_date"))
    return out.withColumn("ingest_date", ingest_column(ingest_ts))


def clean_defaulters(df: DataFrame) -> DataFrame:
    """Typed defaulter rows with delinq_2yrs as int (NULL -> 0)."""
    out = typed(df, DEFAULTERS_DDL)
    out = out.withColumn("delinq_2yrs", F.col("delinq_2yrs").try_cast("int"))
    return out.na.fill(0, subset=["delinq_2yrs"])


def all_present(columns: Iterable[str]) -> Column:
    """None of the columns is NULL."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def inconsistent_payments(df: DataFrame) -> DataFrame:
    """Typed repayment rows with all amounts whose total payment is 0 although
    principal was received: what ``clean_repayments`` repairs."""
    out = typed(df, REPAYMENTS_DDL).where(all_present(REPAYMENT_REQUIRED))
    return out.where((F.col("total_payment_received") == 0.0) & (F.col("total_principal_received") != 0.0))


def is_delinquent() -> Column:
    return (F.col("delinq_2yrs") > 0) | (F.col("mths_since_last_delinq") > 0)


def has_records_or_enquiries() -> Column:
    return (F.col("pub_rec") > 0.0) | (F.col("pub_rec_bankruptcies") > 0.0) | (F.col("inq_last_6mths") > 0.0)


def delinquent_members(defaulters: DataFrame) -> DataFrame:
    """Rows with any delinquency (count or months since last)."""
    return defaulters.where(is_delinquent()).select(
        "member_id",
        "delinq_2yrs",
        "delinq_amnt",
        F.col("mths_since_last_delinq").try_cast("int").alias("mths_since_last_delinq"),
    )


def records_or_enquiry_members(defaulters: DataFrame) -> DataFrame:
    """Members with public records, bankruptcies or recent enquiries."""
    return defaulters.where(has_records_or_enquiries()).select("member_id")


def record_enquiry_detail(defaulters: DataFrame) -> DataFrame:
    """All rows (one per application), three counters as int, NULL -> 0."""
    out = defaulters.withColumns({c: F.col(c).try_cast("int") for c in DETAIL_COUNTERS})
    out = out.na.fill(0, subset=list(DETAIL_COUNTERS))
    return out.select("member_id", *DETAIL_COUNTERS)
