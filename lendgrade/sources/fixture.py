"""Raw loan applications derived from the driver's TPC-H-like tables.

The test data has no loan table, so one application per order is derived,
deterministically, from ``orders ⋈ customer ⋈ nation``. Every expression is
valid Spark SQL and DuckDB SQL, so the oracle derives the identical table.

Scale: ``orders`` is the fact table; ``customer`` is joined by key with a
strategy that Spark picks from its size (a sort-merge join at scale, where AQE
splits a hot customer); ``nation`` is a 25-row dimension that it broadcasts. Everything else is a
per-row projection inside one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The derivation of each raw application column (test input
# definition, shared verbatim with the DuckDB oracle).
RAW_COLUMNS = (
    ("id", "o_orderkey"),
    ("emp_title", "case when o_orderkey % 401 = 0 then null else c_mktsegment end"),
    ("emp_length", "case when o_orderkey % 401 = 0 then null when o_custkey % 13 = 0 then null when o_custkey % 13 = 1 then 'n/a' when o_custkey % 13 = 2 then '< 1 year' when o_custkey % 13 = 12 then '10+ years' else concat(cast(o_custkey % 13 as varchar(4)), ' years') end"),
    ("home_ownership", "case when o_orderkey % 401 = 0 then null when o_custkey % 6 = 0 then 'OWN' when o_custkey % 6 = 1 then 'RENT' when o_custkey % 6 = 2 then 'MORTGAGE' when o_custkey % 6 = 3 then 'ANY' when o_custkey % 6 = 4 then 'NONE' else null end"),
    ("annual_inc", "case when o_orderkey % 401 = 0 then null when o_custkey % 29 = 0 then null when o_orderkey % 10 = 0 then cast(20000 + (o_custkey * 37) % 100000 as double) else cast(20000 + o_orderkey % 900000 as double) end"),
    ("zip_code", "case when o_orderkey % 401 = 0 then null else concat(lpad(cast(o_custkey % 1000 as varchar(4)), 3, '0'), 'xx') end"),
    ("addr_state", "case when o_orderkey % 401 = 0 then null when o_custkey % 37 = 0 then null when o_custkey % 31 = 0 then n_name else substring('CANYTXFLWA', cast(o_custkey % 5 as int) * 2 + 1, 2) end"),
    ("grade", "case when o_orderkey % 401 = 0 then null else substring('ABCDEFG', cast(o_custkey % 7 as int) + 1, 1) end"),
    ("sub_grade", "case when o_orderkey % 401 = 0 then null else concat(substring('ABCDEFG', cast(o_custkey % 7 as int) + 1, 1), cast(1 + o_custkey % 5 as varchar(4))) end"),
    ("verification_status", "case when o_orderkey % 401 = 0 then null when o_custkey % 3 = 0 then 'Verified' when o_custkey % 3 = 1 then 'Source Verified' else 'Not Verified' end"),
    ("tot_hi_cred_lim", "case when o_orderkey % 23 = 0 then null else cast(1000 + (o_orderkey * 991) % 400000 as double) end"),
    ("application_type", "case when o_orderkey % 9 = 0 then 'Joint App' else 'Individual' end"),
    ("annual_inc_joint", "case when o_orderkey % 9 = 0 then cast(40000 + o_orderkey % 50000 as double) else null end"),
    ("verification_status_joint", "case when o_orderkey % 9 = 0 then 'Verified' else null end"),
    ("loan_amnt", "case when o_orderkey % 211 = 0 then null else cast(1000 + (o_orderkey * 7) % 39000 as double) end"),
    ("funded_amnt", "cast(1000 + (o_orderkey * 7) % 39000 as double)"),
    ("term", "case when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end"),
    ("int_rate", "cast(5 + o_orderkey % 25 as double)"),
    ("installment", "cast(50 + o_orderkey % 900 as double)"),
    ("issue_d", "cast(cast(o_orderdate as date) as varchar(10))"),
    ("loan_status", "case when o_orderkey % 8 = 0 then 'Fully Paid' when o_orderkey % 8 = 1 then 'Current' when o_orderkey % 8 = 2 then 'In Grace Period' when o_orderkey % 8 = 3 then 'Late (16-30 days)' when o_orderkey % 8 = 4 then 'Late (31-120 days)' when o_orderkey % 8 = 5 then 'Charged Off' when o_orderkey % 8 = 6 then 'Default' else 'Does not meet the credit policy. Status:Fully Paid' end"),
    ("purpose", "case when o_orderkey % 5 = 0 then 'car' when o_orderkey % 5 = 1 then 'medical' when o_orderkey % 5 = 2 then 'debt_consolidation' when o_orderkey % 5 = 3 then 'free text purpose' else 'wedding' end"),
    ("title", "o_orderpriority"),
    ("total_rec_prncp", "case when o_orderkey % 197 = 0 then null when o_orderkey % 12 = 0 then 0.0e0 else cast(100 + (o_orderkey * 11) % 30000 as double) end"),
    ("total_rec_int", "cast(o_orderkey % 500 as double)"),
    ("total_rec_late_fee", "case when o_orderkey % 17 = 0 then 15.0e0 else 0.0e0 end"),
    ("total_pymnt", "case when o_orderkey % 6 = 0 then 0.0e0 else cast(100 + (o_orderkey * 11) % 30000 + o_orderkey % 500 as double) end"),
    ("last_pymnt_amnt", "case when o_orderkey % 7 = 0 then cast(50 + o_orderkey % 900 as double) when o_orderkey % 7 = 1 then cast(10 + o_orderkey % 30 as double) when o_orderkey % 7 = 2 then cast(50 + o_orderkey % 900 as double) * 0.75e0 when o_orderkey % 7 = 3 then cast(50 + o_orderkey % 900 as double) * 1.25e0 else cast(50 + o_orderkey % 900 as double) * 3e0 end"),
    ("last_pymnt_d", "case when o_orderkey % 19 = 0 then '0.0' when o_orderkey % 19 = 1 then null else cast(cast(o_orderdate as date) as varchar(10)) end"),
    ("next_pymnt_d", "case when o_orderkey % 21 = 0 then '0.0' when o_orderkey % 2 = 1 then null else 'Jan-2019' end"),
    ("delinq_2yrs", "case when o_orderkey % 14 = 0 then null else cast(o_orderkey % 8 as double) end"),
    ("delinq_amnt", "cast((o_orderkey % 4) * 100 as double)"),
    ("pub_rec", "case when o_orderkey % 15 = 0 then null else cast((o_orderkey * 5) % 7 as double) end"),
    ("pub_rec_bankruptcies", "case when o_orderkey % 16 = 0 then null else cast((o_orderkey * 3) % 7 as double) end"),
    ("inq_last_6mths", "case when o_orderkey % 18 = 0 then null else cast(floor(o_orderkey / 8) % 8 as double) end"),
    ("mths_since_last_delinq", "case when o_orderkey % 3 = 0 then null else cast(o_orderkey % 80 as double) end"),
    ("mths_since_last_record", "case when o_orderkey % 5 <> 0 then null else cast(o_orderkey % 100 as double) end"),
)

RAW_COLUMN_NAMES = tuple(name for name, _ in RAW_COLUMNS)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide raw application table (no member key yet)."""
    orders = read_driver_table(spark, sf_dir, "orders")
    customer = read_driver_table(spark, sf_dir, "customer")
    nation = read_driver_table(spark, sf_dir, "nation")
    # no hints: AQE joins customer by its measured size, by sort-merge (with
    # skewed customers split) beyond the broadcast threshold
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner").join(
        nation, customer.c_nationkey == nation.n_nationkey, "inner"
    )
    return joined.selectExpr(*[f"{expr} as {name}" for name, expr in RAW_COLUMNS])
