"""Catalog objects: database, external Parquet tables, view, CTAS table.

All DDL is idempotent (IF NOT EXISTS / OR REPLACE / overwrite), so a rerun
of a stage does not fail on objects left by the previous run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.view import (
    CUSTOMER_VIEW_COLUMNS,
    DELINQ_VIEW_COLUMNS,
    DETAIL_VIEW_COLUMNS,
    LOAN_VIEW_COLUMNS,
    REPAYMENT_VIEW_COLUMNS,
)


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION {_q(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def _location(spark: SparkSession, qualified: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}").collect()
    return next((r["data_type"] for r in rows if r["col_name"] == "Location"), "")


def _qualified_path(spark: SparkSession, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString().rstrip("/")


def register_external_table(spark: SparkSession, qualified: str, ddl: str, location: str) -> DataFrame:
    """An external Parquet table over existing files (columns bind by name).

    A table of this name that is registered with another location or schema
    is registered anew; it is external, so no files go. A managed table of
    this name is an error, since dropping it would delete its data.
    """
    if spark.catalog.tableExists(qualified):
        kind = spark.catalog.getTable(qualified).tableType
        fields = [(f.name, f.dataType) for f in spark.table(qualified).schema.fields]
        same = fields == [(f.name, f.dataType) for f in StructType.fromDDL(ddl).fields]
        if not same or _qualified_path(spark, _location(spark, qualified)) != _qualified_path(spark, location):
            if kind != "EXTERNAL":
                raise ValueError(f"{qualified} exists as a {kind.lower()} table")
            spark.sql(f"DROP TABLE {qualified}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified} ({ddl}) USING parquet LOCATION {_q(location)}")
    # a rerun overwrites the files under an existing table: drop cached listings
    spark.catalog.refreshTable(qualified)
    return spark.table(qualified)


def publish_table(spark: SparkSession, qualified: str, ddl: str, location: str) -> DataFrame:
    """Point a table at another folder of committed files.

    An external table of this schema only changes its location, in one step of
    the catalog, so a reader sees the old rows or the new, never none. A table
    that is absent, or has another schema, is registered anew.
    """
    if spark.catalog.tableExists(qualified) and spark.catalog.getTable(qualified).tableType == "EXTERNAL":
        fields = [(f.name, f.dataType) for f in spark.table(qualified).schema.fields]
        if fields == [(f.name, f.dataType) for f in StructType.fromDDL(ddl).fields]:
            spark.sql(f"ALTER TABLE {qualified} SET LOCATION {_q(location)}")
            spark.catalog.refreshTable(qualified)
            return spark.table(qualified)
    return register_external_table(spark, qualified, ddl, location)


def ddl_of(df: DataFrame) -> str:
    """The schema of a frame as DDL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def customer_loan_view_sql(db: str, view: str = "customers_loan_v") -> str:
    """SQL text of the consolidated view over the quarantined tables. Loans
    meet their repayments first, and then all tables meet on the member: no
    row of several tables is dealt out again."""
    cols = (
        ["l.loan_id"]
        + [f"c.{c}" for c in CUSTOMER_VIEW_COLUMNS]
        + [f"l.{c}" for c in LOAN_VIEW_COLUMNS + REPAYMENT_VIEW_COLUMNS]
        + [f"d.{c}" for c in DELINQ_VIEW_COLUMNS]
        + [f"e.{c}" for c in DETAIL_VIEW_COLUMNS]
    )
    return f"""
CREATE OR REPLACE VIEW {db}.{view} AS
SELECT {', '.join(cols)}
FROM {db}.customers_new c
LEFT JOIN (
    SELECT x.*, {', '.join(f"r.{c}" for c in REPAYMENT_VIEW_COLUMNS)}
    FROM (
        SELECT y.* FROM {db}.loans y
        LEFT ANTI JOIN {db}.bad_customer_data_final b ON y.member_id = b.member_id
    ) x
    LEFT JOIN {db}.loans_repayments r ON x.loan_id = r.loan_id
) l ON c.member_id = l.member_id
LEFT JOIN {db}.loans_defaulters_delinq_new d ON c.member_id = d.member_id
LEFT JOIN {db}.loans_defaulters_detail_rec_enq_new e ON c.member_id = e.member_id
"""


def create_customer_loan_view(spark: SparkSession, db: str, view: str = "customers_loan_v") -> DataFrame:
    spark.sql(customer_loan_view_sql(db, view))
    return spark.table(f"{db}.{view}")


def materialise(spark: SparkSession, df: DataFrame, qualified: str, location: str | None = None) -> DataFrame:
    """CTAS equivalent that can be rerun: overwrite the table's data."""
    w = df.write.mode("overwrite").format("parquet")
    if location:
        w = w.option("path", location)
    w.saveAsTable(qualified)
    return spark.table(qualified)


def materialise_bucketed(spark: SparkSession, df: DataFrame, qualified: str, by: str, buckets: int, location: str | None = None) -> DataFrame:
    """A table stored in ``buckets`` by the hash of ``by``, sorted within each.

    Tables of equal buckets join on ``by`` without a shuffle, every time they
    are read. One shuffle before the write gives each bucket one file.
    """
    w = df.repartition(buckets, by).write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by)
    if location:
        w = w.option("path", location)
    w.saveAsTable(qualified)
    return spark.table(qualified)
