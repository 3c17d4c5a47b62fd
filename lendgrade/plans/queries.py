"""Driver queries: one lazily built DataFrame per covered capability.

Each builder takes ``(spark, sf_dir)`` and reads the driver's parquet
tables (orders, customer, nation) through the raw-application derivation,
so the work of every query grows with the data. Builders that exercise
sinks and catalog objects write to a fresh folder under the shared folder
(``spark.checkpoint.dir``) and return the table read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScoreConfig
from ..functions.columns import EMPTY_IDENTITY_KEY
from ..operators import audit, clean, entities, profile, quarantine
from ..operators.view import customer_loan, customer_loan_of
from ..session import drop_at_exit, file_state, fresh_dir
from ..sources.readers import read_csv, read_entity_csv_checked, read_written_csv, read_written_entity_csv
from ..sources.schemas import CATALOG_DDL, CODED_COLUMNS, CUSTOMERS_DDL, IDENTITY_COLUMNS, LOANS_DDL, REPAYMENTS_DDL
from ..streaming import landing
from . import catalog, sinks
from .stages import Stages

Builder = Callable[[SparkSession, str], DataFrame]


def _st(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages.from_testdata(spark, sf_dir)


def _mst(spark: SparkSession, sf_dir: str) -> Stages:
    """Stages for multi-branch queries: written once for all queries."""
    return Stages.shared(spark, sf_dir)


def _no_ingest(df: DataFrame) -> DataFrame:
    return df.drop("ingest_date")


# -- raw table and member key ---------------------------------------------------------

def raw_applications(spark, sf_dir):
    return _st(spark, sf_dir).raw


def member_key(spark, sf_dir):
    return _st(spark, sf_dir).keyed.select("id", "member_id")


def key_cardinality(spark, sf_dir):
    return _st(spark, sf_dir).keyed.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("member_id").alias("distinct_keys")
    )


def duplicate_keys_ranked(spark, sf_dir):
    return quarantine.duplicate_keys_ranked(_st(spark, sf_dir).keyed)


def blank_identity_rows(spark, sf_dir):
    k = _st(spark, sf_dir).keyed
    return k.where(F.col("member_id") == EMPTY_IDENTITY_KEY).select("id", "member_id", *IDENTITY_COLUMNS)


def key_prefix_rows(spark, sf_dir):
    """Rows whose key starts like that of the all-NULL identity."""
    k = _st(spark, sf_dir).keyed
    return k.where(F.col("member_id").startswith(EMPTY_IDENTITY_KEY[:17])).select("id", "member_id")


# -- entity split and CSV round trip --------------------------------------------------

def split_customers(spark, sf_dir):
    return _st(spark, sf_dir).split["customers"]


def split_loans(spark, sf_dir):
    return _st(spark, sf_dir).split["loans"]


def split_repayments(spark, sf_dir):
    return _st(spark, sf_dir).split["repayments"]


def split_defaulters(spark, sf_dir):
    return _st(spark, sf_dir).split["defaulters"]


def _csv_roundtrip(spark, sf_dir, entity: str) -> DataFrame:
    path = fresh_dir(spark, f"csv-{entity}")
    sinks.write_csv(_st(spark, sf_dir).split[entity], path)
    return read_written_entity_csv(spark, path, entity)


def csv_roundtrip_customers(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "customers")


def csv_roundtrip_loans(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "loans")


def csv_roundtrip_repayments(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "repayments")


def csv_roundtrip_defaulters(spark, sf_dir):
    return _csv_roundtrip(spark, sf_dir, "defaulters")


def csv_inferred_defaulters(spark, sf_dir):
    """A foreign CSV (Spark's own writer, no encoding) read with inferred types."""
    path = fresh_dir(spark, "csv-inferred")
    _st(spark, sf_dir).split["defaulters"].write.mode("overwrite").option("header", True).csv(path)
    return read_csv(spark, path, infer=True)


def _broken_lines(df: DataFrame, faults: dict[str, str], cut: str, longer: str | None = None) -> DataFrame:
    """Lines of a foreign CSV without header: values replaced where ``faults``
    say so (column -> CASE arms), lines cut short or with a field too many
    under the conditions ``cut`` and ``longer``."""
    fields = [f"coalesce(CAST(CASE {faults[c]} ELSE CAST(`{c}` AS STRING) END AS STRING), '')" if c in faults else f"coalesce(CAST(`{c}` AS STRING), '')" for c in df.columns]
    whole, short = f"concat_ws(',', {', '.join(fields)})", f"concat_ws(',', {', '.join(fields[:3])})"
    more = f"WHEN {longer} THEN concat({whole}, ',x') " if longer else ""
    return df.selectExpr(f"CASE WHEN {cut} THEN {short} {more}ELSE {whole} END AS value")


def _foreign(spark, sf_dir) -> dict[str, DataFrame]:
    """Foreign files of repayments and defaulters with broken rows, read with
    the reasons against them."""
    split = _st(spark, sf_dir).split
    lines = {
        "repayments": _broken_lines(split["repayments"], {"total_pymnt": "WHEN total_rec_int = 9 THEN 'n/a'"}, "total_rec_int = 7", "total_rec_int = 8"),
        "defaulters": _broken_lines(split["defaulters"], {"mths_since_last_record": "WHEN delinq_amnt = 300 THEN 'long ago'"}, "inq_last_6mths = 5"),
    }
    out = {}
    for name, df in lines.items():
        path = fresh_dir(spark, f"foreign-{name}")
        df.write.mode("overwrite").text(path)
        out[name] = read_entity_csv_checked(spark, path, name, header=False)
    return out


def csv_audit_counts(spark, sf_dir):
    """Rows of foreign files by the reason against them."""
    return audit.audit_counts(_union([audit.audit_list(rows, name) for name, rows in _foreign(spark, sf_dir).items()]))


def csv_accepted_repayments(spark, sf_dir):
    return audit.accepted(_foreign(spark, sf_dir)["repayments"])


def csv_accepted_defaulters(spark, sf_dir):
    return audit.accepted(_foreign(spark, sf_dir)["defaulters"])


# -- cleaning -------------------------------------------------------------------------

def clean_customers(spark, sf_dir):
    return _no_ingest(_st(spark, sf_dir).customers)


def emp_length_values(spark, sf_dir):
    return clean.customers_deduplicated(_st(spark, sf_dir).split["customers"]).select("emp_length").distinct()


def state_values(spark, sf_dir):
    return _st(spark, sf_dir).customers.select("address_state").distinct()


def long_state_count(spark, sf_dir):
    c = clean.customers_deduplicated(_st(spark, sf_dir).split["customers"])
    return c.agg(F.count_if(F.length("address_state") > 2).alias("long_states"))


def clean_loans(spark, sf_dir):
    return _no_ingest(_st(spark, sf_dir).loans)


def purpose_counts_top(spark, sf_dir):
    return profile.value_counts(_st(spark, sf_dir).loans, "loan_purpose")


def clean_repayments(spark, sf_dir):
    return _no_ingest(_st(spark, sf_dir).repayments)


def invalid_payment_rows(spark, sf_dir):
    """Counts of inconsistent payment rows before and after the repair."""
    r = clean.typed(_st(spark, sf_dir).split["repayments"], REPAYMENTS_DDL)
    r = r.na.drop(how="any", subset=list(clean.REPAYMENT_REQUIRED))
    t, p = F.col("total_payment_received"), F.col("total_principal_received")
    kept = clean.repaired_total_payment() != 0.0
    zero_last = F.col("last_payment_date").try_cast("double") == 0.0
    zero_next = F.col("next_payment_date").try_cast("double") == 0.0
    return r.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(t == 0.0).alias("zero_total"),
        F.count_if((t == 0.0) & (p != 0.0)).alias("zero_total_with_principal"),
        F.count_if(kept & zero_last).alias("zero_last_date"),
        F.count_if(kept & zero_next).alias("zero_next_date"),
        F.count_if(kept & F.col("last_payment_date").isNull()).alias("null_last_date"),
        F.count_if(kept & F.col("next_payment_date").isNull()).alias("null_next_date"),
    )


def delinquency_histogram(spark, sf_dir):
    """The report's first 40 lines (a top-k report)."""
    return profile.value_counts(_st(spark, sf_dir).defaulters, "delinq_2yrs", top=40)


def delinquency_counts(spark, sf_dir):
    return profile.value_counts(_st(spark, sf_dir).defaulters, "delinq_2yrs")


def unpaid_with_principal(spark, sf_dir):
    """The repayment rows whose total is 0 although principal was received."""
    return clean.inconsistent_payments(_st(spark, sf_dir).split["repayments"])


def delinquent_members(spark, sf_dir):
    return _st(spark, sf_dir).delinq


def records_or_enquiry_members(spark, sf_dir):
    return _st(spark, sf_dir).records_enq


def record_enquiry_detail(spark, sf_dir):
    return _st(spark, sf_dir).detail


# -- quarantine -----------------------------------------------------------------------

def duplicates_customers(spark, sf_dir):
    return _st(spark, sf_dir).dup_customers


def duplicates_delinq(spark, sf_dir):
    return _st(spark, sf_dir).dup_delinq


def duplicates_detail(spark, sf_dir):
    return _st(spark, sf_dir).dup_detail


def quarantine_all_rows(spark, sf_dir):
    s = _mst(spark, sf_dir)
    return quarantine.quarantine_all_rows(s.dup_customers, s.dup_delinq, s.dup_detail)


def quarantine_members(spark, sf_dir):
    return _mst(spark, sf_dir).bad


def _duplicates(s: Stages) -> dict[str, DataFrame]:
    return {
        "customers": s.dup_customers,
        "loans_defaulters_delinq": s.dup_delinq,
        "loans_defaulters_detail_rec_enq": s.dup_detail,
    }


def quarantine_reasons(spark, sf_dir):
    return quarantine.quarantine_reasons(_duplicates(_mst(spark, sf_dir)))


def quarantine_audit(spark, sf_dir):
    """The audit lists as written and read back, with the table of each."""
    root = fresh_dir(spark, "audit")
    lists = _duplicates(_mst(spark, sf_dir))
    sinks.write_quarantine(lists, lambda name: f"{root}/{name}")
    out = None
    for name, ids in lists.items():
        part = spark.read.schema(ids.schema).parquet(f"{root}/{name}").select(F.lit(name).alias("table_name"), "member_id")
        out = part if out is None else out.unionByName(part)
    return out


#: One application per member instead of none of the repeated ones.
LATEST = ScoreConfig(record_policy="latest")


def latest_applications(spark, sf_dir):
    """The applications under the policy ``latest``."""
    return Stages.shared(spark, sf_dir, LATEST).applications


def quarantine_latest(spark, sf_dir):
    return Stages.shared(spark, sf_dir, LATEST).bad


def loan_score_latest(spark, sf_dir):
    """The graded score with one application of every member."""
    return _as_doubles(Stages.shared(spark, sf_dir, LATEST).loan_score)


#: Bytes of orders per file of a landing batch (a raw application is several
#: times as wide as its order).
LANDING_BYTES = 8 * 1024 * 1024


def landing_quarantine(spark, sf_dir):
    """The members that repeat, found by the stream over a landing folder whose
    files arrive in three batches: of one file each, or of as many as the input
    fills, so that none grows with it."""
    root = fresh_dir(spark, "landing")
    orders = sum(size for _, size, _ in file_state(spark, f"{sf_dir.rstrip('/')}/orders.parquet"))
    files = max(1, -(-orders // (3 * LANDING_BYTES)))
    _st(spark, sf_dir).raw.repartition(3 * files, "id").write.mode("overwrite").parquet(f"{root}/in")
    query = landing.quarantine_landing(spark, f"{root}/in", f"{root}/out", f"{root}/state", fmt="parquet", max_files_per_trigger=files)
    query.awaitTermination()
    return landing.read_repeated(spark, f"{root}/out")


def exclude_customers(spark, sf_dir):
    return _no_ingest(_mst(spark, sf_dir).customers_new)


def exclude_delinq(spark, sf_dir):
    return _mst(spark, sf_dir).delinq_new


def exclude_detail(spark, sf_dir):
    return _mst(spark, sf_dir).detail_new


def exclude_loans(spark, sf_dir):
    """Loans of the members that are not quarantined, by a filter of the list."""
    s = _mst(spark, sf_dir)
    return _no_ingest(quarantine.exclude_members_filtered(s.loans, s.bad))


# -- catalog objects and the consolidated view ----------------------------------------

def publish_catalog(spark: SparkSession, s: Stages) -> str:
    """The cleaned and quarantined tables of one input as external tables of a
    database; returns its name. Published once per input and application: the
    stages that are written already are registered where they lie, the others
    are written beside them."""
    if s.database:
        return s.database
    db = f"lendgrade_{uuid.uuid4().hex[:10]}"
    drop_at_exit(spark, db)  # with the scratch that its tables lie in
    catalog.create_database(spark, db, f"{s.run_dir}/{db}.db")
    tables = {
        "customers": s.stored("customers"),
        "loans": s.stored("loans"),
        "loans_repayments": s.stored("repayments"),
        "loans_defaulters_delinq": s.stored("delinq"),
        "loans_defaulters_detail_rec_enq": s.stored("detail"),
        "bad_customer_data_final": s.stored("bad"),
        "customers_new": s.stored("customers_new"),
        "loans_defaulters_delinq_new": s.stored("delinq_new"),
        "loans_defaulters_detail_rec_enq_new": s.stored("detail_new"),
    }
    for name, path in tables.items():
        ddl = CATALOG_DDL.get(name.removesuffix("_new"), "member_id string")
        catalog.register_external_table(spark, f"{db}.{name}", ddl, path)
    s.database = db
    return db


def customer_loan_relation(spark, sf_dir):
    return _mst(spark, sf_dir).customer_loan


def customer_loan_view(spark, sf_dir):
    db = publish_catalog(spark, _mst(spark, sf_dir))
    return catalog.create_customer_loan_view(spark, db)


def customer_loan_table(spark, sf_dir):
    s = _mst(spark, sf_dir)
    db = publish_catalog(spark, s)
    t = lambda n: spark.table(f"{db}.{n}")
    rel = customer_loan(
        t("customers_new"),
        t("loans"),
        t("loans_repayments"),
        t("loans_defaulters_delinq_new"),
        t("loans_defaulters_detail_rec_enq_new"),
        t("bad_customer_data_final"),
        s.may_repeat,
    )
    # a table of this call's own: another call's rows may still be read
    name = f"customers_loan_t_{uuid.uuid4().hex[:10]}"
    return catalog.materialise(spark, rel, f"{db}.{name}", fresh_dir(spark, name))


#: Bytes of written applications per bucket: a bucket is sorted in memory.
BUCKET_BYTES = 32 * 1024 * 1024


def customer_loan_bucketed(spark, sf_dir, buckets: int = 8):
    """The consolidated relation over tables bucketed by their join keys, in
    ``buckets`` at least and one for each ``BUCKET_BYTES`` of applications."""
    s = _mst(spark, sf_dir)
    keyed = sum(size for _, size, _ in file_state(spark, s.stored("keyed")))
    buckets = max(buckets, -(-keyed // BUCKET_BYTES))
    root = fresh_dir(spark, "bucketed")
    db = f"lendgrade_{uuid.uuid4().hex[:10]}"
    drop_at_exit(spark, db)
    catalog.create_database(spark, db, f"{root}/{db}.db")
    tables = {
        "customers_new": (s.customers_new, "member_id"),
        "loans_new": (quarantine.exclude_members_filtered(s.loans, s.bad), "loan_id"),
        "loans_repayments": (s.repayments, "loan_id"),
        "loans_defaulters_delinq_new": (s.delinq_new, "member_id"),
        "loans_defaulters_detail_rec_enq_new": (s.detail_new, "member_id"),
    }
    stored = [catalog.materialise_bucketed(spark, df, f"{db}.{name}", by, buckets, f"{root}/{name}") for name, (df, by) in tables.items()]
    return customer_loan_of(*stored)


def customer_loan_csv(spark, sf_dir):
    """The consolidated relation from the CSV half of the dual sink."""
    root = fresh_dir(spark, "customers_loan_dual")
    written = sinks.write_dual(_mst(spark, sf_dir).customer_loan, f"{root}/parquet", f"{root}/csv")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in written.schema.fields)
    return read_written_csv(spark, f"{root}/csv", ddl)


# -- scoring --------------------------------------------------------------------------

def payment_history_points(spark, sf_dir):
    return _mst(spark, sf_dir).payment_points


def default_history_points(spark, sf_dir):
    return _mst(spark, sf_dir).default_points


def financial_health_points(spark, sf_dir):
    return _mst(spark, sf_dir).health_points


def _as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type that both engines return alike."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def weighted_score(spark, sf_dir):
    return _as_doubles(_mst(spark, sf_dir).weighted)


def loan_score(spark, sf_dir):
    return _as_doubles(_mst(spark, sf_dir).loan_score)


def grade_distribution(spark, sf_dir):
    return _mst(spark, sf_dir).loan_score.groupBy("loan_final_grade").agg(F.count(F.lit(1)).alias("total"))


# -- profiles -------------------------------------------------------------------------

def quality_profile(spark, sf_dir):
    return profile.null_profiles(_st(spark, sf_dir).keyed, entities.entity_columns())


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cleaned_profile(spark, sf_dir):
    """NULLs by column after the repairs."""
    s = _mst(spark, sf_dir)
    tables = {
        "customers": _no_ingest(s.customers),
        "loans": _no_ingest(s.loans),
        "loans_repayments": _no_ingest(s.repayments),
        "loans_defaulters_delinq": s.delinq,
        "loans_defaulters_detail_rec_enq": s.detail,
    }
    return _union([profile.null_profile(df, name) for name, df in tables.items()])


def _steps(s: Stages) -> dict[str, list[tuple[DataFrame, profile.Tables]]]:
    """What is profiled in each step: the raw split as columns of one frame,
    then the cleaned tables."""
    raw = s.keyed.withColumn("country", F.lit(entities.DEFAULT_COUNTRY))
    shown = {t: {c: src or c for c, src in cols.items()} for t, cols in entities.entity_columns().items()}
    cleaned = {
        "customers": _no_ingest(s.customers),
        "loans": _no_ingest(s.loans),
        "loans_repayments": _no_ingest(s.repayments),
        "loans_defaulters_delinq": s.delinq,
        "loans_defaulters_detail_rec_enq": s.detail,
    }
    return {"raw": [(raw, shown)], "cleaned": [(df, profile.own_columns(df, name)) for name, df in cleaned.items()]}


def _coded(tables: profile.Tables) -> profile.Tables:
    return {t: {c: src for c, src in cols.items() if c in CODED_COLUMNS} for t, cols in tables.items()}


def _per_step(spark, sf_dir, make) -> DataFrame:
    parts = []
    for step, frames in _steps(_mst(spark, sf_dir)).items():
        parts += [make(df, tables).withColumn("step", F.lit(step)) for df, tables in frames]
    return _union(parts)


def value_histograms(spark, sf_dir):
    """Rows per value of every coded column, in the raw split and when cleaned."""
    return _per_step(spark, sf_dir, lambda df, tables: profile.value_histogram(df, _coded(tables)))


def distinct_counts(spark, sf_dir):
    """Distinct values of every column, in the raw split and when cleaned."""
    return _per_step(spark, sf_dir, lambda df, tables: profile.distinct_counts(profile.value_histogram(df, tables)))


def distinct_estimates(spark, sf_dir):
    """The sketches' distinct estimates held against the exact counts. The
    sketches are made of two halves of the rows and merged."""

    def halves(df: DataFrame, tables: profile.Tables) -> DataFrame:
        half = F.pmod(F.xxhash64(*df.columns[:3]), F.lit(2))
        return profile.sketch_estimates(profile.merge_sketches(profile.column_sketches(df, tables, by=half)))

    guess = _per_step(spark, sf_dir, halves).select("step", "table_name", "column_name", "distinct_estimate")
    both = distinct_counts(spark, sf_dir).join(guess, ["step", "table_name", "column_name"])
    within = profile.within_error(F.col("distinct_estimate"), F.col("distinct_count"))
    return both.select("step", "table_name", "column_name", "row_count", "distinct_count", within.alias("within_error"))


def step_counts(spark, sf_dir):
    """Rows before and after each cleaning step: one aggregate per source."""
    s = _mst(spark, sf_dir)
    customers = clean.rename_columns(clean.typed(s.split["customers"], CUSTOMERS_DDL), clean.CUSTOMER_RENAMES)
    loans = clean.typed(s.split["loans"], LOANS_DDL)
    repayments = clean.typed(s.split["repayments"], REPAYMENTS_DDL)
    full = clean.all_present(clean.REPAYMENT_REQUIRED)
    return _union(
        [
            profile.conditional_counts(s.split["customers"], "customers", {"raw": None}),
            profile.conditional_counts(customers.distinct(), "customers", {"distinct": None, "with_income": F.col("annual_income").isNotNull()}),
            profile.conditional_counts(loans, "loans", {"raw": None, "complete": clean.all_present(clean.LOAN_REQUIRED)}),
            profile.conditional_counts(
                repayments, "loans_repayments", {"raw": None, "complete": full, "nonzero_total": full & (clean.repaired_total_payment() != 0.0)}
            ),
            profile.conditional_counts(
                s.defaulters, "loans_defaulters", {"raw": None, "delinquent": clean.is_delinquent(), "records_or_enquiries": clean.has_records_or_enquiries()}
            ),
        ]
    )


def key_profile(spark, sf_dir):
    s = _mst(spark, sf_dir)
    tables = {
        "raw_applications": s.keyed,
        "customers": s.customers,
        "loans_defaulters_delinq": s.delinq,
        "loans_defaulters_detail_rec_enq": s.detail,
        "customers_new": s.customers_new,
        "loans_defaulters_delinq_new": s.delinq_new,
        "loans_defaulters_detail_rec_enq_new": s.detail_new,
    }
    return _union([profile.key_profile(df, name) for name, df in tables.items()])


QUERIES: dict[str, Builder] = {
    "raw_applications": raw_applications,
    "member_key": member_key,
    "key_cardinality": key_cardinality,
    "duplicate_keys_ranked": duplicate_keys_ranked,
    "blank_identity_rows": blank_identity_rows,
    "key_prefix_rows": key_prefix_rows,
    "split_customers": split_customers,
    "split_loans": split_loans,
    "split_repayments": split_repayments,
    "split_defaulters": split_defaulters,
    "csv_roundtrip_customers": csv_roundtrip_customers,
    "csv_roundtrip_loans": csv_roundtrip_loans,
    "csv_roundtrip_repayments": csv_roundtrip_repayments,
    "csv_roundtrip_defaulters": csv_roundtrip_defaulters,
    "csv_inferred_defaulters": csv_inferred_defaulters,
    "csv_audit_counts": csv_audit_counts,
    "csv_accepted_repayments": csv_accepted_repayments,
    "csv_accepted_defaulters": csv_accepted_defaulters,
    "clean_customers": clean_customers,
    "emp_length_values": emp_length_values,
    "state_values": state_values,
    "long_state_count": long_state_count,
    "clean_loans": clean_loans,
    "purpose_counts_top": purpose_counts_top,
    "clean_repayments": clean_repayments,
    "invalid_payment_rows": invalid_payment_rows,
    "unpaid_with_principal": unpaid_with_principal,
    "delinquency_histogram": delinquency_histogram,
    "delinquency_counts": delinquency_counts,
    "delinquent_members": delinquent_members,
    "records_or_enquiry_members": records_or_enquiry_members,
    "record_enquiry_detail": record_enquiry_detail,
    "duplicates_customers": duplicates_customers,
    "duplicates_delinq": duplicates_delinq,
    "duplicates_detail": duplicates_detail,
    "quarantine_all_rows": quarantine_all_rows,
    "quarantine": quarantine_members,
    "quarantine_reasons": quarantine_reasons,
    "quarantine_audit": quarantine_audit,
    "landing_quarantine": landing_quarantine,
    "latest_applications": latest_applications,
    "quarantine_latest": quarantine_latest,
    "loan_score_latest": loan_score_latest,
    "exclude_customers": exclude_customers,
    "exclude_delinq": exclude_delinq,
    "exclude_detail": exclude_detail,
    "exclude_loans": exclude_loans,
    "customer_loan": customer_loan_relation,
    "customer_loan_view": customer_loan_view,
    "customer_loan_table": customer_loan_table,
    "customer_loan_bucketed": customer_loan_bucketed,
    "customer_loan_csv": customer_loan_csv,
    "payment_history_points": payment_history_points,
    "default_history_points": default_history_points,
    "financial_health_points": financial_health_points,
    "weighted_score": weighted_score,
    "loan_score": loan_score,
    "grade_distribution": grade_distribution,
    "quality_profile": quality_profile,
    "cleaned_profile": cleaned_profile,
    "key_profile": key_profile,
    "step_counts": step_counts,
    "value_histograms": value_histograms,
    "distinct_counts": distinct_counts,
    "distinct_estimates": distinct_estimates,
}
