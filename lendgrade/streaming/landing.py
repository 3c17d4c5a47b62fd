"""Incremental ingestion of raw application files from a landing folder.

A Structured Streaming file source picks up new files; each micro-batch is
keyed and split into the four entity tables (stateless projections). Each
batch is written to ``<out>/<entity>/batch_id=<n>`` with overwrite, so a
batch replayed after a failure replaces its own output (exactly-once
effect); the checkpoint tracks which files were consumed. Reading
``<out>/<entity>`` returns all batches, with ``batch_id`` as a partition
column that downstream jobs can prune on.

``quarantine_landing`` follows the keyed applications as a stream of its own
and keeps, per member, what the three quarantine rules need: a few numbers in
the state store, so a member repeated across batches is found when the second
record arrives. Each batch appends the members that newly repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.entities import split_entities, with_member_key
from ..sources.schemas import CUSTOMER_SPLIT, CUSTOMERS_DDL

# Declared schema of a raw application file (column order of the landing CSV).
RAW_DDL = (
    "id bigint, emp_title string, emp_length string, home_ownership string, annual_inc double, "
    "zip_code string, addr_state string, grade string, sub_grade string, verification_status string, "
    "tot_hi_cred_lim double, application_type string, annual_inc_joint double, "
    "verification_status_joint string, loan_amnt double, funded_amnt double, term string, int_rate double, "
    "installment double, issue_d string, loan_status string, purpose string, title string, "
    "total_rec_prncp double, total_rec_int double, total_rec_late_fee double, total_pymnt double, "
    "last_pymnt_amnt double, last_pymnt_d string, next_pymnt_d string, delinq_2yrs double, "
    "delinq_amnt double, pub_rec double, pub_rec_bankruptcies double, inq_last_6mths double, "
    "mths_since_last_delinq double, mths_since_last_record double"
)


# Folder of the keyed batches, beside those of the entities.
KEYED = "applications"
# Files per micro-batch: bounds the batch that foreachBatch writes.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000


def landing_stream(
    spark: SparkSession,
    landing_dir: str,
    schema: str = RAW_DDL,
    fmt: str = "csv",
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
) -> DataFrame:
    """Streaming DataFrame of keyed raw applications."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_member_key(r.load(landing_dir))


def _batch_writer(out_root: str):
    root = out_root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        # the keyed batch is written once to shared storage and split from there
        path = f"{root}/{KEYED}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        keyed = batch.sparkSession.read.schema(batch.schema).parquet(path)
        for name, df in split_entities(keyed).items():
            df.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

    return write


def _refuse_foreign_output(spark: SparkSession, out_root: str, checkpoint: str) -> None:
    """A new checkpoint counts batches from 0 and would overwrite those of
    another stream: its output must be a new folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out, known = path(f"{out_root.rstrip('/')}/{KEYED}"), path(f"{checkpoint.rstrip('/')}/metadata")
    if out.getFileSystem(conf).exists(out) and not known.getFileSystem(conf).exists(known):
        raise FileExistsError(f"{out_root} holds batches that the checkpoint {checkpoint} does not know")


def ingest_landing(
    spark: SparkSession,
    landing_dir: str,
    out_root: str,
    checkpoint: str,
    schema: str = RAW_DDL,
    fmt: str = "csv",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Start the ingestion; ``available_now`` processes what is there and
    stops, otherwise it keeps polling every ``processing_time``."""
    _refuse_foreign_output(spark, out_root, checkpoint)
    stream = landing_stream(spark, landing_dir, schema, fmt, max_files_per_trigger)
    w = stream.writeStream.foreachBatch(_batch_writer(out_root)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def read_ingested(spark: SparkSession, out_root: str, entity: str) -> DataFrame:
    """All ingested batches of one entity (``batch_id`` partition column)."""
    return spark.read.parquet(f"{out_root.rstrip('/')}/{entity}")


# -- quarantine over the stream --------------------------------------------------------------

#: Folder of the lists of repeated members, beside the entities.
REPEATED = "repeated_members"


def _typed(src: str, kind: str) -> str:
    return f"try_cast(`{src}` AS {kind})"


def _customer_row() -> Column:
    """128 bits of hash of an application's customer row as the cleaning types
    it; NULL if the cleaning drops it."""
    kinds = [f.dataType.simpleString() for f in StructType.fromDDL(CUSTOMERS_DDL).fields]
    row = [F.expr(_typed(src, kind)) for (src, dst), kind in zip(CUSTOMER_SPLIT, kinds) if dst != "country"]
    income = next(F.expr(_typed(src, kind)) for (src, dst), kind in zip(CUSTOMER_SPLIT, kinds) if dst == "annual_inc")
    # a NULL leaves a hash as it was: its place tells where there is one
    row += [c.isNull() for c in row]
    return F.when(income.isNotNull(), F.struct(F.xxhash64(*row).alias("h"), F.xxhash64(F.lit(1), *row).alias("g")))


def member_counts(keyed: DataFrame) -> DataFrame:
    """member_id and what the quarantine rules ask of it: the least and the
    greatest customer row (two rows differ if these do), delinquent rows and
    applications. A handful of numbers per member, over batches or a stream."""
    late = F.expr(f"{_typed('delinq_2yrs', 'float')} >= 1 OR {_typed('mths_since_last_delinq', 'float')} > 0")
    facts = keyed.select("member_id", _customer_row().alias("row"), F.coalesce(late, F.lit(False)).alias("late"))
    return facts.groupBy("member_id").agg(
        F.min("row").alias("least"), F.max("row").alias("greatest"), F.count_if("late").alias("delinquent"), F.count(F.lit(1)).alias("applications")
    )


def repeated(counts: DataFrame) -> DataFrame:
    """member_id, reasons: the members that repeat, and the tables they repeat
    in (as ``quarantine.quarantine_reasons``)."""
    reasons = F.array_compact(
        F.array(
            F.when(F.col("least") != F.col("greatest"), "customers"),
            F.when(F.col("delinquent") > 1, "loans_defaulters_delinq"),
            F.when(F.col("applications") > 1, "loans_defaulters_detail_rec_enq"),
        )
    )
    return counts.select("member_id", F.concat_ws(",", reasons).alias("reasons")).where("reasons <> ''")


def quarantine_landing(
    spark: SparkSession,
    landing_dir: str,
    out_root: str,
    checkpoint: str,
    schema: str = RAW_DDL,
    fmt: str = "csv",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
) -> StreamingQuery:
    """Follow the landing folder and list the members that repeat, within a
    batch or across batches (``read_repeated``).

    The state is one row per member ever seen, dealt by member over
    ``spark.sql.shuffle.partitions`` of the first start; a member's rows are
    combined per task before they reach it. For more members than fit in memory
    set ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB
    provider. A batch that is replayed replaces its own list.
    """
    root = f"{out_root.rstrip('/')}/{REPEATED}"
    stream = member_counts(landing_stream(spark, landing_dir, schema, fmt, max_files_per_trigger))

    def write(batch: DataFrame, batch_id: int) -> None:
        repeated(batch).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    w = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def read_repeated(spark: SparkSession, out_root: str) -> DataFrame:
    """member_id, reasons: every member listed so far, with the reasons of its
    latest listing (a member is listed again when a batch brings more of it)."""
    lists = spark.read.schema("member_id string, reasons string, batch_id bigint").parquet(f"{out_root.rstrip('/')}/{REPEATED}")
    return lists.groupBy("member_id").agg(F.max_by("reasons", "batch_id").alias("reasons"))
