"""Stage graph from the raw applications to the graded score.

``Stages`` builds each intermediate DataFrame once per instance. Stages named
in ``materialize`` are written when they are first asked for, which runs a
job; all others are lazy plans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from ..config import DEFAULT_CONFIG, ScoreConfig
from ..operators import clean, entities, quarantine, score, view
from ..session import file_state, fresh_dir
from ..sources.fixture import raw_applications


#: Stages that several branches of one plan start from, or whose plan Spark
#: would otherwise compute once per branch (pushed filters make the branches'
#: exchanges differ, so it cannot reuse them). The quarantine list is written
#: for its anti joins as well: joined to a written table, a hot member is split
#: by AQE, which it is not above the list's own aggregate. The hashes of repeated
#: members are written for the filter that is made of them.
SHARED = ("keyed", "keyed_repeats", "applications", "repeats", "customers", "bad")

#: Compression of stage files: member keys are hex digits, half of their bytes.
STAGE_OPTIONS = {"compression": "zstd"}


# (application, input, parameters) -> state of the input's files, stages
_SHARED: dict[tuple[str, str, ScoreConfig], tuple[list, "Stages"]] = {}


def forget_shared() -> None:
    """The next query writes its shared stages anew (for timing them). Frames
    over the old ones can still be read."""
    _SHARED.clear()


class Stages:
    """``materialize`` names the stages written as Parquet under the shared
    folder and read back (``True``: all of ``SHARED``)."""

    def __init__(
        self,
        raw: DataFrame,
        cfg: ScoreConfig = DEFAULT_CONFIG,
        ingest_ts=None,
        materialize: bool | tuple[str, ...] = False,
        run_dir: str | None = None,
    ) -> None:
        self.raw = raw
        self.cfg = cfg
        # tables written apart must agree on the time
        self.ingest_ts = clean.run_timestamp(raw.sparkSession) if materialize and ingest_ts is None else ingest_ts
        if materialize is True:
            materialize = SHARED
        self.materialize: tuple[str, ...] = tuple(materialize or ())
        self._run_dir = run_dir
        self._stored: dict[str, str] = {}
        #: The database that publishes these stages, if one does.
        self.database: str | None = None

    @property
    def run_dir(self) -> str:
        if self._run_dir is None:
            self._run_dir = fresh_dir(self.raw.sparkSession, "stages")
        return self._run_dir

    def cleanup(self) -> None:
        """Delete this run's stage folder (call once every DataFrame built
        from these stages has been consumed). Uses the cluster's Hadoop file
        system, so it works on shared storage as well as locally."""
        if self._run_dir is None:
            return
        spark = self.raw.sparkSession
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._run_dir)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self._run_dir = None

    def _land(self, df: DataFrame, label: str) -> DataFrame:
        if label not in self.materialize:
            return df
        path = f"{self.run_dir}/{label}"
        df.write.mode("overwrite").options(**STAGE_OPTIONS).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def stored(self, name: str) -> str:
        """The folder of a stage, written now if it is not."""
        df = getattr(self, name)
        if name in self.materialize:
            return f"{self.run_dir}/{name}"
        if name not in self._stored:
            path = f"{self.run_dir}/stored/{name}"
            df.write.mode("overwrite").options(**STAGE_OPTIONS).parquet(path)
            self._stored[name] = path
        return self._stored[name]

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Stages":
        return cls(raw_applications(spark, sf_dir), **kw)

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> "Stages":
        """The materialized stages of one input, written once per application
        and used by every query on it. A change of the input's files (names,
        sizes, times) makes new ones; the old stay until the process exits, as
        DataFrames over them may still be read."""
        tables = [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("orders", "customer", "nation")]
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), cfg)
        state = [file_state(spark, t) for t in tables]
        known = _SHARED.get(key)
        if known is None or known[0] != state:
            _SHARED[key] = known = (state, cls.from_testdata(spark, sf_dir, cfg=cfg, materialize=True))
        return known[1]

    # -- entity split ---------------------------------------------------------
    @cached_property
    def keyed(self) -> DataFrame:
        return self._land(entities.with_member_key(self.raw), "keyed")

    @cached_property
    def applications(self) -> DataFrame:
        """The keyed applications that the record policy lets through."""
        if self.cfg.record_policy == "published":
            return self.keyed
        maybe = self._may_repeat(self.keyed, "keyed_repeats")
        return self._land(quarantine.resolve(self.keyed, self.cfg.record_policy, maybe=maybe), "applications")

    def _may_repeat(self, df: DataFrame, label: str) -> Column | None:
        if label not in self.materialize:
            return None
        return quarantine.may_repeat(self._land(quarantine.repeated_hashes(df), label))

    @cached_property
    def may_repeat(self) -> Column | None:
        """Whether an application's member may have others: what is done about
        repeated members leaves the rest in place. None where the list of them
        is not written, or too long for a filter."""
        return self._may_repeat(self.applications, "repeats")

    @cached_property
    def split(self) -> dict[str, DataFrame]:
        return entities.split_entities(self.applications)

    # -- cleaning -------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return self._land(clean.clean_customers(self.split["customers"], self.ingest_ts, self.may_repeat), "customers")

    @cached_property
    def loans(self) -> DataFrame:
        return clean.clean_loans(self.split["loans"], ingest_ts=self.ingest_ts)

    @cached_property
    def repayments(self) -> DataFrame:
        return clean.clean_repayments(self.split["repayments"], self.ingest_ts)

    @cached_property
    def defaulters(self) -> DataFrame:
        return clean.clean_defaulters(self.split["defaulters"])

    @cached_property
    def delinq(self) -> DataFrame:
        return clean.delinquent_members(self.defaulters)

    @cached_property
    def records_enq(self) -> DataFrame:
        return clean.records_or_enquiry_members(self.defaulters)

    @cached_property
    def detail(self) -> DataFrame:
        return clean.record_enquiry_detail(self.defaulters)

    # -- quarantine -----------------------------------------------------------
    @cached_property
    def dup_customers(self) -> DataFrame:
        return quarantine.duplicate_members(self.customers, maybe=self.may_repeat)

    @cached_property
    def dup_delinq(self) -> DataFrame:
        return quarantine.duplicate_members(self.delinq, maybe=self.may_repeat)

    @cached_property
    def dup_detail(self) -> DataFrame:
        return quarantine.duplicate_members(self.detail, maybe=self.may_repeat)

    @cached_property
    def bad(self) -> DataFrame:
        return self._land(quarantine.quarantine(self.dup_customers, self.dup_delinq, self.dup_detail), "bad")

    @cached_property
    def customers_new(self) -> DataFrame:
        return quarantine.exclude_members(self.customers, self.bad, maybe=self.may_repeat)

    @cached_property
    def delinq_new(self) -> DataFrame:
        return quarantine.exclude_members(self.delinq, self.bad, maybe=self.may_repeat)

    @cached_property
    def detail_new(self) -> DataFrame:
        return quarantine.exclude_members(self.detail, self.bad, maybe=self.may_repeat)

    # -- consolidated view ----------------------------------------------------
    @cached_property
    def customer_loan(self) -> DataFrame:
        return view.customer_loan(
            self.customers_new, self.loans, self.repayments, self.delinq_new, self.detail_new, self.bad, self.may_repeat
        )

    # -- scoring --------------------------------------------------------------
    @cached_property
    def payment_points(self) -> DataFrame:
        return score.payment_history_points(self.repayments, self.loans, self.bad, self.cfg, maybe=self.may_repeat)

    @cached_property
    def _payment_points_carry(self) -> DataFrame:
        return score.payment_history_points(
            self.repayments, self.loans, self.bad, self.cfg, carry=("loan_status", "funded_amount"), maybe=self.may_repeat
        )

    @cached_property
    def default_points(self) -> DataFrame:
        return score.default_history_points(self.detail_new, self.delinq_new, self.payment_points, self.cfg)

    @cached_property
    def health_points(self) -> DataFrame:
        ldh = score.default_history_points(self.detail_new, self.delinq_new, self._payment_points_carry, self.cfg)
        return score.financial_health_points(ldh, None, self.customers_new, self.cfg)

    @cached_property
    def weighted(self) -> DataFrame:
        return score.weighted_score(self.health_points, self.cfg)

    @cached_property
    def loan_score(self) -> DataFrame:
        return score.final_grade(self.weighted, self.cfg)
