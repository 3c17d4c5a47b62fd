"""The staged batch job: raw applications -> graded loan scores + catalog.

Each stage writes its tables to folders of this run on shared storage and the
next stage reads them back, so every table is computed once and lineage never
spans stages. A stage is committed by a marker when all of its tables are
written (``plans.commits``): a rerun over the same input after a failure skips
the committed stages, and readers of the catalog see the tables of the last
published run until all of the new ones are there. Order:

1. land the keyed raw applications (member key computed once), and the
   applications that the record policy lets through;
2. clean customers, loans, repayments, defaulter subsets (Parquet + CSV);
3. quarantine repeated members (audit lists) and write the ``_new`` tables;
4. the consolidated relation;
5. score and grade;
6. publish: register the tables, or switch them to the new folders.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_CONFIG, Layout, ScoreConfig
from ..operators import clean, entities, quarantine, score, view
from ..sources.schemas import CATALOG_DDL, DELINQ_DDL, DETAIL_DDL
from . import catalog, commits, sinks


@dataclass
class BatchResult:
    """The database, the folder of every table, and the stages that this call
    wrote or found committed."""

    database: str
    tables: dict[str, str] = field(default_factory=dict)
    written: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(f"{self.database}.{name}")


CLEANED = (
    "customers",
    "loans",
    "loans_repayments",
    "loans_defaulters_delinq",
    "loans_defaulters_records_enq",
    "loans_defaulters_detail_rec_enq",
)
QUARANTINED = ("customers", "loans_defaulters_delinq", "loans_defaulters_detail_rec_enq")
BAD = "bad_customer_data_final"


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    layout: Layout,
    cfg: ScoreConfig = DEFAULT_CONFIG,
    ingest_ts=None,
    database: str = "lendgrade",
    csv_copies: bool = True,
    input_state: str | None = None,
) -> BatchResult:
    """Run the job, or take up where a failed run over the same input ended.

    ``input_state`` names the state of an input that is not made of files (a
    table version, say); by default it is found from the files of ``raw``.
    """
    parameters = (commits.config_state(cfg), str(ingest_ts), csv_copies)
    state = commits.input_state(raw, *parameters) if input_state is None else f"{input_state} {parameters}"
    # one time for all tables of the run
    run = commits.open_run(spark, layout.root, state, str(ingest_ts or clean.run_timestamp(spark)))
    at = {f"raw_{n}": run.versioned(layout.raw(n)) for n in ("applications", "chosen")}
    at |= {n: run.versioned(layout.cleaned(n, "parquet")) for n in CLEANED}
    at |= {f"{n}_new": run.versioned(layout.cleaned_new(n)) for n in QUARANTINED}
    at |= {f"bad_data_{n}": run.versioned(layout.bad(f"bad_data_{n}")) for n in QUARANTINED}
    at |= {n: run.versioned(layout.bad(n)) for n in (BAD, "bad_customer_data_reasons")}
    at |= {n: run.versioned(layout.processed(n)) for n in ("customers_loan_t", "loan_score")}
    t = lambda n: spark.read.parquet(at[n])

    def put(df: DataFrame, name: str) -> str:
        sinks.write_parquet(df, at[name])
        return at[name]

    def land() -> list[str]:
        done = [put(entities.with_member_key(raw), "raw_applications")]
        if cfg.record_policy != "published":
            done.append(put(quarantine.resolve(t("raw_applications"), cfg.record_policy), "raw_chosen"))
        if csv_copies:  # the raw entity files
            for name, df in entities.split_entities(t("raw_applications")).items():
                path = run.versioned(layout.raw(f"{name}_csv"))
                sinks.write_csv(df, path)
                done.append(path)
        return done

    def clean_all() -> list[str]:
        ents = entities.split_entities(t("raw_applications" if cfg.record_policy == "published" else "raw_chosen"))
        defaulters = clean.clean_defaulters(ents["defaulters"])
        frames = (
            clean.clean_customers(ents["customers"], run.ingest_ts),
            clean.clean_loans(ents["loans"], ingest_ts=run.ingest_ts),
            clean.clean_repayments(ents["repayments"], run.ingest_ts),
            clean.delinquent_members(defaulters),
            clean.records_or_enquiry_members(defaulters),
            clean.record_enquiry_detail(defaulters),
        )
        done = []
        for name, df in zip(CLEANED, frames):  # each written once; CSV copied from the Parquet
            done.append(put(df, name))
            if csv_copies:
                path = run.versioned(layout.cleaned(name, "csv"))
                sinks.write_csv(t(name), path)
                done.append(path)
        return done

    def quarantine_all() -> list[str]:
        dups = {f"bad_data_{n}": quarantine.duplicate_members(t(n)) for n in QUARANTINED}
        sinks.write_quarantine(dups, at.__getitem__)
        lists = {n: t(f"bad_data_{n}") for n in QUARANTINED}
        done = [at[n] for n in dups]
        done.append(put(quarantine.quarantine_reasons(lists), "bad_customer_data_reasons"))
        done.append(put(quarantine.quarantine(*lists.values()), BAD))
        done += [put(quarantine.exclude_members(t(n), t(BAD)), f"{n}_new") for n in QUARANTINED]
        return done

    def relate() -> list[str]:
        parts = (t(n) for n in ("customers_new", "loans", "loans_repayments", "loans_defaulters_delinq_new", "loans_defaulters_detail_rec_enq_new", BAD))
        return [put(view.customer_loan(*parts), "customers_loan_t")]

    def grade() -> list[str]:
        parts = (t(n) for n in ("loans_repayments", "loans", "customers_new", "loans_defaulters_delinq_new", "loans_defaulters_detail_rec_enq_new", BAD))
        return [put(score.loan_score(*parts, cfg), "loan_score")]

    published = [*CLEANED, BAD, *[f"{n}_new" for n in QUARANTINED], "customers_loan_t", "loan_score"]
    ddl = dict(CATALOG_DDL, loans_defaulters_records_enq="member_id string")
    ddl |= {BAD: "member_id string", "customers_new": CATALOG_DDL["customers"], "loans_defaulters_delinq_new": DELINQ_DDL, "loans_defaulters_detail_rec_enq_new": DETAIL_DDL}

    def switch() -> None:
        catalog.create_database(spark, database, layout.database(database))
        for name in published:
            catalog.publish_table(spark, f"{database}.{name}", ddl.get(name) or catalog.ddl_of(t(name)), at[name])
        catalog.create_customer_loan_view(spark, database)

    for name, write in (("land", land), ("clean", clean_all), ("quarantine", quarantine_all), ("relate", relate), ("score", grade)):
        run.stage(name, write)
    run.publish(switch)
    return BatchResult(database, {n: at[n] for n in published}, run.written, run.skipped)
