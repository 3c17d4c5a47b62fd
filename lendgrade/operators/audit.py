"""Foreign records: every row goes to its table or to the audit list.

A permissive read turns what it cannot parse into NULLs, and the cleaning then
drops rows for NULLs without a trace. Here the reasons are found first, row by
row, without a shuffle: a malformed line, a value that is not of its declared
type, a required value that is missing. Malformed lines and rows without a
required value are rejected; rows with another unparsable value are kept with
a NULL for it. All of them are listed, with their text and reasons.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Columns that ``checked`` adds.
RECORD, REASONS, REJECTED = "_record", "_reasons", "_rejected"
MALFORMED = "malformed line"


def checked(texts: DataFrame, ddl: str, required: Iterable[str] = (), corrupt: str = "_corrupt_record") -> DataFrame:
    """The columns of ``ddl``, typed, from columns of text bound by position,
    with the record's text, the reasons against it and whether it is rejected.

    ``corrupt`` names the column that holds the text of a malformed line (NULL
    for the others); the text of other rows is their values as JSON.
    """
    fields = StructType.fromDDL(ddl).fields
    sources = [c for c in texts.columns if c != corrupt]
    if len(sources) != len(fields):
        raise ValueError(f"expected {len(fields)} columns, got {len(sources)}")
    required = set(required)
    unknown = required - {f.name for f in fields}
    if unknown:
        raise KeyError(f"required columns {sorted(unknown)} are not in the schema")
    # always true: Spark does not read the corrupt column of a file alone
    beside = F.length(F.concat_ws("", F.col(f"`{sources[0]}`"), F.lit("x"))) > 0
    malformed = F.col(f"`{corrupt}`").isNotNull() & beside
    typed, faults, missing = [], [], F.lit(False)
    for src, f in zip(sources, fields):
        text = F.col(f"`{src}`")
        kind = f.dataType.simpleString()
        value = text if kind == "string" else text.try_cast(kind)
        typed.append(value.alias(f.name))
        if kind != "string":
            faults.append(F.when(text.isNotNull() & value.isNull(), f"{f.name}: not a {kind}"))
        if f.name in required:
            faults.append(F.when(text.isNull(), f"{f.name}: missing"))
            missing = missing | value.isNull()
    found = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")
    reasons = F.when(malformed, F.array(F.lit(MALFORMED))).otherwise(found)
    record = F.when(malformed, F.col(f"`{corrupt}`")).otherwise(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f.name) for c, f in zip(sources, fields)])))
    return texts.select(*typed, record.alias(RECORD), reasons.alias(REASONS), (malformed | missing).alias(REJECTED))


def accepted(rows: DataFrame) -> DataFrame:
    """The rows that go to the table."""
    return rows.where(~F.col(REJECTED)).drop(RECORD, REASONS, REJECTED)


def audit_list(rows: DataFrame, table: str) -> DataFrame:
    """table_name, record, reasons, rejected: the rows with a reason."""
    listed = rows.where(F.size(REASONS) > 0)
    return listed.select(F.lit(table).alias("table_name"), F.col(RECORD).alias("record"), F.col(REASONS).alias("reasons"), F.col(REJECTED).alias("rejected"))


def audit_counts(listed: DataFrame) -> DataFrame:
    """table_name, reason, rejected, total: rows of the audit list by reason (a
    row with two reasons counts in both)."""
    return listed.select("table_name", F.explode("reasons").alias("reason"), "rejected").groupBy("table_name", "reason", "rejected").agg(F.count(F.lit(1)).alias("total"))
