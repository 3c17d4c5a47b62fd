"""CSV readers and the text encoding that makes the CSV copies lossless.

A CSV that may hold line breaks inside quotes cannot be split among tasks, so
line breaks are encoded on write and decoded on read, and every file stays
one record per line. Blanks, quotes, backslashes, empty and NULL texts all
come back as they were.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import audit
from ..operators.clean import LOAN_REQUIRED, REPAYMENT_REQUIRED
from .schemas import ENTITY_DDL

#: Columns without which the cleaning drops a row.
REQUIRED = {"loans": LOAN_REQUIRED, "repayments": REPAYMENT_REQUIRED, "customers": ("annual_inc",)}

#: Options that reader and writer share.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

# what stands in a file for characters that would end or confuse a record;
# a backslash goes first on write and last on read
ENCODED = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))

EMPTY = "\\e"

CORRUPT = "_corrupt_record"


def encode_text(c: Column) -> Column:
    for plain, code in ENCODED:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return F.when(c == "", EMPTY).otherwise(c)


def decode_text(c: Column) -> Column:
    c = F.when(c == EMPTY, "").otherwise(c)
    for plain, code in reversed(ENCODED):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True, infer: bool = False) -> DataFrame:
    """A foreign CSV. With ``schema`` the columns bind by position and
    unparsable values become NULL; ``infer=True`` runs Spark's inference
    pass (an extra scan, for exploration only)."""
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: str, required: Iterable[str] = (), header: bool = True) -> DataFrame:
    """A foreign CSV with the reasons against each row (``operators.audit``):
    its columns, bound by position and typed, the record's text, the reasons
    and whether the row is rejected. Lines of too few or too many fields are
    malformed."""
    texts = [StructField(f.name, StringType()) for f in StructType.fromDDL(schema).fields]
    r = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    r = r.option("escape", '"')  # quotes inside quotes are doubled
    r = r.option("columnPruning", False)  # a parser of fewer columns does not see that a line is short
    lines = r.schema(StructType([*texts, StructField(CORRUPT, StringType())])).csv(path)
    return audit.checked(lines, schema, required, CORRUPT)


def read_entity_csv_checked(spark: SparkSession, path: str, entity: str, header: bool = True) -> DataFrame:
    """``read_csv_checked`` of an entity CSV, with the columns that its
    cleaning requires."""
    return read_csv_checked(spark, path, ENTITY_DDL[entity], REQUIRED.get(entity, ()), header)


def read_written_csv(spark: SparkSession, path: str, schema: str, corrupt: bool = False) -> DataFrame:
    """A CSV written by ``sinks.write_csv``, columns bound by position.

    A broken row fails the read; with ``corrupt`` it comes back with NULLs
    and its text in ``_corrupt_record``, to be counted or set aside.
    """
    fields = StructType.fromDDL(schema).fields
    r = spark.read.options(**CSV_OPTIONS)
    if corrupt:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        r = r.schema(StructType([*fields, StructField(CORRUPT, StringType())]))
    else:
        r = r.option("mode", "FAILFAST").schema(StructType(fields))
    texts = {f.name: decode_text(F.col(f"`{f.name}`")) for f in fields if isinstance(f.dataType, StringType)}
    return r.csv(path).withColumns(texts)


def read_entity_csv(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """A foreign entity CSV (customers, loans, repayments, defaulters) with
    its declared schema; unparsable values become NULL."""
    return read_csv(spark, path, ENTITY_DDL[entity])


def read_written_entity_csv(spark: SparkSession, path: str, entity: str, corrupt: bool = False) -> DataFrame:
    """An entity CSV that ``sinks.write_csv`` wrote, without loss."""
    return read_written_csv(spark, path, ENTITY_DDL[entity], corrupt)
