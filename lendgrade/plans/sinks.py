"""Sinks: Parquet, CSV, both, and the quarantine audit lists.

Every writer produces a folder of part files written by all tasks in
parallel; nothing is funnelled through a single task. ``write_dual`` runs
the plan once: it writes Parquet, then copies that Parquet to CSV, so both
copies hold identical rows (including the ingestion timestamp).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..sources.readers import CSV_OPTIONS, encode_text


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV that ``readers.read_written_csv`` reads back without loss."""
    texts = {f.name: encode_text(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, StringType)}
    df.withColumns(texts).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_dual(df: DataFrame, parquet_path: str, csv_path: str, mode: str = "overwrite") -> DataFrame:
    """Write Parquet, then CSV from the written Parquet; return the Parquet
    read back (lineage cut at shared storage)."""
    write_parquet(df, parquet_path, mode)
    written = df.sparkSession.read.schema(df.schema).parquet(parquet_path)
    write_csv(written, csv_path, mode)
    return written


def write_quarantine(lists: Mapping[str, DataFrame], path_of, fmt: str = "parquet") -> None:
    """Write each id list (audit trail) to ``path_of(name)``."""
    for name, ids in lists.items():
        if fmt == "csv":
            write_csv(ids, path_of(name))
        else:
            write_parquet(ids, path_of(name))
