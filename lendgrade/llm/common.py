"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendgrade.session import fresh_dir

#: Rows of one Arrow batch sent to a Python worker. Texts average a few KB, so
#: a batch stays at a few MB; a single very long text is one row by itself.
ARROW_ROWS = 512

#: Characters of text that one step of a Python worker handles at a time.
STEP_CHARS = 400_000


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session's Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return the table read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and every later reader sees the same rows.
    """
    spark = df.sparkSession
    path = f"{fresh_dir(spark, label)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def steps(texts: list[str], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of ``texts`` of about ``limit`` characters each; a longer
    text forms a range by itself."""
    i, size = 0, 0
    for j, text in enumerate(texts):
        if j > i and size + len(text) > limit:
            yield i, j
            i, size = j, 0
        size += len(text)
    if i < len(texts):
        yield i, len(texts)


def score_partitions(df: DataFrame, fn: Callable[[list[str]], Iterable[tuple]], text: str, keep: list[str], schema: str) -> DataFrame:
    """``keep`` columns plus the columns of ``schema``, computed from whole
    texts by ``fn(list of texts) -> one tuple per text``.

    Null texts are passed as empty ones. Only ``keep`` and ``text`` are read.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructType

    bounded_batches(df.sparkSession)
    added = StructType.fromDDL(schema)
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    out = StructType([*src.schema.fields[:-1], *added.fields])
    names = [f.name for f in out.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = [f.type for f in to_arrow_schema(out)][len(keep) :]
        for batch in batches:
            at = 0
            texts = batch.column(len(keep)).to_pylist()
            for i, j in steps(texts):
                rows = list(fn(texts[i:j]))
                cols = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(i, j - i) for k in range(len(keep))] + cols, names=names)
                at = j
            assert at == len(texts)

    return src.mapInArrow(run, out)


def matrix(column, kind=None):
    """An Arrow list column of one length as rows of a matrix of 64-bit integers
    (or of ``kind``)."""
    import numpy as np

    kind = kind or np.int64
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components: (node, component), component the least node.

    ``edges`` has columns ``a`` and ``b`` of one type. Alternating large-star
    and small-star rounds (min aggregates and joins on the node, both with
    partial aggregation or skew splitting) reach stars in a logarithmic
    number of rounds; every round is landed in the shared folder. Nodes
    without an edge to another node do not appear.
    """
    links = landed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), label)
    before = _digest(links)
    while before[0]:
        # large-star: every larger neighbour of u goes to u's least neighbour
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = landed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = landed(large.where("u != v").distinct(), label)
        # small-star: the smaller neighbours of u, and u, go to the least one
        least = landed(large.groupBy("u").agg(F.min("v").alias("m")), label)
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        links = landed(moved.where("u != v").distinct(), label)
        after = _digest(links)
        if after == before:
            break
        before = after
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _digest(links: DataFrame) -> tuple:
    """Number of links and a checksum of their set."""
    return tuple(links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first())
