"""Data-quality profiles: the checks the cleaning steps make, as tables.

Histograms come in two forms. The exact one unpivots a frame to (column,
value) pairs in one scan and counts them, combined per task before the shuffle,
so it costs what the distinct values cost: for coded columns very little, for
ids a row each. For such wide columns there are sketches: one scan and one row
of bounded size per column (HLL for distinct values, frequent items for the
top), which merge, so that new data is profiled alone and added.

``null_profile`` is one scan with one global aggregate (partial per task,
a single tiny final row) turned into long format. ``key_profile`` groups by
the key once (partial aggregation absorbs hot keys) and aggregates the
per-key counts globally.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EMPTY_IDENTITY_KEY


def null_profile(df: DataFrame, name: str) -> DataFrame:
    """table_name, column_name, row_count, null_count (one row per column)."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    long = wide.select(
        "row_count",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("null_count"))
                    for i, c in enumerate(df.columns)
                ]
            )
        ).alias("p"),
    )
    return long.select(
        F.lit(name).alias("table_name"),
        F.col("p.column_name").alias("column_name"),
        "row_count",
        F.col("p.null_count").alias("null_count"),
    )


def null_profiles(df: DataFrame, tables: dict[str, dict[str, str | None]]) -> DataFrame:
    """``null_profile`` of several projections of one frame, in one scan:
    ``tables`` maps each table's columns to the frame's (None: never NULL)."""
    used = sorted({src for cols in tables.values() for src in cols.values() if src})
    wide = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{c}") for c in used])
    rows = [
        F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), (F.col(f"n_{src}") if src else F.lit(0).cast("bigint")).alias("null_count"))
        for t, cols in tables.items()
        for c, src in cols.items()
    ]
    return wide.select("row_count", F.explode(F.array(*rows)).alias("p")).select("p.table_name", "p.column_name", "row_count", "p.null_count")


def conditional_counts(df: DataFrame, table: str, steps: dict) -> DataFrame:
    """table_name, step, row_count: the rows of ``df`` that meet each step's
    condition (None: all), in one aggregate."""
    aggs = [(F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias(f"s{i}") for i, cond in enumerate(steps.values())]
    rows = [F.struct(F.lit(step).alias("step"), F.col(f"s{i}").alias("row_count")) for i, step in enumerate(steps)]
    long = df.agg(*aggs).select(F.explode(F.array(*rows)).alias("p"))
    return long.select(F.lit(table).alias("table_name"), "p.step", "p.row_count")


def key_profile(df: DataFrame, name: str, key: str = "member_id", empty_key: str = EMPTY_IDENTITY_KEY) -> DataFrame:
    """table_name, row_count, distinct_keys, repeated_keys,
    rows_with_repeated_key, empty_identity_rows."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("total"))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.sum("total").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("total") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col("total") > 1, F.col("total"))), F.lit(0)).cast("bigint").alias(
            "rows_with_repeated_key"
        ),
        F.coalesce(F.sum(F.when(F.col(key) == empty_key, F.col("total"))), F.lit(0)).cast("bigint").alias(
            "empty_identity_rows"
        ),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """column, total: rows per value, most frequent first, ties by value
    (``top`` keeps the first rows only, for a report; the tiebreak makes the
    cut deterministic)."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("total")).orderBy(
        F.col("total").desc(), F.col(column).asc_nulls_last()
    )
    return out.limit(top) if top is not None else out


# -- histograms, distinct counts and their sketches --------------------------------------

#: Precision of the distinct sketches: 2^14 registers, a standard error of 0.8 %.
LG_REGISTERS = 14
#: Distinct estimates are within this share of the exact count (five standard
#: errors), and exact to a value or two where there are few.
DISTINCT_ERROR = 0.04
#: Values that a frequent-items sketch tracks.
ITEMS = 1000

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

#: Columns of each table of the map, and the frame's column each is.
Tables = dict[str, dict[str, str]]


def own_columns(df: DataFrame, name: str, columns: list[str] | None = None) -> Tables:
    """A frame as one table of that name, its columns under their own names."""
    return {name: {c: c for c in (columns or df.columns)}}


def _sources(tables: Tables) -> list[str]:
    return sorted({src for cols in tables.values() for src in cols.values()})


def _is_number(kind: str) -> bool:
    return kind.split("(")[0] in _NUMBERS


def _named(tables: Tables, at: Column) -> Column:
    """One row per (table, column) that shows the source at position ``at``."""
    shown = [[(t, c) for t, cols in tables.items() for c, own in cols.items() if own == src] for src in _sources(tables)]
    names = F.array(*[F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name")) for t, c in some]) for some in shown])
    return F.explode(F.get(names, at))


def value_histogram(df: DataFrame, tables: Tables) -> DataFrame:
    """table_name, column_name, value, number, total: rows per value of each
    column, NULLs included. Numbers are in ``number`` (as doubles), all others
    in ``value`` as text. Columns that several tables show are counted once."""
    kinds = dict(df.dtypes)
    pairs = []
    for i, src in enumerate(_sources(tables)):
        c, none = F.col(f"`{src}`"), F.lit(None)
        value, number = (none.cast("string"), c.cast("double")) if _is_number(kinds[src]) else (c.cast("string"), none.cast("double"))
        pairs.append(F.struct(F.lit(i).alias("at"), value.alias("value"), number.alias("number")))
    long = df.select(F.explode(F.array(*pairs)).alias("p")).groupBy("p.at", "p.value", "p.number").agg(F.count(F.lit(1)).alias("total"))
    return long.select(_named(tables, F.col("at")).alias("n"), "value", "number", "total").select("n.table_name", "n.column_name", "value", "number", "total")


def distinct_counts(histogram: DataFrame, *also: str) -> DataFrame:
    """table_name, column_name, row_count, distinct_count (of non-NULL values)
    from a histogram; ``also`` names further columns to keep apart."""
    return histogram.groupBy(*also, "table_name", "column_name").agg(
        F.sum("total").alias("row_count"), F.count_if(F.coalesce("value", F.col("number").cast("string")).isNotNull()).alias("distinct_count")
    )


def column_sketches(df: DataFrame, tables: Tables, lg_registers: int = LG_REGISTERS, items: int = ITEMS, by: Column | None = None) -> DataFrame:
    """table_name, column_name, row_count, values (HLL), top (frequent items):
    one row of bounded size per column, from one scan; with ``by``, one for each
    of its values, of which there should be few."""
    used = _sources(tables)
    aggs = [F.count(F.lit(1)).alias("row_count")]
    for i, src in enumerate(used):
        aggs.append(F.expr(f"hll_sketch_agg(CAST(`{src}` AS STRING), {lg_registers})").alias(f"v{i}"))
        aggs.append(F.expr(f"approx_top_k_accumulate(CAST(`{src}` AS STRING), {items})").alias(f"t{i}"))
    rows = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"v{i}").alias("values"), F.col(f"t{i}").alias("top")) for i in range(len(used))])
    groups = df.groupBy(*([] if by is None else [by.alias("__part")]))
    long = groups.agg(*aggs).select("row_count", F.explode(rows).alias("p"))
    return long.select("row_count", "p.values", "p.top", _named(tables, F.col("p.at")).alias("n")).select("n.table_name", "n.column_name", "row_count", "values", "top")


def merge_sketches(*parts: DataFrame, items: int = ITEMS) -> DataFrame:
    """The sketches of the parts' rows together."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("table_name", "column_name").agg(
        F.sum("row_count").alias("row_count"), F.expr("hll_union_agg(values)").alias("values"), F.expr(f"approx_top_k_combine(top, {items})").alias("top")
    )


def sketch_estimates(sketches: DataFrame, k: int = 10) -> DataFrame:
    """table_name, column_name, row_count, distinct_estimate and the ``k`` most
    frequent values with their estimated rows (``top_values``)."""
    top = F.transform(F.expr(f"approx_top_k_estimate(top, {k})"), lambda x: F.struct(x["item"].alias("value"), x["count"].alias("total")))
    return sketches.select("table_name", "column_name", "row_count", F.expr("hll_sketch_estimate(values)").alias("distinct_estimate"), top.alias("top_values"))


def within_error(estimate: Column, exact: Column, error: float = DISTINCT_ERROR) -> Column:
    """Whether a distinct estimate keeps to its stated error."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.ceil(exact * error))
