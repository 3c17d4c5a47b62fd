"""Band tables: ordered (predicate, points) rows folded into one CASE column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_NO_DEFAULT = object()


def _pts_sql(pts) -> str:
    return "CAST(NULL AS INT)" if pts is None else f"CAST({int(pts)} AS INT)"


def band_sql(bands: Sequence[tuple[str, int | None]], default=_NO_DEFAULT) -> str:
    """SQL text of the CASE expression for string predicates."""
    if not bands:
        raise ValueError("band table is empty")
    parts = ["CASE"]
    parts += [f"WHEN {pred} THEN {_pts_sql(pts)}" for pred, pts in bands]
    if default is not _NO_DEFAULT:
        parts.append(f"ELSE {_pts_sql(default)}")
    parts.append("END")
    return " ".join(parts)


def band_points(
    bands: Sequence[tuple[Column | str, int | None]],
    default: int | None | object = _NO_DEFAULT,
) -> Column:
    """First matching band wins; no match gives ``default`` or NULL.

    Predicates are Columns or SQL text; all-text tables become one parsed
    expression. Either way the result is one ``CASE WHEN`` (int) evaluated
    in generated code.
    """
    if not bands:
        raise ValueError("band table is empty")
    if all(isinstance(p, str) for p, _ in bands):
        return F.expr(band_sql(bands, default))  # type: ignore[arg-type]
    expr = None
    for predicate, pts in bands:
        pred = F.expr(predicate) if isinstance(predicate, str) else predicate
        value = F.lit(pts).cast("int")
        expr = F.when(pred, value) if expr is None else expr.when(pred, value)
    if default is not _NO_DEFAULT:
        expr = expr.otherwise(F.lit(default).cast("int"))
    return expr


def counter_bands(c: str, pts, overflow: int) -> list[tuple[str, int]]:
    """0 -> excellent, 1-2 -> bad, 3-5 -> very bad, >5 or NULL -> ``overflow``
    (``c`` is SQL text). Negative counts match no band (NULL points)."""
    return [
        (f"{c} = 0", pts.excellent),
        (f"{c} BETWEEN 1 AND 2", pts.bad),
        (f"{c} BETWEEN 3 AND 5", pts.very_bad),
        (f"({c} > 5 OR {c} IS NULL)", overflow),
    ]
