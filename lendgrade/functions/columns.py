"""Column expressions used by the cleaning and scoring operators.

All are built-in Spark expressions (JVM side, inside whole-stage codegen) and
safe under ANSI mode: text is turned into numbers with ``try_cast`` so a bad
value gives NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import IDENTITY_COLUMNS


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def member_key(columns: Sequence[str] = IDENTITY_COLUMNS, null_token: str | None = None) -> Column:
    """SHA-256 hex digest of the identity columns joined with ``||``.

    NULLs are skipped by ``concat_ws`` (published behaviour), so ``(x, NULL)``
    and ``(NULL, x)`` hash alike and an all-NULL identity hashes to the digest
    of the empty string. ``null_token`` replaces NULLs with a marker first,
    which gives collision-safe keys.
    """
    parts = [col_(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.sha2(F.concat_ws("||", *parts), 256)


# SHA-256 of the empty string: the member key of an all-NULL identity (fixed).
EMPTY_IDENTITY_KEY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def digits_only(c: str | Column) -> Column:
    """Remove every non-digit character."""
    return F.regexp_replace(col_(c), r"\D", "")


def digits_to_int(c: str | Column) -> Column:
    """'10+ years' -> 10, '< 1 year' -> 1, 'n/a' -> NULL."""
    return digits_only(c).try_cast("int")


def null_if_zero_text(c: str) -> Column:
    """Placeholder dates written as '0.0' become NULL; other text is kept."""
    return F.expr(f"CASE WHEN try_cast(`{c}` AS DOUBLE) = 0.0 THEN CAST(NULL AS STRING) ELSE `{c}` END")


def longer_than(c: str | Column, n: int, replacement: str) -> Column:
    """Values longer than ``n`` characters become ``replacement`` (NULL stays NULL)."""
    return F.when(F.length(col_(c)) > n, F.lit(replacement)).otherwise(col_(c))


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_lookup(c: str, allowed: Iterable[str], fallback: str) -> Column:
    """Keep values from a small fixed lookup list (an IN set compiled into
    the expression), map all others to ``fallback``."""
    values = ", ".join(_sql_lit(v) for v in allowed)
    return F.expr(f"CASE WHEN `{c}` IN ({values}) THEN `{c}` ELSE {_sql_lit(fallback)} END")
