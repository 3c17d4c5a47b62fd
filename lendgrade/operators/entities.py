"""Member key and the vertical split of raw applications into entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import member_key
from ..sources.schemas import (
    CUSTOMER_SPLIT,
    DEFAULTER_SPLIT,
    IDENTITY_COLUMNS,
    LOAN_SPLIT,
    REPAYMENT_SPLIT,
)

# Country of every applicant in the source data (fixed value).
DEFAULT_COUNTRY = "USA"


def with_member_key(
    raw: DataFrame,
    key: str = "member_id",
    identity: Sequence[str] = IDENTITY_COLUMNS,
    null_token: str | None = None,
) -> DataFrame:
    """Add the SHA-256 member key (a per-row projection, no shuffle)."""
    return raw.withColumn(key, member_key(identity, null_token))


def _project(raw: DataFrame, mapping, literals: dict | None = None) -> DataFrame:
    literals = literals or {}
    cols = []
    for src, dst in mapping:
        if dst in literals:
            cols.append(F.lit(literals[dst]).alias(dst))
        else:
            cols.append(F.col(src).alias(dst))
    return raw.select(*cols)


def split_customers(keyed: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    return _project(keyed, CUSTOMER_SPLIT, {"country": country})


def split_loans(keyed: DataFrame) -> DataFrame:
    return _project(keyed, LOAN_SPLIT)


def split_repayments(keyed: DataFrame) -> DataFrame:
    return _project(keyed, REPAYMENT_SPLIT)


def split_defaulters(keyed: DataFrame) -> DataFrame:
    return _project(keyed, DEFAULTER_SPLIT)


def split_entities(keyed: DataFrame, country: str = DEFAULT_COUNTRY) -> dict[str, DataFrame]:
    """Raw (keyed) applications -> customers, loans, repayments, defaulters.

    Pure projections: Catalyst prunes each branch down to the columns it
    needs, so reading the raw table in a columnar format costs only those.
    """
    if "member_id" not in keyed.columns:
        keyed = with_member_key(keyed)
    return {
        "customers": split_customers(keyed, country),
        "loans": split_loans(keyed),
        "repayments": split_repayments(keyed),
        "defaulters": split_defaulters(keyed),
    }


def entity_columns() -> dict[str, dict[str, str | None]]:
    """Per entity: its columns and the raw column of each (None: a literal)."""
    maps = {"customers": CUSTOMER_SPLIT, "loans": LOAN_SPLIT, "repayments": REPAYMENT_SPLIT, "defaulters": DEFAULTER_SPLIT}
    return {name: {dst: None if dst == "country" else src for src, dst in m} for name, m in maps.items()}
