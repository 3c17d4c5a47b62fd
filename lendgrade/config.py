"""Score parameters and storage layout.

The scoring parameters are plain frozen dataclasses that the operators turn
into literals, so a plan carries its parameters with it instead of reading
mutable session state.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal


# Rating points, grade cut-offs and component weights of the
# published loan score. They must stay equal for results to match.
#   points:  unacceptable 0, very_bad 100, bad 250, good 500, very_good 650,
#            excellent 800
#   grade cut-offs (score strictly above): E 750, D 1000, C 1500, B 2000,
#            A 2500
#   weights: payment history 0.20, defaulters history 0.45,
#            financial health 0.35
@dataclass(frozen=True)
class Points:
    unacceptable: int = 0
    very_bad: int = 100
    bad: int = 250
    good: int = 500
    very_good: int = 650
    excellent: int = 800


@dataclass(frozen=True)
class GradeCutoffs:
    unacceptable: int = 750
    very_bad: int = 1000
    bad: int = 1500
    good: int = 2000
    very_good: int = 2500


@dataclass(frozen=True)
class Weights:
    payment_history: Decimal = Decimal("0.20")
    defaulters_history: Decimal = Decimal("0.45")
    financial_health: Decimal = Decimal("0.35")


@dataclass(frozen=True)
class ScoreConfig:
    """All knobs of the loan score.

    ``delinq_overflow_pts``: points for more than five (or unknown)
    delinquencies; ``None`` keeps the published choice, which reuses the
    lowest grade cut-off (750).
    ``population``: ``"delinquent"`` scores only members present in the
    delinquency table (inner join, as published); ``"all"`` keeps members
    without delinquency history, with no delinquency counted (0).
    ``null_component``: ``"null"`` lets an unmatched band make the whole score
    NULL (published behaviour, graded F); ``"unacceptable"`` scores it with
    the unacceptable points instead.
    ``record_policy``: ``"published"`` quarantines every member with repeated
    records; ``"latest"`` keeps the latest application of each member.
    """

    points: Points = field(default_factory=Points)
    cutoffs: GradeCutoffs = field(default_factory=GradeCutoffs)
    weights: Weights = field(default_factory=Weights)
    delinq_overflow_pts: int | None = None
    population: str = "delinquent"
    null_component: str = "null"
    record_policy: str = "published"

    def __post_init__(self) -> None:
        if self.population not in ("delinquent", "all"):
            raise ValueError(f"population must be 'delinquent' or 'all', got {self.population!r}")
        if self.null_component not in ("null", "unacceptable"):
            raise ValueError(
                f"null_component must be 'null' or 'unacceptable', got {self.null_component!r}"
            )

        if self.record_policy not in ("published", "latest"):
            raise ValueError(f"record_policy must be 'published' or 'latest', got {self.record_policy!r}")

    @property
    def delinq_overflow(self) -> int:
        if self.delinq_overflow_pts is None:
            return self.cutoffs.unacceptable
        return self.delinq_overflow_pts


DEFAULT_CONFIG = ScoreConfig()


@dataclass(frozen=True)
class Layout:
    """Every path the staged job reads or writes, under one root.

    One object owns the paths so that writers and readers can never disagree
    on a folder name. ``root`` must be shared storage on a cluster (the
    folder named by ``spark.checkpoint.dir`` is a good default).
    """

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # raw entity split
    def raw(self, entity: str) -> str:
        return self._p("raw", entity)

    # cleaned entity tables (parquet + csv copies)
    def cleaned(self, table: str, fmt: str = "parquet") -> str:
        return self._p("cleaned", f"{table}_{fmt}")

    # quarantine audit lists
    def bad(self, name: str) -> str:
        return self._p("bad", name)

    # cleaned tables minus quarantined members
    def cleaned_new(self, table: str) -> str:
        return self._p("cleaned_new", table)

    def processed(self, name: str) -> str:
        return self._p("processed", name)

    def database(self, name: str) -> str:
        return self._p("warehouse", f"{name}.db")
