"""Bounded learning samples for the classifiers of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id as text; null ids have fold null."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, label: str, wanted: Column, per_class: dict[int, int], max_chars: int, key: str = "doc_id", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Texts and labels of a bounded sample of labelled rows.

    Of class ``c`` about ``per_class[c]`` rows, never more: those of the least
    hash of the id among the labelled ids with ``wanted`` true, so the sample
    does not depend on the order or the partitions of the tables. The rows are
    found by a bound on the hash, from the number of labelled ids, so what
    reaches the driver does not grow with the tables. Ids with both labels or
    none, and texts that are null or longer than ``max_chars``, are left out.
    """
    k = F.col(f"`{key}`")
    marked = labels.where(wanted & k.isNotNull() & F.col(label).isin(0, 1)).groupBy(k.alias("__id")).agg(F.min(label).alias("y"), F.max(label).alias("z"))
    marked = marked.where("y = z").select("__id", "y", hash31(F.col("__id")).alias("h"))
    found = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}  # two rows
    under = F.lit(False)
    for c, n in per_class.items():
        under = under | ((F.col("y") == c) & (F.col("h") < below(n, found.get(c, 0))))
    chosen = docs.select(k.alias("__id"), F.col(f"`{text}`").alias("t")).where(F.length("t") <= max_chars)
    rows = chosen.join(F.broadcast(marked.where(under)), "__id").groupBy("__id", "y", "h").agg(F.min("t").alias("t")).select("t", "y", "h", "__id").toArrow()
    t, y, h, ids = (rows[c].to_pylist() for c in ("t", "y", "h", "__id"))
    left, texts, kept = dict(per_class), [], []
    for i in sorted(range(len(t)), key=lambda i: (h[i], ids[i])):
        if left.get(y[i], 0) > 0:
            left[y[i]] -= 1
            texts.append(t[i])
            kept.append(y[i])
    return texts, np.array(kept, dtype=np.int64)


def hash31(*columns: Column) -> Column:
    """A hash of 31 bits."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 33)


def below(wanted: int, there: int) -> int:
    """The bound on the hash that about ``wanted`` of ``there`` rows are under."""
    return 2**31 if there <= wanted else int(2**31 * wanted / there)


def logistic(features: np.ndarray, y: np.ndarray, penalty: float = 1e-2, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (the intercept last) of a small logistic regression, by Newton
    steps; the penalty keeps separable data finite."""
    x = np.column_stack([features, np.ones(len(features))])
    w, s = np.zeros(x.shape[1]), np.ones(len(x)) if weight is None else weight
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (s * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (s * (p - y)) + ridge @ w)
        size = np.abs(step).max()
        w -= step * min(1, 5 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w
