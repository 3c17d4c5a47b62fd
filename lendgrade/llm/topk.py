"""Exact top-k search over binary codes by incremental multi-index hashing.

Vectors become binary codes (bit j is set if component j is above zero). A
code is cut into segments of 16 bits, and a shard of the codes is indexed by
every segment. For a query the segment radius grows: after all codes whose
first j segments lie within radius r, and the others within r - 1, have been
fetched and verified, every code within r * segments + j - 1 bits in all is
known. The search of a query ends when its kth verified distance is covered.

Codes are dealt to shards and queries to blocks; each pair of a shard and a
block of queries is one group, whose size is bounded. Shards give their exact
top k per query, and the least k of these are the result. Of equal codes only
the ``k + 1`` least ids can be among the nearest of any query (one may be the
query itself), so a code that a third of all rows share is a few entries.

Results: the k rows of least Hamming distance, ties by least id, the query's
own row left out (by id); fewer if there are fewer rows. Rows whose vector is
null, empty or holds null or NaN components have no code: they are neither
found nor asked for. Codes are compared with codes of their own length only.
Rows with a null id are left out. Repeated rows (of one id) are one entry. An
empty table gives an empty result. Only id and vector are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendgrade.llm.common import landed

SEGMENT = 16
#: Codes of one shard, and queries of one block.
SHARD_CODES, BLOCK_QUERIES = 32_768, 4_096
SALTS = 64


def codes(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(id, bits, code): the binary code as an array of 16-bit segments."""
    v = F.col("v")
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{vector}`").alias("v")).where(F.col("id").isNotNull() & (F.size(v) > 0))
    rows = rows.where(~F.exists(v, lambda x: x.isNull() | F.isnan(x)))
    segments = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(v) - 1) / SEGMENT).cast("int")),
        lambda s: F.aggregate(
            F.slice(v, s * SEGMENT + 1, F.lit(SEGMENT)), F.lit(0), lambda acc, x: acc * 2 + F.when(x > 0, 1).otherwise(0)
        ),
    )
    return rows.select("id", F.size(v).alias("bits"), segments.alias("code")).distinct()


class Shard:
    """Codes indexed by every segment; ids ascending."""

    def __init__(self, ids: np.ndarray, code: np.ndarray):
        order = np.lexsort((ids,))
        self.ids, self.code = ids[order], code[order]
        self.tables = []
        for s in range(code.shape[1]):
            by = np.argsort(self.code[:, s], kind="stable")
            starts = np.searchsorted(self.code[by, s], np.arange((1 << SEGMENT) + 1))
            self.tables.append((by, starts))

    def nearest(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the exact k nearest codes, ties by id."""
        m = self.code.shape[1]
        seen = np.zeros(len(self.ids), dtype=bool)
        found, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(SEGMENT + 1):
            flips = _masks(radius)
            for s, (by, starts) in enumerate(self.tables):
                keys = flips ^ int(query[s])
                lo, hi = starts[keys], starts[keys + 1]
                full = np.flatnonzero(hi > lo)
                if len(full):
                    n = hi[full] - lo[full]
                    at = np.repeat(lo[full] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    new = by[at]
                    new = new[~seen[new]]
                    seen[new] = True
                    new = new[self.ids[new] != own]
                    d = np.bitwise_count(self.code[new] ^ query).sum(axis=1, dtype=np.int64)
                    found, far = np.concatenate([found, new]), np.concatenate([far, d])
                    if len(found) > k:
                        best = np.lexsort((found, far))[:k]  # positions ascend with ids
                        found, far = found[best], far[best]
                if len(found) == k and far.max() <= radius * m + s:
                    return self.ids[found], far
        best = np.lexsort((found, far))[:k]
        return self.ids[found[best]], far[best]


_MASKS: dict[int, np.ndarray] = {}


def _masks(radius: int) -> np.ndarray:
    if radius not in _MASKS:
        _MASKS[radius] = np.array([sum(1 << i for i in c) for c in combinations(range(SEGMENT), radius)], dtype=np.int64)
    return _MASKS[radius]


def nearest(df: DataFrame, queries, k: int = 10, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(query_id, rank, id, distance): for every row with the condition
    ``queries`` (over the column ``id``) the ``k`` nearest other rows."""
    import pandas as pd

    rows = landed(codes(df, vector, key), "codes")
    asked = rows.where(queries)
    # the k + 1 least ids of each code; salted first, as a code may be hot
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    for by in (["bits", "code", "salt"], ["bits", "code"]):
        salted = salted.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("n") <= k + 1)
    entries = landed(salted.select("id", "bits", "code"), "entries")
    sizes = entries.groupBy("bits").agg(F.count("*").alias("n"))
    sizes = sizes.join(asked.groupBy("bits").agg(F.count("*").alias("q")), "bits")
    sizes = sizes.select("bits", F.ceil(F.col("n") / SHARD_CODES).cast("int").alias("shards"), F.ceil(F.col("q") / BLOCK_QUERIES).cast("int").alias("blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = entries.join(sizes, "bits").select("id", "bits", "code", F.pmod(F.xxhash64("code"), F.col("shards")).cast("int").alias("shard"), every("blocks").alias("block"))
    right = asked.join(sizes, "bits").select("id", "bits", "code", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), every("shards").alias("shard"))

    def search(codes_: pd.DataFrame, asked_: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(codes_) and len(asked_):
            shard = Shard(codes_["id"].to_numpy(np.int64), np.array(codes_["code"].tolist(), dtype=np.uint16))
            for own, q in zip(asked_["id"].tolist(), np.array(asked_["code"].tolist(), dtype=np.uint16)):
                ids, far = shard.nearest(q, own, k)
                out.append(pd.DataFrame({"query_id": own, "id": ids, "distance": far}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "distance": []})

    by = ["bits", "shard", "block"]
    right = right.select(*[F.col(c).alias(f"{c}_") if c in by else F.col(c) for c in right.columns])
    local = left.groupBy(*by).cogroup(right.groupBy(*[f"{c}_" for c in by])).applyInPandas(search, "query_id bigint, id bigint, distance bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
