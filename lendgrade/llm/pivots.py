"""Embedding near-duplicates by a pivot-permutation index.

Reference points (pivots) are drawn from the rows of each class of vectors
(equal label and dimension), spread out: a row closer to a pivot than two links
reach is none, so a dense group has few of them, however many rows it holds. A
vector is described by its nearest pivots in order. Inverted lists hold, for
every pair of pivots, the vectors that have both among their ``LISTED`` nearest
ones; a vector asks the lists of the pairs of its ``home`` nearest pivots for
those that share at least ``shared`` pivots with it, or its nearest one, and
true cosines are verified in double precision. Vectors close to one pivot are
in a list of its own besides. Classes of all sizes have the same lists.

Equal vectors are one entry with a multiplicity. A list is dealt into blocks
of bounded size, and pairs of blocks are dealt by hash into groups of the
shuffle: a hot list is many tasks, and many short lists are one group, as lists
outnumber what a group each would cost. A pair that meets in several lists counts in one only: that
of a single pivot, else the one of the least number. Groups return, per vector,
the number of rows linked, and of the links a spanning forest: as many rows as
the group has, not as many as its pairs.

Results at the edges: vectors that are null or empty, have length zero, or
hold null or non-finite components, and rows whose label is null, link with
nothing: ``n_links`` 0, a component of their own. Rows with null ids are no
copies of each other's id but link as other rows do. An empty table gives an
empty result. Only id, vector and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import TYPE_CHECKING

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendgrade.llm.common import components, landed, matrix

if TYPE_CHECKING:
    import pyarrow as pa

#: Rows per pivot, and the bounds of the pivots of a class.
ROWS_PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 48, 16, 1024
#: Rows drawn for each pivot, to have enough of them that are spread out.
DRAWN = 4
#: Length of the descriptions, nearest pivots whose pairs a vector asks, those
#: whose pairs it is listed under, pivots that candidates share.
ORDER, HOME, LISTED, SHARED = 8, 3, 5, 3
#: Members of a list that are compared with as many others at once.
BLOCK = 1024
#: Numbers in the vectors of one group of the shuffle, which holds many lists,
#: and pairs of them counted at once.
GROUP, PAIRS = 1 << 20, 1 << 16
#: Cosine to the nearest pivot from which a vector is close to it.
CLOSE = 0.8


def _entries(df: DataFrame, vector: str, label: str, key: str) -> DataFrame:
    """Distinct valid vectors of each label: (least id, copies)."""
    v = F.col("v")
    rows = df.select(F.col(f"`{key}`").alias("id"), F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double")).alias("v"), F.col(f"`{label}`").alias("label"))
    sound = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    rows = rows.withColumn("sound", F.coalesce(sound & F.col("label").isNotNull() & (norm > 0) & (norm < float("inf")), F.lit(False)))
    # -0.0 and 0.0 are one value; vectors of floats stay floats, half the size
    kind = "array<float>" if dict(df.dtypes)[vector] == "array<float>" else "array<double>"
    return rows.withColumn("v", F.when(F.col("sound"), F.transform(v, lambda x: x + 0.0)).cast(kind))


def list_keys(near: np.ndarray, close: np.ndarray, home: int = HOME, listed: int = LISTED) -> tuple[np.ndarray, int]:
    """The lists of each vector, those it asks first, and how many these are:
    that of its nearest pivot alone, if it is ``close`` to it (else -1, which is
    no list), as its other pivots are far then and hardly in one order; and those
    of the pairs of its nearest pivots, whatever their order. Where there is one
    pivot only, all are in its list."""
    base = MOST_PIVOTS + 1
    if near.shape[1] < 2:
        return near[:, :1].astype(np.int64) + base**2, 1
    spots = sorted(combinations(range(min(listed, near.shape[1])), 2), key=lambda c: (c[-1], c))
    pairs = np.sort(near[:, np.array(spots)], axis=2).astype(np.int64)
    own = np.where(close, near[:, 0] + base**2, -1)
    return np.column_stack([own, pairs[:, :, 0] * base + pairs[:, :, 1]]), 1 + sum(c[-1] < home for c in spots)


def is_single(number: int | np.ndarray) -> bool | np.ndarray:
    """Whether a list (``list_keys``) is that of a single pivot."""
    return number >= (MOST_PIVOTS + 1) ** 2


def spread_out(drawn: np.ndarray, least: float, most: int) -> np.ndarray:
    """Of ``drawn`` vectors, in order, the first ``most`` that are further from
    each other than two links reach (twice the angle of ``least``)."""
    unit = drawn / np.linalg.norm(drawn, axis=1)[:, None]
    bound = 2 * least * least - 1
    free, some = np.ones(len(drawn), dtype=bool), []
    for i in range(len(drawn)):
        if free[i] and len(some) < most:
            some.append(i)
            free &= unit @ unit[i] < bound
    return drawn[some]


def spanning(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links ``a`` to ``b`` join trees of ``root``, which gets them."""
    some = []
    at, pick = np.arange(len(a)), np.empty(len(root), dtype=np.int64)
    while True:
        while (root[root] != root).any():
            root[:] = root[root]
        apart = root[a[at]] != root[b[at]]
        at = at[apart]
        if not len(at):
            return np.concatenate([np.zeros(0, dtype=np.int64), *some])
        # each tree takes one link to a tree of lesser root, so no circle closes
        hi, lo = np.maximum(root[a[at]], root[b[at]]), np.minimum(root[a[at]], root[b[at]])
        pick[hi] = np.arange(len(at))
        one = pick[hi] == np.arange(len(at))
        root[hi[one]] = lo[one]
        some.append(at[one])


def linked(group: pa.Table, least: float, home: int, shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links that count in the lists of ``group``, which holds both blocks of
    every pair of blocks whole: (entry, itself, number of rows linked), and
    (entry, entry, 0) for those of a spanning forest."""
    col = {c: group[c].to_numpy() for c in ("e", "copies", "close", "asking", "class", "pivot", "block", "lo", "hi")}
    # pairs of blocks one after the other, their lower block first, in a block those who ask first
    order = np.lexsort((~col["asking"], col["block"], col["hi"], col["lo"], col["pivot"], col["class"]))
    col = {c: v[order] for c, v in col.items()}
    x = matrix(group["v"], np.float64)[order]
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = matrix(group["near"])[order]
    keys, asks = list_keys(near, col["close"], home)
    own, pivot, copies, alone = keys[:, 0], col["pivot"], col["copies"], is_single(col["pivot"])
    least_shared = min(shared, near.shape[1])  # a small class has few pivots
    entries, at = np.unique(col["e"], return_inverse=True)
    links, root = np.zeros(len(entries), dtype=np.int64), np.arange(len(entries))
    forest = [np.zeros((0, 2), dtype=np.int64)]

    def count(a: np.ndarray, b: np.ndarray) -> None:
        # pairs that are in one list of a single pivot count there
        mine = (a < b) & (alone[a] | (own[a] != own[b]) | (own[a] < 0))
        a, b = a[mine], b[mine]
        if (rest := ~alone[a]).any():
            c, d = a[rest], b[rest]
            equal = near[c][:, :, None] == near[d][:, None, :]
            ok = (equal.sum(axis=(1, 2)) >= least_shared) | equal[:, 0, 0]
            # others count in the list of the least key where they meet
            equal = keys[c][:, 1:, None] == keys[d][:, None, 1:]
            equal[:, asks - 1 :, asks - 1 :] = False
            meet = np.where(equal.any(axis=2), keys[c][:, 1:], pivot[c][:, None]).min(axis=1)
            mine = ~rest
            mine[rest] = ok & (meet == pivot[c])
            a, b = a[mine], b[mine]
        u, v = at[a], at[b]
        np.add.at(links, u, copies[b])
        np.add.at(links, v, copies[a])
        some = spanning(root, u, v)
        forest.append(np.column_stack([u[some], v[some]]))

    # of two rows that do not ask, neither asks this list
    new = np.ones(len(x), dtype=bool)
    new[1:] = np.any([col[c][1:] != col[c][:-1] for c in ("class", "pivot", "lo", "hi")], axis=0)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(x))
    same = col["lo"][start] == col["hi"][start]
    low = col["block"] == col["lo"]
    middle = np.where(same, start, start + np.add.reduceat(low, start, dtype=np.int64))
    asked = start + np.add.reduceat(col["asking"] & low, start, dtype=np.int64)
    asked_too = np.where(same, middle, middle + np.add.reduceat(col["asking"] & ~low, start, dtype=np.int64))
    boxes = np.concatenate([np.column_stack([start, asked, middle, end]), np.column_stack([asked, middle, middle, asked_too])])
    boxes = boxes[(boxes[:, 0] < boxes[:, 1]) & (boxes[:, 2] < boxes[:, 3])]
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for k, (i, j, m, n) in enumerate(boxes.tolist(), 1):
        a, b = np.nonzero(x[i:j] @ x[m:n].T >= least)
        if len(a):
            pairs.append((a + i, b + m))
            size += len(a)
        if size and (size > PAIRS or k == len(boxes)):
            a, b = (np.concatenate(p) for p in zip(*pairs))
            for s in range(0, size, PAIRS):
                count(a[s : s + PAIRS], b[s : s + PAIRS])
            pairs, size = [], 0
    full = np.flatnonzero(links)
    tree = entries[np.concatenate(forest)]
    return np.append(entries[full], tree[:, 0]), np.append(entries[full], tree[:, 1]), np.append(links[full], np.zeros(len(tree), dtype=np.int64))


def near_duplicates(
    df: DataFrame,
    least: float = 0.98,
    vector: str = "embedding",
    label: str = "label",
    key: str = "vec_id",
    order: int = ORDER,
    home: int = HOME,
    shared: int = SHARED,
) -> DataFrame:
    """``key``, n_links, component_id, kept for every row of ``df``."""
    import pandas as pd
    import pyarrow as pa

    rows = landed(_entries(df, vector, label, key), "vectors")
    sound = rows.where("sound").groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    # entries are numbered as they are written, since ids may be null or repeat
    sound = landed(sound.withColumn("e", F.monotonically_increasing_id()), "entries")
    spot = F.struct(F.shiftrightunsigned(F.xxhash64("label", "v"), 33).alias("o"), "e")
    numbered = landed(sound.select("e", "label", F.size("v").alias("dim"), spot.getField("o").alias("o")), "numbered")
    classes = numbered.groupBy("label", "dim").agg(F.count("*").alias("n"), F.min(F.struct("o", "e")).getField("e").alias("one"))
    n = F.col("n")
    pivots_wanted = F.least(F.lit(MOST_PIVOTS), F.greatest(F.lit(LEAST_PIVOTS), F.ceil(n / ROWS_PER_PIVOT))).cast("int")
    classes = landed(classes.withColumn("p", pivots_wanted).withColumn("class", F.monotonically_increasing_id()), "classes")
    # pivots: p entries of each class, spread out, of DRAWN times as many by a
    # hash threshold; found by number, so that only the drawn vectors are dealt by class
    share = F.lit(float(2**31)) * F.least(F.lit(1.0), DRAWN * F.col("p") / n)
    # the entry of least hash is one always, so no class is without
    some = numbered.join(classes, ["label", "dim"]).where((F.col("o") < share) | (F.col("e") == F.col("one")))
    drawn = sound.select("e", "v").join(some.select("e", "o", "label", "dim", "p", "class"), "e")
    drawn = drawn.groupBy("label", "dim", "class").agg(F.first("p").alias("p"), F.sort_array(F.collect_list(F.struct("o", "v"))).alias("drawn"))
    drawn = drawn.select("label", "dim", "class", "p", F.col("drawn.v").alias("drawn"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = [spread_out(np.array([list(r) for r in d], dtype=np.float64), least, p).tolist() for d, p in zip(batch["drawn"], batch["p"])]
            yield pd.DataFrame({"label": batch["label"], "dim": batch["dim"], "class": batch["class"], "pivots": some})

    kinds = dict(sound.dtypes)
    pivots = landed(drawn.mapInPandas(choose, f"label {kinds['label']}, dim int, class bigint, pivots array<array<double>>"), "pivots")

    described = sound.withColumn("dim", F.size("v")).withColumn("part", F.pmod(F.xxhash64("e"), F.lit(max(1, sound.count() // 4096))).cast("int"))

    def describe(batch: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(batch):
            return pd.DataFrame({c: [] for c in ("e", "near", "keys", "asks", "label", "dim", "class", "v", "copies")})
        x = np.array(batch["v"].tolist(), dtype=np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        p = np.array([list(r) for r in own["pivots"].iloc[0]], dtype=np.float64)  # every class has some
        p /= np.linalg.norm(p, axis=1)[:, None]
        cosine = x @ p.T
        near = np.argsort(-cosine, axis=1, kind="stable")[:, :order]
        keys, asks = list_keys(near, cosine.max(axis=1) >= CLOSE, home)
        one = {"asks": asks, "label": batch["label"], "dim": x.shape[1], "class": own["class"].iloc[0]}
        return pd.DataFrame({"e": batch["e"], "near": list(near), "keys": list(keys), **one, "v": batch["v"], "copies": batch["copies"]})

    # the pivots of a class go to each of its parts: bounded by MOST_PIVOTS vectors a task
    parts = described.select(F.col("label").alias("l"), F.col("dim").alias("d"), F.col("part").alias("p")).distinct()
    parts = parts.join(pivots, (F.col("l").eqNullSafe(F.col("label"))) & (F.col("d") == F.col("dim"))).select("l", "d", "p", "class", "pivots")
    by = ["label", "dim", "part"]
    schema = f"e bigint, near array<int>, keys array<bigint>, asks int, label {kinds['label']}, dim int, class bigint, v {kinds['v']}, copies bigint"
    orders = described.select(*by, "e", "v", "copies").groupBy(*by).cogroup(parts.groupBy("l", "d", "p")).applyInPandas(describe, schema)
    table = landed(orders, "orders")

    # inverted lists, cut into blocks; each pair of blocks is compared
    close = (F.element_at("keys", 1) >= 0).alias("close")
    posts = table.select("e", "near", close, "asks", "v", "copies", "class", "dim", F.posexplode("keys").alias("at", "pivot")).where("pivot >= 0")
    # only long lists are joined, so vectors are shuffled once
    long = posts.groupBy("class", "dim", "pivot").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    long = landed(long.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "long")
    posts = posts.join(long.select("class", "pivot", "blocks"), ["class", "pivot"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    posts = posts.withColumn("block", F.pmod(F.xxhash64("e"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    asking = (F.col("at") < F.col("asks")).alias("asking")
    base = [F.col(c) for c in ("e", "near", "close", "v", "copies", "class", "dim", "pivot", "block")]
    sides = posts.select(*base, asking, other).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    # many lists to a group of the shuffle, as most are short: groups in number as the listed vectors fill them
    numbers = classes.agg(F.sum(F.col("n") * F.col("dim"))).first()[0] or 0
    again = long.agg(F.sum(F.col("n") * (F.col("blocks") - 1) * F.col("dim"))).first()[0] or 0
    groups = F.lit(int((numbers * (1 + LISTED * (LISTED - 1) // 2) + again) // GROUP) + 1)
    sides = sides.withColumn("group", F.pmod(F.xxhash64("class", "pivot", "lo", "hi"), groups)).withColumn("width", F.size("near")).drop("other")

    def verify(group: pa.Table) -> pa.Table:
        e, f, n = linked(group, least, home, shared)
        return pa.table({"e": pa.array(e, pa.int64()), "f": pa.array(f, pa.int64()), "n": pa.array(n, pa.int64())})

    # vectors of one length, and descriptions of one, in a group
    found = landed(sides.groupBy("dim", "width", "group").applyInArrow(verify, "e bigint, f bigint, n bigint"), "found")
    counts = found.where("e = f").groupBy("e").agg(F.sum("n").alias("n"))
    groups = components(found.where("e != f").select(F.col("e").alias("a"), F.col("f").alias("b")))
    table = sound.join(counts, "e", "left").join(groups.withColumnRenamed("node", "e"), "e", "left")
    table = landed(table.select("label", "v", "id", "e", F.col("copies"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "e").alias("component")), "grouped")
    firsts = landed(table.groupBy("component").agg(F.min("id").alias("first")), "firsts")
    table = table.join(firsts, "component").select("label", "v", (F.col("n") + F.col("copies") - 1).alias("n"), "first")
    joined = rows.where("sound").join(table, ["label", "v"]).select("id", "n", "first")
    every = joined.union(rows.where("not sound").select("id", F.lit(0).cast("bigint"), "id"))
    return every.select(
        F.col("id").alias(key), F.col("n").alias("n_links"), F.col("first").alias("component_id"), F.coalesce(F.col("id") == F.col("first"), F.col("first").isNull()).alias("kept")
    )
