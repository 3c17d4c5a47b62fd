"""Hard negatives by L2AP-style threshold joins.

Anchors ask for the first rows by inner product, once among the rows of their
label (positives), then among those of other labels within windows that each
positive's score sets (negatives). Both are threshold joins: all pairs whose
score reaches the anchor's threshold are found exactly, and the threshold is
lowered until every window holds as many rows as are wanted or reaches its
lower end.

A join works on shards of rows and blocks of anchors, each pair of which is
one group of bounded size. In a shard, dimensions are taken in order of their
energy, in runs of ``RUN``. The inverted index of a run lists the rows whose norm
from that run on is not yet covered: by Cauchy-Schwarz, what a row has left
can add no more than its remaining norm times the anchor's. Scores are
accumulated run by run; pairs whose score so far plus the product of the
remaining norms stays under the threshold are dropped; for the others the
dimensions that are not indexed are added last.

Where the first threshold lies is estimated from the mean and spread of an
anchor's scores with ``SAMPLE`` rows; it only decides how many rounds are
needed, never what is found. A round returns no more than the wanted rows per
shard and window, and only windows not yet full go on to the next one.

Entries x = floor(scale * entry) are whole numbers, and scores are exact: rows
whose squares add up to 2^53 or more (entries beyond 370,000 of one value
before scaling) take no part, nor do rows with a null id or label, or a
vector that is null, empty or holds null or non-finite entries. Vectors meet
only those of their own length. Rows that repeat an id stand for themselves;
a row is no positive of an anchor of its own id. Ties go to the smaller id. A positive below zero
has no negatives, one of zero only those of zero. An empty table gives an
empty result. Only id, vector and label are read.
"""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendgrade.llm import learning
from lendgrade.llm.common import landed, matrix

#: Rows of a shard, anchors of a block, anchors that a group handles at a time.
SHARD, BLOCK, STEP = 8192, 16_384, 128
#: Dimensions of one run of the index.
RUN = 16
#: Rows that the first thresholds are estimated from.
SAMPLE = 512
#: Rows aimed at per wanted one, by round; the last round takes whole windows.
AIMS = (4, 64, 1024)
#: Scores are below this.
ANY = 2**60
#: Room for the rounding of norms.
ROOM = 1 + 1e-12


def entries(df: DataFrame, vector: str, label: str, key: str, scale: int) -> DataFrame:
    """(id, label as text, x) of the rows that take part."""
    v, x = F.col("v"), F.col("x")
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double") * scale).alias("v"))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(F.abs(c) < 2.0**27, F.lit(False)) & ~F.isnan(c))
    rows = rows.where(F.coalesce(sound, F.lit(False))).select("id", "label", F.transform(v, lambda c: F.floor(c).cast("int")).alias("x"))
    return rows.where(F.aggregate(x, F.lit(0.0), lambda a, c: a + c.cast("double") * c) < 2.0**53)


class Index:
    """Rows by runs of dimensions, for pairs of at least ``level`` times the
    norm of the other side.

    ``left[j, r]`` is the norm of row j from run r on. Row j is in the lists of
    the runs before ``runs[j]``, where its remaining norm falls under the level.
    """

    def __init__(self, x: np.ndarray, level: float, run: int = RUN):
        self.dims = np.argsort(-(x * x).sum(axis=0), kind="stable")
        self.bounds = [*range(0, x.shape[1], run), x.shape[1]]
        x = x[:, self.dims]
        left = self.left_norms(x)
        listed = (left[:, :-1] * ROOM >= level).sum(axis=1)
        # rows of many runs first, so a list is a range of rows
        self.rows = np.argsort(-listed, kind="stable")
        self.x, self.left, self.runs = x[self.rows], left[self.rows], listed[self.rows]
        self.sizes = [int((listed > r).sum()) for r in range(len(self.bounds) - 1)]

    def left_norms(self, x: np.ndarray) -> np.ndarray:
        squares = np.add.reduceat(x * x, self.bounds[:-1], axis=1)
        return np.sqrt(np.column_stack([np.cumsum(squares[:, ::-1], axis=1)[:, ::-1], np.zeros(len(x))]))

    def reaching(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (i, row, score) of ``q[i]`` whose score is ``least[i]`` or
        more. No ``least[i]`` may lie under the level of the index."""
        q = q[:, self.dims]
        own = self.left_norms(q)
        score = np.zeros((len(q), len(self.x)))
        last = len(self.sizes)
        for r, n in enumerate(self.sizes):
            a, b = self.bounds[r], self.bounds[r + 1]
            score[:, :n] += q[:, a:b] @ self.x[:n, a:b].T
            at = np.minimum(r + 1, self.runs)  # runs added so far
            alive = score + own[:, at] * self.left[np.arange(len(at)), at] * ROOM >= least[:, None]
            if r + 1 == last or np.count_nonzero(alive) * 16 < alive.size:
                break
        i, j = np.nonzero(alive)
        s, at = score[i, j], at[j]
        for r in range(last):  # what is not added yet
            lacks = np.flatnonzero(at == r)
            if len(lacks):
                a, b = self.bounds[r], self.bounds[r + 1]
                s[lacks] += np.einsum("ij,ij->i", q[i[lacks], a:b], self.x[j[lacks], a:b])
                at[lacks] = r + 1
                keep = s + own[i, at] * self.left[j, at] * ROOM >= least[i]
                i, j, s, at = i[keep], j[keep], s[keep], at[keep]
        keep = s >= least[i]
        return i[keep], self.rows[j[keep]], s[keep].astype(np.int64)


def first_of(i: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of every ``i``: higher scores, then smaller ids."""
    order = np.lexsort((ids, -scores, i))
    run = i[order]
    begin = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
    place = np.arange(len(run)) - np.repeat(begin, np.diff(np.append(begin, len(run))))
    return order[place < k]


def thresholds(q: np.ndarray, pool: np.ndarray, windows: list, some: np.ndarray, aim: int | None) -> list[list[int]]:
    """For every anchor and window the threshold above which about ``aim`` of
    the ``pool`` rows of the window are expected; its lower end without aim."""
    if aim is None or not len(some):
        return [[w["lo"] for w in own] for own in windows]
    scores = q @ some.T
    mean, spread = scores.mean(axis=1), scores.std(axis=1)
    bell, out = NormalDist(), []
    for m, s, n, own in zip(mean.tolist(), spread.tolist(), pool.tolist(), windows):
        row = []
        for w in own:
            t = w["lo"]
            if s > 0 and n > aim:
                share = bell.cdf((m - w["hi"]) / s) + aim / n  # of rows above
                if share < 1 - 1e-9:
                    t = max(t, min(w["hi"], int(m - s * bell.inv_cdf(share))))
            row.append(t)
        out.append(row)
    return out


def _search(rows, asked, same: bool, k: int) -> dict[str, np.ndarray]:
    """The first ``k`` of a shard for every window of a block of anchors."""
    out: dict[str, list] = {"no": [], "w": [], "id": [], "score": []}
    x, ids = matrix(rows["x"]).astype(np.float64), rows["id"].to_numpy().astype(np.int64)
    q, own = matrix(asked["x"]).astype(np.float64), asked["id"].to_numpy().astype(np.int64)
    no = asked["no"].to_numpy()
    windows = asked["windows"].to_pylist()
    kind = {v: c for c, v in enumerate(sorted({*rows["label"].to_pylist(), *asked["label"].to_pylist()}))}
    of, q_of = (np.array([kind[v] for v in t["label"].to_pylist()], dtype=np.int64) for t in (rows, asked))
    least = np.array([min(w["t"] for w in ws) for ws in windows], dtype=np.float64)
    norm = np.sqrt((q * q).sum(axis=1))
    # a null vector reaches 0 with every row, and no more
    level = np.where(norm > 0, least / np.where(norm > 0, norm, 1), np.where(least > 0, np.inf, -np.inf))
    groups = [(np.flatnonzero(of == c), np.flatnonzero(q_of == c)) for c in np.unique(q_of)] if same else [(np.arange(len(x)), np.arange(len(q)))]
    for theirs, mine in groups:
        if not len(theirs):
            continue
        index = Index(x[theirs], level[mine].min())
        for a in range(0, len(mine), STEP):
            some = mine[a : a + STEP]
            i, j, s = index.reaching(q[some], least[some])
            i, j = some[i], theirs[j]
            fits = ids[j] != own[i] if same else of[j] != q_of[i]
            i, j, s = i[fits], j[fits], s[fits]
            for n in range(max(len(windows[c]) for c in some)):  # the nth window of each
                lo, hi, name = np.full(len(q), ANY), np.full(len(q), -ANY), np.zeros(len(q), dtype=np.int64)
                for c in some:
                    if n < len(windows[c]):
                        w = windows[c][n]
                        lo[c], hi[c], name[c] = max(w["lo"], w["t"]), w["hi"], w["w"]
                full = np.flatnonzero((s >= lo[i]) & (s <= hi[i]))
                full = full[first_of(i[full], ids[j[full]], s[full], k)]
                for column, values in (("no", no[i[full]]), ("w", name[i[full]]), ("id", ids[j[full]]), ("score", s[full])):
                    out[column].append(values)
    return {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}


def threshold_join(rows: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """(no, w, rank, id, score): of ``rows`` (id, label, x, no) the first ``k`` with a
    score within [lo, hi], for every window of ``asked`` (no, id, label, x,
    windows of w, lo, hi), among rows of the same or of other labels."""
    import pyarrow as pa

    spark = rows.sparkSession
    sizes = rows.groupBy(F.size("x").alias("dim"), "label").agg(F.count("*").alias("n"))
    dims = sizes.groupBy("dim").agg(F.sum("n").alias("all"))
    if same:
        pool = sizes.select("dim", "label", F.col("n").alias("pool"))
    else:
        pool = sizes.join(dims, "dim").select("dim", "label", (F.col("all") - F.col("n")).alias("pool"))
    shards = dims.select("dim", F.ceil(F.col("all") / SHARD).cast("int").alias("shards"))
    asked = asked.withColumn("dim", F.size("x"))
    open_ = landed(asked.join(pool, ["dim", "label"]).join(shards, "dim"), "asked")
    sharded = rows.withColumn("dim", F.size("x")).join(shards, "dim").select("id", "label", "x", "dim", F.pmod(F.xxhash64("no"), F.col("shards")).cast("int").alias("shard"))
    # of each length of vectors, a bounded number of rows for the estimates
    small = learning.hash31(F.col("no"))
    drawn: dict[int, np.ndarray] = {}
    for r in dims.orderBy(F.desc("all")).limit(8).collect():  # other lengths go without estimates
        some = rows.where((F.size("x") == r["dim"]) & (small < learning.below(SAMPLE, r["all"]))).select("x").limit(2 * SAMPLE).toArrow()
        drawn[r["dim"]] = matrix(some["x"]).astype(np.float64)
    done = []
    for aim in (*AIMS, None):
        full = asked_round(open_, drawn, aim and aim * k)
        blocks = full.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = sharded.join(blocks, "dim").select("id", "label", "x", "dim", "shard", every("blocks").alias("block"))
        right = full.join(blocks, "dim").select("no", "id", "label", "x", "windows", F.col("dim").alias("dim_"), F.pmod(F.xxhash64("no"), F.col("blocks")).cast("int").alias("block_"), every("shards").alias("shard_"))

        def search(theirs: pa.Table, mine: pa.Table) -> pa.Table:
            empty = {c: np.zeros(0, np.int64) for c in ("no", "w", "id", "score")}
            return pa.table(_search(theirs, mine, same, k) if len(theirs) and len(mine) else empty)

        pairs = left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim_", "shard_", "block_"))
        found = pairs.applyInArrow(search, "no bigint, w bigint, id bigint, score bigint")
        rank = F.row_number().over(Window.partitionBy("no", "w").orderBy(F.desc("score"), "id"))
        found = landed(found.withColumn("rank", rank).where(F.col("rank") <= k), "found")
        if aim is None:
            done.append(found)
            break
        # full windows are done, as are those searched to their lower end
        windows = full.select("no", F.explode("windows").alias("own")).select("no", "own.w", "own.lo", "own.hi", "own.t")
        counts = found.groupBy("no", "w").agg(F.count("*").alias("n"))
        short = windows.join(counts, ["no", "w"], "left").where((F.coalesce("n", F.lit(0)) < k) & (F.col("t") > F.col("lo")))
        short = landed(short.groupBy("no").agg(F.array_sort(F.collect_list(F.struct("w", "lo", "hi"))).alias("windows")), "short")
        done.append(found.join(short.select("no", F.explode("windows.w").alias("w")), ["no", "w"], "left_anti"))
        if short.isEmpty():
            break
        open_ = landed(open_.drop("windows").join(short, "no"), "asked")
    return reduce(DataFrame.union, [d.select("no", "w", "rank", "id", "score") for d in done])


def asked_round(open_: DataFrame, drawn: dict[int, np.ndarray], aim: int | None) -> DataFrame:
    """``open_`` with the threshold ``t`` of every window, written down, so
    that all shards use the same."""
    import pyarrow as pa

    fields = "windows array<struct<w:bigint,lo:bigint,hi:bigint,t:bigint>>"
    names = [c for c in open_.columns if c != "windows"]
    src = open_.select(*names, "windows")

    def run(batches):
        for batch in batches:
            windows = batch.column(len(names)).to_pylist()
            dim, x, pool = (batch.column(names.index(c)) for c in ("dim", "x", "pool"))
            dims = dim.to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                q = matrix(x.take(pa.array(at))).astype(np.float64)
                ts = thresholds(q, pool.to_numpy()[at], [windows[c] for c in at], drawn.get(int(d), np.zeros((0, int(d)))), aim)
                for c, row in zip(at, ts):
                    for w, t in zip(windows[c], row):
                        w["t"] = t
            own = pa.array(windows, pa.list_(pa.struct([(c, pa.int64()) for c in ("w", "lo", "hi", "t")])))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], own], names=[*names, "windows"])

    kinds = dict(src.dtypes)
    return landed(src.mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in names], fields])), "round")


def mine(
    df: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    vector: str = "embedding",
    label: str = "label",
    key: str = "vec_id",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows with the condition ``anchors`` (over the column
    ``id``). Of the rows of other labels, those are negatives of a positive
    whose score is ``low`` to ``high`` percent of the positive's.
    """
    rows = landed(entries(df, vector, label, key, scale).withColumn("no", F.monotonically_increasing_id()), "rows")
    asked = rows.where(anchors)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("w"), F.lit(-ANY).alias("lo"), F.lit(ANY).alias("hi")))
    close = landed(threshold_join(rows, asked.withColumn("windows", whole), True, positives).select("no", F.col("id").alias("positive_id"), F.col("score").alias("w")), "positives")
    # a window for every score of a positive; the score is its name
    w = F.col("w")
    bounds = close.select("no", w, F.expr(f"({low} * w + 99) div 100").alias("lo"), F.expr(f"({high} * w) div 100").alias("hi")).where((w >= 0) & (F.col("lo") <= F.col("hi")))
    bounds = bounds.groupBy("no").agg(F.array_sort(F.collect_set(F.struct("w", "lo", "hi"))).alias("windows"))
    found = threshold_join(rows, asked.join(bounds, "no"), False, negatives)
    named = close.join(asked.select("no", F.col("id").alias("anchor_id")), "no").join(found, ["no", "w"])
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), w.alias("positive_score"), F.col("score").alias("negative_score"))
