"""Best-fit packing of token sequences by linear grouping.

Documents become pieces of at most ``capacity`` tokens; pieces are packed
whole. The plan is made on the histogram of piece lengths (at most
``capacity`` numbers, whatever the data):

1. full pieces are sequences of their own;
2. linear grouping: the large lengths, longest first, are cut into groups of
   equal cardinality, and every length counts as its group's greatest;
3. the few group sizes are packed by configurations (Gilmore-Gomory columns:
   a linear program with a knapsack as its pricing step), rounded down, and
   what is left over follows by best fit decreasing;
4. actual documents take the places of their group, which leaves more room
   than planned;
5. the small lengths go best-fit, longest first, into what room there is.

All steps move counts of equal sequences, never single documents. The plan is
a list of runs: "of length L, documents number r to r+n take offset o of
sequences s, s+step, ...". Spark numbers the documents of each length without
bringing a length into one task, and each row finds its run by bisection.

Results at the edges: a null text is an empty one and packs as its end token
alone. Equal rows are packed as often as they occur. Documents of equal
length are numbered by salt, id, piece and digest, so the outcome depends on
the rows alone. An empty table gives an empty result. No columns but the id
and the text are read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendgrade.llm.common import bounded_batches, landed, steps

#: Chunks of text between white space kept by a worker with their ids.
CACHE_CHUNKS, CACHE_LENGTH = 1_600_000, 48
#: A length is large if it is over this share of the capacity; groups of them.
LARGE_SHARES, GROUPS = (0.2, 0.1, 0.34), 48


# ---------------------------------------------------------------- tokenizing


class ChunkTokenizer:
    """Ids of whole texts by a ``tokenizers`` vocabulary that works within
    white space: chunks between white space repeat and are kept with their
    ids, and so are the words and signs that new chunks consist of.

    ``split`` is the vocabulary's own pre-tokenizing pattern and ``word_end``
    the ending that marks the last token of each of its matches.
    """

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_buffer(data)
        spec = json.loads(data)
        # the same merges for words that are split and lower-case already
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.merger = Tokenizer(models.BPE(vocab=spec["model"]["vocab"], merges=merges, end_of_word_suffix=spec["model"]["end_of_word_suffix"], cache_capacity=0))
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.find = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        ending = spec["model"]["end_of_word_suffix"]
        vocabulary = spec["model"]["vocab"]
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(ending)]] = True
        self.special = [t["content"][:2] for t in spec["added_tokens"]]
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _raw(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _plain(self, chunk: str) -> bool:
        """Whether the chunk's words can be told apart here as the vocabulary
        does: letters of the Latin blocks, no capital with a special rule."""
        return max(chunk) < "\u0250" and "\u0130" not in chunk and not any(x in chunk for x in self.special)

    def _learn_words(self, words: list[str]) -> None:
        for i in range(0, len(words), 100):
            some = words[i : i + 100]
            ids = np.array(self.merger.encode(" ".join(some), add_special_tokens=False).ids, dtype="<u4")
            ends = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not end each word by a token of its own")
            raw, at = ids.tobytes(), 0
            for w, e in zip(some, ends.tolist()):
                self.words[w] = raw[at:e]
                at = e

    def _learn(self, chunks: list[str]) -> None:
        if len(self.words) > CACHE_CHUNKS:
            self.words.clear()
        found = {c: self.find(c.lower()) for c in chunks if self._plain(c)}
        self._learn_words(list(set().union(*found.values()).difference(self.words)))
        word = self.words.__getitem__
        for c in chunks:
            parts = found.get(c)
            self.chunks[c] = self._raw(c) if parts is None else b"".join(map(word, parts))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        # U+001C to U+001F part words for str.split, but not for the vocabulary
        odd = [any(c in t for c in "\x1c\x1d\x1e\x1f") for t in texts]
        chunks = [[] if o else t.split() for t, o in zip(texts, odd)]
        distinct = set().union(*chunks)
        new = list(distinct.difference(self.chunks))
        if len(self.chunks) + len(new) > CACHE_CHUNKS:
            self.chunks.clear()
            new = list(distinct)
        self._learn(new)
        for t, o, own in zip(texts, odd, chunks):
            yield self._raw(t) if o else b"".join(map(self.chunks.__getitem__, own))
        for kept in (self.chunks, self.words):
            for c in [c for c in new if len(c) > CACHE_LENGTH]:
                kept.pop(c, None)


_TOKENIZERS: dict[int, ChunkTokenizer] = {}


def worker_tokenizer(data: bytes) -> ChunkTokenizer:
    key = zlib.crc32(data)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = ChunkTokenizer(data)
    return _TOKENIZERS[key]


def pieces(df: DataFrame, tokenizer_file: str, capacity: int, end_id: int, text: str, key: str, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``key``, piece, start, length, ids_crc32 (and ids)."""
    import pyarrow as pa

    spark = df.sparkSession
    bounded_batches(spark)
    with open(tokenizer_file, "rb") as f:  # a vocabulary: does not grow with the data
        sent = spark.sparkContext.broadcast(f.read())
    src = df.select(F.col(f"`{key}`").alias("__key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    schema = StructType([src.schema["__key"], *StructType.fromDDL("piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids).fields])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        tok = worker_tokenizer(sent.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in steps(texts):
                at, rows = [], []
                for k, raw in enumerate(tok.encode(texts[i:j])):
                    raw += end
                    for n, s in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[s : s + 4 * capacity]
                        at.append(i + k)
                        rows.append((n, s // 4, len(part) // 4, zlib.crc32(part), part))
                cols = list(zip(*rows))
                arrays = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:4]]]
                if with_ids:
                    arrays.append(pa.array(cols[4], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return src.mapInArrow(run, schema).withColumnRenamed("__key", key)


# ------------------------------------------------------------------ planning


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole numbers of sequences by configuration (how many of each size one
    sequence takes): the linear program over all configurations, solved by
    columns and rounded down, so no size is used more often than it occurs."""
    k = len(sizes)
    size, need = np.array(sizes), np.array(counts, dtype=float)
    basis = np.diag([float(capacity // s) for s in sizes])  # columns: configurations
    x = need / np.diag(basis)
    for _ in range(60 * k):
        prices = np.linalg.solve(basis.T, np.ones(k))
        # knapsack: the configuration of greatest price within the capacity
        best, taken = np.zeros(capacity + 1), np.zeros((k, capacity + 1), dtype=np.int16)
        for i in np.flatnonzero(prices > 1e-12):
            base = best
            for times in range(1, capacity // sizes[i] + 1):
                at = times * sizes[i]
                value = base[: capacity + 1 - at] + times * prices[i]
                better = value > best[at:] + 1e-12
                best = np.concatenate([best[:at], np.where(better, value, best[at:])])
                taken[i, at:][better] = times
        if best[capacity] <= 1 + 1e-6:
            break
        column, room = np.zeros(k), capacity
        for i in range(k - 1, -1, -1):
            column[i] = taken[i, room]
            room -= taken[i, room] * sizes[i]
        change = np.linalg.solve(basis, column)
        ratio = np.where(change > 1e-9, x / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x = x - step * change
        basis[:, out], x[out] = column, step
    left, plan = np.array(counts), []
    for j in np.argsort(-x):
        column = basis[:, j].round().astype(int)
        n = int(min([np.floor(x[j] + 1e-9), *[left[i] // column[i] for i in range(k) if column[i]]]))
        if n > 0:
            left -= n * column
            plan.append((tuple(int(c) for c in column), n))
    return plan


Runs = list[tuple[int, int, int, int, int, int]]


def plan_runs(histogram: dict[int, int], capacity: int, large_shares: tuple[float, ...] = LARGE_SHARES, groups: int = GROUPS) -> tuple[Runs, int]:
    """The plan of fewest sequences over several bounds of what is large."""
    least = -(-sum(s * n for s, n in histogram.items()) // capacity)
    best: tuple[Runs, int] | None = None
    for share in large_shares:
        plan = plan_once(histogram, capacity, share, groups)
        if best is None or plan[1] < best[1]:
            best = plan
        if best[1] == least:
            break
    return best


def plan_once(histogram: dict[int, int], capacity: int, large_share: float, groups: int) -> tuple[Runs, int]:
    """Where every piece goes, from the number of pieces of each length.

    Returns runs (length, first number, pieces, first sequence, pieces in one
    sequence, offset) and the number of sequences: pieces first + i of the
    length take sequence first_sequence + i // per at offset + length * (i %
    per). The work and the runs depend on the number of distinct lengths.
    """
    runs: Runs = []
    used: dict[int, int] = defaultdict(int)  # pieces of a length placed so far
    sequences = 0

    def place(length: int, n: int, first: int, per: int, offset: int) -> None:
        runs.append((length, used[length], n, first, per, offset))
        used[length] += n

    if histogram.get(capacity):
        place(capacity, histogram[capacity], 0, 1, 0)
        sequences = histogram[capacity]
    lengths = sorted((s for s in histogram if s < capacity and histogram[s]), reverse=True)
    large = [s for s in lengths if s > large_share * capacity]
    # room -> [(first sequence, sequences)]: equal sequences that can take more
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)

    # linear grouping: equal numbers of pieces, longest first
    total = sum(histogram[s] for s in large)
    if total:
        share = -(-total // groups)
        members: list[list[list[int]]] = [[]]  # per group: [length, pieces]
        filled = 0
        few = len(large) <= groups  # few sizes need no rounding
        for s in large:
            n = histogram[s]
            while n:
                if filled == share or few and members[-1]:
                    members.append([])
                    filled = 0
                take = n if few else min(n, share - filled)
                members[-1].append([s, take])
                filled += take
                n -= take
        sizes = [g[0][0] for g in members]
        # groups whose greatest lengths are equal are one size
        merged: dict[int, list[list[int]]] = {}
        for size, g in zip(sizes, members):
            merged.setdefault(size, []).extend(g)
        sizes = list(merged)
        plan = configurations(sizes, [sum(n for _, n in merged[s]) for s in sizes], capacity)
        for column, n in plan:
            # the sequences of this configuration, split where the actual lengths change
            open_: list[tuple[int, int, int]] = [(sequences, n, 0)]  # first, sequences, tokens used
            sequences += n
            for size, times in zip(sizes, column):
                for _ in range(times):
                    after = []
                    for first, m, offset in open_:
                        while m:
                            s, have = merged[size][0]
                            take = min(m, have)
                            place(s, take, first, 1, offset)
                            after.append((first, take, offset + s))
                            merged[size][0][1] -= take
                            if not merged[size][0][1]:
                                merged[size].pop(0)
                            first, m = first + take, m - take
                    open_ = after
            for first, m, offset in open_:
                rooms[capacity - offset].append((first, m))

    # what is left over of the large lengths, then the small ones: best fit
    from bisect import bisect_left, insort

    keys = sorted(r for r in rooms if r > 0)

    def put(room: int, first: int, m: int) -> None:
        if room > 0 and m > 0:
            if not rooms[room]:
                insort(keys, room)
            rooms[room].append((first, m))

    for s in lengths:
        left = histogram[s] - used[s]
        while left:
            at = bisect_left(keys, s)
            if at == len(keys):
                per = capacity // s
                m = -(-left // per)
                put(capacity, sequences, m)
                sequences += m
                continue
            room = keys[at]
            first, m = rooms[room].pop()
            if not rooms[room]:
                keys.pop(at)
            per = room // s
            full = min(m, left // per)
            if full:
                place(s, full * per, first, per, capacity - room)
                left -= full * per
                put(room - per * s, first, full)
                first, m = first + full, m - full
            if left and m:  # fewer than a sequence takes
                place(s, left, first, left, capacity - room)
                put(room - left * s, first, 1)
                first, m, left = first + 1, m - 1, 0
            put(room, first, m)
    return runs, sequences


# ------------------------------------------------------------------ placing


def pack(df: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 1, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``key``, piece, start, length, ids_crc32, sequence_id, offset (and the
    ids of the piece): every text, as few sequences as the plan finds."""
    spark = df.sparkSession
    cut = landed(pieces(df, tokenizer_file, capacity, end_id, text, key, with_ids), "pieces")
    k = F.col(f"`{key}`")
    total = cut.count()
    # numbering without a hot length in one task: a length is dealt over salts
    salts = max(1, total // 20_000)
    cut = cut.withColumn("salt", F.pmod(F.xxhash64(k, "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    cells = cut.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs, _ = plan_runs(histogram, capacity)
    before = cells.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    numbered = cut.withColumn("number", F.row_number().over(Window.partitionBy("length", "salt").orderBy(k, "piece", "ids_crc32")) - 1)
    numbered = numbered.join(before, ["length", "salt"]).withColumn("number", F.col("number") + F.col("before")).drop("salt", "before")
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)  # in the order of (length, first number)
    sent = spark.sparkContext.broadcast(table)  # bounded by the number of lengths
    return numbered.mapInArrow(_placer(sent, numbered.schema.names), StructType([f for f in cut.drop("salt").schema.fields if f.name != "ids"] + StructType.fromDDL("sequence_id bigint, offset bigint").fields + [f for f in cut.schema.fields if f.name == "ids"])).select(
        k, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])
    )


def _placer(sent, names: list[str]):
    import pyarrow as pa

    def run(batches):
        table = sent.value
        code = table[:, 0] << 40 | table[:, 1] if len(table) else table[:, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {n: batch.column(i) for i, n in enumerate(names)}
            length, number = (np.asarray(cols[n].to_numpy(zero_copy_only=False), dtype=np.int64) for n in ("length", "number"))
            r = table[np.searchsorted(code, length << 40 | number, side="right") - 1]
            i = number - r[:, 1]
            cols["sequence_id"] = pa.array(r[:, 3] + i // r[:, 4], pa.int64())
            cols["offset"] = pa.array(r[:, 5] + length * (i % r[:, 4]), pa.int64())
            order = [n for n in names if n not in ("length", "number", "ids")]
            key_first = [order[0], "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + (["ids"] if "ids" in names else [])
            yield pa.RecordBatch.from_arrays([cols[n] for n in key_first], names=key_first)

    return run
