"""Repeated-member detection, quarantine and exclusion.

Scale notes: duplicate detection is a group-by count, which Spark runs as a
partial aggregate before the shuffle, so even a key holding a third of all
rows sends one row per map task. Exclusion is a left-anti join on the key
(never a broadcast of an unbounded list): AQE broadcasts the quarantine list
only when its measured size is under the broadcast threshold, otherwise it
runs a sort-merge anti join and splits a skewed (hot-key) partition of the
big side. The key can never be NULL (SHA-256 of concat_ws), so the anti join
equals the null-aware ``NOT IN`` of SQL.

``resolve`` applies the record policy before any of this: ``published`` leaves
the applications as they are, so that every member with several is quarantined;
``latest`` keeps the latest application of each member instead. Rank filters
on a window are cut down to one row per member and map task before the
shuffle, so a member with a third of all rows costs no more than the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import EMPTY_IDENTITY_KEY

#: What is done about members with several applications.
POLICIES = ("published", "latest")


def latest_records(df: DataFrame, order: Sequence[str] = ("id",), key: str = "member_id") -> DataFrame:
    """One row per key: the one that is greatest by the columns of ``order``
    (NULLs least; rows equal in all of them by a hash of the row)."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    window = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order], row)
    place = "__place"
    while place in df.columns:
        place += "_"
    return df.withColumn(place, F.row_number().over(window)).where(F.col(place) == 1).drop(place)


def resolve(
    df: DataFrame, policy: str = "published", order: Sequence[str] = ("id",), key: str = "member_id", blank: str = EMPTY_IDENTITY_KEY, maybe: Column | None = None
) -> DataFrame:
    """The applications that the record policy lets through.

    The key of the all-NULL identity names no one member: its rows stay under
    either policy, and are quarantined if there are several. Rows that ``maybe``
    (``may_repeat``) rules out are their member's only ones, and stay in place.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    if policy == "published":
        return df
    known = F.col(key) != blank
    if maybe is None:
        return latest_records(df.where(known), order, key).unionByName(df.where(~known))
    return latest_records(df.where(known & maybe), order, key).unionByName(df.where(~(known & maybe)))


def key_counts(df: DataFrame, key: str = "member_id") -> DataFrame:
    """key, total: rows per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("total"))


def duplicate_members(df: DataFrame, key: str = "member_id", maybe: Column | None = None) -> DataFrame:
    """Keys that occur more than once; those that ``maybe`` (``may_repeat``)
    rules out are not counted."""
    if maybe is not None:
        df = df.where(maybe)
    return key_counts(df, key).where(F.col("total") > 1).select(key)


def duplicate_keys_ranked(df: DataFrame, key: str = "member_id") -> DataFrame:
    """Repeated keys with their row counts, most repeated first."""
    return key_counts(df, key).where(F.col("total") > 1).orderBy(F.col("total").desc())


def quarantine_all_rows(*id_frames: DataFrame, key: str = "member_id") -> DataFrame:
    """Union of id lists, keeping repeats."""
    if not id_frames:
        raise ValueError("need at least one id list")
    out = id_frames[0].select(key)
    for f in id_frames[1:]:
        out = out.unionByName(f.select(key))
    return out


def quarantine(*id_frames: DataFrame, key: str = "member_id") -> DataFrame:
    """Set union of id lists: every key to exclude, once."""
    return quarantine_all_rows(*id_frames, key=key).distinct()


def exclude_members(df: DataFrame, bad: DataFrame, key: str = "member_id", maybe: Column | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not quarantined (left-anti join). Rows that
    ``maybe`` rules out pass in place, and only the others are shuffled."""
    if maybe is not None:
        return exclude_members(df.where(maybe), bad, key).unionByName(df.where(~maybe))
    return df.join(bad.select(key), on=key, how="left_anti")


#: Bits of the filter per listed key, and the most words of 64 bits that it may
#: have (8 MB, sent with the tasks of a stage).
FILTER_BITS, FILTER_WORDS = 16, 2**20
#: With fewer bits per key than this the filter lets too much through to help.
LEAST_BITS = 4


def _place_and_mask(key: str | Column, words: int) -> tuple[Column, Column]:
    """A key's word of the filter, and its four bits there."""
    bits, one = F.xxhash64(key, F.lit(1)), F.lit(1).cast("bigint")
    mask = None
    for i in range(4):
        at = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", one, at)
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int"), mask


def filter_words(keys: int, most: int = FILTER_WORDS) -> int:
    """Words of a filter of so many keys; 0 if it would not help."""
    words = min(most, 1 << max(0, -(-keys * FILTER_BITS // 64) - 1).bit_length())
    return words if words * 64 >= keys * LEAST_BITS else 0


def key_filter(bad: DataFrame, words: int, key: str = "member_id") -> DataFrame:
    """One row with the Bloom filter of the listed keys (``words``), four bits
    of one word per key. Its size is that of ``words``, not of the list."""
    place, mask = _place_and_mask(key, words)
    own = bad.select(place.alias("place"), mask.alias("mask")).groupBy("place").agg(F.bit_or("mask").alias("mask"))
    every = bad.sparkSession.range(words).select(F.col("id").cast("int").alias("place")).join(own, "place", "left")
    cells = F.sort_array(F.collect_list(F.struct("place", F.coalesce("mask", F.lit(0)).alias("mask"))))
    return every.agg(cells.getField("mask").alias("words"))


def may_be_listed(bad: DataFrame, words: int, key: str = "member_id") -> Column:
    """False for keys that are surely not in the list."""
    place, mask = _place_and_mask(key, words)
    cell = F.get(key_filter(bad, words, key).scalar(), place)
    return F.coalesce(cell.bitwiseAND(mask) == mask, F.lit(False))


def repeated_hashes(df: DataFrame, key: str = "member_id") -> DataFrame:
    """Hashes of the keys of several rows (``key_hash``): a number per key is
    shuffled, not the key. Keys that share a hash are listed as well."""
    return df.groupBy(F.xxhash64(key).alias("key_hash")).agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > 1).select("key_hash")


def may_repeat(hashes: DataFrame, words: int | None = None, key: str = "member_id") -> Column | None:
    """False for rows whose key is surely that of no other row, by a filter of
    the written ``repeated_hashes``. All that is done about repeated members
    can leave these rows where they are. None where the list is too long for a
    filter."""
    if words is None:
        words = filter_words(hashes.count())
    if not words:
        return None
    place, mask = _place_and_mask(F.xxhash64(key), words)
    cell = F.get(key_filter(hashes, words, "key_hash").scalar(), place)
    return F.coalesce(cell.bitwiseAND(mask) == mask, F.lit(False))


def exclude_members_filtered(df: DataFrame, bad: DataFrame, key: str = "member_id", words: int | None = None) -> DataFrame:
    """``exclude_members`` for a list too large to broadcast and a table far
    larger: rows that a Bloom filter of the list rules out pass in place, and
    only the others are shuffled to the exact anti join.

    The table is scanned twice for that, with its filters and columns pushed
    down. ``bad`` should be a written list, as it is counted and read for the
    filter and the join. Beyond ``FILTER_WORDS`` words for it, this is the
    plain anti join.
    """
    if words is None:
        words = filter_words(bad.count())
    if not words:
        return exclude_members(df, bad, key)
    maybe = may_be_listed(bad, words, key)
    return df.where(~maybe).unionByName(exclude_members(df.where(maybe), bad, key))


def quarantine_reasons(named: dict[str, DataFrame], key: str = "member_id") -> DataFrame:
    """Audit list: every quarantined key once, with the tables it repeats in
    (``reasons``, comma-separated, sorted). One shuffle on the key; the set
    per key is bounded by the number of tables."""
    tagged = None
    for name, ids in named.items():
        part = ids.select(key, F.lit(name).alias("source"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(F.concat_ws(",", F.array_sort(F.collect_set("source"))).alias("reasons"))
