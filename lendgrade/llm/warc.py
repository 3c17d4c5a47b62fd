"""Deterministic sharded WARC archives, written and read back.

Writing: pages are dealt to shards by ranges of their id, sorted within each,
and written as one gzip member per record; a file is closed before its
compressed size passes the limit. All headers and digests are made anew from
the payload. Of records with equal payloads the one of the largest page id is
the response; the others are revisits of it and carry no payload.

Ranges are cut from the exact number of bytes before each id, a running sum
that Spark makes over ranges of ids, so shards, files and bytes depend on the
rows alone, not on tasks or their order. An id that repeats beyond two shards'
worth (or null ids) takes as many shards as it needs, by payload digest. Tasks
write one shard each, or equally many neighbouring ones where there are more
than ``GROUPS``: what the driver knows and sends is the first id of each such
group, and the ids too large for one, never more than ``GROUPS`` of either.

Committing: every task attempt writes files under names of its own and
reports them; Spark's commit of that report picks one attempt per task. The
files are then renamed to their final names (a step that can be repeated), and
only files that the manifest names are read, so files of lost attempts are
never seen. The folder must be one that all executors share.

Results at the edges: a null page is an empty payload. A page whose id is null
is archived and read back with a null id; as a response it has no number to
refer to. Of repeated rows (equal id and payload) the first is the response if
any is, the others revisit it. An empty table makes no files and an empty
result. Only id, url and page are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendgrade.llm.common import bounded_batches, landed
from lendgrade.session import fresh_dir

#: Uncompressed bytes of a shard, compressed bytes of a file, groups of shards.
SHARD_BYTES, FILE_BYTES, GROUPS = 16 << 20, 4 << 20, 65_536
#: Ids whose running sum one task makes.
RANGE_IDS = 1 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"  # fixed, so that equal input makes equal files
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, number int, name string, temporary string, records bigint, bytes bigint, sha1 string"


def store(uri: str):
    """File system and path of a shared folder, for Python tasks."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + z.flush()


def _urn(page_id, sha: str, copy: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}/{sha}/{copy}').urn}>"


def page_record(page_id, url: str | None, payload: bytes, sha: str, copy: int, top) -> bytes:
    """The response, or the revisit of the page ``top``, of one page."""
    from urllib.parse import quote

    response = page_id == top and copy == 0
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if response else http
    fields = [
        ("WARC-Type", "response" if response else "revisit"),
        ("WARC-Record-ID", _urn(page_id, sha, copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or f"urn:page:{page_id}", safe="!#$%&'()*+,/:;=?@[]~-._")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
    ]
    if not response:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(top, sha, 0)), ("X-Refers-To-Page-Id", "" if top is None else str(top))]
    return record(fields, block)


class _Files:
    """The files of one task attempt, rolled by compressed size."""

    def __init__(self, out: str, limit: int):
        self.fs, self.base = store(out)
        self.limit, self.attempt = limit, uuid.uuid4().hex
        self.sink, self.shard, self.number, self.done = None, None, 0, []

    def add(self, shard: int, member: bytes) -> None:
        if self.shard != shard:
            self.close()
            self.shard, self.number = shard, 0
        elif self.sink is not None and self.size + len(member) > self.limit:
            self.close()
            self.number += 1
        if self.sink is None:
            self.name = f"{shard:07d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.attempt}-{self.name}"
            self.sink = self.fs.open_output_stream(f"{self.base}/temporary/{self.temporary}", compression=None)
            self.size, self.records, self.sum = 0, 0, hashlib.sha1()
            info = f"software: warc\r\nformat: WARC File Format 1.1\r\nfile: {self.name}\r\n".encode()
            self._write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'file/{self.name}').urn}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info))
        self._write(member)
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.sum.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.sink is not None:
            self.sink.close()
            self.done.append((self.shard, self.number, self.name, self.temporary, self.records, self.size, self.sum.hexdigest()))
            self.sink = None


def places(keys: DataFrame, shard_bytes: int) -> DataFrame:
    """(id, first, parts): the first shard of every id, landed, and how many it
    is dealt to. Null ids come first; other ids begin in the shard that the
    bytes before them reach."""
    spark = keys.sparkSession
    size = F.sum(F.col("bytes") + 512).cast("bigint").alias("b")
    blank = keys.where("id IS NULL").agg(size).first()["b"] or 0
    taken = -(-blank // shard_bytes)  # shards of the null ids
    ids = keys.where("id IS NOT NULL").groupBy("id").agg(size)
    ids = landed(ids, "warc-ids")
    ranges = max(1, -(-ids.count() // RANGE_IDS))
    ids = landed(ids.repartitionByRange(ranges, "id").withColumn("range", F.spark_partition_id()), "warc-ranges")
    # one row per range of ids, so the window over all of them is small
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ids.groupBy("range").agg(F.sum("b").alias("all")).select("range", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("range").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("b").over(within), F.lit(0)) + taken * shard_bytes
    first = F.expr(f"CAST(start div {shard_bytes} AS BIGINT)").alias("first")
    parts = F.when(F.col("b") > 2 * shard_bytes, F.ceil(F.col("b") / shard_bytes)).otherwise(1).cast("bigint").alias("parts")
    out = ids.join(landed(offsets, "warc-offsets"), "range").withColumn("start", start).select("id", first, parts)
    if blank:
        out = out.union(spark.createDataFrame([(None, 0, taken)], "id bigint, first bigint, parts bigint"))
    return landed(out, "warc-places")


def _groups(placed: DataFrame) -> tuple[int, int, list[int], list[int], DataFrame]:
    """Number of groups, shards of a group, the first ids of the groups that begin with an id and
    those groups, and the ids that are dealt over several groups."""
    last = placed.agg(F.max(F.col("first") + F.col("parts"))).first()[0] or 1
    each = -(-last // GROUPS)
    starts = placed.where("id IS NOT NULL").groupBy(F.expr(f"first div {each}").alias("g")).agg(F.min("id").alias("id")).orderBy("id").collect()  # GROUPS rows at most
    # an id of more than two groups' bytes has groups of its own: half as many at most
    wide = placed.where(F.col("id").isNull() | (F.col("parts") > 2 * each))
    return -(-last // each), each, [r["id"] for r in starts], [r["g"] for r in starts], wide


def keys_of(pages: DataFrame, key: str = "page_id", page: str = "html") -> DataFrame:
    """(id, sha, bytes) of every page, landed."""
    h = F.coalesce(F.col(f"`{page}`"), F.lit(""))
    rows = pages.select(F.col(f"`{key}`").alias("id"), F.sha1(h.cast("binary")).alias("sha"), F.octet_length(h).cast("bigint").alias("bytes"))
    return landed(rows, "warc-keys")


def marked(keys: DataFrame) -> DataFrame:
    """(id, sha, top): for every id and payload the id of its response."""
    # landed, so that a payload that many pages share can be split in the join
    tops = landed(keys.groupBy("sha").agg(F.max("id").alias("top")), "warc-tops")
    return keys.join(tops, "sha").groupBy("id", "sha").agg(F.max("top").alias("top"))


def write(pages: DataFrame, out: str, key: str = "page_id", url: str = "url", page: str = "html", shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive every page under the shared folder ``out``; returns the
    manifest, read from its committed table."""
    import pyarrow as pa

    spark = pages.sparkSession
    bounded_batches(spark)
    h = F.coalesce(F.col(f"`{page}`"), F.lit(""))
    rows = pages.select(F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").alias("url"), h.alias("page"), F.sha1(h.cast("binary")).alias("sha"))
    keys = keys_of(pages, key, page)
    marks = marked(keys)
    placed = places(keys, shard_bytes)
    count, each, ids, groups, wide = _groups(placed)
    ids_, groups_ = np.array(ids, dtype=np.int64), np.array(groups, dtype=np.int64)

    @F.pandas_udf("bigint")
    def group_of(id_: pd.Series) -> pd.Series:
        at = np.searchsorted(ids_, id_.fillna(0).to_numpy(np.int64), side="right") - 1
        return pd.Series(groups_[np.maximum(at, 0)])

    # one shuffle deals a mark (the id to refer to, the shards of its own) ahead
    # of the pages it is for
    nothing, none = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    marks = marks.join(placed, marks["id"].eqNullSafe(placed["id"])).select(marks["id"], nothing.alias("url"), nothing.alias("page"), "sha", "top", "first", "parts", F.lit(0).alias("kind"))
    both = marks.union(rows.select("id", "url", "page", "sha", none, none, none, F.lit(1)))
    wide = F.broadcast(wide.select(F.col("id").alias("wide_id"), F.col("first").alias("wide_first"), F.col("parts").alias("wide_parts")))
    both = both.join(wide, F.col("id").eqNullSafe(F.col("wide_id")) & F.col("wide_parts").isNotNull(), "left")
    spread = F.expr(f"(wide_first + shiftright(CAST(conv(substring(sha, 1, 6), 16, 10) AS BIGINT) * wide_parts, 24)) div {each}")
    both = both.withColumn("group", F.coalesce(spread, group_of("id")) if ids else spread)
    both = both.repartition(count, "group").sortWithinPartitions("group", "id", "sha", "kind", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, last, top, copy, shard = _Files(out, file_bytes), None, None, 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] == 0:
                    last, top, copy = (r["id"], r["sha"]), r["top"], 0
                    # an id of several shards within one group does not leave it
                    shard = min(r["first"] + (int(r["sha"][:6], 16) * r["parts"] >> 24), (r["group"] + 1) * each - 1)
                    continue
                assert last == (r["id"], r["sha"])
                files.add(shard, page_record(r["id"], r["url"], r["page"].encode("utf-8", "surrogatepass"), r["sha"], copy, top))
                copy += 1
        files.close()
        if files.done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*files.done), (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["shard", "number", "name", "temporary", "records", "bytes", "sha1"])

    fs, base = store(out)
    for d in ("temporary", "data"):
        fs.create_dir(f"{base}/{d}", recursive=True)
    report = both.select("id", "url", "page", "sha", "top", "first", "parts", "kind", "group").mapInArrow(run, MANIFEST)
    report.write.parquet(f"{out}/report")
    report = spark.read.schema(report.schema).parquet(f"{out}/report")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pfs

        fs, base = store(out)
        for batch in batches:
            for r in batch.to_pylist():
                source, target = f"{base}/temporary/{r['temporary']}", f"{base}/data/{r['name']}"
                if fs.get_file_info(source).type == pfs.FileType.File:
                    fs.move(source, target)
                elif fs.get_file_info(target).size != r["bytes"]:
                    raise FileNotFoundError(source)
            yield batch

    report.mapInArrow(rename, report.schema).write.parquet(f"{out}/manifest")
    fs.delete_dir(f"{base}/temporary")  # what lost attempts have left
    return spark.read.schema(report.schema).parquet(f"{out}/manifest")


def members(source) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    z, parts = zlib.decompressobj(31), []
    while chunk := source.read(1 << 18):
        while chunk:
            parts.append(z.decompress(chunk))
            if not z.eof:
                break
            yield b"".join(parts)
            chunk, z, parts = z.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise EOFError("the archive ends inside a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; checks the length and digests."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no WARC record: {version[:40]}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(": "), "") for line in lines)
    n = int(fields["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    if "WARC-Block-Digest" in fields and fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError("the block's digest is wrong")
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != f"sha1:{digest(block.partition(b'\r\n\r\n')[2])}":
        raise ValueError("the payload's digest is wrong")
    return fields, block


RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, file string"


def read(spark: SparkSession, manifest: DataFrame, out: str, with_payload: bool = False) -> DataFrame:
    """The page records of the files that the manifest names."""
    import pyarrow as pa

    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(RECORDS + ", payload binary" * with_payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, base = store(out)
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{base}/data/{name}", compression=None) as source:
                    for data in members(source):
                        f, block = parse(data)
                        if "X-Page-Id" not in f:
                            continue
                        refers = f.get("X-Refers-To-Page-Id", "")
                        own = f["X-Page-Id"]
                        row = (int(own) if own else None, int(f["X-Payload-Length"]), f["WARC-Payload-Digest"][5:], f["WARC-Type"], int(refers) if refers else None, f["WARC-Target-URI"], name)
                        rows.append(row + (block.partition(b"\r\n\r\n")[2],) if with_payload else row)
                        size += len(block) if with_payload else 0
                        if len(rows) == 4096 or size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow)

    files = max(1, manifest.count())
    return manifest.select("name").repartition(files, "name").mapInArrow(run, schema)


def archive(pages: DataFrame, out: str | None = None, **how) -> DataFrame:
    """Write the pages to ``out`` (a new shared folder by default) and return
    the records read back."""
    out = out or fresh_dir(pages.sparkSession, "warc")
    return read(pages.sparkSession, write(pages, out, **how), out)
