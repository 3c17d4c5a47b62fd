"""Archives: round trip, determinism, lost attempts and edge rows."""

import gzip
import hashlib
import os
import re

import duckdb
import pytest

from lendgrade.llm import registry, warc
from lendgrade.session import fresh_dir

DDL = "page_id bigint, url string, html string, sha string, bin int, shard int, kind int"


def odd_pages(spark):
    rows = [(i, f"http://h/{i % 7}?x=\u00e4 b\r\n", "same" if i % 3 == 0 else f"<p>page {i}</p>\r\n\r\nWARC/1.1") for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (None, "u", "no id"), (None, "u", "same"), (59, "again", rows[59][2]), (59, "again", rows[59][2]), (200, "u", "x" * 300_000)]
    return spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], DDL)


def test_query_matches_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_small}/pages.parquet')")
    cur = con.execute(registry.ORACLE_SQL["op2_warc_shards"])
    got = registry.op2_warc_shards(spark, sf_small).select(*[c[0] for c in cur.description]).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cur.fetchall()))


def test_round_trip_and_determinism(spark):
    pages = odd_pages(spark)
    seen = []
    for parts in (1, 5):
        out = fresh_dir(spark, "warc-test")
        manifest = warc.write(pages.repartition(parts), out, shard_bytes=4000, file_bytes=1500)
        back = warc.read(spark, manifest, out, with_payload=True).collect()
        path = out.removeprefix("file:")
        seen.append({f: hashlib.sha256(open(f"{path}/data/{f}", "rb").read()).hexdigest() for f in os.listdir(f"{path}/data") if f.endswith(".gz")})
        assert not os.path.exists(f"{path}/temporary")
        assert {r.name: r.sha1 for r in manifest.collect()}.keys() == seen[-1].keys() and len(seen[-1]) > 3
        # files are ranges of ids, sorted within (a hot bin would be dealt by digest)
        raw = {r.name: gzip.decompress(open(f"{path}/data/{r.name}", "rb").read()) for r in manifest.collect()}
        assert all(len(r.name) and r.bytes <= 1500 or r.records == 1 for r in manifest.collect())
        assert all(b.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for b in raw.values())
    assert seen[0] == seen[1]
    source = pages.collect()
    assert len(back) == len(source)
    payloads = {}
    for r in source:
        payloads.setdefault(r.html or "", []).append(r.page_id)
    for r in back:
        if r.record_type == "response":
            assert r.refers_to is None and len(r.payload) == r.payload_bytes and warc.digest(r.payload) == r.payload_digest
            ids = payloads[r.payload.decode()]
            assert r.page_id == max((i for i in ids if i is not None), default=None)
    by = {warc.digest(p.encode()): max((i for i in ids if i is not None), default=None) for p, ids in payloads.items()}
    assert sum(r.record_type == "response" for r in back) == len(payloads)
    assert all(r.refers_to == by[r.payload_digest] for r in back if r.record_type == "revisit")


def test_hot_id_is_dealt_by_digest(spark):
    rows = [(7, "u", f"payload {i} " * 20) for i in range(400)] + [(i, "u", "small") for i in range(100, 160)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = fresh_dir(spark, "warc-hot")
    manifest = warc.write(pages, out, shard_bytes=20_000)
    assert manifest.count() >= 5
    back = warc.read(spark, manifest, out).collect()
    assert len(back) == len(rows) and sum(r.record_type == "response" for r in back) == 401


def test_damage_and_empty_tables(spark):
    pages = odd_pages(spark)
    assert warc.archive(pages.limit(0)).collect() == []
    good = warc.page_record(1, "u", b"abc", "sha", 0, 1)
    fields, block = warc.parse(gzip.decompress(good))
    assert fields["WARC-Type"] == "response" and block.endswith(b"abc")
    with pytest.raises(ValueError):
        warc.parse(gzip.decompress(good).replace(b"abc", b"abd"))

    class Source:
        def __init__(self, data):
            self.data = data

        def read(self, n):
            part, self.data = self.data[:7], self.data[7:]
            return part

    assert len(list(warc.members(Source(good * 3)))) == 3
    with pytest.raises(EOFError):
        list(warc.members(Source(good[:-9])))


def test_shards_are_ranges_beside_an_outlier(spark):
    ids = [*range(1000, 1400), 10**15]
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 40) for i in ids], "page_id bigint, url string, html string")
    out = fresh_dir(spark, "warc-test")
    held = {}
    for r in warc.write(pages, out, shard_bytes=20_000).collect():
        raw = gzip.decompress(open(f"{out.removeprefix('file:')}/data/{r.name}", "rb").read())
        held.setdefault(r.shard, []).extend(int(x) for x in re.findall(rb"http://h/(\d+)", raw))
    assert sorted(x for s in held.values() for x in s) == ids and len(held) > 10
    ranges = [(min(s), max(s)) for _, s in sorted(held.items())]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("most", [65_536, 7])
def test_few_groups_of_many_shards(spark, monkeypatch, most):
    """More shards than groups: ranges stay whole, sorted and the same for any
    partitions; nothing that the driver holds passes the number of groups."""
    monkeypatch.setattr(warc, "GROUPS", most)
    monkeypatch.setattr(warc, "RANGE_IDS", 50)
    rows = [(i, f"http://h/{i}", f"page {i} " * 40) for i in [*range(1000, 1300), 10**9, 10**15]]
    rows += [(1100, "http://h/1100", f"copy {i} " * 60) for i in range(300)]  # an id of many shards
    rows += [(1200, "http://h/1200", f"copy {i} " * 60) for i in range(30)]  # one of a few
    rows += [(None, "http://h/", f"no id {i} " * 60) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    seen = []
    for parts in (1, 6):
        out = fresh_dir(spark, "warc-test")
        manifest = warc.write(pages.repartition(parts), out, shard_bytes=8000, file_bytes=3000).collect()
        assert len({(r.shard, r.number) for r in manifest}) == len(manifest) and len({r.shard for r in manifest}) > 20
        held = {}
        for r in sorted(manifest):
            raw = gzip.decompress(open(f"{out.removeprefix('file:')}/data/{r.name}", "rb").read())
            held.setdefault(r.shard, []).extend(int(x or -1) for x in re.findall(rb"http://h/(\d*)", raw))
        order = [i for _, shard in sorted(held.items()) for i in shard]
        assert order == sorted(-1 if i is None else i for i, *_ in rows)  # sorted through all shards
        seen.append(sorted((r.name, r.sha1) for r in manifest))
        back = warc.read(spark, spark.read.parquet(f"{out}/manifest"), out).collect()
        assert len(back) == len(rows) and sum(r.record_type == "revisit" for r in back) == 30
    assert seen[0] == seen[1]
    count, each, ids, groups, wide = warc._groups(warc.places(warc.keys_of(pages), 8000))
    assert count <= most and len(ids) <= most and len(set(groups)) == len(groups) and wide.count() <= max(2, most)
