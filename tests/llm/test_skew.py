"""A key with a third of the rows is split in the joins of the operators' own
frames."""

from contextlib import contextmanager

import pytest

from lendgrade.llm import common, simhash, warc

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "32",
}


@contextmanager
def split_finely(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def plans(monkeypatch):
    """The final plans of the frames that the operators land."""
    seen = []
    land = common.landed

    def watched(df, label):
        df.collect()
        seen.append((label, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]))
        return land(df, label)

    for module in (common, simhash, warc):
        monkeypatch.setattr(module, "landed", watched)
    return seen


def joins(plans, label=None):
    return [line for name, p in plans if label in (None, name) for line in p.splitlines() if "SortMergeJoin" in line]


def test_components_split_the_centre_of_a_star(spark, plans):
    # one centre below its neighbours, one above them: hot in either step
    edges = spark.range(30_000).selectExpr("id + 10 AS a", "CASE id % 3 WHEN 0 THEN 2000000 + id div 30 WHEN 1 THEN 5 ELSE 1000000 END AS b")
    with split_finely(spark):
        out = common.components(edges)
        assert out.count() == edges.select("a").union(edges.select("b")).distinct().count()
    large, small = joins(plans)[:2]
    assert "skew=true" in large and "skew=true" in small, joins(plans)


def test_warc_splits_a_payload_that_many_pages_share(spark, plans):
    pages = spark.range(30_000, numPartitions=8).selectExpr("id AS page_id", "'u' AS url", "CASE WHEN id % 3 = 0 THEN concat('page ', id) ELSE 'same' END AS html")
    with split_finely(spark):
        marks = warc.marked(warc.keys_of(pages))
        marks.collect()
        plan = marks._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "skew=true" in plan, plan
