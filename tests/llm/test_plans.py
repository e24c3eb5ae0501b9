"""A third of all rows under one key: the joins of the operators split it."""

import pytest
from pyspark.sql import functions as F

from docketlake.llm.common import per_key
from docketlake.llm.components import _large_star, _small_star
from tests.test_plans import plan, settings


@pytest.fixture
def splitting(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                  spark__sql__adaptive__coalescePartitions__enabled="false",
                  spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
                  spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
                  spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB"):
        yield spark


def skewed(spark, n=120_000):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(0, n, 1, 12).select(key.alias("k"), F.xxhash64("id").alias("payload"), "id")


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_rows_meet_an_aggregate_of_their_hot_key(splitting, how):
    rows = skewed(splitting)
    groups = per_key(rows, "k", F.count("*").alias("n")).where("n > 1 OR k % 2 = 0")
    out = rows.join(groups, "k", how)
    assert len(out.collect()) == 40_000 + sum(1 for i in range(120_000) if i % 3 and i % 2 == 0)
    assert "skew=true" in plan(out)


@pytest.mark.parametrize("star, hub", [(_large_star, "v"), (_small_star, "u")])
def test_a_hub_of_a_component_is_split(splitting, star, hub):
    # The hub is the smallest node of its links for one star, the largest for the other.
    rows = skewed(splitting).where("k <> id")
    node = F.lit(0) if hub == "v" else F.lit(10_000_000)
    other = F.col("id") + 1
    hot = rows.select((other if hub == "v" else node).cast("bigint").alias("u"),
                      (node if hub == "v" else other).cast("bigint").alias("v"))
    chains = splitting.range(0, 120_000, 2, 12).select(
        (F.col("id") + 20_000_001).alias("u"), (F.col("id") + 20_000_000).alias("v"))
    out = star(hot.unionAll(chains))
    got = {(r.u, r.v) for r in out.collect()}
    assert len(got) == hot.count() + 60_000
    assert "skew=true" in plan(out)
