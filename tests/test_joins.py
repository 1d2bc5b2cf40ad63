from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from heliotab.operators import joins
from heliotab.sources import testbed


@contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the rows on one key, one in two hundred on another, a twelfth without key."""
    path = str(tmp_path_factory.mktemp("skewed"))
    text = F.repeat(F.lit("x"), 20)
    spark.range(0, 120_000, 1, 16).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 200 = 1 THEN 8 WHEN id % 12 = 1 THEN NULL ELSE id % 5000 END AS k",
    ).withColumn("text", F.concat(text, F.md5(F.col("id").cast("string")))).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 4000, 1, 4).selectExpr("id AS k", "id * 10 AS w")


def _rows(df):
    return sorted(map(str, df.select("id", "k", "w").collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_ways_give_the_same_rows(spark, skewed, lookup, how):
    small = joins.lookup_join(skewed, lookup, "k", 4000, how)
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        large = joins.lookup_join(skewed, lookup, "k", 4000, how, max_bytes=10)
        assert _rows(small) == _rows(large) == _rows(skewed.join(lookup, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_split_beyond_the_broadcast_size(spark, skewed, lookup, how):
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="16",
        adaptive__advisoryPartitionSizeInBytes="256k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="512k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__coalescePartitions__enabled="false",
    ):
        joined = joins.lookup_join(skewed, lookup, "k", 4000, how, max_bytes=10)
        # The text is used too, or only the keys would be shuffled.
        tasks = joined.withColumn("p", F.spark_partition_id()).groupBy("p")
        of_key = [F.count_if(F.col("k") == k).alias(f"k{k}") for k in (7, 8)]
        counts = tasks.agg(F.count("*").alias("n"), *of_key, F.max("text")).collect()
    sizes = [r["n"] for r in counts]
    assert max(sizes) < 120_000 / 6
    assert max(r['k7'] for r in counts) < 40_000 / 3 and max(r['k8'] for r in counts) <= 600


def test_size_of_the_table_that_is_broadcast(lookup):
    assert joins.row_bytes(lookup) == 16
    assert joins.row_bytes(lookup.withColumn("text", F.lit("x"))) == 16 + joins.STRING_BYTES


def test_tables_beyond_the_broadcast_size(spark, sf_dir, monkeypatch):
    """The whole chain of joins gives the same readings when nothing may be broadcast."""
    expected = testbed.readings(spark, sf_dir).collect()
    monkeypatch.setattr(joins, "row_bytes", lambda table: 1 << 50)
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        shuffled = testbed.readings(spark, sf_dir).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, expected))


def test_hashed_lookup_sorts_neither_side(spark):
    big = spark.range(1000).selectExpr("id", "if(id % 10 = 0, NULL, id % 7) AS k")
    lookup = spark.range(5).selectExpr("id AS k", "concat('n', id) AS name")
    plain, hashed = (joins.lookup_join(big, lookup, "k", 5, max_bytes=0, hashed=h) for h in (False, True))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, hashed.collect())) == sorted(map(tuple, plain.collect()))
        plan = hashed._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        small = joins.lookup_join(big, lookup, "k", 5, hashed=True)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
