import pytest
from pyspark.sql import functions as F

from chargelens.operators import skew

from .frames import rows


@pytest.fixture(scope="module")
def fact(spark):
    return spark.range(2000).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("bigint").alias("customer_id")).cache()


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(40).select(F.col("id").alias("customer_id"), (F.col("id") * 1.5).alias("spend"))


def test_hot_keys(fact):
    hot = skew.hot_keys(fact, "customer_id", 500)
    assert rows(hot, "_hot", "_rows", "_pieces") == [(1, fact.filter("customer_id = 1").count(), 2)]


def test_hot_keys_are_found_in_a_sample(spark, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLED_ROWS", 200)
    many = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"))
    hot = skew.hot_keys(many, "k", 20_000)
    (key, size), = rows(hot, "_hot", "_rows")
    assert key == -1 and 25_000 < size < 42_000


def test_every_hot_key_is_found(spark):
    many = spark.range(60_000).select((F.col("id") % 12_000).alias("k"))
    assert skew.hot_keys(many, "k", 1).count() == 12_000


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [1, 500, 10_000])
def test_spread_join_equals_broadcast_join(fact, dim, how, hot_rows, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_PIECE", 100)
    small = skew.join_dimension(fact, dim, "customer_id", how)
    large = skew.join_dimension(fact, dim, "customer_id", how, broadcast_bytes=5, hot_rows=hot_rows)
    columns = ["transaction_id", "customer_id", "spend"]
    assert sorted(rows(small, *columns), key=str) == sorted(rows(large, *columns), key=str)


def test_a_large_dimension_is_not_broadcast(spark, fact, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = skew.join_dimension(fact, dim, "customer_id", broadcast_bytes=5, hot_rows=500)
        plan = large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "customer_id" in join and "_piece" in join      # only the table of pieces is broadcast
    assert plan.count("BroadcastHashJoin") == 2


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_null_key_is_spread(spark, dim, how, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_PIECE", 100)
    half = spark.range(3000).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("customer_id"))
    assert (None, 15) in rows(skew.hot_keys(half, "customer_id", 500), "_hot", "_pieces")
    small = skew.join_dimension(half, dim, "customer_id", how)
    large = skew.join_dimension(half, dim, "customer_id", how, broadcast_bytes=5, hot_rows=500)
    columns = ["transaction_id", "customer_id", "spend"]
    assert sorted(rows(small, *columns), key=str) == sorted(rows(large, *columns), key=str)


def test_bytes_are_counted_before_a_broadcast(spark, fact):
    wide = spark.range(40).select(F.col("id").alias("customer_id"), F.repeat(F.lit("x"), 1000).alias("spend"))
    assert 40_000 < skew.counted_bytes(wide) < 45_000 and skew.counted_bytes(wide.limit(0)) == 0
    assert "broadcast" in skew.sized(wide)._jdf.queryExecution().toString()
    assert "broadcast" not in skew.sized(wide, 40_000)._jdf.queryExecution().logical().toString()


def test_a_dimension_is_counted_once(spark, fact, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(40).select(F.col("id").alias("customer_id"), F.lit("abc").alias("spend")).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    first = len(skew._counted)
    sizes = [skew.counted_bytes(read()), skew.counted_bytes(read())]
    assert len(skew._counted) == first + 1 and sizes[0] == sizes[1]
    assert skew.counted_bytes(read().filter("customer_id < 5")) < sizes[0] and len(skew._counted) == first + 2
    spark.range(400).select(F.col("id").alias("customer_id"), F.lit("abc").alias("spend")).write.mode("overwrite").parquet(path)
    assert skew.counted_bytes(read()) > 5 * sizes[0]        # other files, counted anew
