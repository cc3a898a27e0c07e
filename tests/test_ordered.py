import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chargelens.operators import ordered

from .frames import START, rows, txns


@pytest.fixture(scope="module")
def skewed(spark):
    """One customer holds a third of the rows, one instant holds a fifth of them."""
    pick = random.Random(5)
    return txns(spark, [
        (i, 7 if i % 3 == 0 else pick.randrange(40), 500 if i % 5 == 0 else pick.randrange(2000),
         pick.randrange(1, 9000) / 100, int(pick.random() < .1)) for i in range(3000)]).cache()


def test_previous_row_of_hot_keys(skewed):
    order = ["timestamp", "transaction_id"]
    plain = skewed.withColumn("p", F.lag("timestamp").over(Window.partitionBy("customer_id").orderBy(*order)))
    for hot_rows in (1, 500, 10_000):
        sliced = ordered.with_previous(skewed, "customer_id", order, "timestamp", "p", hot_rows)
        assert sorted(rows(sliced, "transaction_id", "p"), key=str) == sorted(
            rows(plain, "transaction_id", "p"), key=str)


def test_previous_row_of_a_hot_null_key(skewed, monkeypatch):
    monkeypatch.setattr("chargelens.operators.skew.ROWS_PER_PIECE", 100)
    order = ["timestamp", "transaction_id"]
    open_ = skewed.withColumn("customer_id", F.nullif("customer_id", F.lit(7)))
    plain = open_.withColumn("p", F.lag("timestamp").over(Window.partitionBy("customer_id").orderBy(*order)))
    sliced = ordered.with_previous(open_, "customer_id", order, "timestamp", "p", 500)
    assert sorted(rows(sliced, "transaction_id", "p"), key=str) == sorted(rows(plain, "transaction_id", "p"), key=str)


def test_hot_rows_are_spread_over_slices(skewed, monkeypatch):
    monkeypatch.setattr("chargelens.operators.skew.ROWS_PER_PIECE", 100)
    monkeypatch.setattr(ordered, "FAN", 3)
    seen = []
    original = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df: seen.append(original(df)) or seen[-1])
    order = ["timestamp", "transaction_id"]
    got = ordered.with_previous(skewed, "customer_id", order, "timestamp", "p", 500)
    written = next(df for df in seen if "_slice" in df.columns)
    sizes = [r["count"] for r in written.filter("customer_id = 7").groupBy("_slice").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 400        # 1,000 hot rows, a fifth of them at one instant
    assert written.filter("customer_id != 7 AND _slice IS NOT NULL").count() == 0
    plain = skewed.withColumn("p", F.lag("timestamp").over(Window.partitionBy("customer_id").orderBy(*order)))
    assert sorted(rows(got, "transaction_id", "p"), key=str) == sorted(rows(plain, "transaction_id", "p"), key=str)


def test_hot_keys_read_the_input_once(spark, skewed, tmp_path, monkeypatch):
    """Apart from the search for hot keys and boundaries: one scan in what is written, none after it."""
    path = str(tmp_path / "facts")
    skewed.write.parquet(path)
    plans = []
    original = ordered.materialize
    monkeypatch.setattr(ordered, "materialize",
                        lambda df: plans.append(df._jdf.queryExecution().toString()) or original(df))
    after = ordered.with_previous(spark.read.parquet(path), "customer_id", ["timestamp", "transaction_id"], "timestamp", "p", 500)
    windowed = next(p for p in plans if "lag(" in p and "_slice" in p and path in p)
    physical = windowed[windowed.index("== Physical Plan =="):]
    assert physical.count(path) == 1 and physical.count("Exchange hashpartitioning") == 1
    assert path not in after._jdf.queryExecution().toString()


@pytest.mark.parametrize("finish, cuts", [(100_000, 4096), (50, 16), (1, 64), (1, 2)])
def test_row_at_rank(skewed, monkeypatch, finish, cuts):
    monkeypatch.setattr(ordered, "FINISH_ROWS", finish)
    monkeypatch.setattr(ordered, "CUTS", cuts)
    expected = sorted(rows(skewed, "timestamp", "transaction_id"))
    for rank in (0, 700, 2250):
        assert ordered.row_at_rank(skewed, lambda n: rank) == expected[rank]
    assert ordered.row_at_rank(skewed, lambda n: n) is None


@pytest.mark.parametrize("keys", [
    [i * i * i for i in range(4_000)], [2**62 - i % 7 for i in range(4_000)], [0] * 3_999 + [2**63 - 1],
    [(-1)**i * (1 << i % 62) for i in range(4_000)]])
def test_two_passes_whatever_the_range(spark, monkeypatch, keys):
    passes = []
    for name in ("_sketch", "_census"):
        original = getattr(ordered, name)
        monkeypatch.setattr(ordered, name, lambda *a, f=original, n=name: passes.append(n) or f(*a))
    monkeypatch.setattr(ordered, "FINISH_ROWS", 100)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    assert ordered.row_at_rank(df, lambda n: 3 * n // 4, ["k"]) == (sorted(keys)[3_000],)
    assert passes == ["_sketch", "_census"]


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FINISH_ROWS", 10)
    original = ordered._sketch
    monkeypatch.setattr(ordered, "_sketch", lambda df, order: (original(df, order)[0], [990 + i % 3 for i in range(ordered.CUTS + 1)]))
    df = spark.range(1000).select(F.col("id").alias("k"))
    for rank in (0, 500, 999):
        assert ordered.row_at_rank(df, lambda n: rank, ["k"]) == (rank,)


def test_row_at_rank_before_the_epoch_and_with_microseconds(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FINISH_ROWS", 1)
    times = [datetime(1969, 12, 31, 23, 59, 59, 999_999), datetime(1970, 1, 1), datetime(1960, 5, 5, 1, 2, 3, 4),
             datetime(2030, 1, 1, 0, 0, 0, 1), datetime(2030, 1, 1)]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "timestamp timestamp_ntz, transaction_id bigint")
    for rank, expected in list(enumerate(sorted(times)))[::2]:
        assert ordered.row_at_rank(df, lambda n: rank)[0] == expected


def test_row_at_rank_of_rows_equal_in_every_key(spark, monkeypatch):
    monkeypatch.setattr(ordered, "FINISH_ROWS", 2)
    df = spark.createDataFrame([(5,)] * 10, "k int")
    assert ordered.row_at_rank(df, lambda n: 6, ["k"]) == (5,)


def test_order_key_of_another_type_is_refused(spark):
    with pytest.raises(TypeError, match="order key"):
        ordered.row_at_rank(spark.createDataFrame([("x",)], "k string"), lambda n: 0, ["k"])


@pytest.mark.parametrize("finish", [1, 100])
def test_double_order_keys(spark, monkeypatch, finish):
    monkeypatch.setattr(ordered, "FINISH_ROWS", finish)
    inf, nan = float("inf"), float("nan")
    keys = [-inf, -1e300, -1.5, -0.0, 0.0, 5e-324, 0.1, 0.30000000000000004, 1e300, inf, nan]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k double, id int")
    for rank in (0, 3, 4, 7, 10):
        k, i = ordered.row_at_rank(df, lambda n: rank, ["k", "id"])
        assert i == rank
        early = df.filter(ordered.before((k, i), ["k", "id"]))
        assert sorted(r["id"] for r in early.collect()) == list(range(rank))


@pytest.mark.parametrize("finish", [1, 100])
def test_zoned_and_other_order_keys(spark, monkeypatch, finish):
    """Two instants an hour apart that read the same on the clock when summer time ends stay apart."""
    monkeypatch.setattr(ordered, "FINISH_ROWS", finish)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        micros = [1_761_438_600_000_000, 1_761_442_200_000_000, -1, 0, 1_761_440_000_000_001]
        df = spark.createDataFrame([(m,) for m in micros], "m bigint").withColumn("k", F.timestamp_micros("m"))
        for rank, m in list(enumerate(sorted(micros)))[::2]:
            point = ordered.row_at_rank(df, lambda n: rank, ["k"])
            assert point[0] == ordered.EPOCH + timedelta(microseconds=m)
            assert df.filter(ordered.before(point, ["k"])).count() == rank
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    for sql in ("date_add(date'2020-01-01', cast(id as int))", "cast(id / 7 as decimal(20,4))", "cast(id / 7 as float)"):
        df = spark.range(50).selectExpr(f"{sql} AS k", "id")
        early, late, point = ordered.temporal_split(df, 0.25, ["k", "id"])
        assert (early.count(), late.count(), point[1]) == (37, 13, 37)


@pytest.mark.parametrize("n, train", [(4, 3), (5, 3), (7, 5), (1, 0)])
def test_split_truncates_the_train_size(spark, n, train):
    df = txns(spark, [(i, 1, 60 * i, 1, 0) for i in range(n)])
    early, late, point = ordered.temporal_split(df, 0.25)
    assert (early.count(), late.count()) == (train, n - train)
    assert point == (START + timedelta(seconds=60 * train), train)


def test_split_through_equal_timestamps(spark):
    df = txns(spark, [(i, 1, 0, 1, 0) for i in range(8)])
    early, late, point = ordered.temporal_split(df, 0.25)
    assert sorted(rows(early, "transaction_id")) == [(i,) for i in range(6)]
    assert sorted(rows(late, "transaction_id")) == [(6,), (7,)]


def test_split_of_nothing(spark):
    early, late, point = ordered.temporal_split(txns(spark, [(1, 1, 0, 1, 0)]).limit(0), 0.25)
    assert (early.count(), late.count(), point) == (0, 0, None)


def test_split_moves_no_rows(skewed):
    early, _, _ = ordered.temporal_split(skewed, 0.25)
    assert "Exchange" not in early._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_numbers_are_dense_and_ordered(spark, skewed, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        numbered = ordered.number_rows(skewed, ["timestamp", "transaction_id"], "n")
        got = sorted(rows(numbered, "n", "timestamp", "transaction_id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = sorted(rows(skewed, "timestamp", "transaction_id"))
    assert got == [(i, *r) for i, r in enumerate(expected, 1)]


@pytest.mark.parametrize("bounded", [True, False])
def test_running_totals(spark, bounded):
    df = spark.createDataFrame([(i, i % 4, 1) for i in range(500)], "k int, a int, b int")
    out = ordered.running_totals(df, [F.desc("k")], {"ta": "a", "tb": "b"}, bounded)
    got = {r["k"]: (r["ta"], r["tb"], r["ta_all"], r["tb_all"]) for r in out.collect()}
    for k in range(500):
        later = range(k, 500)
        assert got[k] == (sum(i % 4 for i in later), len(later), sum(i % 4 for i in range(500)), 500)


@pytest.mark.parametrize("keys", [
    [0, 4_000, 4_001, 4_005, 2**62], [-2**63, -5, 0, 3, 2**63 - 1], [-2**62 - 3, -2**62, 2**61, 2**62, 2**62 + 1]])
def test_rank_of_keys_beyond_doubles(spark, monkeypatch, keys):
    monkeypatch.setattr(ordered, "FINISH_ROWS", 1)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    assert [ordered.row_at_rank(df, lambda n, i=i: i, ["k"])[0] for i in range(len(keys))] == sorted(keys)


@pytest.mark.parametrize("finish", [1, 100])
def test_null_order_keys_are_refused(spark, monkeypatch, finish):
    monkeypatch.setattr(ordered, "FINISH_ROWS", finish)
    df = spark.createDataFrame([(i if i > 1 else None, i) for i in range(10)], "k bigint, id bigint")
    with pytest.raises(ValueError, match="order key k is null in 2 rows"):
        ordered.temporal_split(df, 0.25, ["k", "id"])
    with pytest.raises(ValueError, match="order key k"):
        ordered.temporal_split(df, 0.25, ["id", "k"])
