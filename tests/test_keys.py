from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators.keys import by_rows, highest, latest_per_key, look_up, number_rows, stored_among, unseen


def test_newest_batch_wins_with_one_row_per_key(stg, rows):
    staged = stg("users",
                 dict(batch_id="b1", extract_dts="2024-01-01", user_id=1, city="old"),
                 dict(batch_id="b2", extract_dts="2024-01-02", user_id=1, city="new"),
                 dict(batch_id="b1", extract_dts="2024-01-01", user_id=2, city="only"))
    assert rows(latest_per_key(staged, ["user_id"]), "user_id", "city") == [(1, "new"), (2, "only")]


def test_batch_id_then_all_columns_break_ties(stg, rows):
    same = dict(extract_dts="2024-01-01", user_id=1)
    staged = stg("users", dict(batch_id="b1", city="x", **same), dict(batch_id="b2", city="z", **same),
                 dict(batch_id="b2", city="y", **same), dict(batch_id="b2", **same))
    for order in (staged, staged.orderBy("city"), staged.repartition(3, "city")):
        assert rows(latest_per_key(order, ["user_id"]), "batch_id", "city") == [("b2", "y")]


def test_copies_of_a_hot_key_are_thinned_out_before_the_exchange(spark, rows):
    events = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS v")
    kept = latest_per_key(events, ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert kept.count() == 20_001
    assert rows(kept.where("k = -1")) == [(-1, 0)]


def test_unseen_keeps_rows_without_a_stored_key(stg, core, rows):
    staged = stg("users", dict(user_id=1), dict(user_id=2), dict(user_id=3))
    stored = core("dim_user", dict(user_id=2), dict(user_id=2), dict(user_id=9))
    assert rows(unseen(staged, stored, "user_id"), "user_id") == [(1,), (3,)]


def test_numbering_continues_after_the_highest_key(spark, core, rows):
    stored = core("dim_user", dict(user_sk=3, user_id=5), dict(user_sk=41, user_id=6))
    new = spark.createDataFrame([(8,), (7,)], "user_id BIGINT")
    assert rows(number_rows(new, "user_id", "user_sk", highest(stored, "user_sk"))) == [(42, 7), (43, 8)]
    empty = core("dim_user")
    assert rows(number_rows(new, "user_id", "user_sk", highest(empty, "user_sk"))) == [(1, 7), (2, 8)]


def test_numbering_crosses_pages_and_books(spark):
    keys = [-2**63, -2**41, -65_537, -65_536, -1, 0, 1, 65_535, 65_536, 2**31, 2**40 - 1, 2**40, 2**40 + 1,
            2**41 + 5, 2**63 - 1]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k BIGINT")
    got = {r.k: r.sk for r in number_rows(df, "k", "sk").collect()}
    assert got == {k: i + 1 for i, k in enumerate(keys)}


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.sets(st.one_of(st.integers(-100, 100), st.integers(-2**63, 2**63 - 1),
                         st.integers(2**40 - 200_000, 2**40 + 200_000)), min_size=1, max_size=60))
def test_numbering_is_the_position_in_key_order(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k BIGINT")
    got = {r.k: r.sk for r in number_rows(df, "k", "sk", 10).collect()}
    assert got == {k: i + 11 for i, k in enumerate(sorted(keys))}


def test_numbering_spreads_dense_keys_over_tasks(spark):
    df = spark.range(200_000).selectExpr("id * 2 AS k")
    numbered = number_rows(df, "k", "sk")
    assert numbered.where("sk <> k / 2 + 1").count() == 0
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    # Only the running sum over book sizes is gathered in one place.
    assert plan.count("SinglePartition") == 1


def test_look_up_gives_null_for_unknown_and_null_keys(stg, core, rows):
    rides = stg("rides", dict(ride_id="a", vehicle_id=1), dict(ride_id="b", vehicle_id=7), dict(ride_id="c"))
    vehicles = core("dim_vehicle", dict(vehicle_sk=11, vehicle_id=1))
    assert rows(look_up(rides, vehicles, "vehicle_id", "vehicle_sk"), "ride_id", "vehicle_sk") == [
        ("a", 11), ("b", None), ("c", None)]


def _written(spark, path, n):
    """Keys of n rows as a stored table; many of them take few bytes."""
    spark.range(n).selectExpr("id AS user_id", "id + 1 AS user_sk").write.option("compression", "zstd").parquet(str(path))
    return spark.read.parquet(str(path))


def _broadcasts(df):
    return "Broadcast" in df._jdf.queryExecution().executedPlan().toString()


def test_many_rows_in_small_files_are_not_broadcast(spark, tmp_path):
    few, many = _written(spark, tmp_path / "few", 1_000), _written(spark, tmp_path / "many", 700_000)
    most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    assert many._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < most
    rides = many.select("user_id")
    assert _broadcasts(look_up(rides, few, "user_id", "user_sk"))
    assert _broadcasts(unseen(rides, few, "user_id"))
    found = look_up(rides.selectExpr("user_id + 1 AS user_id"), many, "user_id", "user_sk")
    assert not _broadcasts(found)
    assert found.selectExpr("count(user_sk)", "count_if(user_sk = user_id + 1)", "count(*)").first() == (699_999, 699_999, 700_000)
    new = unseen(rides.selectExpr("user_id + 1 AS user_id"), many, "user_id")
    assert not _broadcasts(new)
    assert [tuple(r) for r in new.collect()] == [(700_000,)]


def test_many_grouped_keys_are_not_broadcast(spark, tmp_path):
    few, many = _written(spark, tmp_path / "few", 1_000), _written(spark, tmp_path / "many", 700_000)
    assert _broadcasts(stored_among(many, few, "user_id"))
    among = stored_among(many, many.unionByName(few), "user_id")
    assert not _broadcasts(among)
    assert among.count() == 700_000


def test_rows_are_not_counted_where_that_would_be_work(spark, tmp_path):
    few = _written(spark, tmp_path / "few", 1_000)
    failing = few.groupBy("user_id").agg(F.max("user_sk").alias("user_sk")).withColumn(
        "user_sk", F.raise_error(F.lit("worked out")).cast("bigint"))
    assert by_rows(failing) is failing
