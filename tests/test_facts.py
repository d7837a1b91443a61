import random
from datetime import datetime
from decimal import Decimal

import pytest

from headway.operators.facts import accepted, payment_facts, position_facts, rejected, ride_facts

LOAD = "2024-02-01T00:00:00Z"
AT = "2024-01-10 08:00:00"


@pytest.fixture
def dims(core):
    return (core("dim_user", dict(user_sk=1, user_id=10)),
            core("dim_vehicle", dict(vehicle_sk=2, vehicle_id=20)),
            core("dim_route_scd2",
                 dict(route_sk=3, route_id=30, valid_from_dts="2024-01-01", valid_to_dts="2024-01-20",
                      is_current=False),
                 dict(route_sk=4, route_id=30, valid_from_dts="2024-01-20", valid_to_dts="9999-12-31",
                      is_current=True)))


def _ride(ride_id, **more):
    return {**dict(ride_id=ride_id, user_id=10, vehicle_id=20, route_id=30, start_time=AT,
                   end_time="2024-01-10 08:10:30", fare_amount=50), **more}


def test_ride_with_all_keys(stg, dims, rows):
    got = ride_facts(stg("rides", _ride("a")), *dims, LOAD)
    assert rows(got) == [("a", 1, 4, 2, datetime(2024, 1, 10, 8), datetime(2024, 1, 10, 8, 10, 30), 630,
                          Decimal("50.00"), 20240110, datetime(2024, 2, 1))]


def test_route_version_current_or_as_of_the_start(stg, dims, rows):
    rides = stg("rides", _ride("early"), _ride("change", start_time="2024-01-20 00:00:00"),
                _ride("too early", start_time="2023-01-01 00:00:00"))
    assert rows(ride_facts(rides, *dims, LOAD), "ride_id", "route_sk") == [
        ("change", 4), ("early", 4), ("too early", 4)]
    assert rows(ride_facts(rides, *dims, LOAD, route_lookup="asof"), "ride_id", "route_sk") == [
        ("change", 4), ("early", 3), ("too early", None)]
    with pytest.raises(ValueError, match="route_lookup"):
        ride_facts(rides, *dims, LOAD, route_lookup="latest")


def test_unknown_members_reject_or_stay_null(stg, dims, rows):
    rides = stg("rides", _ride("ok"), _ride("user", user_id=99), _ride("route", route_id=99),
                _ride("both", user_id=None, route_id=None), _ride("vehicle", vehicle_id=99),
                _ride("time", start_time=None))
    facts = ride_facts(rides, *dims, LOAD)
    assert rows(accepted(facts, "fact_ride"), "ride_id", "vehicle_sk") == [("ok", 2), ("vehicle", None)]
    assert rows(rejected(facts, "fact_ride")) == [
        ("both", "user_sk,route_sk"), ("route", "route_sk"), ("time", "start_time"), ("user", "user_sk")]


def test_missing_end_and_end_before_start(stg, dims, rows):
    rides = stg("rides", _ride("open", end_time=None), _ride("back", end_time="2024-01-10 07:59:00"))
    assert rows(ride_facts(rides, *dims, LOAD), "ride_id", "duration_s") == [("back", -60), ("open", None)]


def test_repeats_and_loaded_rides_are_left_out(stg, core, dims, rows):
    rides = stg("rides", _ride("a", batch_id="b1", extract_dts="2024-01-11", fare_amount=1),
                _ride("a", batch_id="b2", extract_dts="2024-01-12", fare_amount=2), _ride("b"),
                _ride(None))
    loaded = core("fact_ride", dict(ride_id="b"), dict(ride_id="z"))
    got = ride_facts(rides.unionByName(stg("rides", _ride(None))), *dims, LOAD, loaded)
    assert rows(got, "ride_id", "fare_amount") == [("a", Decimal("2.00")), (None, Decimal("50.00")), (None, Decimal("50.00"))]
    assert rows(rejected(got, "fact_ride")) == [(None, "ride_id")] * 2


@pytest.mark.parametrize("seed", range(4))
def test_every_row_is_accepted_or_rejected(stg, dims, seed):
    rng = random.Random(seed)
    some = lambda *values: rng.choice(values)
    ids = [some(None, f"r{rng.randrange(12)}") for _ in range(30)]
    rides = stg("rides", *[_ride(i, user_id=some(10, 99, None), route_id=some(30, 31), start_time=some(AT, None)) for i in ids])
    facts = ride_facts(rides, *dims, LOAD)
    distinct = len({i for i in ids if i}) + ids.count(None)
    assert accepted(facts, "fact_ride").count() + rejected(facts, "fact_ride").count() == distinct


def test_payments(stg, core, dims, rows):
    payments = stg("payments", dict(payment_id="p", ride_id="a", user_id=10, amount=5, created_at=AT),
                   dict(payment_id="q", user_id=11, created_at=AT), dict(payment_id="r", user_id=10),
                   dict(payment_id="s", user_id=10))
    got = payment_facts(payments, dims[0], LOAD, core("fact_payment", dict(payment_id="s")))
    assert rows(accepted(got, "fact_payment"), "payment_id", "user_sk", "created_date_sk") == [
        ("p", 1, 20240110), ("r", 1, None)]
    assert rows(rejected(got, "fact_payment")) == [("q", "user_sk")]


def test_positions(stg, core, dims, rows):
    events = stg("vehicle_positions", dict(event_id="e", vehicle_id=20, event_time=AT, speed_kmh=1.5),
                 dict(event_id="e", vehicle_id=20, event_time=AT, speed_kmh=1.5),
                 dict(event_id="f", vehicle_id=99, event_time=AT), dict(event_id="g", vehicle_id=20),
                 dict(event_id="h", event_time=AT))
    got = position_facts(events, dims[1], LOAD, core("fact_vehicle_position", dict(event_id="h")))
    table = "fact_vehicle_position"
    assert rows(accepted(got, table), "event_id", "vehicle_sk", "event_date_sk", "speed_kmh") == [
        ("e", 2, 20240110, 1.5), ("f", None, 20240110, None)]
    assert rows(rejected(got, table)) == [("g", "event_time")]


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_a_third_of_the_rides_on_one_route_and_user(spark, core, rows, broadcast):
    """Hot keys change nothing about the result, whichever join is chosen."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        staged = spark.range(9_000).selectExpr(
            "'b' AS batch_id", "TIMESTAMP '2024-01-02' AS extract_dts", "CAST(id AS STRING) AS ride_id",
            "IF(id % 3 = 0, 0, id % 50) AS user_id", "IF(id % 3 = 0, 0, id % 70) AS route_id",
            "IF(id % 3 = 0, NULL, id % 9) AS vehicle_id", "TIMESTAMP '2024-01-10' AS start_time",
            "TIMESTAMP '2024-01-10' AS end_time", "CAST(1 AS DECIMAL(10,2)) AS fare_amount")
        users = spark.range(50).selectExpr("id AS user_id", "id + 1 AS user_sk")
        vehicles = spark.range(9).selectExpr("id AS vehicle_id", "id + 1 AS vehicle_sk")
        routes = spark.range(70).selectExpr(
            "id AS route_id", "id + 1 AS route_sk", "true AS is_current",
            "TIMESTAMP '2024-01-01' AS valid_from_dts", "TIMESTAMP '2025-01-01' AS valid_to_dts")
        for lookup in ("current", "asof"):
            got = ride_facts(staged, users, vehicles, routes, LOAD, route_lookup=lookup)
            wrong = ("user_sk <> IF(ride_id % 3 = 0, 0, ride_id % 50) + 1 "
                     "OR route_sk <> IF(ride_id % 3 = 0, 0, ride_id % 70) + 1 "
                     "OR (vehicle_sk IS NULL) <> (ride_id % 3 = 0)")
            assert got.count() == 9_000 and got.where(wrong).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_split_in_shuffled_lookups(spark):
    """With thresholds scaled down to test size, AQE splits the task that holds a third of the rides."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        staged = spark.range(0, 120_000, 1, 8).selectExpr(
            "'b' AS batch_id", "TIMESTAMP '2024-01-02' AS extract_dts", "sha2(CAST(id AS STRING), 256) AS ride_id",
            "IF(id % 3 = 0, 0, id % 5000) AS user_id", "IF(id % 3 = 0, 0, id % 7000) AS route_id",
            "IF(id % 3 = 0, NULL, id % 9000) AS vehicle_id", "TIMESTAMP '2024-01-10' AS start_time",
            "TIMESTAMP '2024-01-10' AS end_time", "CAST(1 AS DECIMAL(10,2)) AS fare_amount")
        users = spark.range(5000).selectExpr("id AS user_id", "id + 1 AS user_sk")
        vehicles = spark.range(9000).selectExpr("id AS vehicle_id", "id + 1 AS vehicle_sk")
        routes = spark.range(7000).selectExpr(
            "id AS route_id", "id + 1 AS route_sk", "true AS is_current",
            "TIMESTAMP '2024-01-01' AS valid_from_dts", "TIMESTAMP '2025-01-01' AS valid_to_dts")
        for lookup in ("current", "asof"):
            facts = ride_facts(staged, users, vehicles, routes, LOAD, route_lookup=lookup)
            got = facts.selectExpr("count(*) AS n", "max(hash(*)) AS whole_rows")
            assert got.collect()[0].n == 120_000
            plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            # One join each on user, vehicle (a third of them null) and route.
            assert plan.count("skew=true") >= 3
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
