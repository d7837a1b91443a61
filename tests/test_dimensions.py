from datetime import date, datetime
from decimal import Decimal

import pytest

from headway.operators.dimensions import (calendar, clock, event_times, new_routes, new_users, new_vehicles,
                                          overwrite_users)

LOAD = "2024-02-01T00:00:00Z"
LOADED = datetime(2024, 2, 1)


def test_only_new_users_are_inserted(stg, core, rows):
    staged = stg("users", dict(batch_id="b1", extract_dts="2024-01-01", user_id=1, city="A"),
                 dict(batch_id="b1", extract_dts="2024-01-01", user_id=3, city="old"),
                 dict(batch_id="b2", extract_dts="2024-01-02", user_id=3, city="new"),
                 dict(batch_id="b2", extract_dts="2024-01-02", user_id=2, city="B"))
    stored = core("dim_user", dict(user_sk=5, user_id=1, city="Z"))
    assert rows(new_users(staged, stored, LOAD), "user_sk", "user_id", "city", "updated_dts") == [
        (6, 2, "B", LOADED), (7, 3, "new", LOADED)]


@pytest.mark.parametrize("table, build", [("users", new_users), ("vehicles", new_vehicles), ("routes", new_routes)])
def test_a_member_without_a_key_fails_the_load(stg, table, build):
    with pytest.raises(Exception, match=f"a row has no {table[:-1]}_id"):
        build(stg(table, dict(batch_id="b")), None, LOAD).collect()


def test_only_unseen_routes_are_backdated(stg, core, rows):
    stored = core("dim_route_scd2", dict(route_sk=1, route_id=1, valid_from_dts="2023-01-01", valid_to_dts="2024-01-01",
                                         is_current=False))
    got = new_routes(stg("routes", dict(route_id=1), dict(route_id=2)), stored, LOAD, "1900-01-01T00:00:00Z")
    assert rows(got.selectExpr("route_id", "year(valid_from_dts)")) == [(1, LOADED.year), (2, 1900)]


def test_only_new_vehicles_are_inserted(stg, core, rows):
    staged = stg("vehicles", dict(vehicle_id=101, route_id=1, capacity=40), dict(vehicle_id=102))
    stored = core("dim_vehicle", dict(vehicle_sk=1, vehicle_id=101))
    assert rows(new_vehicles(staged, stored, LOAD), "vehicle_sk", "vehicle_id", "license_plate") == [
        (2, 102, None)]


def test_routes_without_a_current_version_are_inserted_once(stg, core, rows):
    staged = stg("routes", dict(batch_id="b1", extract_dts="2024-01-01", route_id=1, base_fare=10),
                 dict(batch_id="b1", extract_dts="2024-01-01", route_id=2, base_fare=20),
                 dict(batch_id="b2", extract_dts="2024-01-02", route_id=2, base_fare=21),
                 dict(batch_id="b2", extract_dts="2024-01-02", route_id=3, base_fare=30))
    stored = core("dim_route_scd2", dict(route_sk=1, route_id=1, base_fare=9, is_current=True),
                  dict(route_sk=8, route_id=3, base_fare=9, is_current=False))
    got = new_routes(staged, stored, LOAD)
    end = datetime(9999, 12, 31)
    columns = ("route_sk", "route_id", "base_fare", "valid_from_dts", "valid_to_dts", "is_current")
    assert sorted(rows(got, *columns)) == [
        (9, 2, Decimal("21.00"), LOADED, end, True),
        (10, 3, Decimal("30.00"), LOADED, end, True)]


def test_overwriting_users_keeps_keys_and_absent_users(stg, core, rows):
    old = "2023-01-01"
    stored = core("dim_user", dict(user_sk=1, user_id=1, city="A", updated_dts=old),
                  dict(user_sk=2, user_id=2, city="B", updated_dts=old),
                  dict(user_sk=3, user_id=3, city="C", updated_dts=old),
                  dict(user_sk=4, user_id=4, city=None, updated_dts=old))
    staged = stg("users", dict(user_id=1, city="A"), dict(user_id=2, city=None), dict(user_id=4, city="D"),
                 dict(user_id=9, city="new"))
    before = datetime(2023, 1, 1)
    got = overwrite_users(stored, staged, LOAD)
    assert rows(got, "user_sk", "user_id", "city", "updated_dts") == [
        (1, 1, "A", before), (2, 2, None, LOADED), (3, 3, "C", before), (4, 4, "D", LOADED),
        (5, 9, "new", LOADED)]


def _times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t STRING").selectExpr("CAST(t AS TIMESTAMP) AS ts")


def test_calendar_of_observed_dates(spark, rows):
    times = _times(spark, "2023-12-31 23:59:59", "2024-02-29 00:00:00", "2024-02-29 10:00:00")
    assert rows(calendar(times)) == [
        (20231231, date(2023, 12, 31), 2023, 4, 12, 31, 7, True),
        (20240229, date(2024, 2, 29), 2024, 1, 2, 29, 4, False)]


def test_every_weekday(spark, rows):
    times = _times(spark, *[f"2024-01-{d:02d} 12:00:00" for d in range(1, 8)])
    assert rows(calendar(times), "day", "day_of_week", "is_weekend") == [
        (d, d, d >= 6) for d in range(1, 8)]


def test_clock_of_observed_seconds(spark, rows):
    times = _times(spark, "2023-12-31 23:59:59.9", "2024-01-01 23:59:59", "2024-01-01 00:00:00",
                   "2024-01-01 13:30:05")
    assert rows(clock(times)) == [(0, "00:00:00", 0, 0, 0), (133005, "13:30:05", 13, 30, 5),
                                  (235959, "23:59:59", 23, 59, 59)]


def test_event_times_keep_repeats_and_drop_nulls(stg, rows):
    at = "2024-01-01 00:00:00"
    times = event_times(stg("rides", dict(ride_id="a", start_time=at), dict(ride_id="b")),
                        stg("payments", dict(payment_id="p", created_at=at)),
                        stg("vehicle_positions", dict(event_id="e", event_time="2024-01-02 00:00:00")))
    assert [r[0] for r in rows(times)] == [datetime(2024, 1, 1)] * 2 + [datetime(2024, 1, 2)]
