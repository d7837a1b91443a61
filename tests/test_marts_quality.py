from datetime import date, datetime

from headway.operators import marts, quality

AT = "2024-01-10 08:15:00"


def _rides(core):
    return core("fact_ride",
                dict(ride_id="a", route_sk=1, start_time=AT, fare_amount=10, duration_s=60),
                dict(ride_id="b", route_sk=1, start_time=AT, fare_amount=None, duration_s=None),
                dict(ride_id="c", route_sk=2, start_time=AT, fare_amount=7, duration_s=10),
                dict(ride_id="d", route_sk=3, start_time="2024-01-10 09:00:00", fare_amount=1, duration_s=1))


def _routes(core):
    return core("dim_route_scd2", dict(route_sk=1, route_id=1, route_number="B-1", base_fare=40, is_current=True),
                dict(route_sk=2, route_id=1, route_number="B-1", base_fare=50, is_current=False),
                dict(route_sk=3, route_id=2, route_number="T-9", base_fare=60, is_current=True))


def test_rides_on_closed_versions_have_no_route_number(core, rows):
    got = marts.rides_by_route_hour(_rides(core), _routes(core))
    day = date(2024, 1, 10)
    assert rows(got) == sorted([("B-1", day, 8, 2, 10.0, 60.0), (None, day, 8, 1, 7.0, 10.0),
                                ("T-9", day, 9, 1, 1.0, 1.0)], key=repr)


def test_by_version_every_ride_has_its_route_and_tariff(core, rows):
    got = marts.rides_by_route_version(_rides(core), _routes(core))
    assert rows(got, "route_number", "hour", "trips_count", "avg_fare", "avg_base_fare") == [
        ("B-1", 8, 3, 8.5, 43.333333), ("T-9", 9, 1, 1.0, 60.0)]


def test_aggregation_combines_before_the_exchange(core):
    plan = marts.rides_by_route_hour(_rides(core), _routes(core))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_avg" in plan


def test_first_rows_are_a_top_k(core, rows):
    mart = core("dm_rides_by_route_hour", *[
        dict(route_number=r, date=f"2024-01-0{d}", hour=h) for r in "BA" for d in (2, 1) for h in (9, 8)])
    got = marts.first_rows(mart, 3)
    assert [(r.date.day, r.hour, r.route_number) for r in got.collect()] == [(1, 8, "A"), (1, 8, "B"), (1, 9, "A")]
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


def test_movement_by_route_and_hour(core, rows):
    positions = core("fact_vehicle_position",
                     dict(event_id="a", route_number="B-1", event_time=AT, speed_kmh=10, passengers_estimated=4),
                     dict(event_id="b", route_number="B-1", event_time=AT, speed_kmh=20),
                     dict(event_id="c", route_number="B-1", event_time="2024-01-10 09:00:00"))
    assert rows(marts.movement_by_route_hour(positions)) == [
        ("B-1", datetime(2024, 1, 10, 8), 2, 15.0, 4.0), ("B-1", datetime(2024, 1, 10, 9), 1, None, None)]


def test_row_counts_include_empty_tables(core, rows):
    assert rows(marts.row_counts({"rides": _rides(core), "users": core("dim_user")})) == [
        ("rides", 4), ("users", 0)]


def _violations(df):
    return {(r.table_name, r.check_name): r.violations for r in df.collect() if r.violations}


def test_duplicate_keys(core, stg):
    tables = {"dim_user": core("dim_user", dict(user_sk=1, user_id=1), dict(user_sk=2, user_id=1),
                               dict(user_sk=2, user_id=1)),
              "stg.users": stg("users", dict(batch_id="a", user_id=1), dict(batch_id="b", user_id=1)),
              "dim_date": core("dim_date")}
    got = quality.duplicate_keys(tables)
    assert got.count() == 5
    assert _violations(got) == {("dim_user", "user_sk"): 1, ("dim_user", "user_id"): 1}


def test_missing_values(core):
    got = quality.missing_values({"fact_ride": core("fact_ride", dict(ride_id="a", user_sk=1), dict(user_sk=2))})
    assert _violations(got) == {("fact_ride", c): n for c, n in [
        ("ride_id", 1), ("route_sk", 2), ("start_time", 2), ("start_date_sk", 2), ("load_dts", 2)]}


def test_orphans_ignore_nulls(core):
    tables = {"fact_payment": core("fact_payment", dict(payment_id="p", ride_id="a", user_sk=1),
                                   dict(payment_id="q", ride_id="x", user_sk=9),
                                   dict(payment_id="r", ride_id="x", user_sk=None),
                                   dict(payment_id="s", ride_id=None, user_sk=9)),
              "fact_ride": core("fact_ride", dict(ride_id="a", user_sk=1)),
              "dim_user": core("dim_user", dict(user_sk=1))}
    got = quality.orphans(tables)
    assert _violations(got) == {("fact_payment", "ride_id -> fact_ride"): 2,
                                ("fact_payment", "user_sk -> dim_user"): 2}
    assert got.count() == 3


def _version(route, start, end, current):
    return dict(route_id=route, valid_from_dts=start, valid_to_dts=end, is_current=current)


def test_several_current_versions(core, rows):
    routes = core("dim_route_scd2", _version(1, "2024-01-01", "2025-01-01", True),
                  _version(1, "2024-01-01", "2025-01-01", True), _version(2, "2024-01-01", "2025-01-01", True))
    assert rows(quality.several_current(routes), "violations") == [(1,)]


def test_overlapping_versions(core, rows):
    sound = [_version(1, "2024-01-01", "2024-01-05", False), _version(1, "2024-01-05", "2024-03-01", False),
             _version(1, "2024-03-01", "9999-12-31", True), _version(2, "2024-01-01", "9999-12-31", True)]
    broken = [_version(3, "2024-01-01", "2024-01-10", False),     # overlaps inside the month
              _version(3, "2024-01-09", "2024-06-01", False),     # overlaps two months on
              _version(3, "2024-03-01", "2024-04-01", False),
              _version(4, "2024-01-01", "2024-02-01", False), _version(4, "2024-01-01", "2024-02-01", False),
              _version(4, "2024-02-01", "2024-03-01", False)]     # one start twice
    routes = core("dim_route_scd2", *sound)
    assert rows(quality.overlapping_versions(routes), "violations") == [(0,)]
    routes = core("dim_route_scd2", *sound, *broken)
    assert rows(quality.overlapping_versions(routes), "violations") == [(3,)]
    assert rows(quality.overlapping_versions(core("dim_route_scd2")), "violations") == [(0,)]


def test_mart_of_partials_looks_numbers_up_before_it_adds(core):
    partials = marts.partial_rides(_rides(core))
    plan = marts.mart_of_partials(partials, _routes(core).select("route_sk", "route_number"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    # One sum by the mart's own key above the join, and the sums of rides below it.
    assert text.count("Aggregate") == 2
