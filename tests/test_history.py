from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from headway.operators import quality
from headway.operators.dimensions import new_routes
from headway.operators.history import merge_routes, merge_snapshots, version_at, version_at_ordered
from headway.schemas import BEFORE_ALL

OPEN = datetime(9999, 12, 31)
COLUMNS = ("route_id", "base_fare", "valid_from_dts", "valid_to_dts", "is_current")


def _version(sk, route, fare, start="2024-01-01", end="9999-12-31", current=True, **more):
    return dict(route_sk=sk, route_id=route, base_fare=fare, valid_from_dts=start, valid_to_dts=end,
                is_current=current, updated_dts=start, **more)


def test_unchanged_changed_new_and_absent_routes(stg, core, rows):
    stored = core("dim_route_scd2", _version(1, 1, 10), _version(2, 2, 20), _version(3, 3, 30))
    staged = stg("routes", dict(route_id=1, base_fare=10), dict(route_id=2, base_fare=25),
                 dict(route_id=4, base_fare=40))
    got = merge_routes(stored, staged, "2024-02-01T00:00:00Z")
    jan, feb = datetime(2024, 1, 1), datetime(2024, 2, 1)
    assert rows(got, "route_sk", *COLUMNS, "updated_dts") == [
        (1, 1, Decimal("10.00"), jan, OPEN, True, jan),
        (2, 2, Decimal("20.00"), jan, feb, False, feb),
        (3, 3, Decimal("30.00"), jan, OPEN, True, jan),
        (4, 2, Decimal("25.00"), feb, OPEN, True, feb),
        (5, 4, Decimal("40.00"), feb, OPEN, True, feb)]


def test_null_to_value_and_back_are_changes(stg, core, rows):
    first = core("dim_route_scd2", _version(1, 1, None))
    second = merge_routes(first, stg("routes", dict(route_id=1, base_fare=5)), "2024-02-01T00:00:00Z")
    third = merge_routes(second, stg("routes", dict(route_id=1)), "2024-03-01T00:00:00Z")
    same = merge_routes(third, stg("routes", dict(route_id=1)), "2024-04-01T00:00:00Z")
    assert rows(third, "route_sk", "base_fare", "is_current") == [
        (1, None, False), (2, Decimal("5.00"), False), (3, None, True)]
    assert rows(same) == rows(third)


def test_the_latest_of_repeated_staged_routes_counts(stg, core, rows):
    staged = stg("routes", dict(batch_id="b1", extract_dts="2024-01-01", route_id=1, base_fare=1),
                 dict(batch_id="b2", extract_dts="2024-01-02", route_id=1, base_fare=2))
    got = merge_routes(core("dim_route_scd2"), staged, "2024-02-01T00:00:00Z")
    assert rows(got, "route_sk", "base_fare") == [(1, Decimal("2.00"))]


def test_a_state_that_is_not_newer_fails(stg, core):
    stored = core("dim_route_scd2", _version(1, 1, 10, start="2024-02-01"))
    for load in ("2024-02-01T00:00:00Z", "2024-01-15T00:00:00Z"):
        with pytest.raises(Exception, match="not newer"):
            merge_routes(stored, stg("routes", dict(route_id=1, base_fare=11)), load).collect()
        assert merge_routes(stored, stg("routes", dict(route_id=1, base_fare=10)), load).count() == 1


def test_first_versions_may_reach_back(stg, core, rows):
    stored = core("dim_route_scd2", _version(1, 1, 10))
    staged = stg("routes", dict(route_id=1, base_fare=11), dict(route_id=2, base_fare=20))
    got = merge_routes(stored, staged, "2024-02-01T00:00:00Z", BEFORE_ALL)
    assert rows(got, "route_sk", "valid_from_dts") == [
        (1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1)), (3, datetime(1900, 1, 1))]


def test_version_at_a_time_is_half_open(stg, core, rows):
    versions = core("dim_route_scd2",
                    _version(1, 1, 10, "2024-01-01", "2024-02-01", False),
                    _version(2, 1, 20, "2024-02-01"), _version(3, 2, 30, "2024-03-01"))
    rides = stg("rides", *[dict(ride_id=r, route_id=1, start_time=t) for r, t in [
        ("before", "2023-12-31 23:59:59"), ("at start", "2024-01-01 00:00:00"),
        ("inside", "2024-01-15 00:00:00"), ("at change", "2024-02-01 00:00:00"),
        ("late", "2030-01-01 00:00:00")]], dict(ride_id="no time", route_id=1),
        dict(ride_id="no route", start_time="2024-01-15 00:00:00"))
    assert rows(version_at(rides, versions, "start_time"), "ride_id", "route_sk") == sorted([
        ("before", None), ("at start", 1), ("inside", 1), ("at change", 2), ("late", 2), ("no time", None),
        ("no route", None)], key=repr)


def test_version_lookup_is_an_equi_join(stg, core):
    joined = version_at(stg("rides"), core("dim_route_scd2"), "start_time")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@settings(max_examples=4, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(st.lists(st.dictionaries(st.integers(1, 4), st.sampled_from([None, 1, 2]), max_size=4),
                min_size=1, max_size=3))
def test_any_sequence_of_states_keeps_a_sound_history(spark, stg, core, rows, states):
    dimension, known = core("dim_route_scd2"), {}
    for month, state in enumerate(states, start=1):
        staged = stg("routes", *[dict(route_id=r, base_fare=f) for r, f in state.items()])
        dimension = merge_routes(dimension, staged, f"2024-{month:02d}-01T00:00:00Z")
        known.update(state)
    dimension = dimension.checkpoint()
    assert rows(quality.several_current(dimension), "violations") == [(0,)]
    assert rows(quality.overlapping_versions(dimension), "violations") == [(0,)]
    current = {r.route_id: r.base_fare for r in dimension.where("is_current").collect()}
    assert current == {r: None if f is None else Decimal(f"{f}.00") for r, f in known.items()}
    keys = [r.route_sk for r in dimension.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_inserting_only_ignores_changes(stg, core, rows):
    stored = core("dim_route_scd2", _version(1, 1, 10))
    assert rows(new_routes(stg("routes", dict(route_id=1, base_fare=99)), stored, "2024-02-01T00:00:00Z")) == []


def _states(stg, *batches):
    """Staged routes from (batch, day of January, {route: fare})."""
    return stg("routes", *[dict(batch_id=b, extract_dts=f"2024-01-{day:02d}", route_id=r, route_number="A", base_fare=fare)
                           for b, day, fares in batches for r, fare in fares.items()])


def test_several_snapshots_at_once(stg, core, rows):
    staged = _states(stg, ("b1", 1, {1: 10, 2: 20}), ("b2", 2, {1: 11, 2: 20, 3: 30}), ("b3", 3, {1: 12}), ("b4", 4, {1: 11, 2: None}))
    got = merge_snapshots(core("dim_route_scd2"), staged, BEFORE_ALL)
    day = lambda d: datetime(2024, 1, d)
    first = datetime(1900, 1, 1)
    fare = lambda x: None if x is None else Decimal(f"{x}.00")
    assert rows(got, "route_sk", *COLUMNS, "updated_dts") == [(sk, r, fare(f), a, b, c, u) for sk, r, f, a, b, c, u in [
        (1, 1, 10, first, day(2), False, day(2)), (2, 2, 20, first, day(4), False, day(4)),
        (3, 1, 11, day(2), day(3), False, day(3)), (4, 3, 30, first, OPEN, True, day(2)),
        (5, 1, 12, day(3), day(4), False, day(4)), (6, 1, 11, day(4), OPEN, True, day(4)),
        (7, 2, None, day(4), OPEN, True, day(4))]]
    assert rows(merge_snapshots(got, staged, BEFORE_ALL)) == rows(got)


def test_snapshots_out_of_order_fail(stg, core):
    stored = core("dim_route_scd2", _version(1, 1, 10, start="2024-01-05", route_number="A"))
    with pytest.raises(Exception, match="not newer"):
        merge_snapshots(stored, _states(stg, ("b", 4, {1: 11}))).collect()
    with pytest.raises(Exception, match="same time"):
        merge_snapshots(stored, _states(stg, ("b", 6, {1: 11}), ("c", 6, {1: 12}))).collect()


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.integers(1, 4), st.one_of(st.none(), st.integers(1, 2)), max_size=4), min_size=1, max_size=4),
       st.integers(0, 3), st.booleans())
def test_snapshots_equal_loads_one_by_one(stg, core, rows, spark, states, cut, backdate):
    first = BEFORE_ALL if backdate else None
    batches = [(f"b{i}", i + 1, state) for i, state in enumerate(states)]
    single = core("dim_route_scd2")
    for batch in batches:
        single = merge_routes(single, _states(stg, batch), f"2024-01-{batch[1]:02d}T00:00:00Z", first)
        single = spark.createDataFrame(single.collect(), single.schema)
    split = core("dim_route_scd2")
    for part in (batches[:cut], batches):  # the first states come a second time
        split = merge_snapshots(split, _states(stg, *part), first)
        split = spark.createDataFrame(split.collect(), split.schema)
    assert rows(split) == rows(single)
    assert rows(quality.overlapping_versions(split), "violations") == [(0,)]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 120), st.integers(1, 60)), max_size=8),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.one_of(st.none(), st.integers(1, 200))), max_size=20),
       st.integers(1, 3))
def test_versions_by_order_equal_versions_by_join(spark, core, rows, versions, rides, spread):
    held, until = [], {}
    for sk, (route, gap, length) in enumerate(versions, 1):
        start = until.get(route, 0) + gap
        until[route] = start + length
        held.append(_version(sk, route, 1, start=f"2024-01-01 00:00:00 +{start}", end=f"2024-01-01 00:00:00 +{start + length}"))
    day = lambda n: f"timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, {n})"
    dimension = core("dim_route_scd2").unionByName(spark.sql(" UNION ALL ".join(
        f"SELECT {v['route_sk']}L AS route_sk, {v['route_id']}L AS route_id, 'A' AS route_number, 'b' AS vehicle_type, "
        f"CAST(1 AS DECIMAL(10,2)) AS base_fare, {day(v['valid_from_dts'].split('+')[1])} AS valid_from_dts, "
        f"{day(v['valid_to_dts'].split('+')[1])} AS valid_to_dts, true AS is_current, {day(0)} AS updated_dts" for v in held))) if held else core("dim_route_scd2")
    made = spark.createDataFrame([(i, r, d) for i, (r, d) in enumerate(rides)], "id INT, route_id BIGINT, d INT").selectExpr(
        "id", "route_id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, d) AS start_time")
    want = version_at(made, dimension, "start_time")
    assert rows(version_at_ordered(made, dimension, "start_time", spread), "id", "route_sk") == rows(want, "id", "route_sk")


def test_a_route_with_very_many_versions_costs_rows_not_pairs(spark):
    versions = spark.range(10_000).selectExpr(
        "id AS route_sk", "1L AS route_id", "timestamp'2000-01-01' + make_interval(0, 0, 0, id) AS valid_from_dts",
        "timestamp'2000-01-01' + make_interval(0, 0, 0, id + 1) AS valid_to_dts")
    rides = spark.range(20_000).selectExpr("id", "1L AS route_id", "timestamp'2000-01-01' + make_interval(0, 0, 0, id div 2, 1) AS start_time")
    found = version_at_ordered(rides, versions, "start_time")
    assert found.where("route_sk = id div 2").count() == 20_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    # Joins are on route and month, of which each side that is not a row has one row, so no join multiplies rows.
    assert plan.count("Join") <= 3
