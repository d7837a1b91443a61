from datetime import datetime
from decimal import Decimal

import pytest

from headway.operators.staging import event_attribute, stage, stage_rejects
from headway.schemas import RAW, STAGING

LOAD = "2024-02-01T00:00:00Z"
LOADED = datetime(2024, 2, 1)


@pytest.mark.parametrize("name", list(STAGING))
def test_columns_and_types_follow_the_declared_table(spark, name):
    raw = spark.createDataFrame([], RAW[name].columns)
    staged = stage(raw, name, "b1", LOAD)
    assert {f.name: f.dataType.simpleString() for f in staged.schema} == {
        c: kind for c, kind in STAGING[name].types.items()}


def test_times_are_read_in_their_own_zone(raw, rows):
    ride = dict(ride_id="a", start_time="2024-01-01T23:30:00+00:00", end_time="2024-01-02T00:10:00Z")
    shifted = dict(ride_id="b", start_time="2024-01-02T02:30:00+03:00")
    staged = stage(raw("rides", ride, shifted), "rides", "b1", LOAD)
    assert rows(staged, "ride_id", "start_time", "end_time") == [
        ("a", datetime(2024, 1, 1, 23, 30), datetime(2024, 1, 2, 0, 10)),
        ("b", datetime(2024, 1, 1, 23, 30), None)]


def test_money_is_rounded_to_cents_and_rows_are_stamped(raw, rows):
    staged = stage(raw("routes", dict(route_id=1, base_fare=54.999), dict(route_id=2)), "routes", "b7", LOAD)
    assert rows(staged, "batch_id", "extract_dts", "route_id", "base_fare") == [
        ("b7", LOADED, 1, Decimal("55.00")), ("b7", LOADED, 2, None)]


def test_unreadable_time_fails_the_strict_load(raw):
    broken = raw("payments", dict(payment_id="p", created_at="yesterday"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(broken, "payments", "b1", LOAD).collect()


def test_lenient_load_keeps_the_row_and_reports_it(raw, rows):
    source = raw("rides", dict(ride_id="ok", start_time="2024-01-01T00:00:00Z"),
                 dict(ride_id="bad", start_time="??", end_time="??"), dict(ride_id="empty"))
    staged = stage(source, "rides", "b1", LOAD, lenient=True)
    assert rows(staged, "ride_id", "start_time") == [
        ("bad", None), ("empty", None), ("ok", datetime(2024, 1, 1))]
    assert rows(stage_rejects(source, "rides")) == [("bad", "start_time,end_time")]


def test_raw_event_text_is_kept_when_there_is_one(spark, raw, rows):
    plain = raw("vehicle_positions", dict(event_id="e"))
    assert rows(stage(plain, "vehicle_positions", "b", LOAD), "raw_json") == [(None,)]
    with_text = plain.selectExpr("*", """'{"k": 7}' AS raw_json""")
    staged = stage(with_text, "vehicle_positions", "b", LOAD)
    assert rows(event_attribute(staged, "$.k", "int", "k")) == [("e", '{"k": 7}', 7)]


def test_staging_is_a_narrow_plan(raw):
    staged = stage(raw("users", dict(user_id=1)), "users", "b", LOAD)
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()
