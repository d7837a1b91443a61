from datetime import datetime

import pytest

from headway.schemas import RAW
from headway.sources.warehouse import Warehouse
from headway.streaming import positions

SCHEMA = "event_id STRING, vehicle_id BIGINT, route_number STRING, event_time TIMESTAMP, latitude DOUBLE, " \
         "longitude DOUBLE, speed_kmh DOUBLE, passengers_estimated INT"


@pytest.fixture
def feed(spark, tmp_path):
    """Each call adds one input file of (event id, vehicle, time, speed)."""
    folder = tmp_path / "in"

    def add(*events):
        rows = [(e, v, "B-1", t, s) for e, v, t, s in events]
        (spark.createDataFrame(rows, "e STRING, v BIGINT, r STRING, t STRING, s DOUBLE")
         .selectExpr("e AS event_id", "v AS vehicle_id", "r AS route_number",
                     "CAST(t AS TIMESTAMP) AS event_time", "CAST(NULL AS DOUBLE) AS latitude",
                     "CAST(NULL AS DOUBLE) AS longitude", "s AS speed_kmh",
                     "1 AS passengers_estimated")
         .coalesce(1).write.mode("append").parquet(str(folder)))
        return str(folder)

    return add


def _run(spark, rows, tmp_path):
    positions.write_files(rows, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{tmp_path}/out")


def test_repeats_within_the_watermark_and_late_events_are_dropped(spark, feed, rows, tmp_path):
    stream = lambda path: positions.without_repeats(positions.read_files(spark, path, SCHEMA))
    folder = feed(("a", 1, "2024-01-01 10:00:00", 1.0), ("a", 1, "2024-01-01 10:00:00", 1.0),
                  ("b", 1, "2024-01-01 10:10:00", 1.0))
    assert rows(_run(spark, stream(folder), tmp_path), "event_id") == [("a",), ("b",)]
    feed(("a", 1, "2024-01-01 10:00:00", 1.0), ("c", 1, "2024-01-01 12:00:00", 1.0))
    assert rows(_run(spark, stream(folder), tmp_path), "event_id") == [("a",), ("b",), ("c",)]
    # The watermark stands at 11:00 now: an older new event comes too late.
    feed(("late", 1, "2024-01-01 10:30:00", 1.0), ("d", 1, "2024-01-01 11:30:00", 1.0))
    assert rows(_run(spark, stream(folder), tmp_path), "event_id") == [("a",), ("b",), ("c",), ("d",)]


def test_a_hot_event_read_by_many_tasks_comes_out_once(spark, feed, rows, tmp_path):
    for _ in range(6):
        folder = feed(*[("hot", 1, "2024-01-01 10:00:00", 1.0)] * 50, ("x", 1, "2024-01-01 10:00:00", 1.0))
    got = _run(spark, positions.without_repeats(positions.read_files(spark, folder, SCHEMA)), tmp_path)
    assert rows(got, "event_id") == [("hot",), ("x",)]


def test_hours_come_out_when_closed(spark, feed, rows, tmp_path):
    stream = lambda path: positions.movement(positions.read_files(spark, path, SCHEMA))
    folder = feed(("a", 1, "2024-01-01 10:00:00", 10.0), ("b", 1, "2024-01-01 10:59:59", 20.0),
                  ("c", 1, "2024-01-01 11:10:00", 5.0))
    assert rows(_run(spark, stream(folder), tmp_path)) == []
    feed(("d", 1, "2024-01-01 12:00:00", 1.0))
    assert rows(_run(spark, stream(folder), tmp_path)) == [
        ("B-1", datetime(2024, 1, 1, 10), 2, 15.0, 1.0)]
    feed(("e", 1, "2024-01-01 13:00:00", 1.0))
    assert rows(_run(spark, stream(folder), tmp_path), "hour_start", "events_count") == [
        (datetime(2024, 1, 1, 10), 2), (datetime(2024, 1, 1, 11), 1)]


def _load(spark, folder, warehouse, vehicles, progress, **options):
    events = positions.read_files(spark, folder, SCHEMA, max_files=1)
    positions.append_facts(events, lambda: vehicles, warehouse, "2024-02-01T00:00:00Z", progress, **options).awaitTermination()


def test_every_streamed_event_is_staged_and_loaded_or_rejected(spark, feed, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    folder = feed(("a", 1, "2024-01-01 10:00:00", 1.0), (None, 1, "2024-01-01 10:00:00", 1.0), ("b", 1, None, 1.0))
    feed((None, 1, "2024-03-01 10:00:00", 1.0), ("c", 1, "2024-03-01 10:00:00", 1.0), ("late", 1, "2023-12-01 10:00:00", 1.0))
    for progress in ("p1", "p2"):  # everything again after progress was lost
        _load(spark, folder, warehouse, core("dim_vehicle"), f"{tmp_path}/{progress}", stream="gps")
        assert rows(warehouse.read("fact_vehicle_position"), "event_id") == [("a",), ("c",), ("late",)]
        assert rows(warehouse.read("fact_vehicle_position_rejects")) == sorted([
            ("b", "event_time", f"gps-{0:020d}"), (None, "event_id", f"gps-{0:020d}"), (None, "event_id", f"gps-{1:020d}")], key=repr)
        assert rows(warehouse.read("stg.vehicle_positions").groupBy("batch_id").count()) == [(f"gps-{0:020d}", 3), (f"gps-{1:020d}", 3)]


def test_streams_with_checkpoints_of_their_own_leave_each_other_alone(spark, feed, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    folder = feed(("a", 1, "2024-01-01 10:00:00", 1.0), (None, 1, "2024-01-01 10:00:00", 1.0), ("b", 1, None, 1.0))
    _load(spark, folder, warehouse, core("dim_vehicle"), f"{tmp_path}/p1")
    other = str(tmp_path / "other")
    spark.read.parquet(folder).limit(1).selectExpr(
        "'c' AS event_id", "vehicle_id", "route_number", "timestamp'2024-01-01 10:00:00' AS event_time", "latitude",
        "longitude", "speed_kmh", "passengers_estimated").write.parquet(other)
    _load(spark, other, warehouse, core("dim_vehicle"), f"{tmp_path}/p2")
    assert rows(warehouse.read("fact_vehicle_position"), "event_id") == [("a",), ("c",)]
    assert rows(warehouse.read("fact_vehicle_position_rejects"), "event_id", "reason") == sorted(
        [("b", "event_time"), (None, "event_id")], key=repr)
    assert warehouse.read("stg.vehicle_positions").count() == 4
    # A later event brings the missing time, and leaves what has no id on the list.
    feed(("b", 1, "2024-01-01 11:00:00", 1.0))
    _load(spark, folder, warehouse, core("dim_vehicle"), f"{tmp_path}/p1")
    assert rows(warehouse.read("fact_vehicle_position"), "event_id") == [("a",), ("b",), ("c",)]
    assert rows(warehouse.read("fact_vehicle_position_rejects"), "event_id") == [(None,)]


def test_a_micro_batch_lists_its_own_folder(spark, feed, core, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for day in range(1, 4):
        folder = feed((f"e{day}", 1, f"2024-01-0{day} 10:00:00", 1.0))
    _load(spark, folder, warehouse, core("dim_vehicle"), f"{tmp_path}/p", stream="gps")
    batches = warehouse.batches("stg.vehicle_positions")
    assert batches == [f"gps-{i:020d}" for i in range(3)]
    one = warehouse.read_batches("stg.vehicle_positions", batches[1:2])
    assert len(one.inputFiles()) == 1 and one.count() == 1
    assert warehouse.read_batches("stg.vehicle_positions", ["none"]).count() == 0


def test_movements_count_late_events(spark, feed, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    folder = feed(("a", 1, "2024-01-02 10:00:00", 10.0), ("b", 1, "2024-01-05 10:59:59", 20.0))
    feed(("c", 1, "2024-01-02 10:30:00", 20.0), ("a", 1, "2024-01-02 10:00:00", 10.0))
    _load(spark, folder, warehouse, core("dim_vehicle"), f"{tmp_path}/p", movements=True)
    assert rows(warehouse.read("dm_movement_by_route_hour")) == [
        ("B-1", datetime(2024, 1, 2, 10), 2, 15.0, 1.0), ("B-1", datetime(2024, 1, 5, 10), 1, 20.0, 1.0)]


@pytest.mark.parametrize("keep_time", [False, True])
def test_facts_are_appended_once_even_when_a_batch_is_replayed(spark, feed, core, rows, tmp_path, keep_time):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    vehicles = core("dim_vehicle", dict(vehicle_sk=5, vehicle_id=1))
    name = "fact_vehicle_position"

    def run(progress):
        events = positions.read_files(spark, folder, SCHEMA, max_files=1)
        positions.append_facts(events, lambda: vehicles, warehouse, "2024-02-01T00:00:00Z",
                               f"{tmp_path}/{progress}", keep_time).awaitTermination()
        return rows(warehouse.read(name), "event_id", "vehicle_sk", "event_date_sk")

    folder = feed(("a", 1, "2024-01-01 10:00:00", 1.0), ("b", 2, "2024-01-02 10:00:00", 1.0))
    feed(("a", 1, "2024-01-01 10:00:00", 1.0), ("c", 1, "2024-01-01 11:00:00", 1.0))
    want = [("a", 5, 20240101), ("b", None, 20240102), ("c", 5, 20240101)]
    assert run("p1") == want
    assert run("p1") == want
    # Progress lost altogether: everything is read again and nothing is added.
    assert run("p2") == want
    assert set(RAW["vehicle_positions"].column_names) <= set(positions.read_files(spark, folder, SCHEMA).columns)
