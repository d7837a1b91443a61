import os
import re
import subprocess
import sys
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from headway.plans import mart
from headway.plans.load import _Staged, load_all, load_core, load_mart, load_staging
from headway.schemas import RAW, WAREHOUSE
from headway.session import input_bytes, scratch_path, size_shuffles
from headway.sources import ledger
from headway.sources.raw import raw_path, raw_root, read_raw
from headway.sources.warehouse import Warehouse

DAY1, DAY2 = "2024-01-11T00:00:00Z", "2024-01-12T00:00:00Z"
FACTS = ("fact_ride", "fact_payment", "fact_vehicle_position")


def _write_raw(raw, root, users=(1, 2), fare=10.0, rides=(("r1", 1), ("r2", 2), ("r3", 7))):
    tables = {
        "users": [dict(user_id=u, name=f"u{u}", city=f"c{fare:.0f}", created_at="2023-05-01T10:00:00+00:00")
                  for u in users],
        "routes": [dict(route_id=1, route_number="B-1", vehicle_type="bus", base_fare=fare),
                   dict(route_id=2, route_number="M-2", vehicle_type="metro", base_fare=60.0)],
        "vehicles": [dict(vehicle_id=101, route_id=1, license_plate="A1", capacity=80),
                     dict(vehicle_id=102, route_id=2, capacity=900)],
        "rides": [dict(ride_id=r, user_id=u, route_id=1 + i % 2, vehicle_id=101,
                       start_time=f"2024-01-10T{8 + i:02d}:00:00+00:00",
                       end_time=f"2024-01-10T{8 + i:02d}:20:00+00:00", fare_amount=40.0 + i)
                  for i, (r, u) in enumerate(rides)],
        "payments": [dict(payment_id=f"p-{r}", ride_id=r, user_id=u, amount=40.0, payment_method="card",
                          status="success", created_at="2024-01-10T08:01:00+00:00") for r, u in rides],
        "vehicle_positions": [dict(event_id=f"e{i}", vehicle_id=101 + i, route_number="B-1",
                                   event_time=f"2024-01-10T08:00:{30 * (i % 2):02d}Z", latitude=55.7,
                                   longitude=37.6, speed_kmh=20.0, passengers_estimated=i) for i in range(3)],
    }
    for name, values in tables.items():
        typed = raw(name, *values)
        typed.write.mode("overwrite").parquet(raw_path(root, name))


def _contents(warehouse, rows):
    return {name: rows(warehouse.read(name)) for name in WAREHOUSE if not name.startswith("stg.")}


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "raw"), str(tmp_path / "warehouse")


def test_raw_locations():
    assert raw_root("file", folder="/data/") == "/data"
    assert raw_root("s3a", bucket="b", prefix="/x/") == "s3a://b/x"
    assert raw_root(bucket="b") == "s3a://b"
    assert raw_path("s3a://b", "users") == "s3a://b/oltp/users.parquet"
    assert raw_path("/d", "vehicle_positions") == "/d/kafka/vehicle_positions.parquet"
    with pytest.raises(ValueError):
        raw_root("ftp")
    with pytest.raises(ValueError):
        raw_root("file")


def test_tables_read_empty_before_anything_is_written(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "none"))
    for name, table in WAREHOUSE.items():
        df = warehouse.read(name)
        assert df.columns == table.column_names and df.count() == 0


def test_first_load_from_raw_files(spark, raw, rows, folder):
    source, root = folder
    _write_raw(raw, source)
    warehouse = load_all(spark, read_raw(spark, source), root, "b1", DAY1)
    assert rows(warehouse.read("dim_user"), "user_sk", "user_id") == [(1, 1), (2, 2)]
    assert rows(warehouse.read("dim_date"), "date_sk") == [(20240110,)]
    assert rows(warehouse.read("dim_time"), "time_sk") == [(t,) for t in sorted(
        [80000, 80030, 80100, 90000, 100000], key=lambda t: repr((t,)))]
    assert rows(warehouse.read("fact_ride"), "ride_id", "user_sk", "route_sk", "duration_s") == [
        ("r1", 1, 1, 1200), ("r2", 2, 2, 1200)]
    assert rows(warehouse.read("fact_ride_rejects")) == [("r3", "user_sk", "b1")]
    assert rows(warehouse.read("fact_payment_rejects"), "payment_id") == [("p-r3",)]
    assert rows(warehouse.read("fact_vehicle_position"), "event_id", "vehicle_sk") == [
        ("e0", 1), ("e1", 2), ("e2", None)]
    assert rows(warehouse.read("dm_rides_by_route_hour"), "route_number", "hour", "trips_count", "avg_fare") == [
        ("B-1", 8, 1, 40.0), ("M-2", 9, 1, 41.0)]


def test_loading_again_changes_nothing(spark, raw, rows, folder):
    source, root = folder
    _write_raw(raw, source)
    load = lambda batch, at: load_all(spark, read_raw(spark, source), root, batch, at)
    once = _contents(load("b1", DAY1), rows)
    assert _contents(load("b1", DAY1), rows) == once
    again = _contents(load("b2", DAY2), rows)
    # The next batch only lists its own rejects as well.
    assert {n: v for n, v in again.items() if "rejects" not in n} == {
        n: v for n, v in once.items() if "rejects" not in n}
    assert Warehouse(spark, root).read("stg.users").count() == 4


def test_an_interrupted_fact_append_is_completed(spark, raw, rows, folder):
    source, root = folder
    _write_raw(raw, source, users=(1, 2, 7))
    other = load_all(spark, read_raw(spark, source), f"{root}-whole", "b1", DAY1)
    part = other.read("fact_ride").where("ride_id = 'r2'")
    broken = Warehouse(spark, f"{root}-part")
    load_staging(broken, read_raw(spark, source), "b1", DAY1)
    broken.append(part, "fact_ride")
    load_core(broken, "b1", DAY1)
    load_mart(broken)
    by_rides = rows(broken.read("dm_rides_by_route_hour"))
    mart.refresh(broken)
    assert rows(broken.read("dm_rides_by_route_hour")) == by_rides
    assert _contents(broken, rows) == _contents(other, rows)


def test_rejected_rides_load_once_their_user_arrives(spark, raw, rows, folder):
    source, root = folder
    _write_raw(raw, source)
    load_all(spark, read_raw(spark, source), root, "b1", DAY1)
    _write_raw(raw, source, users=(7,), rides=())
    warehouse = load_all(spark, read_raw(spark, source), root, "b2", DAY2)
    assert rows(warehouse.read("dim_user"), "user_sk", "user_id") == [(1, 1), (2, 2), (3, 7)]
    assert rows(warehouse.read("fact_ride"), "ride_id", "user_sk") == [("r1", 1), ("r2", 2), ("r3", 3)]
    assert rows(warehouse.read("fact_payment"), "payment_id") == [("p-r1",), ("p-r2",), ("p-r3",)]


def test_loading_one_batch_alone(spark, raw, rows, folder):
    source, root = folder
    _write_raw(raw, source)
    load_all(spark, read_raw(spark, source), root, "b1", DAY1)
    _write_raw(raw, source, users=(2, 3), rides=(("r2", 2), ("r4", 3)))
    warehouse = load_all(spark, read_raw(spark, source), root, "b2", DAY2, only_batch=True)
    assert rows(warehouse.read("dim_user"), "user_sk", "user_id") == [(1, 1), (2, 2), (3, 3)]
    assert rows(warehouse.read("fact_ride"), "ride_id", "user_sk") == [("r1", 1), ("r2", 2), ("r4", 3)]
    assert warehouse.read("fact_vehicle_position").count() == 3


def test_one_batch_takes_earlier_rejects_along(spark, raw, rows, folder):
    source, root = folder
    _write_raw(raw, source, rides=(("r1", 1), (None, 1), ("r3", 7)))
    load_all(spark, read_raw(spark, source), root, "b1", DAY1, only_batch=True)
    _write_raw(raw, source, users=(7,), rides=(("r8", 8), (None, 7)))
    warehouse = load_all(spark, read_raw(spark, source), root, "b2", DAY2, only_batch=True)
    assert rows(warehouse.read("fact_ride"), "ride_id") == [("r1",), ("r3",)]
    want = sorted([("r8", "user_sk", "b2"), (None, "ride_id", "b1"), (None, "ride_id", "b2")], key=repr)
    assert rows(warehouse.read("fact_ride_rejects")) == want
    # A third load of a batch without rides keeps the list.
    _write_raw(raw, source, users=(1,), rides=())
    warehouse = load_all(spark, read_raw(spark, source), root, "b3", DAY2, only_batch=True)
    assert rows(warehouse.read("fact_ride_rejects")) == want


def _offered(warehouse, name, fact, key):
    staged = warehouse.read(f"stg.{name}").selectExpr(f"count(DISTINCT {key}) + count_if({key} IS NULL) AS n").first().n
    return staged, warehouse.read(fact).count() + warehouse.read(f"{fact}_rejects").count()


def test_unloaded_batches_are_loaded_together_and_once(spark, raw, rows, folder):
    source, root = folder
    warehouse = Warehouse(spark, root)
    _write_raw(raw, source)
    load_staging(warehouse, read_raw(spark, source), "b1", DAY1)
    load_core(warehouse, "b1", DAY1, unloaded=True)
    assert rows(warehouse.read("fact_ride"), "ride_id") == [("r1",), ("r2",)]
    for batch, at, users, rides in (("b2", DAY2, (3,), (("r4", 3), ("r5", 9))), ("b3", "2024-01-13T00:00:00Z", (7,), (("r6", 7),))):
        _write_raw(raw, source, users=users, rides=rides, fare=20.0 if batch == "b2" else 30.0)
        load_staging(warehouse, read_raw(spark, source), batch, at)
    assert ledger.unloaded(warehouse)["rides"] == ["b2", "b3"]
    load_core(warehouse, "", "2024-01-13T00:00:00Z", unloaded=True, routes="history")
    assert rows(warehouse.read("fact_ride"), "ride_id") == [("r1",), ("r2",), ("r3",), ("r4",), ("r6",)]
    assert rows(warehouse.read("fact_ride_rejects")) == [("r5", "user_sk", "b2")]
    # Both states of the route became versions.
    assert rows(warehouse.read("dim_route_scd2").where("route_id = 1"), "base_fare", "is_current") == [
        (Decimal("10.00"), False), (Decimal("20.00"), False), (Decimal("30.00"), True)]
    assert not any(ledger.unloaded(warehouse).values())
    mart.refresh(warehouse)
    before = _contents(warehouse, rows)
    load_core(warehouse, "", "2024-01-14T00:00:00Z", unloaded=True, routes="history")
    mart.refresh(warehouse)
    assert _contents(warehouse, rows) == before
    # A batch that is staged anew is loaded anew.
    _write_raw(raw, source, users=(9,), rides=(("r6", 7), ("r7", 7)))
    load_staging(warehouse, read_raw(spark, source), "b3", "2024-01-13T00:00:00Z")
    assert ledger.unloaded(warehouse)["rides"] == ["b3"]
    load_core(warehouse, "", "2024-01-15T00:00:00Z", unloaded=True)
    assert rows(warehouse.read("fact_ride"), "ride_id") == [("r1",), ("r2",), ("r3",), ("r4",), ("r5",), ("r6",), ("r7",)]
    with pytest.raises(ValueError, match="either"):
        load_core(warehouse, "b3", DAY2, unloaded=True, only_batch=True)


def test_only_the_folders_of_unloaded_batches_are_read(spark, raw, folder):
    source, root = folder
    warehouse = Warehouse(spark, root)
    _write_raw(raw, source)
    for batch in ("b1", "b2", "b3"):
        load_staging(warehouse, read_raw(spark, source), batch, DAY1)
    ledger.record(warehouse, {"rides": ["b1", "b2"]}, DAY1)
    chosen = _Staged(warehouse, ledger.unloaded(warehouse)).rows("rides")
    assert all("batch_id=b3" in f for f in chosen.inputFiles()) and chosen.count() == 3
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan or "PartitionFilters: [(batch_id" in plan


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.permutations(["b1", "b2", "b3"]), st.lists(st.sampled_from(["only", "all", "unloaded"]), min_size=3, max_size=3))
def test_nothing_staged_is_lost_in_any_order_of_loads(spark, raw, tmp_path_factory, order, ways):
    source, root = str(tmp_path_factory.mktemp("raw")), str(tmp_path_factory.mktemp("warehouse"))
    warehouse = Warehouse(spark, root)
    contents = {"b1": dict(users=(1,), rides=(("r1", 1), (None, 1), ("r3", 7))),
                "b2": dict(users=(2,), rides=(("r2", 2), (None, 2), ("r3", 7), ("r8", 8))),
                "b3": dict(users=(7,), rides=(("r9", 9), (None, 7)))}
    for batch, way in zip(order, ways, strict=True):
        _write_raw(raw, source, **contents[batch])
        load_staging(warehouse, read_raw(spark, source), batch, DAY1)
        load_core(warehouse, batch, DAY1, only_batch=way == "only", unloaded=way == "unloaded")
        for name, fact, key in (("rides", "fact_ride", "ride_id"), ("payments", "fact_payment", "payment_id")):
            staged, found = _offered(warehouse, name, fact, key)
            assert staged == found, (order, ways, batch, name)
    load_core(warehouse, order[-1], DAY2, only_batch=True)
    assert _offered(warehouse, "rides", "fact_ride", "ride_id") == (8, 8)


def test_only_the_last_versions_stay(spark, core, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), keep_versions=2)
    for i in range(4):
        warehouse.replace(core("dim_user", dict(user_sk=i, user_id=i)), "dim_user")
    assert len(warehouse.versions("dim_user")) == 2 and warehouse.read("dim_user").first().user_sk == 3
    with pytest.raises(ValueError, match="two"):
        Warehouse(spark, str(tmp_path), keep_versions=1)


def test_date_bounds_prune_months_on_both_sides(spark, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.append(core("fact_ride", *[dict(ride_id=str(m), start_date_sk=20240015 + 100 * m) for m in range(1, 7)]), "fact_ride")
    got = warehouse.read("fact_ride", from_date_sk=20240215, to_date_sk=20240414)
    assert rows(got, "ride_id") == [("2",), ("3",)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*month[^]]*>= 202402[^]]*<= 202404", plan)


def test_untouched_months_of_the_mart_keep_their_files(spark, raw, folder):
    source, root = folder
    _write_raw(raw, source)
    warehouse = load_all(spark, read_raw(spark, source), root, "b1", DAY1)
    before = sorted(p.name for p in Path(warehouse.path("dm_rides_by_route_hour")).rglob("*.parquet"))
    load_all(spark, read_raw(spark, source), root, "b2", DAY2)
    assert sorted(p.name for p in Path(warehouse.path("dm_rides_by_route_hour")).rglob("*.parquet")) == before


def test_staging_is_written_without_a_shuffle(spark, stg, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    rows, table = stg("users", dict(batch_id="b", user_id=1)), WAREHOUSE["stg.users"]
    plan = warehouse._laid_out(rows, table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_history_and_overwritten_users(spark, raw, rows, folder):
    source, root = folder
    options = dict(users="overwrite", routes="history", route_lookup="asof")
    _write_raw(raw, source)
    load_all(spark, read_raw(spark, source), root, "b1", DAY1, **options)
    _write_raw(raw, source, users=(2, 3), fare=15.0, rides=(("r4", 3), ("r5", 2)))
    warehouse = load_all(spark, read_raw(spark, source), root, "b2", DAY2, **options)
    assert rows(warehouse.read("dim_user"), "user_sk", "user_id", "city") == [
        (1, 1, "c10"), (2, 2, "c15"), (3, 3, "c15")]
    assert rows(warehouse.read("dim_route_scd2"), "route_sk", "route_id", "base_fare", "is_current") == [
        (1, 1, Decimal("10.00"), False), (2, 2, Decimal("60.00"), True), (3, 1, Decimal("15.00"), True)]
    # These rides started before the change, so they refer to the version of then.
    assert rows(warehouse.read("fact_ride"), "ride_id", "route_sk") == [
        ("r1", 1), ("r2", 2), ("r4", 1), ("r5", 2)]
    assert len(warehouse.versions("dim_route_scd2")) == 2
    # Repeating the batch finds nothing to change.
    before = rows(warehouse.read("dim_route_scd2"))
    load_core(warehouse, "b2", DAY2, **options)
    assert rows(warehouse.read("dim_route_scd2")) == before


def test_without_backdating_rides_before_the_first_load_are_rejected(spark, raw, rows, folder):
    source, root = folder
    _write_raw(raw, source)
    warehouse = load_all(spark, read_raw(spark, source), root, "b1", DAY1, route_lookup="asof",
                         backdate_first_version=False)
    assert rows(warehouse.read("fact_ride")) == []
    assert rows(warehouse.read("fact_ride_rejects"), "ride_id", "reason") == [
        ("r1", "route_sk"), ("r2", "route_sk"), ("r3", "user_sk,route_sk")]


def test_a_lenient_load_lists_unreadable_rows(raw, spark, rows, folder):
    source, root = folder
    _write_raw(raw, source)
    broken = {**read_raw(spark, source), "payments": raw("payments", dict(payment_id="p", created_at="soon"))}
    warehouse = Warehouse(spark, root)
    load_staging(warehouse, broken, "b1", DAY1, lenient=True)
    assert rows(warehouse.read("stg.unreadable")) == [("b1", "payments", "p", "created_at")]
    assert rows(warehouse.read("stg.payments"), "payment_id", "created_at") == [("p", None)]
    # Repeating the batch strictly fails and leaves the staged rows as they were.
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_staging(warehouse, broken, "b1", DAY1)
    assert warehouse.read("stg.payments").count() == 1
    # A repeat without payments clears them, and the list.
    load_staging(warehouse, {**broken, "payments": raw("payments")}, "b1", DAY1, lenient=True)
    assert warehouse.read("stg.payments").count() == 0
    assert warehouse.read("stg.unreadable").count() == 0
    assert warehouse.read("stg.users").count() == 2
    with pytest.raises(ValueError, match="batch id"):
        load_staging(warehouse, broken, "b1/../b2", DAY1)


def test_tables_are_compressed_with_zstd(spark, core, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.append(core("dim_vehicle", dict(vehicle_sk=1, vehicle_id=1)), "dim_vehicle")
    assert [p.name for p in tmp_path.rglob("*.zstd.parquet")]


def test_unfinished_versions_are_ignored(spark, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.replace(core("dim_user", dict(user_sk=1, user_id=1)), "dim_user")
    warehouse.replace(warehouse.read("dim_user"), "dim_user")
    second = Path(warehouse.path("dim_user").removeprefix("file:"))
    assert second.name == "version-00000002"
    (second / "_SUCCESS").unlink()
    assert warehouse.path("dim_user").endswith("version-00000001")
    warehouse.replace(core("dim_user", dict(user_sk=2, user_id=2)), "dim_user")
    assert rows(warehouse.read("dim_user"), "user_sk") == [(2,)]


def test_mart_replaces_only_its_months(spark, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.append(core("dim_route_scd2", dict(route_sk=1, route_id=1, route_number="B", is_current=True)),
                     "dim_route_scd2")
    ride = dict(route_sk=1, fare_amount=1, duration_s=1)
    warehouse.append(core("fact_ride", dict(ride_id="a", start_time="2024-01-31 10:00:00",
                                            start_date_sk=20240131, **ride),
                          dict(ride_id="b", start_time="2024-02-01 10:00:00", start_date_sk=20240201, **ride)),
                     "fact_ride")
    load_mart(warehouse)
    warehouse.append(core("fact_ride", dict(ride_id="c", start_time="2024-02-01 10:00:00",
                                            start_date_sk=20240201, **ride)), "fact_ride")
    load_mart(warehouse, from_month=202402)
    assert rows(warehouse.read("dm_rides_by_route_hour").selectExpr("month(date)", "trips_count")) == [(1, 1), (2, 2)]
    recent = warehouse.read("fact_ride", from_month=202402)
    assert recent.count() == 2
    assert "PartitionFilters: [isnotnull(month" in recent._jdf.queryExecution().executedPlan().toString()


def test_shuffles_are_sized_by_input(spark, raw, tmp_path):
    raw("users", dict(user_id=1)).write.parquet(f"{tmp_path}/users.parquet")
    size = input_bytes(spark, str(tmp_path))
    assert size > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 0) == int(before)
        assert size_shuffles(spark, 100 << 30) == 1600
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scratch_tables_go_to_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_command_line(raw, rows, spark, folder):
    source, root = folder
    _write_raw(raw, source)
    command = [sys.executable, "-m", "headway.plans.load", "--root", root, "--batch-id", "b1",
               "--load-dts", DAY1]
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS":
           "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
    run = subprocess.run([*command, "--raw", source], cwd=Path(__file__).parents[1], env=env,
                         capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "'fact_ride': 1" in run.stdout
    assert Warehouse(spark, root).read("dm_rides_by_route_hour").count() == 2


def test_a_load_of_many_months_writes_few_files_a_month(spark, core, rows, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    days = [dict(ride_id=f"{m}-{d}", start_date_sk=20240000 + 100 * m + d) for m in range(1, 4) for d in range(1, 29)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        warehouse.append(core("fact_ride", *days), "fact_ride")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    folders = sorted(Path(warehouse.path("fact_ride")).glob("month=*"))
    assert [f.name for f in folders] == ["month=202401", "month=202402", "month=202403"]
    assert all(len(list(f.glob("*.parquet"))) <= 4 for f in folders)
    assert rows(warehouse.read("fact_ride"), "ride_id") == sorted(((d["ride_id"],) for d in days), key=repr)


def test_stored_keys_are_picked_out_for_small_batches_only(spark, raw, folder, monkeypatch):
    source, root = folder
    _write_raw(raw, source)
    warehouse = load_all(spark, read_raw(spark, source), root, "b1", DAY1)
    load_staging(warehouse, read_raw(spark, source), "b2", DAY2)
    staged = _Staged(warehouse, {name: ["b2"] for name in ledger.STAGING})
    assert "Join" in staged.known("rides")._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr("headway.plans.load.FEW_BYTES", 0)
    assert "Join" not in staged.known("rides")._jdf.queryExecution().optimizedPlan().toString()
    assert load_core(warehouse, "b2", DAY2, only_batch=True)["fact_ride"] == 1
    assert warehouse.read("fact_ride").count() == 2


def test_payments_are_not_appended_before_the_rides(spark, raw, folder, monkeypatch):
    source, root = folder
    _write_raw(raw, source)
    warehouse = Warehouse(spark, root)
    load_staging(warehouse, read_raw(spark, source), "b1", DAY1)
    whole = Warehouse.append
    started = []

    def append(self, rows, name):
        started.append(name)
        if name == "fact_ride":
            raise OSError("no more room")
        whole(self, rows, name)

    monkeypatch.setattr(Warehouse, "append", append)
    with pytest.raises(OSError, match="no more room"):
        load_core(warehouse, "b1", DAY1)
    assert "fact_ride" in started and "fact_payment" not in started


def test_months_all_of_new_loads_are_not_searched_for_moved_routes(spark, raw, folder, monkeypatch):
    source, root = folder
    _write_raw(raw, source)
    warehouse = Warehouse(spark, root)
    load_staging(warehouse, read_raw(spark, source), "b1", DAY1)
    load_core(warehouse, "b1", DAY1)
    read = Warehouse.read
    reads = []
    monkeypatch.setattr(Warehouse, "read", lambda self, name, *a, **k: reads.append(name) or read(self, name, *a, **k))
    assert mart.refresh(warehouse) == [202401]
    assert "rides_shown" not in reads
    assert warehouse.read("dm_rides_by_route_hour").count() == 2


def test_a_load_without_rides_loses_its_sums(spark, raw, folder):
    source, root = folder
    _write_raw(raw, source)
    warehouse = load_all(spark, read_raw(spark, source), root, "b1", DAY1)
    label = warehouse.batches("rides_partial")[0]
    assert warehouse.months("rides_partial", [label]) == {202401}
    warehouse.overwrite_batch(warehouse.read("rides_partial").limit(0), "rides_partial", label)
    assert warehouse.batches("rides_partial") == [] and warehouse.read("rides_partial").count() == 0


def test_several_batches_read_the_joined_rides_once(spark, rows, tmp_path):
    from headway.plans.queries import Tables
    from headway.sources.supplied import SCHEMAS

    at = datetime(1997, 1, 1)
    spark.createDataFrame([(1, 2, 3, 1, 1.0, 5.0, 0.0, 0.0, "A", "F", at)], SCHEMAS["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, "O", 5.0, at, "1-URGENT")], SCHEMAS["orders"]).write.parquet(f"{tmp_path}/orders.parquet")
    rides = Tables(spark, str(tmp_path)).raw_rides()
    assert "Join" not in rides._jdf.queryExecution().optimizedPlan().toString()
    assert rows(rides, "ride_id", "user_id") == [("1-1", 7)]
