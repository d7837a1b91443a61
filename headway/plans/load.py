"""A full load: raw tables to staging, dimensions, facts and mart, each step safe to repeat.

The steps can run as one application or one by one:

    python -m headway.plans.load --raw URI --root URI --batch-id ID [--step staging|core|mart|all]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import dimensions, facts, history, marts
from headway.operators.keys import by_rows, stored_among, unseen
from headway.operators.staging import stage, stage_rejects
from headway.plans import mart
from headway.schemas import BEFORE_ALL, CORE, STAGING
from headway.session import build_session, input_bytes, scratch_table, side_by_side, size_shuffles, use_utc
from headway.sources import ledger
from headway.sources.raw import read_raw
from headway.sources.rejects import append_fact, waiting
from headway.sources.warehouse import Warehouse


def load_staging(warehouse: Warehouse, raw: dict[str, DataFrame], batch_id: str, load_dts: str,
                 lenient: bool = False) -> None:
    """Write every raw table as one batch; repeating a batch id replaces that batch and has it loaded again.

    A ``lenient`` load stages unreadable values as null and lists their rows in `stg.unreadable`.
    """
    def write(name: str) -> None:
        rows = stage(raw[name], name, batch_id, load_dts, lenient)
        warehouse.overwrite_batch(rows, f"stg.{name}", batch_id)

    ledger.forget(warehouse, batch_id)
    side_by_side(*[partial(write, name) for name in STAGING])
    if lenient:
        found = [stage_rejects(raw[name], name).select(
                    F.lit(batch_id).alias("batch_id"), F.lit(name).alias("table_name"),
                    F.col(STAGING[name].key[-1]).cast("string").alias("row_key"), "broken_columns")
                 for name in STAGING]
        warehouse.overwrite_batch(reduce(DataFrame.unionByName, found), "stg.unreadable", batch_id)


# Files of batches whose keys may still be broadcast. The keys of larger ones are shuffled, as the stored ones are then;
# picking the stored keys among them first would only read and shuffle the batches twice.
FEW_BYTES = 16 << 20


class _Staged:
    """The staged rows a load reads: those of the chosen batches, and rejected rows of others to try again.

    ``chosen`` names batches per staging table; None stands for all of them.
    """

    def __init__(self, warehouse: Warehouse, chosen: dict[str, list[str]] | None):
        self._warehouse, self._chosen = warehouse, chosen
        self._waiting = {} if chosen is None else {
            name: self._again(fact, chosen[name]) for name, fact in _FACT_OF.items()}

    def _again(self, fact: str, but: list[str]) -> tuple[DataFrame, list[str]] | None:
        listed = waiting(self._warehouse, fact, but)
        if listed is None:
            return None
        batches = [r.load_batch for r in listed.select("load_batch").distinct().collect()]
        return (listed.select(CORE[fact].key[0]), batches) if batches else None

    @property
    def is_whole(self) -> bool:
        return self._chosen is None

    def batches(self, name: str) -> list[str] | None:
        return None if self._chosen is None else self._chosen[name]

    def batch(self, name: str) -> DataFrame:
        """The rows of the chosen batches alone."""
        table = f"stg.{name}"
        return self._warehouse.read(table) if self._chosen is None else self._warehouse.read_batches(table, self._chosen[name])

    def rows(self, name: str) -> DataFrame:
        again = self._waiting.get(name)
        if again is None:
            return self.batch(name)
        keys, batches = again
        earlier = self._warehouse.read_batches(f"stg.{name}", batches)
        return self.batch(name).unionByName(earlier.join(by_rows(keys.distinct(), keys), CORE[_FACT_OF[name]].key[0], "left_semi"))

    def known(self, name: str) -> DataFrame:
        """The stored fact, or of it the keys that are among the rows, where these are few."""
        fact = _FACT_OF[name]
        stored, key = self._warehouse.read(fact), CORE[fact].key[0]
        if self.is_whole or self._warehouse.batch_bytes(f"stg.{name}", self._chosen[name]) > FEW_BYTES:
            return stored
        again, keys = self._waiting.get(name), self.batch(name).select(key)
        return stored_among(stored, keys if again is None else keys.unionByName(again[0]), key)


def load_core(warehouse: Warehouse, batch_id: str, load_dts: str, *, users: str = "insert",
              routes: str = "insert", route_lookup: str = "current", backdate_first_version: bool = True,
              only_batch: bool = False, unloaded: bool = False) -> dict[str, int]:
    """Load dimensions, then facts, from all staged batches. Returns rejected rows per fact.

    With ``unloaded`` just the batches are read that no load has finished with, in any number: the ledger tells
    which, and every load enters there what it has loaded. With ``only_batch`` it is the batch ``batch_id``. Either
    way the rows that earlier loads had rejected are taken along: they are looked up in the batches they are listed
    with and tried again. The cost of a load then follows these batches instead of the whole history. Rows without
    a key can't be tried again; they stay listed.

    ``users`` is ``"insert"`` (new users only) or ``"overwrite"`` (type 1: by the batch ``batch_id``, or the newest
    state among the unloaded ones); ``routes`` is ``"insert"`` (new routes only) or ``"history"`` (type 2: every
    state that is read becomes part of it, at its extract time; with ``only_batch`` at ``load_dts``). With
    ``route_lookup="asof"`` a ride refers to the route version valid at its start, and a route's first version then
    reaches back before the first load, unless ``backdate_first_version`` is false.
    """
    if only_batch and unloaded:
        raise ValueError("either one batch or the unloaded ones")
    if unloaded:
        chosen = finished = ledger.unloaded(warehouse)
    else:
        present = ledger.staged_batches(warehouse)
        chosen = {name: [batch_id] for name in STAGING} if only_batch else None
        finished = {name: [b for b in batches if b == batch_id or not only_batch] for name, batches in present.items()}
    staged = _Staged(warehouse, chosen)
    mart.announce(warehouse, load_dts)
    _load_dimensions(warehouse, staged, batch_id, load_dts, users, routes,
                     BEFORE_ALL if route_lookup.startswith("asof") and backdate_first_version else None,
                     every_state=not only_batch, newest_users=unloaded)
    rejected = _load_facts(warehouse, staged, load_dts, route_lookup)
    ledger.record(warehouse, finished, load_dts)
    return rejected


_FACT_OF = {"rides": "fact_ride", "payments": "fact_payment", "vehicle_positions": "fact_vehicle_position"}


def _one_of(value: str, label: str, *allowed: str) -> None:
    if value not in allowed:
        raise ValueError(f"{label} must be one of {allowed}, not {value!r}")


def _load_dimensions(warehouse: Warehouse, staged: _Staged, batch_id: str, load_dts: str, users: str, routes: str,
                     first_valid_from: str | None, every_state: bool, newest_users: bool) -> None:
    _one_of(users, "users", "insert", "overwrite")
    _one_of(routes, "routes", "insert", "history")
    read = warehouse.read

    def load_users() -> None:
        rows, stored = staged.batch("users"), read("dim_user")
        if users == "insert":
            warehouse.append(dimensions.new_users(rows, stored, load_dts), "dim_user")
        else:
            # Batches loaded before would be no change, or undo one.
            batch = rows if newest_users else rows.where(F.col("batch_id") == batch_id)
            warehouse.replace(dimensions.overwrite_users(stored, batch, load_dts), "dim_user")

    def load_vehicles() -> None:
        new = dimensions.new_vehicles(staged.batch("vehicles"), read("dim_vehicle"), load_dts)
        warehouse.append(new, "dim_vehicle")

    def load_routes() -> None:
        rows, stored = staged.batch("routes"), read("dim_route_scd2")
        if routes == "insert":
            new = dimensions.new_routes(rows, stored, load_dts, first_valid_from)
            warehouse.append(new, "dim_route_scd2")
        elif every_state:
            warehouse.replace(history.merge_snapshots(stored, rows, first_valid_from), "dim_route_scd2")
        else:
            warehouse.replace(history.merge_routes(stored, rows, load_dts, first_valid_from), "dim_route_scd2")

    def load_observed() -> None:
        # Each event table is read once; both dimensions are made from the distinct moments.
        times = dimensions.event_times(staged.batch("rides"), staged.batch("payments"), staged.batch("vehicle_positions"))
        with scratch_table(warehouse.spark, dimensions.moments(times), "moments") as found:
            for name, build in (("dim_date", dimensions.calendar), ("dim_time", dimensions.clock)):
                warehouse.append(unseen(build(found), read(name), CORE[name].key), name)

    side_by_side(load_users, load_vehicles, load_routes, load_observed)


def _load_facts(warehouse: Warehouse, staged: _Staged, load_dts: str, route_lookup: str) -> dict[str, int]:
    read, carry = warehouse.read, ("batch_id",)
    users, vehicles, routes = read("dim_user"), read("dim_vehicle"), read("dim_route_scd2")

    def rides() -> DataFrame:
        return facts.ride_facts(staged.rows("rides"), users, vehicles, routes, load_dts, staged.known("rides"),
                                route_lookup, carry)

    def payments() -> DataFrame:
        return facts.payment_facts(staged.rows("payments"), users, load_dts, staged.known("payments"), carry)

    def positions() -> DataFrame:
        return facts.position_facts(staged.rows("vehicle_positions"), vehicles, load_dts,
                                    staged.known("vehicle_positions"), carry)

    def load(name: str, build: Callable[[], DataFrame], after: Callable[[], object] | None = None) -> int:
        append_fact(warehouse, build(), _FACT_OF[name], staged.batches(name), after and (lambda _: after()))
        return read(f"{_FACT_OF[name]}_rejects").count()

    # Payments refer to rides: they are worked out at the same time, and appended when the rides are there.
    with ThreadPoolExecutor(3) as threads:
        first = threads.submit(load, "rides", rides)
        counts = [first, threads.submit(load, "payments", payments, first.result),
                  threads.submit(load, "vehicle_positions", positions)]
        return {fact: count.result() for fact, count in zip(_FACT_OF.values(), counts, strict=True)}


def load_mart(warehouse: Warehouse, from_month: int | None = None, to_month: int | None = None) -> None:
    """Recompute the mart from the rides, of some months (e.g. 202410) if bounds are given, and replace these months.

    `mart.refresh` does the same for what loads changed, from stored sums.
    """
    rides = warehouse.read("fact_ride", from_month, to_month)
    rows = marts.rides_by_route_hour(rides, warehouse.read("dim_route_scd2"))
    warehouse.overwrite_partitions(rows, "dm_rides_by_route_hour")


def load_all(spark: SparkSession, raw: dict[str, DataFrame], root: str, batch_id: str, load_dts: str,
             lenient: bool = False, **core_options) -> Warehouse:
    """Run all three steps and return the warehouse."""
    warehouse = Warehouse(use_utc(spark), root)
    load_staging(warehouse, raw, batch_id, load_dts, lenient)
    load_core(warehouse, batch_id, load_dts, **core_options)
    mart.refresh(warehouse)
    return warehouse


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--raw", help="root of the raw tables (staging step)")
    parser.add_argument("--root", required=True, help="root of the warehouse")
    parser.add_argument("--batch-id", help="default: the load time as yyyymmddHHMMSS")
    parser.add_argument("--load-dts", help="ISO-8601 load time with zone; default: now")
    parser.add_argument("--step", default="all", choices=["staging", "core", "mart", "all"])
    parser.add_argument("--lenient", action="store_true", help="stage unreadable values as null")
    parser.add_argument("--users", default="insert", choices=["insert", "overwrite"])
    parser.add_argument("--routes", default="insert", choices=["insert", "history"])
    parser.add_argument("--route-lookup", default="current", choices=["current", "asof", "asof_ordered"])
    parser.add_argument("--no-backdating", action="store_true", help="first versions of routes start at their load")
    parser.add_argument("--recompute", action="store_true", help="compute the mart from the rides, not from stored sums")
    parser.add_argument("--from-month", type=int, help="first month to recompute, as yyyymm")
    parser.add_argument("--to-month", type=int, help="last month to recompute, as yyyymm")
    parser.add_argument("--only-batch", action="store_true",
                        help="load the core from this batch and earlier rejects, not from all staged batches")
    parser.add_argument("--unloaded", action="store_true",
                        help="load the core from the staged batches no load has finished with, and earlier rejects")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    now = datetime.now(timezone.utc).replace(microsecond=0)
    load_dts = args.load_dts or now.isoformat()
    batch_id = args.batch_id or now.strftime("%Y%m%d%H%M%S")
    by_batch = args.only_batch or not args.unloaded and (args.users == "overwrite" or args.routes == "history")
    if args.step == "core" and by_batch and not args.batch_id:
        raise SystemExit("--batch-id must name the staged batch to load")
    if args.step in ("staging", "all") and not args.raw:
        raise SystemExit("--raw is needed to load staging")

    spark = build_session("headway-load")
    warehouse = Warehouse(spark, args.root)
    if args.step in ("staging", "all"):
        size_shuffles(spark, input_bytes(spark, args.raw))
        load_staging(warehouse, read_raw(spark, args.raw), batch_id, load_dts, args.lenient)
    if args.step in ("core", "all"):
        size_shuffles(spark, input_bytes(spark, f"{args.root}/stg"))
        rejected = load_core(warehouse, batch_id, load_dts, users=args.users, routes=args.routes,
                             route_lookup=args.route_lookup, only_batch=args.only_batch,
                             unloaded=args.unloaded,
                             backdate_first_version=not args.no_backdating)
        print("rejected rows:", rejected)
    if args.step in ("mart", "all"):
        if args.recompute or args.from_month or args.to_month:
            load_mart(warehouse, args.from_month, args.to_month)
        else:
            mart.refresh(warehouse)
    spark.stop()


if __name__ == "__main__":
    main()
