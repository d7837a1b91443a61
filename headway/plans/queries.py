"""The registered queries: every operator over the whole supplied tables.

Operators with a "before" state take it from the data: members or facts active before a date were
loaded earlier. Results are cast so that both engines' client libraries show equal values alike
(decimals as doubles; dates, far-future timestamps and integers with nulls as text).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions.calendar import instant
from headway.operators import dimensions, facts, history, keys, marts, quality, staging
from headway.plans import mart
from headway.plans.load import load_all, load_core, load_staging
from headway.schemas import BEFORE_ALL, CORE, STAGING
from headway.session import scratch_path, side_by_side, use_utc
from headway.sources import supplied
from headway.sources.keystore import KeyStore
from headway.sources.warehouse import Warehouse
from headway.streaming import runs

BATCH, LOAD = "20240201000000", "2024-02-01T00:00:00Z"

# Activity before these dates makes the earlier load; each leaves about a third of the members new.
USERS_FROM = "1995-09-01T00:00:00Z"
ROUTES_FROM = "1995-03-23T00:00:00Z"
VEHICLES_FROM = "1995-01-05T00:00:00Z"
# Facts up to here were loaded earlier.
FACTS_FROM = "1998-01-01T00:00:00Z"
EVENTS_FROM = "2024-01-16T00:00:00Z"
# The two states of the route history.
HISTORY_START, HISTORY_CHANGE = "1995-01-01T00:00:00Z", "1998-01-01T00:00:00Z"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def _portable(df: DataFrame) -> DataFrame:
    shown = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType) or field.name in ("capacity", "vehicle_sk"):
            value = value.cast("string").alias(field.name)
        elif field.name == "valid_to_dts":
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        shown.append(value)
    return df.select(*shown)


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(build(use_utc(spark), sf_dir))

    REGISTRY[build.__name__] = run
    return run


class Tables:
    """Staged tables and what is loaded from them.

    Facts look dimensions up in stored tables, as they do in a load: dimensions are computed once, written
    to the shared scratch folder and read back. Everything else is defined lazily.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def staged(self, name: str) -> DataFrame:
        binding = "positions" if name == "vehicle_positions" else name
        raw = getattr(supplied, binding)(self.spark, self.sf_dir)
        return staging.stage(raw, name, BATCH, LOAD)

    def all_staged(self) -> dict[str, DataFrame]:
        return {f"stg.{name}": self.staged(name) for name in STAGING}

    def _store(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stored:
            rows, path = build(), scratch_path(self.spark, name)
            rows.write.parquet(path)
            self._stored[name] = self.spark.read.schema(rows.schema).parquet(path)
        return self._stored[name]

    def raw_rides(self) -> DataFrame:
        return self._store("raw_rides", lambda: supplied.rides(self.spark, self.sf_dir))

    # Members that were active before the given dates, i.e. what an earlier batch held.
    def early_users(self) -> DataFrame:
        active = self.staged("payments").where(F.col("created_at") < instant(USERS_FROM))
        active = active.select("user_id")
        return self.staged("users").join(keys.by_rows(active.distinct(), active), "user_id", "left_semi")

    def early_routes(self) -> DataFrame:
        active = self.staged("rides").where(F.col("start_time") < instant(ROUTES_FROM))
        return self.staged("routes").join(active.select("route_id").distinct(), "route_id", "left_semi")

    def early_vehicles(self) -> DataFrame:
        active = self.staged("rides").where(F.col("start_time") < instant(VEHICLES_FROM))
        return self.staged("vehicles").join(active.select("vehicle_id").distinct(), "vehicle_id", "left_semi")

    # Dimensions after that earlier batch.
    def first_users(self) -> DataFrame:
        return self._store("first_users", lambda: dimensions.new_users(
            self.early_users(), None, HISTORY_START))

    def first_vehicles(self) -> DataFrame:
        return self._store("first_vehicles", lambda: dimensions.new_vehicles(
            self.early_vehicles(), None, HISTORY_START))

    def first_routes(self) -> DataFrame:
        return self._store("first_routes", lambda: dimensions.new_routes(
            self.early_routes(), None, HISTORY_START))

    # Dimensions when everything comes in one batch.
    def users(self) -> DataFrame:
        return self._store("users", lambda: dimensions.new_users(self.staged("users"), None, LOAD))

    def vehicles(self) -> DataFrame:
        return self._store("vehicles", lambda: dimensions.new_vehicles(
            self.staged("vehicles"), None, LOAD))

    def routes(self) -> DataFrame:
        return self._store("routes", lambda: dimensions.new_routes(self.staged("routes"), None, LOAD))

    def merged_routes(self) -> DataFrame:
        return history.merge_routes(self.first_routes(), self.repriced_routes(), HISTORY_CHANGE)

    def route_history(self) -> DataFrame:
        return self._store("route_history", self.merged_routes)

    def repriced_routes(self) -> DataFrame:
        """A later state of all routes in which one kind of vehicle got dearer."""
        dearer = (F.col("base_fare") + 5).cast("decimal(10,2)")
        return self.staged("routes").withColumn(
            "base_fare", F.when(F.col("vehicle_type") == "PROMO", dearer).otherwise(F.col("base_fare")))

    def times(self) -> DataFrame:
        return dimensions.event_times(self.staged("rides"), self.staged("payments"),
                                      self.staged("vehicle_positions"))

    def calendar(self) -> DataFrame:
        return self._store("calendar", lambda: dimensions.calendar(self.times()))

    def clock(self) -> DataFrame:
        return self._store("clock", lambda: dimensions.clock(self.times()))

    def early_times(self) -> DataFrame:
        """Times that earlier loads of rides, payments and positions had brought."""
        early, recent = instant(FACTS_FROM), instant(EVENTS_FROM)
        return dimensions.event_times(
            self.staged("rides").where(F.col("start_time") < early),
            self.staged("payments").where(F.col("created_at") < early),
            self.staged("vehicle_positions").where(F.col("event_time") < recent))

    def all_rides(self, existing: DataFrame | None = None) -> DataFrame:
        side_by_side(self.users, self.vehicles, self.routes)
        return facts.ride_facts(self.staged("rides"), self.users(), self.vehicles(), self.routes(),
                                LOAD, existing)

    def rides(self) -> DataFrame:
        return facts.accepted(self.all_rides(), "fact_ride")

    def all_rides_asof(self) -> DataFrame:
        side_by_side(self.users, self.vehicles, self.route_history)
        return facts.ride_facts(self.staged("rides"), self.users(), self.vehicles(),
                                self.route_history(), LOAD, route_lookup="asof")

    def rides_asof(self) -> DataFrame:
        return facts.accepted(self.all_rides_asof(), "fact_ride")

    def payments(self, existing: DataFrame | None = None) -> DataFrame:
        return facts.accepted(
            facts.payment_facts(self.staged("payments"), self.users(), LOAD, existing), "fact_payment")

    def positions(self, existing: DataFrame | None = None) -> DataFrame:
        return facts.accepted(
            facts.position_facts(self.staged("vehicle_positions"), self.vehicles(), LOAD, existing),
            "fact_vehicle_position")

    def core(self, asof: bool = False) -> dict[str, DataFrame]:
        """The core after one load; with ``asof`` over the route history, rejected rides included."""
        routes = self.route_history if asof else self.routes
        side_by_side(self.users, self.vehicles, routes, self.calendar, self.clock)
        # The audits read facts several times, so these are stored as a load would store them.
        rides = ("all_rides_asof", self.all_rides_asof) if asof else ("rides", self.rides)
        side_by_side(partial(self._store, *rides), partial(self._store, "payments", self.payments),
                     partial(self._store, "positions", self.positions))
        return {"dim_user": self.users(), "dim_vehicle": self.vehicles(), "dim_route_scd2": routes(),
                "dim_date": self.calendar(), "dim_time": self.clock(), "fact_ride": self._stored[rides[0]],
                "fact_payment": self._stored["payments"], "fact_vehicle_position": self._stored["positions"]}


# --- staging ---------------------------------------------------------------------------------------

def _stage_text(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Stage a raw table whose times are ISO-8601 text, as in raw files."""
    binding = getattr(supplied, "positions" if name == "vehicle_positions" else name)
    return staging.stage(binding(spark, sf_dir, text_times=True), name, BATCH, LOAD)


@query
def stg_users(spark, sf_dir):
    return Tables(spark, sf_dir).staged("users")


@query
def stg_routes(spark, sf_dir):
    return Tables(spark, sf_dir).staged("routes")


@query
def stg_vehicles(spark, sf_dir):
    return Tables(spark, sf_dir).staged("vehicles")


@query
def stg_rides(spark, sf_dir):
    return _stage_text(spark, sf_dir, "rides")


@query
def stg_payments(spark, sf_dir):
    return _stage_text(spark, sf_dir, "payments")


@query
def stg_positions(spark, sf_dir):
    return _stage_text(spark, sf_dir, "vehicle_positions").drop("raw_json")


@query
def stg_positions_json(spark, sf_dir):
    staged = Tables(spark, sf_dir).staged("vehicle_positions")
    return staging.event_attribute(staged, "$.k", "int", "k")


# --- keys ------------------------------------------------------------------------------------------

@query
def dedupe_latest(spark, sf_dir):
    """Two batches of rides: all of them, then corrected fares for the later ones."""
    raw = supplied.rides(spark, sf_dir)
    first = staging.stage(raw, "rides", "20010901000000", "2001-09-01T00:00:00Z")
    fixed = (raw.where(F.col("start_time") >= instant(FACTS_FROM))
             .withColumn("fare_amount", F.col("fare_amount") + 1))
    second = staging.stage(fixed, "rides", "20020101000000", "2002-01-01T00:00:00Z")
    return keys.latest_per_key(first.unionByName(second), ["ride_id"])


@query
def surrogate_keys(spark, sf_dir):
    """User ids with their keys after two loads: early users first, then all others."""
    t = Tables(spark, sf_dir)
    first = t.first_users().select("user_id", "user_sk")
    later = keys.unseen(t.staged("users").select("user_id"), first, "user_id")
    return first.unionByName(
        keys.number_rows(later, "user_id", "user_sk", keys.highest(first, "user_sk")))


# --- dimensions ------------------------------------------------------------------------------------

@query
def dim_user_new(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return dimensions.new_users(t.staged("users"), t.first_users(), LOAD)


@query
def dim_vehicle_new(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return dimensions.new_vehicles(t.staged("vehicles"), t.first_vehicles(), LOAD)


@query
def dim_route_new(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return dimensions.new_routes(t.staged("routes"), t.first_routes(), LOAD)


@query
def dim_user_scd1(spark, sf_dir):
    """Early users, then a batch of all users, in which some changed city."""
    t = Tables(spark, sf_dir)
    moved = F.when(F.col("city") == "MACHINERY", F.lit("BUILDING")).otherwise(F.col("city"))
    return dimensions.overwrite_users(t.first_users(), t.staged("users").withColumn("city", moved), LOAD)


@query
def dim_route_scd2(spark, sf_dir):
    return Tables(spark, sf_dir).merged_routes()


@query
def dim_route_scd2_backdated(spark, sf_dir):
    """A history in which promo routes have closed versions only, then all routes with backdated first versions."""
    t = Tables(spark, sf_dir)
    promo = F.col("vehicle_type") == "PROMO"
    closed = (t.first_routes().withColumn("is_current", ~promo)
              .withColumn("valid_to_dts", F.when(promo, instant(HISTORY_CHANGE)).otherwise(F.col("valid_to_dts"))))
    return history.merge_routes(closed, t.staged("routes"), LOAD, BEFORE_ALL)


def _route_states(t: Tables) -> DataFrame:
    """Four later states of the routes, each a batch: as they are, promo dearer, standard too, promo as before."""
    kind, fare = F.col("vehicle_type"), F.col("base_fare")
    dearer = {1: F.lit(False), 2: kind == "PROMO", 3: kind.isin("PROMO", "STANDARD"), 4: kind == "STANDARD"}
    states = [t.staged("routes").where("route_id % 10 <> 3" if n == 2 else "true")
              .withColumn("batch_id", F.lit(f"b{n}")).withColumn("extract_dts", instant(f"{1996 + n}-01-01T00:00:00Z"))
              .withColumn("base_fare", F.when(changed, fare + 5).otherwise(fare).cast("decimal(10,2)"))
              for n, changed in dearer.items()]
    return reduce(DataFrame.unionByName, states)


@query
def dim_route_scd2_snapshots(spark, sf_dir):
    """The early routes, then four states of the routes merged at once; the second lacks every tenth route."""
    t = Tables(spark, sf_dir)
    return history.merge_snapshots(t.first_routes(), _route_states(t))


@query
def all_event_times(spark, sf_dir):
    return Tables(spark, sf_dir).times()


@query
def dim_date(spark, sf_dir):
    return dimensions.calendar(Tables(spark, sf_dir).times())


@query
def dim_date_new(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return keys.unseen(dimensions.calendar(t.times()), dimensions.calendar(t.early_times()), "date_sk")


@query
def dim_time(spark, sf_dir):
    return dimensions.clock(Tables(spark, sf_dir).times())


@query
def dim_time_new(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return keys.unseen(dimensions.clock(t.times()), dimensions.clock(t.early_times()), "time_sk")


# --- facts -----------------------------------------------------------------------------------------

@query
def fact_ride_current_route(spark, sf_dir):
    return Tables(spark, sf_dir).rides()


@query
def fact_ride_asof_route(spark, sf_dir):
    return Tables(spark, sf_dir).rides_asof()


@query
def fact_ride_asof_ordered(spark, sf_dir):
    """The same rides, with versions found by the order of time instead of a join."""
    t = Tables(spark, sf_dir)
    side_by_side(t.users, t.vehicles, t.route_history)
    rides = facts.ride_facts(t.staged("rides"), t.users(), t.vehicles(), t.route_history(), LOAD, route_lookup="asof_ordered")
    return facts.accepted(rides, "fact_ride")


@query
def fact_ride_bucketed_incremental(spark, sf_dir):
    """The rides that are new beside a bucketed store of the keys of earlier ones."""
    t = Tables(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    store = KeyStore(warehouse, "fact_ride", buckets=8)
    store.add(_keys_before(t.staged("rides"), "ride_id", "start_time", FACTS_FROM))
    return facts.accepted(t.all_rides(store.table()), "fact_ride")


def _keys_before(staged: DataFrame, key: str, at: str, until: str) -> DataFrame:
    """Keys an earlier load had brought; distinct, so that copies of one key do not meet in a join task."""
    return staged.where(F.col(at) < instant(until)).select(key).distinct()


@query
def fact_ride_incremental(spark, sf_dir):
    t = Tables(spark, sf_dir)
    loaded = _keys_before(t.staged("rides"), "ride_id", "start_time", FACTS_FROM)
    return facts.accepted(t.all_rides(loaded), "fact_ride")


@query
def fact_ride_rejects(spark, sf_dir):
    return facts.rejected(Tables(spark, sf_dir).all_rides_asof(), "fact_ride")


def _without_some_ids(payments: DataFrame) -> DataFrame:
    lost = (F.col("payment_method") == "1-URGENT") & (F.col("status") == "P")
    return payments.withColumn("payment_id", F.when(~lost, F.col("payment_id")))


def _without_some_ids_and_times(positions: DataFrame) -> DataFrame:
    k = F.col("passengers_estimated")
    return (positions.withColumn("event_id", F.when(k % 9 != 4, F.col("event_id")))
            .withColumn("event_time", F.when(k % 7 != 3, F.col("event_time"))))


@query
def fact_payment_rejects(spark, sf_dir):
    """Payments after only the early users were loaded; some lost their id."""
    t = Tables(spark, sf_dir)
    found = facts.payment_facts(_without_some_ids(t.staged("payments")), t.first_users(), LOAD)
    return facts.rejected(found, "fact_payment")


@query
def fact_position_rejects(spark, sf_dir):
    """Positions of which some lost their id or their time."""
    t = Tables(spark, sf_dir)
    found = facts.position_facts(_without_some_ids_and_times(t.staged("vehicle_positions")), t.vehicles(), LOAD)
    return facts.rejected(found, "fact_vehicle_position")


@query
def load_reconciliation(spark, sf_dir):
    """Staged keys, loaded rows and rejected rows per fact after two loads of one batch each.

    A row without a key counts as a key of its own. The first batch lacks most users, so its rides and payments
    are rejected until the second brings them. The positions come in both batches.
    """
    raw, t = supplied.raw_tables(spark, sf_dir), Tables(spark, sf_dir)
    # Every batch reads the rides; they are joined once.
    raw["rides"] = t.raw_rides()
    raw["payments"] = _without_some_ids(raw["payments"])
    raw["vehicle_positions"] = _without_some_ids_and_times(raw["vehicle_positions"])
    first, second = dict(raw), dict(raw)
    first["users"] = raw["users"].join(keys.by_rows(t.early_users().select("user_id"), raw["users"].select("user_id")), "user_id", "left_semi")
    for name, at in (("rides", "start_time"), ("payments", "created_at")):
        first[name] = raw[name].where(F.col(at) < instant(FACTS_FROM))
        second[name] = raw[name].where(F.col(at) >= instant(FACTS_FROM))
    root = scratch_path(spark, "warehouse")
    load_all(spark, first, root, "20240131000000", "2024-01-31T00:00:00Z", only_batch=True)
    warehouse = load_all(spark, second, root, BATCH, LOAD, only_batch=True)
    counts = []
    for name, fact in (("rides", "fact_ride"), ("payments", "fact_payment"), ("vehicle_positions", "fact_vehicle_position")):
        key = CORE[fact].key[0]
        staged = warehouse.read(f"stg.{name}").agg(F.expr(f"count(DISTINCT {key}) + count_if({key} IS NULL) AS n"))
        loaded = warehouse.read(fact).agg(F.count("*").alias("n"))
        rejected = warehouse.read(f"{fact}_rejects").agg(F.count("*").alias("n"))
        counts += [rows.select(F.lit(fact).alias("table_name"), F.lit(kind).alias("kind"), "n")
                   for kind, rows in (("staged", staged), ("loaded", loaded), ("rejected", rejected))]
    return reduce(DataFrame.unionByName, counts)


@query
def ledger_load(spark, sf_dir):
    """Batches, loaded and rejected rows per fact after three staged batches went through two loads of what was unloaded.

    The first batch lacks most users, so its rides and payments wait; the second load takes the other two batches.
    """
    raw, t = supplied.raw_tables(spark, sf_dir), Tables(spark, sf_dir)
    # Every batch reads the rides; they are joined once.
    raw["rides"] = t.raw_rides()
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    bounds = ["1900-01-01T00:00:00Z", "1997-01-01T00:00:00Z", FACTS_FROM, "2100-01-01T00:00:00Z"]
    for n, (since, until) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), 1):
        batch = dict(raw)
        for name, at in (("rides", "start_time"), ("payments", "created_at")):
            batch[name] = raw[name].where((F.col(at) >= instant(since)) & (F.col(at) < instant(until)))
        if n == 1:
            batch["users"] = raw["users"].join(keys.by_rows(t.early_users().select("user_id"), raw["users"].select("user_id")), "user_id", "left_semi")
        load_staging(warehouse, batch, f"b{n}", f"2024-02-0{n}T00:00:00Z")
        if n != 2:
            load_core(warehouse, f"b{n}", f"2024-02-0{n}T00:00:00Z", unloaded=True)
    counts = []
    for name, fact in (("rides", "fact_ride"), ("payments", "fact_payment"), ("vehicle_positions", "fact_vehicle_position")):
        for kind, rows in (("batches", warehouse.read("stg.loaded").where(F.col("table_name") == name)),
                           ("loaded", warehouse.read(fact)), ("rejected", warehouse.read(f"{fact}_rejects"))):
            counts.append(rows.agg(F.count("*").alias("n")).select(F.lit(fact).alias("table_name"), F.lit(kind).alias("kind"), "n"))
    return reduce(DataFrame.unionByName, counts)


@query
def rides_by_date_range(spark, sf_dir):
    """Rides of two months out of a written warehouse; the folders of other months are not opened."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.append(Tables(spark, sf_dir).rides(), "fact_ride")
    return warehouse.read("fact_ride", from_date_sk=19970115, to_date_sk=19970314)


@query
def fact_payment(spark, sf_dir):
    return Tables(spark, sf_dir).payments()


@query
def fact_payment_incremental(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.payments(_keys_before(t.staged("payments"), "payment_id", "created_at", FACTS_FROM))


@query
def fact_position(spark, sf_dir):
    return Tables(spark, sf_dir).positions()


@query
def fact_position_incremental(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.positions(_keys_before(t.staged("vehicle_positions"), "event_id", "event_time", EVENTS_FROM))


# --- marts and counts ------------------------------------------------------------------------------

@query
def mart_rides_by_route_hour(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _rounded(marts.rides_by_route_hour(t.rides(), t.routes()))


@query
def mart_rides_by_route_version(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _rounded(marts.rides_by_route_version(t.rides_asof(), t.route_history()))


@query
def mart_incremental(spark, sf_dir):
    """The mart after three loads of rides, the last with a route state that closes versions; kept from partial sums."""
    t = Tables(spark, sf_dir)
    rides, routes = t._store("rides", t.rides), t.routes()
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.replace(routes, "dim_route_scd2")
    bounds = ["1900-01-01T00:00:00Z", "1997-01-01T00:00:00Z", FACTS_FROM, "2100-01-01T00:00:00Z"]
    for n, (since, until) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), 1):
        at = f"2024-02-0{n + 1}T00:00:00Z"
        mart.announce(warehouse, at)
        added = rides.where((F.col("start_time") >= instant(since)) & (F.col("start_time") < instant(until)))
        warehouse.append(added.withColumn("load_dts", instant(at)), "fact_ride")
        if n == 3:
            warehouse.replace(history.merge_routes(routes, t.repriced_routes(), at), "dim_route_scd2")
        mart.refresh(warehouse)
    return _rounded(warehouse.read("dm_rides_by_route_hour"))


@query
def mart_top20(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _rounded(marts.first_rows(marts.rides_by_route_hour(t.rides(), t.routes()), 20))


@query
def movement_by_route_hour(spark, sf_dir):
    positions = Tables(spark, sf_dir).positions()
    return _rounded(marts.movement_by_route_hour(runs.with_exact_speed(positions)))


def _rounded(df: DataFrame) -> DataFrame:
    """Averages at six decimals, the scale of a decimal average."""
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.startswith("avg_")})


@query
def layer_row_counts(spark, sf_dir):
    core = Tables(spark, sf_dir).core()
    mart = marts.rides_by_route_hour(core["fact_ride"], core["dim_route_scd2"])
    return marts.row_counts({**core, "dm_rides_by_route_hour": mart})


# --- integrity -------------------------------------------------------------------------------------

@query
def qa_duplicate_keys(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.duplicate_keys({**t.all_staged(), **t.core()})


@query
def qa_not_null(spark, sf_dir):
    """Required columns of staging and core, with as-of rides as they come out of the lookups."""
    t = Tables(spark, sf_dir)
    return quality.missing_values({**t.all_staged(), **t.core(asof=True)})


@query
def qa_orphans(spark, sf_dir):
    return quality.orphans(Tables(spark, sf_dir).core())


def _broken_history(t: Tables) -> DataFrame:
    """The route history had closing been forgotten."""
    return (t.route_history().withColumn("is_current", F.lit(True))
            .withColumn("valid_to_dts", instant("2100-01-01T00:00:00Z")))


@query
def qa_scd2_current(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.several_current(t.route_history()).unionByName(
        quality.several_current(_broken_history(t), "dim_route_scd2 unclosed"))


@query
def qa_scd2_overlap(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return quality.overlapping_versions(t.route_history()).unionByName(
        quality.overlapping_versions(_broken_history(t), "dim_route_scd2 unclosed"))


# --- streams ---------------------------------------------------------------------------------------

@query
def stream_positions_dedupe(spark, sf_dir):
    return runs.deduplicated(spark, sf_dir)


@query
def stream_fact_position(spark, sf_dir):
    return runs.facts(spark, sf_dir, Tables(spark, sf_dir).vehicles())


@query
def stream_stage_positions(spark, sf_dir):
    return runs.staged(spark, sf_dir, Tables(spark, sf_dir).vehicles())


@query
def stream_late_events(spark, sf_dir):
    """What became of the events of each micro-batch, four files out of order and with repeats."""
    warehouse = runs.accounted(spark, sf_dir, Tables(spark, sf_dir).vehicles())
    return warehouse.read("stg.stream_account").drop("batch_id")


@query
def stream_two_sources_reconciliation(spark, sf_dir):
    """Staged, loaded and rejected events of two streams, each with its own checkpoint; some events lost id or time."""
    warehouse = runs.two_sources(spark, sf_dir, Tables(spark, sf_dir).vehicles(), _without_some_ids_and_times)
    name = "fact_vehicle_position"
    counts = [warehouse.read(table).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
              for kind, table in (("staged", "stg.vehicle_positions"), ("loaded", name), ("rejected", f"{name}_rejects"))]
    return reduce(DataFrame.unionByName, counts)


@query
def stream_movement_by_route_hour(spark, sf_dir):
    return _rounded(runs.movement(spark, sf_dir, Tables(spark, sf_dir).vehicles()))


# --- the whole load --------------------------------------------------------------------------------

@query
def warehouse_load(spark, sf_dir):
    """Raw tables to mart through written layers; the mart as read back."""
    raw = supplied.raw_tables(spark, sf_dir)
    warehouse = load_all(spark, raw, scratch_path(spark, "warehouse"), BATCH, LOAD)
    return _rounded(warehouse.read("dm_rides_by_route_hour"))
