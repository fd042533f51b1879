"""Transit-shaped Bronze tables derived from the benchmark tables.

The benchmark data is TPC-H-like; these views re-read it as a transit feed so
every operator runs over whole tables whose size grows with the scale factor:

    agency           <- nation      routes      <- supplier
    stops            <- part        trips       <- orders
    stop_times       <- lineitem    trip updates <- lineitem
    vehicle positions <- events

All derivations use integer arithmetic and string concatenation only, so an
independent SQL engine can reproduce them exactly (see plans.oracle).
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrovia.operators import dims, facts, gold
from ferrovia.session import delete_path, scratch_dir
from ferrovia.sources.lake import materialize

# FIXED VALUES of the derivation (test-data design, not business rules).
AS_OF = _dt.date(2025, 2, 15)           # dimension calendar covers 2024-11-17 .. 2025-03-17
FIRST_DAY = _dt.datetime(2025, 1, 15)   # realtime days: FIRST_DAY + 0..59
N_DAYS = 60
AGENCY_PREFIXES = [
    "Dublin Bus", "Bus Éireann", "Iarnród Éireann", "LUAS", "Go-Ahead Ireland",
    "Transport for Ireland", "Bus Átha Cliath – Dublin Bus", "Coach express",
]
N_TRIP_ROUTES = 120                     # trips use routes R0..R119
N_VEHICLES = 50


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(prefix: str, c) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def _pick(idx: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
    return expr


def bronze_agency(spark, sf_dir) -> DataFrame:
    n = F.col("n_nationkey")
    return read_table(spark, sf_dir, "nation").select(
        F.when(n % 9 != 4, _s("A", n)).alias("agency_id"),
        F.concat(_pick(n % 8, AGENCY_PREFIXES), F.lit(" "), F.col("n_name")).alias("agency_name"),
        F.concat(F.lit("https://operator"), n.cast("string"), F.lit(".example.ie")).alias("agency_url"),
        F.lit("Europe/Dublin").alias("agency_timezone"),
        F.lit(None).cast("string").alias("agency_lang"),
    )


def bronze_routes(spark, sf_dir) -> DataFrame:
    s = F.col("s_suppkey")
    name = F.col("s_name")
    long_name = (F.when(s % 13 == 6, F.lit(None))
                 .when(s % 5 == 0, F.concat(F.lit("City Centre - "), name))
                 .when(s % 5 == 1, F.concat(F.lit("Cross City "), name))
                 .when(s % 5 == 2, F.concat(name, F.lit(" Commuter")))
                 .when(s % 5 == 3, F.concat(name, F.lit(" express")))
                 .otherwise(F.concat(name, F.lit(" Local"))))
    return read_table(spark, sf_dir, "supplier").select(
        _s("R", s).alias("route_id"),
        F.when(s % 17 != 0, _s("A", "s_nationkey")).alias("agency_id"),
        F.concat(s.cast("string"), _pick(s % 3, ["", "A", "X"])).alias("route_short_name"),
        long_name.alias("route_long_name"),
        F.when(s % 11 != 0, s % 6).cast("int").alias("route_type"),
        _pick(s % 3, ["00A3E0", "E4002B", None]).alias("route_color"),
        F.lit("FFFFFF").alias("route_text_color"),
        F.lit(None).cast("string").alias("route_desc"),
    )


def bronze_stops(spark, sf_dir) -> DataFrame:
    p = F.col("p_partkey")
    no_coord = p % 97 == 0
    lat = (F.lit(51800) + (p * 37) % 1800).cast("double") / 1000
    lon = (F.lit(-9200) + (p * 53) % 3200).cast("double") / 1000
    return read_table(spark, sf_dir, "part").select(
        _s("S", p).alias("stop_id"),
        F.col("p_name").alias("stop_name"),
        p.cast("string").alias("stop_code"),
        F.when(~no_coord, lat).alias("stop_lat"),
        F.when(~no_coord, lon).alias("stop_lon"),
        _s("Z", p % 5).alias("zone_id"),
        F.when(p % 10 == 0, _s("P", F.expr("p_partkey div 10"))).alias("parent_station"),
        F.when(p % 10 == 0, 1).when(p % 7 == 0, None).otherwise(0).cast("int").alias("location_type"),
        (p % 3).cast("int").alias("wheelchair_boarding"),
    )


def bronze_trips(spark, sf_dir) -> DataFrame:
    o = F.col("o_orderkey")
    return read_table(spark, sf_dir, "orders").select(
        _s("R", F.col("o_custkey") % N_TRIP_ROUTES).alias("route_id"),
        _s("SVC", o % 7).alias("service_id"),
        _s("T", o).alias("trip_id"),
        F.col("o_orderpriority").alias("trip_headsign"),
        (o % 2).cast("int").alias("direction_id"),
        _s("SH", F.col("o_custkey") % N_TRIP_ROUTES).alias("shape_id"),
        F.lit(None).cast("string").alias("block_id"),
    )


def _hhmm(minute: Column, pad_hour: bool = True) -> Column:
    h = F.floor(minute / 60).cast("string")
    hh = F.lpad(h, 2, "0") if pad_hour else h
    return F.concat(hh, F.lit(":"), F.lpad((minute % 60).cast("string"), 2, "0"), F.lit(":00"))


def bronze_stop_times(spark, sf_dir) -> DataFrame:
    k = F.col("l_orderkey")
    m = (k * 7 + F.col("l_linenumber") * 13) % 1560
    dep = (F.when(k % 53 == 0, F.lit(None))
           .when(k % 59 == 0, _hhmm(m, pad_hour=False))
           .when(k % 61 == 0, F.lit("12:3 "))
           .otherwise(_hhmm(m)))
    return read_table(spark, sf_dir, "lineitem").select(
        _s("T", k).alias("trip_id"),
        _hhmm(m).alias("arrival_time"),
        dep.alias("departure_time"),
        _s("S", "l_partkey").alias("stop_id"),
        F.col("l_linenumber").cast("int").alias("stop_sequence"),
        (F.col("l_linenumber") % 2).cast("int").alias("pickup_type"),
        F.lit(0).alias("drop_off_type"),
        F.col("l_quantity").alias("shape_dist_traveled"),
        F.when(k % 5 != 0, F.col("l_linenumber") % 2).cast("int").alias("timepoint"),
    )


class _Snapshot:
    """Snapshot instant FIRST_DAY + days + hours + minutes (UTC), with its
    stamp strings built from a date cast and zero-padded integers (no
    per-row timestamp formatter)."""

    def __init__(self, day_idx: Column, hour: Column, minute: Column):
        self.day = F.date_add(F.lit(FIRST_DAY.date()), day_idx.cast("int")).cast("string")   # yyyy-MM-dd
        self.hh = F.lpad(hour.cast("string"), 2, "0")
        self.mi = F.lpad(minute.cast("string"), 2, "0")
        first = int(FIRST_DAY.replace(tzinfo=_dt.timezone.utc).timestamp())
        self.epoch = F.lit(first) + day_idx * 86400 + hour * 3600 + minute * 60
        self.compact_day = F.regexp_replace(self.day, "-", "")

    def stamp(self, key: Column) -> Column:
        """Compact stamp for even keys, ISO for odd keys, junk when key % 97 == 5."""
        compact = F.concat(self.compact_day, F.lit("T"), self.hh, self.mi, F.lit("00Z"))
        iso = F.concat(self.day, F.lit("T"), self.hh, F.lit(":"), self.mi, F.lit(":00Z"))
        return F.when(key % 97 == 5, F.lit("ts")).when(key % 2 == 0, compact).otherwise(iso)


def bronze_trip_updates(spark, sf_dir) -> DataFrame:
    """Flattened trip updates (18 columns), one per lineitem."""
    k = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    snap = _Snapshot(k % N_DAYS, F.col("l_partkey") % 24, ((k * 3 + F.col("l_suppkey")) % 12) * 5)
    arr = F.when(ln != 7, F.col("l_quantity").cast("int") * 30 - 150)
    dep = F.when(ln != 7, F.col("l_quantity").cast("int") * 30 - 150 + (ln % 3) * 20)
    epoch = snap.epoch
    return read_table(spark, sf_dir, "lineitem").select(
        snap.stamp(k).alias("fetched_at"),
        _s("E", k).alias("entity_id"),
        _s("T", k).alias("trip_id"),
        F.when(F.col("l_suppkey") % 23 == 7, F.lit("")).otherwise(_s("R", "l_suppkey")).alias("route_id"),
        (k % 2).cast("int").alias("direction_id"),
        snap.compact_day.alias("start_date"),
        F.concat(snap.hh, F.lit(":00:00")).alias("start_time"),
        F.when(k % 9 == 0, "ADDED").otherwise("SCHEDULED").alias("schedule_relationship"),
        _s("V", k % 40).alias("vehicle_id"),
        F.when(F.col("l_partkey") % 89 == 0, F.lit("")).otherwise(_s("S", "l_partkey")).alias("stop_id"),
        ln.cast("int").alias("stop_sequence"),
        arr.cast("int").alias("arrival_delay_secs"),
        F.when(ln != 7, epoch + arr).alias("arrival_time_unix"),
        F.when(ln != 7, F.lit(0)).alias("arrival_uncertainty"),
        dep.cast("int").alias("departure_delay_secs"),
        (epoch + F.coalesce(dep, F.lit(0))).alias("departure_time_unix"),
        F.lit(0).alias("departure_uncertainty"),
        F.lit("SCHEDULED").alias("stu_schedule_rel"),
    )


def bronze_vehicle_positions(spark, sf_dir) -> DataFrame:
    """Flattened vehicle positions (18 columns), one per event."""
    e = F.col("event_id")
    u = F.col("user_id")
    snap = _Snapshot(e % N_DAYS, (e * 7) % 24, (e % 12) * 5)
    speed = (F.when(F.col("event_type") == "error", F.lit(None))
             .when(F.col("event_type") == "signup", F.lit(0.0))
             .otherwise(F.col("value") / 7))
    return read_table(spark, sf_dir, "events").select(
        snap.stamp(e).alias("fetched_at"),
        _s("VE", e).alias("entity_id"),
        F.when(u % N_VEHICLES == N_VEHICLES - 1, F.lit("")).otherwise(_s("V", u % N_VEHICLES)).alias("vehicle_id"),
        _s("Bus ", u % N_VEHICLES).alias("vehicle_label"),
        _s("T", u).alias("trip_id"),
        _s("R", u % 100).alias("route_id"),
        (u % 2).cast("int").alias("direction_id"),
        snap.compact_day.alias("start_date"),
        ((F.lit(53000) + (e * 37) % 800).cast("double") / 1000).alias("latitude"),
        ((F.lit(-6600) + (e * 53) % 700).cast("double") / 1000).alias("longitude"),
        ((e * 11) % 360).cast("double").alias("bearing"),
        speed.cast("double").alias("speed_mps"),
        (e % 30).cast("int").alias("current_stop_seq"),
        _s("S", (e * 7) % 2000).alias("current_stop_id"),
        F.lit("IN_TRANSIT_TO").alias("current_status"),
        snap.epoch.alias("timestamp_unix"),
        F.lit("UNKNOWN_CONGESTION_LEVEL").alias("congestion_level"),
        F.lit("").alias("occupancy_status"),
    )


def trip_update_docs(spark, sf_dir) -> DataFrame:
    """Trip updates as landed JSON lines (fetched_at, value)."""
    from ferrovia.operators.flatten import trip_update_documents
    return trip_update_documents(bronze_trip_updates(spark, sf_dir))


def vehicle_position_docs(spark, sf_dir) -> DataFrame:
    """Vehicle positions as landed JSON lines; every 30th stop sequence
    (7 mod 30) arrives without its vehicle part."""
    from ferrovia.operators.flatten import vehicle_position_documents
    return vehicle_position_documents(bronze_vehicle_positions(spark, sf_dir),
                                      with_vehicle=F.col("current_stop_seq") != 7)


def bronze_feeds(spark, sf_dir) -> dict[str, DataFrame]:
    """Every Bronze feed of the transit views, by feed name."""
    return {
        "agency": bronze_agency(spark, sf_dir), "routes": bronze_routes(spark, sf_dir),
        "stops": bronze_stops(spark, sf_dir), "trips": bronze_trips(spark, sf_dir),
        "stop_times": bronze_stop_times(spark, sf_dir),
        "trip_updates": bronze_trip_updates(spark, sf_dir),
        "vehicle_positions": bronze_vehicle_positions(spark, sf_dir),
    }


# ---------------------------------------------------------------------------
# Silver and Gold over the derived Bronze


class TransitViews:
    """Silver inputs over one benchmark directory, built lazily on first use.

    Attributes are plans, not data: nothing here executes until a query runs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=AS_OF, persist: str | None = "cache"):
        self.spark, self.sf_dir, self.as_of, self.persist = spark, sf_dir, as_of, persist
        self._kept: list[DataFrame] = []
        self._landed: list[str] = []
        self.streamed_lake: str | None = None
        self.poisoned_lake: str | None = None

    def scratch(self, name: str) -> str:
        """A scratch folder that goes with these views."""
        self._landed.append(scratch_dir(self.spark, name))
        return self._landed[-1]

    def release(self) -> None:
        """Unpersist what is kept and delete the landed documents and scratch lakes."""
        for df in self._kept:
            df.unpersist()
        for path in self._landed:
            delete_path(self.spark, path)
        self._kept, self._landed, self.streamed_lake, self.poisoned_lake = [], [], None, None

    def _silver(self, df: DataFrame, name: str, partition_by=None) -> DataFrame:
        """A Silver fact, as every Gold query reads it.

        ``persist='cache'``: each query computes the columns it needs from the short
        scan lineage, and those that run after ``build_silver``, or that cut a fact
        (``kept_facts``), read what is kept;
        ``persist='table'``: written as a Parquet table, partitioned by day,
        to the shared checkpoint folder and scanned back;
        ``persist=None``: recomputed by each query.
        """
        if self.persist == "table":
            return materialize(df, f"silver-{name}", partition_by)
        return df

    def build_silver(self) -> None:
        """Fill the three Silver facts now: kept with MEMORY_AND_DISK, for a session of
        many queries (a lost executor recomputes its blocks from the lineage)."""
        for df in (self.sched, self.delays, self.positions):
            self._keep(df).write.format("noop").mode("overwrite").save()

    @cached_property
    def kept_facts(self) -> list[DataFrame]:
        """Both realtime facts, kept for a query that reads parts of them: a cut by day
        and hour would parse the stamp anew in each of its conditions."""
        return [self._keep(df) for df in (self.delays, self.positions)]

    @cached_property
    def _schedule_counts(self) -> list[DataFrame]:
        """Scheduled trips per route and departures per hour, kept: a query that derives
        a Gold table twice finds them, so the schedule is joined once."""
        return [self._keep(count(self.sched)) for count in (gold.schedule_by_route, gold.schedule_by_hour)]

    @cached_property
    def bronze_routes(self):
        return bronze_routes(self.spark, self.sf_dir)

    @cached_property
    def dim_agency(self):
        return dims.build_dim_agency(bronze_agency(self.spark, self.sf_dir))

    @cached_property
    def dim_route(self):
        return dims.build_dim_route(self.bronze_routes)

    @cached_property
    def dim_stop(self):
        return dims.build_dim_stop(bronze_stops(self.spark, self.sf_dir))

    @cached_property
    def dim_date(self):
        return dims.build_dim_date(self.spark, self.as_of)

    @cached_property
    def dim_tod(self):
        return dims.build_dim_time_of_day(self.spark)

    @cached_property
    def sched(self):
        return self._silver(facts.build_scheduled_departures(
            bronze_stop_times(self.spark, self.sf_dir), bronze_trips(self.spark, self.sf_dir),
            self.bronze_routes, self.as_of), "fact_scheduled_departures")

    @cached_property
    def bronze_trip_updates(self):
        return bronze_trip_updates(self.spark, self.sf_dir)

    @cached_property
    def bronze_vehicle_positions(self):
        return bronze_vehicle_positions(self.spark, self.sf_dir)

    @cached_property
    def delays(self):
        return self._silver(facts.build_realtime_delays(self.bronze_trip_updates),
                            "fact_realtime_delays", "fetched_date_key")

    @cached_property
    def positions(self):
        return self._silver(facts.build_vehicle_positions(self.bronze_vehicle_positions),
                            "fact_vehicle_positions", "fetched_date_key")

    # Landed realtime documents (JSON lines), shared by the streaming queries
    # of a session; each stream keeps its own checkpoint and output.

    @cached_property
    def trip_update_landing(self) -> str:
        from ferrovia.operators.flatten import trip_update_documents
        from ferrovia.sources.realtime import land_documents
        path = scratch_dir(self.spark, "landing-trip-updates")
        # as many files as the data needs: no fixed width, a bounded number of
        # documents per file
        land_documents(trip_update_documents(bronze_trip_updates(self.spark, self.sf_dir)), path)
        self._landed.append(path)
        return path

    @cached_property
    def vehicle_position_landing(self) -> str:
        from ferrovia.sources.realtime import land_documents
        path = scratch_dir(self.spark, "landing-vehicle-positions")
        land_documents(vehicle_position_docs(self.spark, self.sf_dir), path)
        self._landed.append(path)
        return path

    # Gold: the default aggregates are shared like stored Gold tables (views
    # read them); variants with substituted inputs are computed fresh.

    def _keep(self, df: DataFrame) -> DataFrame:
        if self.persist != "cache":
            return df
        self._kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    @cached_property
    def _route_daily(self):
        return self._keep(gold.route_daily_performance(self.delays, self.dim_route, self.dim_agency,
                                                       self.sched, self.positions))

    def route_daily(self, delays=None, positions=None):
        if delays is None and positions is None:
            return self._route_daily
        _ = self._schedule_counts
        return gold.route_daily_performance(delays or self.delays, self.dim_route, self.dim_agency,
                                            self.sched, positions or self.positions)

    @cached_property
    def _hotspots(self):
        return self._keep(gold.stop_delay_hotspot(self.delays, self.dim_stop))

    def hotspots(self, delays=None):
        return self._hotspots if delays is None else gold.stop_delay_hotspot(delays, self.dim_stop)

    @cached_property
    def _hourly(self):
        return self._keep(gold.hourly_network_pattern(self.delays, self.dim_tod, self.dim_date,
                                                      self.sched, self.positions))

    def hourly(self, delays=None, positions=None):
        if delays is None and positions is None:
            return self._hourly
        _ = self._schedule_counts
        return gold.hourly_network_pattern(delays or self.delays, self.dim_tod, self.dim_date,
                                           self.sched, positions or self.positions)

    @cached_property
    def _scorecard(self):
        return self._keep(gold.operator_weekly_scorecard(self.delays, self.dim_route,
                                                         self.dim_agency, self.dim_date))

    def scorecard(self, delays=None):
        if delays is None:
            return self._scorecard
        return gold.operator_weekly_scorecard(delays, self.dim_route, self.dim_agency, self.dim_date)

    @cached_property
    def _trend(self):
        return self._keep(gold.delay_trend_daily(self.delays, self.dim_date, "calendar"))

    def trend(self, mode="calendar", delays=None):
        if mode == "calendar" and delays is None:
            return self._trend
        return gold.delay_trend_daily(self.delays if delays is None else delays, self.dim_date, mode)

    def type_summary(self):
        return gold.route_type_summary(self.delays, self.dim_route, self.positions)


_VIEWS: dict = {}


def views_for(spark: SparkSession, sf_dir: str) -> TransitViews:
    """Shared lazily-built views of the latest (session, directory); those of an
    earlier one are released first, so at most one set is kept."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _VIEWS:
        for (app, _), views in _VIEWS.items():
            if app == spark.sparkContext.applicationId:
                views.release()
        _VIEWS.clear()
        _VIEWS[key] = TransitViews(spark, sf_dir)
    return _VIEWS[key]
