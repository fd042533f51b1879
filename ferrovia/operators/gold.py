"""Gold aggregates over the Silver facts.

Plan shape shared by every aggregate here:

1. project the fact to the few columns needed (pruned at the Parquet scan);
2. aggregate on the grouping key into *integer partial sums* — Spark computes
   them map-side (partial HashAggregate) so a hot key costs one row per map
   task in the shuffle, never a whole group in one task;
3. attach dimension attributes to the (small) aggregate afterwards, instead of
   carrying wide dimension columns through the fact shuffle;
4. finish with one exact decimal division per metric (see functions.metrics).

Dimension joins are plain equi-joins: the planner broadcasts a side only when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE
re-checks this on the actual shuffle output), otherwise it falls back to a
sort-merge / shuffled-hash join, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrovia.functions import classify as C
from ferrovia.functions import metrics as M
from ferrovia.functions import timeparse as T

BAND = "delay_band"
BANDS = ("On-Time", "Minor", "Moderate", "Severe")


# ---------------------------------------------------------------------------
# partial aggregates

def _delay_partials(bands=("On-Time",), with_departure=False, with_max=False) -> list[Column]:
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.sum("arrival_delay_secs").alias("arr_sum"),
        F.count("arrival_delay_secs").alias("arr_n"),
    ]
    if with_departure:
        aggs += [F.sum("departure_delay_secs").alias("dep_sum"),
                 F.count("departure_delay_secs").alias("dep_n")]
    if with_max:
        aggs.append(F.max("arrival_delay_secs").alias("arr_max"))
    for b in bands:
        aggs.append(F.count_if(F.col(BAND) == b).alias(_band_col(b)))
    return aggs


def _band_col(band: str) -> str:
    return "k_" + band.lower().replace("-", "_")


def _merge_partials(cols) -> list[Column]:
    """Re-aggregate partial sums/counts at a coarser grain."""
    return [F.sum(c).alias(c) for c in cols]


def moving_vehicle_stats(positions: DataFrame, keys: list[str],
                         approx_rsd: float | None = None) -> DataFrame:
    """Distinct moving vehicles and average km/h (per-row rounded) per key.

    Only positions with a known, positive speed count.  ``approx_rsd``
    switches the distinct count to a HyperLogLog++ estimate.
    """
    kmh = M.speed_kmh("speed_mps")
    return (positions
            .where(F.col("speed_mps").isNotNull() & (F.col("speed_mps") > 0))
            .groupBy(*keys)
            .agg(M.distinct_count("vehicle_id", approx_rsd).alias("active_vehicles"),
                 M.kmh_from_sums(F.sum(kmh), F.count(kmh)).alias("avg_speed_kmh")))


def moving_cells(positions: DataFrame, keys: list[str]) -> DataFrame:
    """Positions with a known, positive speed as km/h sums per day and ``keys``."""
    kmh = M.speed_kmh("speed_mps")
    return (positions.where(F.col("speed_mps").isNotNull() & (F.col("speed_mps") > 0))
            .groupBy("fetched_date_key", *keys)
            .agg(F.sum(kmh).alias("kmh_sum"), F.count(kmh).alias("kmh_n")))


def schedule_by_route(sched: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    return sched.groupBy("route_id").agg(
        M.distinct_count("trip_id", approx_rsd).alias("total_scheduled_trips"),
        F.count("stop_id").alias("total_scheduled_stops"))


def schedule_by_hour(sched: DataFrame) -> DataFrame:
    return sched.groupBy("departure_hour").agg(F.count(F.lit(1)).alias("scheduled_departures"))


# ---------------------------------------------------------------------------
# A1

ROUTE_DAILY_COLUMNS = [
    "date_key", "route_id", "route_short_name", "route_long_name", "agency_name",
    "route_type_desc", "total_scheduled_trips", "total_scheduled_stops",
    "total_delay_observations", "avg_arrival_delay_mins", "avg_departure_delay_mins",
    "pct_on_time", "pct_minor_delay", "pct_moderate_delay", "pct_severe_delay",
    "max_delay_mins", "active_vehicles", "avg_speed_kmh",
]


def route_daily_performance(delays: DataFrame, dim_route: DataFrame, dim_agency: DataFrame,
                            sched: DataFrame, positions: DataFrame,
                            approx_rsd: float | None = None) -> DataFrame:
    """One row per (day, known route): volumes, delay averages, band shares,
    worst delay, scheduled volume and moving-vehicle activity.

    Early and Unknown observations count in the denominator of the four band
    percentages but in none of the numerators.  Distinct counts are exact
    unless ``approx_rsd`` asks for HyperLogLog++ estimates.
    """
    part = (delays.groupBy(F.col("fetched_date_key").alias("date_key"), "route_id")
            .agg(*_delay_partials(BANDS, with_departure=True, with_max=True)))
    vp = (moving_vehicle_stats(positions, ["route_id", "fetched_date_key"], approx_rsd)
          .withColumnRenamed("fetched_date_key", "date_key"))
    return route_daily_from(part, dim_route, dim_agency, schedule_by_route(sched, approx_rsd), vp)


def route_daily_from(part: DataFrame, dim_route: DataFrame, dim_agency: DataFrame, by_route: DataFrame,
                     vp: DataFrame) -> DataFrame:
    """:func:`route_daily_performance` from partial sums per (date_key, route_id),
    schedule counts per route and vehicle figures per (route_id, date_key)."""
    routes = dim_route.select("route_id", "agency_id", "route_short_name",
                              "route_long_name", "route_type_desc")
    agencies = dim_agency.select("agency_id", "agency_name")
    out = (part.join(routes, "route_id")
           .join(agencies, "agency_id", "left")
           .join(by_route, "route_id", "left")
           .join(vp, ["route_id", "date_key"], "left"))
    return out.select(
        "date_key", "route_id", "route_short_name", "route_long_name", "agency_name",
        "route_type_desc", "total_scheduled_trips", "total_scheduled_stops",
        F.col("n").alias("total_delay_observations"),
        M.minutes_from_sums("arr_sum", "arr_n").alias("avg_arrival_delay_mins"),
        M.minutes_from_sums("dep_sum", "dep_n").alias("avg_departure_delay_mins"),
        M.pct_from_counts(_band_col("On-Time"), "n").alias("pct_on_time"),
        M.pct_from_counts(_band_col("Minor"), "n").alias("pct_minor_delay"),
        M.pct_from_counts(_band_col("Moderate"), "n").alias("pct_moderate_delay"),
        M.pct_from_counts(_band_col("Severe"), "n").alias("pct_severe_delay"),
        M.minutes("arr_max").alias("max_delay_mins"),
        "active_vehicles", "avg_speed_kmh",
    )


# ---------------------------------------------------------------------------
# A2

def _exact_avg(sum_col: str, n_col: str) -> Column:
    """Exact average as a wide decimal (ordering key only; NULL when n = 0)."""
    return F.col(sum_col).cast("decimal(20,0)") / F.when(F.col(n_col) != 0, F.col(n_col).cast("decimal(20,0)"))


def stop_delay_hotspot(delays: DataFrame, dim_stop: DataFrame) -> DataFrame:
    """Per (stop, day): volume, average delay, % on time and the route with
    the highest average arrival delay at that stop that day.

    Two-level aggregation: (day, stop, route) partials first, then (day, stop)
    sums plus an ``min(struct(...))`` arg-max for the worst route — one pass
    over the fact, no second scan (Spark sorts each task's groups for the struct minimum).  Ties on the average
    go to the smallest route_id; routes whose delays are all unknown rank last.
    """
    lvl1 = (delays.groupBy(F.col("fetched_date_key").alias("date_key"), "stop_id", "route_id")
            .agg(*_delay_partials()))
    return hotspots_from(lvl1, dim_stop)


def hotspots_from(lvl1: DataFrame, dim_stop: DataFrame) -> DataFrame:
    """:func:`stop_delay_hotspot` from partial sums per (date_key, stop_id, route_id)."""
    avg = _exact_avg("arr_sum", "arr_n")
    rank_key = F.struct(avg.isNull().alias("no_avg"), (-avg).alias("neg_avg"),
                        F.col("route_id").alias("route_id"))
    lvl2 = (lvl1.groupBy("date_key", "stop_id")
            .agg(*_merge_partials(["n", "arr_sum", "arr_n", _band_col("On-Time")]),
                 F.min(rank_key).alias("worst")))
    stops = dim_stop.select("stop_id", "stop_name", "stop_lat", "stop_lon", "county",
                            "is_city_centre")
    return lvl2.join(stops, "stop_id").select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "county", "is_city_centre",
        "date_key",
        F.col("n").alias("total_observations"),
        M.minutes_from_sums("arr_sum", "arr_n").alias("avg_arrival_delay_mins"),
        M.pct_from_counts(_band_col("On-Time"), "n").alias("pct_on_time"),
        F.col("worst.route_id").alias("worst_route"),
    )


# ---------------------------------------------------------------------------
# A3

def hourly_network_pattern(delays: DataFrame, dim_tod: DataFrame, dim_date: DataFrame,
                           sched: DataFrame, positions: DataFrame,
                           approx_rsd: float | None = None) -> DataFrame:
    part = (delays.groupBy(F.col("fetched_date_key").alias("date_key"),
                           F.col("fetched_hour").alias("hour_of_day"))
            .agg(*_delay_partials()))
    vp = (moving_vehicle_stats(positions, ["fetched_date_key", "fetched_hour"], approx_rsd)
          .withColumnRenamed("fetched_date_key", "date_key")
          .withColumnRenamed("fetched_hour", "hour_of_day"))
    return hourly_from(part, dim_tod, dim_date, schedule_by_hour(sched), vp)


def hourly_from(part: DataFrame, dim_tod: DataFrame, dim_date: DataFrame, by_hour: DataFrame,
                vp: DataFrame) -> DataFrame:
    """:func:`hourly_network_pattern` from partial sums per (date_key, hour_of_day),
    schedule counts per departure hour and vehicle figures per (date_key, hour_of_day)."""
    tod = dim_tod.where(F.col("minute") == 0).select(
        F.col("hour").alias("hour_of_day"), F.col("period").alias("time_period"))
    dates = dim_date.select("date_key", "day_name", "is_weekend")
    sh = by_hour.withColumnRenamed("departure_hour", "hour_of_day")
    out = (part.join(tod, "hour_of_day", "left")
           .join(dates, "date_key", "left")
           .join(sh, "hour_of_day", "left")
           .join(vp, ["date_key", "hour_of_day"], "left"))
    return out.select(
        "date_key", "hour_of_day", "time_period", "day_name", "is_weekend",
        "scheduled_departures",
        F.col("n").alias("delay_observations"),
        M.minutes_from_sums("arr_sum", "arr_n").alias("avg_delay_mins"),
        M.pct_from_counts(_band_col("On-Time"), "n").alias("pct_on_time"),
        "active_vehicles", "avg_speed_kmh",
    )


# ---------------------------------------------------------------------------
# A4

def operator_weekly_scorecard(delays: DataFrame, dim_route: DataFrame, dim_agency: DataFrame,
                              dim_date: DataFrame) -> DataFrame:
    """Per Sunday-start week and operator: routes observed, volume, delay,
    % on time / severe, reliability score and band (band on % on time)."""
    part = (delays.groupBy(F.col("fetched_date_key").alias("date_key"), "route_id")
            .agg(*_delay_partials(("On-Time", "Severe"))))
    return scorecard_from(part, dim_route, dim_agency, dim_date)


def scorecard_from(part: DataFrame, dim_route: DataFrame, dim_agency: DataFrame, dim_date: DataFrame) -> DataFrame:
    """:func:`operator_weekly_scorecard` from partial sums per (date_key, route_id)."""
    routes = dim_route.select("route_id", "agency_id")
    agencies = dim_agency.select("agency_id", "agency_name", "operator_type")
    ws = T.week_start_sunday("full_date")
    days = dim_date.select("date_key", ws.alias("week_start_date"))
    sums = ["n", "arr_sum", "arr_n", _band_col("On-Time"), _band_col("Severe")]
    wk = (part.join(routes, "route_id").join(agencies, "agency_id").join(days, "date_key")
          .groupBy("week_start_date", "agency_name", "operator_type")
          .agg(F.count_distinct("route_id").alias("route_count"), *_merge_partials(sums)))
    pct_on = M.pct_from_counts(_band_col("On-Time"), "n")
    pct_sev = M.pct_from_counts(_band_col("Severe"), "n")
    return (wk.select(
        "week_start_date", T.week_label("week_start_date").alias("week_label"),
        "agency_name", "operator_type", "route_count",
        F.col("n").alias("total_delay_obs"),
        M.minutes_from_sums("arr_sum", "arr_n").alias("avg_delay_mins"),
        pct_on.alias("pct_on_time"), pct_sev.alias("pct_severe_delay"))
        .withColumn("reliability_score", C.reliability_score("pct_on_time", "pct_severe_delay"))
        .withColumn("reliability_band", C.tier("pct_on_time")))


# ---------------------------------------------------------------------------
# A5 + W5

def daily_delay_sums(delays: DataFrame) -> DataFrame:
    return (delays.groupBy(F.col("fetched_date_key").alias("date_key"))
            .agg(*_delay_partials()))


def rolling_sums(daily: DataFrame, cols: list[str], days: int = 7, mode: str = "calendar") -> DataFrame:
    """Sums of ``cols`` over the ``days``-day frame ending on each day present.

    Each daily row is exploded onto the days whose frame contains it (itself
    and the next ``days - 1``), then summed per target day — an equi-grouping
    that stays distributed (no ordered window over a single partition, no
    range join).  ``mode='calendar'`` steps calendar days; ``mode='date_key'``
    steps the integer key (so frames lose days across a month start).
    """
    if mode == "calendar":
        target = T.date_key(F.date_add(T.date_from_key("date_key"), F.col("_i")))
    elif mode == "date_key":
        target = F.col("date_key") + F.col("_i")
    else:
        raise ValueError(f"unknown rolling mode {mode!r}")
    spread = daily.select(F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("_i"), "date_key", *cols)
    sums = (spread.select(target.cast("int").alias("date_key"), *cols)
            .groupBy("date_key").agg(*[F.sum(c).alias(f"r_{c}") for c in cols]))
    return sums.join(daily.select("date_key"), "date_key")


def delay_trend_daily(delays: DataFrame, dim_date: DataFrame, mode: str = "calendar") -> DataFrame:
    """Daily trend with observation-weighted rolling 7-day delay and % on time.

    The rolling frame works on *daily sums* (one row per day), never on raw
    fact rows (see ``rolling_sums``).  ``mode='calendar'`` frames the 7
    calendar days ending on the day; ``mode='date_key'`` frames
    ``date_key - 6 .. date_key`` on the integer key, for parity with older
    outputs.  Days missing from the date dimension still feed their
    neighbours' frames.
    """
    return trend_from(daily_delay_sums(delays), dim_date, mode)


def trend_from(daily: DataFrame, dim_date: DataFrame, mode: str = "calendar") -> DataFrame:
    """:func:`delay_trend_daily` from partial sums per date_key."""
    on_time = _band_col("On-Time")
    roll = rolling_sums(daily, ["n", "arr_sum", "arr_n", on_time], 7, mode)
    dates = dim_date.select("date_key", "full_date", "day_name", "is_weekend")
    return daily.join(roll, "date_key").join(dates, "date_key").select(
        "date_key", "full_date", "day_name", "is_weekend",
        F.col("n").alias("total_observations"),
        M.minutes_from_sums("arr_sum", "arr_n").alias("avg_delay_mins"),
        M.pct_from_counts(on_time, "n").alias("pct_on_time"),
        M.minutes_from_sums("r_arr_sum", "r_arr_n").alias("rolling_7d_avg_delay"),
        M.pct_from_counts(f"r_{on_time}", "r_n").alias("rolling_7d_pct_on_time"),
    )


# ---------------------------------------------------------------------------
# A6

def route_type_summary(delays: DataFrame, dim_route: DataFrame, positions: DataFrame) -> DataFrame:
    """Per (day, route type): distinct routes and trips observed, volume,
    average delay, % on time, distinct moving vehicles and their average speed.

    Each distinct count gets its own aggregate (no multi-distinct Expand):
    routes from the (day, route) partials, trips from a (day, type, trip)
    de-duplication, vehicles from the positions side.
    """
    part = (delays.groupBy(F.col("fetched_date_key").alias("date_key"), "route_id")
            .agg(*_delay_partials()))
    trips = delays.select(F.col("fetched_date_key").alias("date_key"), "route_id", "trip_id").distinct()
    per_vehicle = (moving_cells(positions, ["route_id", "vehicle_id"]).withColumnRenamed("fetched_date_key", "date_key"))
    return route_types_from(part, trips, per_vehicle, dim_route)


def route_types_from(part: DataFrame, trips: DataFrame, per_vehicle: DataFrame, dim_route: DataFrame) -> DataFrame:
    """:func:`route_type_summary` from partial sums per (date_key, route_id), the
    distinct (date_key, route_id, trip_id) and km/h sums per (date_key, route_id,
    vehicle_id)."""
    types = dim_route.select("route_id", "route_type_desc")
    sums = ["n", "arr_sum", "arr_n", _band_col("On-Time")]
    by_type = (part.join(types, "route_id").groupBy("date_key", "route_type_desc")
               .agg(F.count(F.lit(1)).alias("route_count"), *_merge_partials(sums)))
    # one row per (day, route, trip), so a hot route carries one row per trip,
    # not one per observation
    trips = (trips.join(types, "route_id")
             .groupBy("date_key", "route_type_desc")
             .agg(F.count_distinct("trip_id").alias("trip_count")))
    vp = (per_vehicle.join(types, "route_id")
          .groupBy("date_key", "route_type_desc")
          .agg(F.count_distinct("vehicle_id").alias("active_vehicles"),
               M.kmh_from_sums(F.sum("kmh_sum"), F.sum("kmh_n")).alias("avg_speed_kmh")))
    out = (by_type.join(trips, ["date_key", "route_type_desc"], "left")
           .join(vp, ["date_key", "route_type_desc"], "left"))
    return out.select(
        "date_key", "route_type_desc", "route_count",
        F.coalesce("trip_count", F.lit(0).cast("bigint")).alias("trip_count"),
        F.col("n").alias("delay_observations"),
        M.minutes_from_sums("arr_sum", "arr_n").alias("avg_delay_mins"),
        M.pct_from_counts(_band_col("On-Time"), "n").alias("pct_on_time"),
        "active_vehicles", "avg_speed_kmh",
    )


# ---------------------------------------------------------------------------
# Cells: what a batch adds to the aggregates
#
# A cell is a row of partial sums at the finest grain that every aggregate can be
# derived from; sums, maxima and key sets of several batches merge into one by
# grouping again.  Distinct counts stay exact: the things counted are part of the
# key, one row for each per day and route, however often it was seen.

CELL_SUMS = ["n", "arr_sum", "arr_n", "dep_sum", "dep_n", *map(_band_col, BANDS)]


def delay_cells(delays: DataFrame) -> DataFrame:
    return (delays.groupBy("fetched_date_key", "fetched_hour", "route_id")
            .agg(*_delay_partials(BANDS, with_departure=True, with_max=True)))


def stop_cells(delays: DataFrame) -> DataFrame:
    return delays.groupBy("fetched_date_key", "stop_id", "route_id").agg(*_delay_partials())


def trip_cells(delays: DataFrame) -> DataFrame:
    return delays.select("fetched_date_key", "route_id", "trip_id").distinct()


def vehicle_cells(positions: DataFrame) -> DataFrame:
    return moving_cells(positions, ["fetched_hour", "route_id", "vehicle_id"])


DELAY_CELLS = {"delay_cells": delay_cells, "stop_cells": stop_cells, "trip_cells": trip_cells}
POSITION_CELLS = {"vehicle_cells": vehicle_cells}


def merged_delays(cells: DataFrame, *keys: str) -> DataFrame:
    """Delay cells as partial sums per ``keys``."""
    return cells.groupBy(*keys).agg(*_merge_partials(CELL_SUMS), F.max("arr_max").alias("arr_max"))


def merged_vehicles(cells: DataFrame, *keys: str) -> DataFrame:
    """Vehicle cells as distinct vehicles and average km/h per ``keys``."""
    return cells.groupBy(*keys).agg(F.count_distinct("vehicle_id").alias("active_vehicles"),
                                    M.kmh_from_sums(F.sum("kmh_sum"), F.sum("kmh_n")).alias("avg_speed_kmh"))
