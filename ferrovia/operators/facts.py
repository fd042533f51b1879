"""Silver facts: scheduled departures, realtime delays, vehicle positions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrovia.functions import classify as C
from ferrovia.functions import metrics as M
from ferrovia.functions import timeparse as T

MIN_DEPARTURE_LEN = 5


def build_scheduled_departures(stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                               as_of, wrap_hours: bool = False) -> DataFrame:
    """One row per stop time of a trip on a known route, dated ``as_of``.

    stop_times ⋈ trips is the only fact-to-fact join of the system: both sides
    are pruned to the needed columns before the shuffle on ``trip_id``.  The
    route side is a dimension (size-checked broadcast by the planner / AQE).
    """
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    st = (stop_times
          .where(F.col("departure_time").isNotNull()
                 & (T.trimmed_length("departure_time") >= MIN_DEPARTURE_LEN))
          .select("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time",
                  "pickup_type", "drop_off_type", "timepoint"))
    tr = trips.select("trip_id", "route_id", "service_id", "direction_id")
    rt = routes.select("route_id", "agency_id")
    dep_hour = T.service_time_part("departure_time", 1)
    return (st.join(tr, "trip_id").join(rt, "route_id")
            .select(
                "trip_id", "route_id", "agency_id", "service_id", "stop_id", "stop_sequence",
                T.date_key(F.lit(as_of)).alias("date_key"),
                F.col("arrival_time").alias("scheduled_arrival_time"),
                F.col("departure_time").alias("scheduled_departure_time"),
                T.service_time_part("arrival_time", 1).alias("arrival_hour"),
                dep_hour.alias("departure_hour"),
                T.service_time_part("departure_time", 2).alias("departure_minute"),
                C.period_from_hour(dep_hour, wrap=wrap_hours).alias("time_period"),
                "direction_id", "pickup_type", "drop_off_type",
                (F.coalesce("timepoint", F.lit(1)) == 1).alias("is_timepoint"),
            ))


def build_realtime_delays(trip_updates: DataFrame) -> DataFrame:
    """Typed delay fact from flattened trip updates.

    The snapshot stamp is parsed once (compact or ISO form); rows whose stamp
    does not parse are dropped (the column is NOT NULL in the model), and date
    key and hour derive from the parsed instant.
    """
    ts = T.parse_snapshot_ts("fetched_at")
    return (trip_updates
            .select(ts.alias("fetched_at_ts"), "trip_id", "route_id", "stop_id",
                    "stop_sequence", "direction_id", "vehicle_id", "arrival_delay_secs",
                    "departure_delay_secs", "schedule_relationship")
            .where(F.col("fetched_at_ts").isNotNull())
            .select(
                "fetched_at_ts",
                T.date_key("fetched_at_ts").alias("fetched_date_key"),
                F.hour("fetched_at_ts").alias("fetched_hour"),
                "trip_id", "route_id", "stop_id", "stop_sequence", "direction_id",
                "vehicle_id", "arrival_delay_secs", "departure_delay_secs",
                M.minutes("arrival_delay_secs").alias("arrival_delay_mins"),
                M.minutes("departure_delay_secs").alias("departure_delay_mins"),
                C.delay_band("arrival_delay_secs").alias("delay_band"),
                "schedule_relationship",
            ))


def build_vehicle_positions(positions: DataFrame) -> DataFrame:
    ts = T.parse_snapshot_ts("fetched_at")
    return (positions
            .select(ts.alias("fetched_at_ts"), "vehicle_id", "vehicle_label", "trip_id",
                    "route_id", "direction_id", "latitude", "longitude", "bearing",
                    "speed_mps", "current_stop_id", "current_status", "congestion_level",
                    "occupancy_status")
            .where(F.col("fetched_at_ts").isNotNull())
            .select(
                "fetched_at_ts",
                T.date_key("fetched_at_ts").alias("fetched_date_key"),
                F.hour("fetched_at_ts").alias("fetched_hour"),
                "vehicle_id", "vehicle_label", "trip_id", "route_id", "direction_id",
                "latitude", "longitude", "bearing",
                M.speed_kmh("speed_mps").alias("speed_kmh"),
                "speed_mps", "current_stop_id", "current_status", "congestion_level",
                "occupancy_status",
            ))


# Why a flattened row can't become a row of its fact.
NO_STAMP = "fetched_at does not parse"
OUT_OF_RANGE = "{} out of range"


def _problem(limits: dict[str, Column]) -> Column:
    ts = T.parse_snapshot_ts("fetched_at")
    # a day key has a four-digit year
    found = F.when(ts.isNull() | ~F.year(ts).between(1, 9999), NO_STAMP)
    for name, fits in limits.items():
        found = found.when(~fits, OUT_OF_RANGE.format(name))
    return found


def delay_problem() -> Column:
    """The reason why a flattened trip update can't be a delay fact; NULL if it can.
    The fact builders raise on such rows: the jobs put them aside first."""
    return _problem({c: M.fits_minutes(c) for c in ("arrival_delay_secs", "departure_delay_secs")})


def position_problem() -> Column:
    """The same for a flattened vehicle position."""
    return _problem({"speed_mps": M.fits_kmh("speed_mps")})


def unparsed_stamp_count(bronze: DataFrame) -> DataFrame:
    """Rows a fact build drops because their snapshot stamp does not parse."""
    return bronze.agg(F.count_if(T.parse_snapshot_ts("fetched_at").isNull()).alias("dropped_rows"))
