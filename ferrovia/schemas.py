"""Schemas of feeds, realtime documents and flattened Bronze rows."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, ArrayType)

S, I, L, D = "string", "int", "bigint", "double"

# Expected columns per static feed (name -> Spark type).  Columns found in the
# file are cast by name; unexpected columns are kept as strings; missing ones
# are tolerated (added as NULL by the reader).
FEED_COLUMNS: dict[str, dict[str, str]] = {
    "agency": {"agency_id": S, "agency_name": S, "agency_url": S,
               "agency_timezone": S, "agency_lang": S},
    "routes": {"route_id": S, "agency_id": S, "route_short_name": S,
               "route_long_name": S, "route_type": I, "route_color": S,
               "route_text_color": S, "route_desc": S},
    "trips": {"route_id": S, "service_id": S, "trip_id": S, "trip_headsign": S,
              "direction_id": I, "shape_id": S, "block_id": S},
    "stops": {"stop_id": S, "stop_name": S, "stop_lat": D, "stop_lon": D,
              "stop_code": S, "zone_id": S, "parent_station": S,
              "location_type": I, "wheelchair_boarding": I},
    "stop_times": {"trip_id": S, "arrival_time": S, "departure_time": S,
                   "stop_id": S, "stop_sequence": I, "pickup_type": I,
                   "drop_off_type": I, "shape_dist_traveled": D, "timepoint": I},
    "calendar": {"service_id": S, "monday": I, "tuesday": I, "wednesday": I,
                 "thursday": I, "friday": I, "saturday": I, "sunday": I,
                 "start_date": S, "end_date": S},
    "calendar_dates": {"service_id": S, "date": S, "exception_type": I},
}

STATIC_FEEDS = list(FEED_COLUMNS)


def feed_schema(feed: str) -> StructType:
    return StructType([StructField(c, _t(t)) for c, t in FEED_COLUMNS[feed].items()])


def _t(name: str):
    return {S: StringType(), I: IntegerType(), L: LongType(), D: DoubleType()}[name]


# Realtime documents (protobuf JSON).  64-bit numbers arrive as JSON strings,
# so they are declared as strings here and cast afterwards.
_TRIP = StructType([
    StructField("tripId", StringType()), StructField("routeId", StringType()),
    StructField("directionId", IntegerType()), StructField("startDate", StringType()),
    StructField("startTime", StringType()), StructField("scheduleRelationship", StringType()),
])
_EVENT = StructType([
    StructField("delay", IntegerType()), StructField("time", StringType()),
    StructField("uncertainty", IntegerType()),
])
TRIP_UPDATES_DOC = StructType([
    StructField("entity", ArrayType(StructType([
        StructField("id", StringType()),
        StructField("tripUpdate", StructType([
            StructField("trip", _TRIP),
            StructField("vehicle", StructType([StructField("id", StringType())])),
            StructField("stopTimeUpdate", ArrayType(StructType([
                StructField("stopSequence", IntegerType()),
                StructField("stopId", StringType()),
                StructField("arrival", _EVENT),
                StructField("departure", _EVENT),
                StructField("scheduleRelationship", StringType()),
            ]))),
        ])),
    ]))),
])
VEHICLE_POSITIONS_DOC = StructType([
    StructField("entity", ArrayType(StructType([
        StructField("id", StringType()),
        StructField("vehicle", StructType([
            StructField("trip", _TRIP),
            StructField("vehicle", StructType([StructField("id", StringType()),
                                               StructField("label", StringType())])),
            StructField("position", StructType([
                StructField("latitude", DoubleType()), StructField("longitude", DoubleType()),
                StructField("bearing", DoubleType()), StructField("speed", DoubleType()),
            ])),
            StructField("currentStopSequence", IntegerType()),
            StructField("stopId", StringType()),
            StructField("currentStatus", StringType()),
            StructField("timestamp", StringType()),
            StructField("congestionLevel", StringType()),
            StructField("occupancyStatus", StringType()),
        ])),
    ]))),
])

TRIP_UPDATE_COLUMNS = [
    "fetched_at", "entity_id", "trip_id", "route_id", "direction_id", "start_date",
    "start_time", "schedule_relationship", "vehicle_id", "stop_id", "stop_sequence",
    "arrival_delay_secs", "arrival_time_unix", "arrival_uncertainty",
    "departure_delay_secs", "departure_time_unix", "departure_uncertainty",
    "stu_schedule_rel",
]
VEHICLE_POSITION_COLUMNS = [
    "fetched_at", "entity_id", "vehicle_id", "vehicle_label", "trip_id", "route_id",
    "direction_id", "start_date", "latitude", "longitude", "bearing", "speed_mps",
    "current_stop_seq", "current_stop_id", "current_status", "timestamp_unix",
    "congestion_level", "occupancy_status",
]
