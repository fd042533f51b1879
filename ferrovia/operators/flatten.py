"""Realtime feed flattening: nested JSON documents -> Bronze rows.

Documents are parsed with ``from_json`` against a declared schema (invalid
JSON -> NULL -> no rows) and unnested with ``explode``; all of it is JVM-side
expression code, one pass per micro-batch or file set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferrovia.schemas import (TRIP_UPDATE_COLUMNS, TRIP_UPDATES_DOC, VEHICLE_POSITION_COLUMNS,
                              VEHICLE_POSITIONS_DOC)


def get_str(c: Column) -> Column:
    """Missing string field -> ''."""
    return F.coalesce(c, F.lit(""))


def get_long(c: Column) -> Column:
    """64-bit numbers arrive as JSON strings; junk -> NULL."""
    return c.try_cast("bigint")


CORRUPT = "_corrupt"


def parsed_documents(raw: DataFrame, schema: StructType) -> DataFrame:
    """``fetched_at``, ``value`` and the parsed ``doc`` of each document: what the
    flattening reads, and what tells documents that can't be read."""
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return raw.select("fetched_at", "value",
                      F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT}).alias("doc"))


def is_unreadable() -> Column:
    """Of parsed documents: nothing could be read (a single bad field is NULL, and
    the rest of its document is read)."""
    return F.col(f"doc.{CORRUPT}").isNotNull() & F.col("doc.entity").isNull()


def _document(raw: DataFrame, doc_col: str, schema: StructType) -> Column:
    return F.col(doc_col) if isinstance(raw.schema[doc_col].dataType, StructType) else F.from_json(F.col(doc_col), schema)


def flatten_trip_updates(raw: DataFrame, doc_col: str = "value",
                         stamp_col: str = "fetched_at") -> DataFrame:
    """``doc_col`` is the document's text, or the document already parsed.

    One row per (entity, stop-time update); trip and vehicle fields are
    repeated on each row; entities without updates give no rows."""
    doc = _document(raw, doc_col, TRIP_UPDATES_DOC)
    ents = raw.select(F.col(stamp_col).alias("fetched_at"), F.explode(doc["entity"]).alias("e"))
    rows = ents.select("fetched_at", "e", F.explode("e.tripUpdate.stopTimeUpdate").alias("u"))
    trip = F.col("e.tripUpdate.trip")
    u = F.col("u")
    out = rows.select(
        "fetched_at",
        get_str(F.col("e.id")).alias("entity_id"),
        get_str(trip["tripId"]).alias("trip_id"),
        get_str(trip["routeId"]).alias("route_id"),
        trip["directionId"].alias("direction_id"),
        get_str(trip["startDate"]).alias("start_date"),
        get_str(trip["startTime"]).alias("start_time"),
        get_str(trip["scheduleRelationship"]).alias("schedule_relationship"),
        get_str(F.col("e.tripUpdate.vehicle.id")).alias("vehicle_id"),
        get_str(u["stopId"]).alias("stop_id"),
        u["stopSequence"].alias("stop_sequence"),
        u["arrival"]["delay"].alias("arrival_delay_secs"),
        get_long(u["arrival"]["time"]).alias("arrival_time_unix"),
        u["arrival"]["uncertainty"].alias("arrival_uncertainty"),
        u["departure"]["delay"].alias("departure_delay_secs"),
        get_long(u["departure"]["time"]).alias("departure_time_unix"),
        u["departure"]["uncertainty"].alias("departure_uncertainty"),
        get_str(u["scheduleRelationship"]).alias("stu_schedule_rel"),
    )
    return out.select(*TRIP_UPDATE_COLUMNS)


def flatten_vehicle_positions(raw: DataFrame, doc_col: str = "value",
                              stamp_col: str = "fetched_at") -> DataFrame:
    """One row per entity — also when the vehicle part is absent (then all
    strings are '' and all numbers NULL)."""
    doc = _document(raw, doc_col, VEHICLE_POSITIONS_DOC)
    ents = raw.select(F.col(stamp_col).alias("fetched_at"), F.explode(doc["entity"]).alias("e"))
    v = F.col("e.vehicle")
    trip, pos, veh = v["trip"], v["position"], v["vehicle"]
    out = ents.select(
        "fetched_at",
        get_str(F.col("e.id")).alias("entity_id"),
        get_str(veh["id"]).alias("vehicle_id"),
        get_str(veh["label"]).alias("vehicle_label"),
        get_str(trip["tripId"]).alias("trip_id"),
        get_str(trip["routeId"]).alias("route_id"),
        trip["directionId"].alias("direction_id"),
        get_str(trip["startDate"]).alias("start_date"),
        pos["latitude"].alias("latitude"),
        pos["longitude"].alias("longitude"),
        pos["bearing"].alias("bearing"),
        pos["speed"].alias("speed_mps"),
        v["currentStopSequence"].alias("current_stop_seq"),
        get_str(v["stopId"]).alias("current_stop_id"),
        get_str(v["currentStatus"]).alias("current_status"),
        get_long(v["timestamp"]).alias("timestamp_unix"),
        get_str(v["congestionLevel"]).alias("congestion_level"),
        get_str(v["occupancyStatus"]).alias("occupancy_status"),
    )
    return out.select(*VEHICLE_POSITION_COLUMNS)


# Documents from rows (the inverse direction, used to land feeds) ---------------

def trip_update_documents(bronze: DataFrame) -> DataFrame:
    """(fetched_at, value) JSON lines — one document per snapshot and trip
    entity, its stop-time updates nested.  A group holds one trip's stops, so
    it is bounded by the trip length, never by the snapshot size."""
    arrival = F.when(F.col("arrival_time_unix").isNotNull(), F.struct(
        F.col("arrival_delay_secs").alias("delay"),
        F.col("arrival_time_unix").cast("string").alias("time"),
        F.col("arrival_uncertainty").alias("uncertainty")))
    departure = F.when(F.col("departure_time_unix").isNotNull(), F.struct(
        F.col("departure_delay_secs").alias("delay"),
        F.col("departure_time_unix").cast("string").alias("time"),
        F.col("departure_uncertainty").alias("uncertainty")))
    stu = F.struct(F.col("stop_sequence").alias("stopSequence"), F.col("stop_id").alias("stopId"),
                   arrival.alias("arrival"), departure.alias("departure"),
                   F.col("stu_schedule_rel").alias("scheduleRelationship"))
    keys = ["fetched_at", "entity_id", "trip_id", "route_id", "direction_id", "start_date",
            "start_time", "schedule_relationship", "vehicle_id"]
    ent = bronze.groupBy(*keys).agg(F.collect_list(stu).alias("stus"))
    entity = F.struct(
        F.col("entity_id").alias("id"),
        F.struct(
            F.struct(F.col("trip_id").alias("tripId"), F.col("route_id").alias("routeId"),
                     F.col("direction_id").alias("directionId"), F.col("start_date").alias("startDate"),
                     F.col("start_time").alias("startTime"),
                     F.col("schedule_relationship").alias("scheduleRelationship")).alias("trip"),
            F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
            F.col("stus").alias("stopTimeUpdate")).alias("tripUpdate"))
    return ent.select("fetched_at", F.to_json(F.struct(F.array(entity).alias("entity"))).alias("value"))


def vehicle_position_documents(bronze: DataFrame, with_vehicle: Column | None = None) -> DataFrame:
    """(fetched_at, value) JSON lines, one entity per line.  ``with_vehicle``
    (a boolean column) drops the vehicle part where false."""
    vehicle = F.struct(
        F.struct(F.col("trip_id").alias("tripId"), F.col("route_id").alias("routeId"),
                 F.col("direction_id").alias("directionId"),
                 F.col("start_date").alias("startDate")).alias("trip"),
        F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label")).alias("vehicle"),
        F.struct(F.col("latitude").alias("latitude"), F.col("longitude").alias("longitude"),
                 F.col("bearing").alias("bearing"), F.col("speed_mps").alias("speed")).alias("position"),
        F.col("current_stop_seq").alias("currentStopSequence"),
        F.col("current_stop_id").alias("stopId"),
        F.col("current_status").alias("currentStatus"),
        F.col("timestamp_unix").cast("string").alias("timestamp"),
        F.col("congestion_level").alias("congestionLevel"),
        F.col("occupancy_status").alias("occupancyStatus"))
    if with_vehicle is not None:
        vehicle = F.when(with_vehicle, vehicle)
    entity = F.struct(F.col("entity_id").alias("id"), vehicle.alias("vehicle"))
    return bronze.select("fetched_at", F.to_json(F.struct(F.array(entity).alias("entity"))).alias("value"))
