"""Silver dimensions: agency, route, stop, date, time of day."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrovia.functions import classify as C
from ferrovia.functions import timeparse as T
from ferrovia.sources.spine import spine


def build_dim_agency(agency: DataFrame) -> DataFrame:
    """agency_id falls back to the name; operator type from the name."""
    return agency.select(
        F.coalesce("agency_id", "agency_name").alias("agency_id"),
        "agency_name", "agency_timezone", "agency_url",
        C.operator_type("agency_name").alias("operator_type"),
    )


def build_dim_route(routes: DataFrame) -> DataFrame:
    """Route dimension.  Type description and commuter flag read the *raw*
    type, so a NULL type becomes code 3 with description Unknown."""
    return routes.select(
        "route_id",
        F.coalesce("agency_id", F.lit("UNKNOWN")).alias("agency_id"),
        "route_short_name", "route_long_name",
        F.coalesce("route_type", F.lit(C.ROUTE_TYPE_FALLBACK_CODE)).cast("int").alias("route_type"),
        C.decode_route_type("route_type").alias("route_type_desc"),
        "route_color",
        C.is_cross_city("route_long_name").alias("is_cross_city"),
        C.is_commuter("route_type", "route_long_name").alias("is_commuter"),
    )


def build_dim_stop(stops: DataFrame) -> DataFrame:
    return stops.select(
        "stop_id", "stop_name", "stop_code", "stop_lat", "stop_lon", "zone_id",
        "parent_station",
        F.coalesce("location_type", F.lit(0)).cast("int").alias("location_type"),
        C.classify_bbox("stop_lat", "stop_lon").alias("county"),
        C.is_city_centre("stop_lat", "stop_lon").alias("is_city_centre"),
        F.col("parent_station").isNotNull().alias("is_interchange"),
        "wheelchair_boarding",
    )


def build_dim_date(spark: SparkSession, as_of, back: int = 90, fwd: int = 30,
                   holidays=None) -> DataFrame:
    """Calendar attributes for ``as_of - back`` .. ``as_of + fwd`` (inclusive)."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    hol = [_dt.date.fromisoformat(h) for h in (holidays if holidays is not None
                                                 else C.DEFAULT_BANK_HOLIDAYS)]
    d = F.date_add(F.lit(as_of), F.col("n").cast("int"))
    days = spine(spark, -back, fwd, "n").select(d.alias("full_date"))
    fd = F.col("full_date")
    return days.select(
        T.date_key(fd).alias("date_key"),
        fd,
        F.year(fd).alias("year"),
        F.month(fd).alias("month"),
        F.date_format(fd, "MMMM").alias("month_name"),
        F.dayofmonth(fd).alias("day_of_month"),
        T.iso_day_of_week(fd).alias("day_of_week"),
        F.date_format(fd, "EEEE").alias("day_name"),
        F.quarter(fd).alias("quarter"),
        F.weekofyear(fd).alias("week_number"),
        T.is_weekend(fd).alias("is_weekend"),
        (fd.isin(*hol) if hol else F.lit(False)).alias("is_bank_holiday"),
        F.lit(C.DEFAULT_PERIOD_LABEL).alias("period_label"),
    )


def build_dim_time_of_day(spark: SparkSession) -> DataFrame:
    """All 1440 minutes: HHMM key, hour, minute, period and three flags."""
    m = F.col("m")
    (_, am_lo, am_hi), (_, pm_lo, pm_hi), (_, nt_lo, nt_hi) = C.MINUTE_PERIODS
    return spine(spark, 0, 1439, "m").select(
        (F.expr("m div 60") * 100 + m % 60).cast("int").alias("time_key"),
        F.expr("m div 60").cast("int").alias("hour"),
        (m % 60).cast("int").alias("minute"),
        C.period_from_minute(m).alias("period"),
        m.between(am_lo, am_hi).alias("is_peak_am"),
        m.between(pm_lo, pm_hi).alias("is_peak_pm"),
        m.between(nt_lo, nt_hi).alias("is_night"),
    )
