"""Dashboard views over the Gold tables.

All ranking windows partition by day or week over *Gold* rows (one row per
route / operator per day or week), so a window partition is bounded by the
number of routes or operators, never by fact volume.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrovia.functions import classify as C


def vw_route_performance(route_daily: DataFrame) -> DataFrame:
    pct = F.col("pct_on_time")
    by_agency = Window.partitionBy("agency_name", "date_key").orderBy(pct.desc_nulls_last())
    by_day = Window.partitionBy("date_key").orderBy(pct.desc_nulls_last())
    return route_daily.select(
        "*",
        C.tier(pct).alias("performance_tier"),
        C.tier(pct, C.TIER_COLOURS).alias("tier_colour"),
        F.rank().over(by_agency).alias("agency_rank"),
        F.rank().over(by_day).alias("network_rank"),
    )


def vw_delay_heatmap(hourly: DataFrame) -> DataFrame:
    return hourly.select(
        "date_key", "hour_of_day", "time_period", "day_name", "is_weekend",
        "scheduled_departures", "delay_observations", "avg_delay_mins", "pct_on_time",
        "active_vehicles", "avg_speed_kmh",
        C.severity_index("pct_on_time").alias("severity_index"),
        C.hour_label("hour_of_day").alias("hour_label"),
    )


def vw_stop_map(hotspots: DataFrame) -> DataFrame:
    """Hotspot rows + bubble size ``1 + avg/max_of_day * 9`` as DECIMAL(4,1)
    (NULL when the day's max is 0 or the value leaves the type's range).

    The per-day maximum is a grouped aggregate joined back (one row per day)
    rather than a window, so no day's stops are sorted inside one task.
    """
    day_max = hotspots.groupBy("date_key").agg(F.max("avg_arrival_delay_mins").alias("_day_max"))
    avg = F.col("avg_arrival_delay_mins")
    mx = F.col("_day_max")
    bubble = (F.lit(1) + (avg / F.when(mx != 0, mx)) * F.lit(9)).try_cast("decimal(4,1)")
    return hotspots.join(day_max, "date_key", "left").select(
        "stop_id", "stop_name", "stop_lat", "stop_lon", "county", "is_city_centre",
        "date_key", "total_observations", "avg_arrival_delay_mins", "pct_on_time",
        "worst_route",
        bubble.alias("bubble_size"),
        C.tier("pct_on_time", C.DELAY_LABELS).alias("delay_label"),
    )


def vw_operator_comparison(scorecard: DataFrame) -> DataFrame:
    score = F.col("reliability_score")
    by_agency = Window.partitionBy("agency_name").orderBy("week_start_date")
    by_week = Window.partitionBy("week_start_date").orderBy(score.desc_nulls_last())
    return scorecard.select(
        "*",
        (score - F.lag(score).over(by_agency)).alias("reliability_delta"),
        F.rank().over(by_week).alias("weekly_rank"),
    )


def network_kpi(route_daily: DataFrame) -> DataFrame:
    """Single-row summary of the latest day.

    The latest-day filter is an equi-join with the one-row ``max(date_key)``
    aggregate; best / worst route are arg-max / arg-min aggregates on struct
    keys (best: highest % on time, unknown last; worst: lowest, unknown
    first; ties to the smallest route_id) — no sort of the day's routes.
    Empty input still yields one row (NULLs, 0 routes).
    """
    latest = route_daily.agg(F.max("date_key").alias("date_key"))
    day = route_daily.join(latest, "date_key")
    pct = F.col("pct_on_time")
    best_key = F.struct(pct.isNull().alias("k0"), (-pct).alias("k1"),
                        F.col("route_id").alias("k2"), F.col("route_short_name").alias("name"))
    worst_key = F.struct(pct.isNotNull().alias("k0"), pct.alias("k1"),
                         F.col("route_id").alias("k2"), F.col("route_short_name").alias("name"))
    return day.agg(
        F.max("date_key").alias("latest_date_key"),
        F.count_distinct("route_id").alias("total_routes_monitored"),
        F.sum("total_delay_observations").alias("total_obs_today"),
        F.avg("pct_on_time").alias("network_avg_on_time_pct"),
        F.avg("avg_arrival_delay_mins").alias("network_avg_delay_mins"),
        F.max("max_delay_mins").alias("worst_delay_mins"),
        F.min(best_key).getField("name").alias("best_route"),
        F.min(worst_key).getField("name").alias("worst_route"),
    )


def vw_network_kpi(route_daily: DataFrame, now=None) -> DataFrame:
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return network_kpi(route_daily).withColumn(
        "last_refreshed", F.lit(now.strftime("%Y-%m-%d %H:%M:%S")))


def vw_delay_trend(trend: DataFrame) -> DataFrame:
    """Trend rows + label comparing the rolling delay with the previous row.

    One row per day, so the un-partitioned ordered window holds #days rows.
    """
    r = F.col("rolling_7d_avg_delay")
    prev = F.lag(r).over(Window.orderBy("date_key"))
    return trend.select("*", C.trend_label(r, prev).alias("trend_label"))
