"""Registered queries: name -> (spark builder, oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
benchmark tables (through the transit views of ``plans.testviews``).  Output
timestamps are rendered as UTC strings so comparisons never depend on the
client's time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrovia.operators import views as V
from ferrovia.plans import oracle as O
from ferrovia.plans.testviews import views_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TS_FMT = "yyyy-MM-dd HH:mm:ss"
TS_SQL = "strftime(fetched_at_ts, '%Y-%m-%d %H:%M:%S')"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _tv(spark, sf_dir):
    return views_for(spark, sf_dir)


# --- dimensions and facts ---------------------------------------------------

@register("dim_agency", O.with_ctes("SELECT * FROM dim_agency"))
def q_dim_agency(spark, sf_dir):
    return _tv(spark, sf_dir).dim_agency


@register("dim_route", O.with_ctes("SELECT * FROM dim_route"))
def q_dim_route(spark, sf_dir):
    return _tv(spark, sf_dir).dim_route


@register("dim_stop", O.with_ctes("SELECT * FROM dim_stop"))
def q_dim_stop(spark, sf_dir):
    return _tv(spark, sf_dir).dim_stop


@register("scheduled_departures", O.with_ctes("SELECT * FROM sched"))
def q_scheduled_departures(spark, sf_dir):
    return _tv(spark, sf_dir).sched


_DELAY_COLS = ["fetched_date_key", "fetched_hour", "trip_id", "route_id", "stop_id",
               "stop_sequence", "direction_id", "vehicle_id", "arrival_delay_secs",
               "departure_delay_secs", "arrival_delay_mins", "departure_delay_mins",
               "delay_band", "schedule_relationship"]


def delays_out(df: DataFrame) -> DataFrame:
    return df.select(F.date_format("fetched_at_ts", TS_FMT).alias("fetched_at_utc"), *_DELAY_COLS)


DELAYS_SQL_COLS = f"{TS_SQL} AS fetched_at_utc, " + ", ".join(_DELAY_COLS)


@register("realtime_delays", O.with_ctes(f"SELECT {DELAYS_SQL_COLS} FROM delays"))
def q_realtime_delays(spark, sf_dir):
    return delays_out(_tv(spark, sf_dir).delays)


_POS_COLS = ["fetched_date_key", "fetched_hour", "vehicle_id", "vehicle_label", "trip_id",
             "route_id", "direction_id", "latitude", "longitude", "bearing", "speed_kmh",
             "speed_mps", "current_stop_id", "current_status", "congestion_level",
             "occupancy_status"]


def positions_out(df: DataFrame) -> DataFrame:
    return df.select(F.date_format("fetched_at_ts", TS_FMT).alias("fetched_at_utc"), *_POS_COLS)


POS_SQL_COLS = (f"{TS_SQL} AS fetched_at_utc, "
                + ", ".join(c if c != "speed_kmh" else f"{O.kmh_row('speed_mps')} AS speed_kmh"
                            for c in _POS_COLS))


@register("vehicle_positions", O.with_ctes(f"SELECT {POS_SQL_COLS} FROM positions"))
def q_vehicle_positions(spark, sf_dir):
    return positions_out(_tv(spark, sf_dir).positions)


# --- Gold ---------------------------------------------------------------------

@register("route_daily_performance", O.with_ctes("SELECT * FROM route_daily"))
def q_route_daily(spark, sf_dir):
    return _tv(spark, sf_dir).route_daily()


@register("stop_delay_hotspot", O.with_ctes("SELECT * FROM hotspot"))
def q_hotspot(spark, sf_dir):
    return _tv(spark, sf_dir).hotspots()


@register("hourly_network_pattern", O.with_ctes("SELECT * FROM hourly"))
def q_hourly(spark, sf_dir):
    return _tv(spark, sf_dir).hourly()


@register("operator_weekly_scorecard", O.with_ctes("SELECT * FROM scorecard"))
def q_scorecard(spark, sf_dir):
    return _tv(spark, sf_dir).scorecard()


@register("delay_trend_daily", O.with_ctes("SELECT * FROM trend"))
def q_trend(spark, sf_dir):
    return _tv(spark, sf_dir).trend()


@register("delay_trend_datekey_mode", O.with_ctes("SELECT * FROM trend_datekey"))
def q_trend_datekey(spark, sf_dir):
    return _tv(spark, sf_dir).trend(mode="date_key")


@register("route_type_summary", O.with_ctes("SELECT * FROM type_summary"))
def q_type_summary(spark, sf_dir):
    return _tv(spark, sf_dir).type_summary()


# --- views --------------------------------------------------------------------

@register("vw_route_performance", O.with_ctes(f"""
SELECT *,
       {O.tier_case('pct_on_time')} AS performance_tier,
       {O.tier_case('pct_on_time', O.C.TIER_COLOURS)} AS tier_colour,
       CAST(rank() OVER (PARTITION BY agency_name, date_key ORDER BY pct_on_time DESC NULLS LAST) AS INTEGER) AS agency_rank,
       CAST(rank() OVER (PARTITION BY date_key ORDER BY pct_on_time DESC NULLS LAST) AS INTEGER) AS network_rank
FROM route_daily"""))
def q_vw_route_performance(spark, sf_dir):
    return V.vw_route_performance(_tv(spark, sf_dir).route_daily())


@register("vw_delay_heatmap", O.with_ctes("""
SELECT date_key, hour_of_day, time_period, day_name, is_weekend, scheduled_departures,
       delay_observations, avg_delay_mins, pct_on_time, active_vehicles, avg_speed_kmh,
       CAST(100 - COALESCE(pct_on_time, 100) AS DECIMAL(5,2)) AS severity_index,
       lpad(CAST(hour_of_day AS VARCHAR), 2, '0') || ':00' AS hour_label
FROM hourly"""))
def q_vw_delay_heatmap(spark, sf_dir):
    return V.vw_delay_heatmap(_tv(spark, sf_dir).hourly())


_BUBBLE_T = ("sign(10 * (m + 9 * a)) * sign(m) * "
             "((2 * abs(10 * (m + 9 * a)) + abs(m)) // (2 * abs(m)))")


@register("vw_stop_map", O.with_ctes(f"""
SELECT stop_id, stop_name, stop_lat, stop_lon, county, is_city_centre, date_key,
       total_observations, avg_arrival_delay_mins, pct_on_time, worst_route,
       CASE WHEN m <> 0 AND abs({_BUBBLE_T}) <= 9999
            THEN CAST(CAST({_BUBBLE_T} AS DECIMAL(18,0)) * 0.1 AS DECIMAL(4,1)) END AS bubble_size,
       {O.tier_case('pct_on_time', O.C.DELAY_LABELS)} AS delay_label
FROM (SELECT *, CAST(avg_arrival_delay_mins * 100 AS BIGINT) AS a,
             CAST(MAX(avg_arrival_delay_mins) OVER (PARTITION BY date_key) * 100 AS BIGINT) AS m
      FROM hotspot)"""))
def q_vw_stop_map(spark, sf_dir):
    return V.vw_stop_map(_tv(spark, sf_dir).hotspots())


@register("vw_operator_comparison", O.with_ctes("""
SELECT r.* EXCLUDE (ahead, scored, week_before),
       CAST(r.reliability_score - p.reliability_score AS DECIMAL(6,2)) AS reliability_delta,
       CAST(1 + CASE WHEN r.reliability_score IS NULL THEN r.scored ELSE r.ahead END AS INTEGER) AS weekly_rank
FROM ranked r LEFT JOIN scorecard p ON p.agency_name = r.agency_name AND p.week_start_date = r.week_before""", {"ranked": """
SELECT this.*, (SELECT COUNT(*) FROM scorecard better WHERE better.week_start_date = this.week_start_date
                AND better.reliability_score > this.reliability_score) AS ahead,
       (SELECT COUNT(*) FROM scorecard scored WHERE scored.week_start_date = this.week_start_date
        AND scored.reliability_score IS NOT NULL) AS scored,
       (SELECT MAX(week_start_date) FROM scorecard earlier WHERE earlier.agency_name = this.agency_name
        AND earlier.week_start_date < this.week_start_date) AS week_before
FROM scorecard this"""}))
def q_vw_operator_comparison(spark, sf_dir):
    return V.vw_operator_comparison(_tv(spark, sf_dir).scorecard())


@register("vw_network_kpi", O.with_ctes(f"""
SELECT date_key AS latest_date_key, COUNT(DISTINCT route_id) AS total_routes_monitored,
       CAST(SUM(total_delay_observations) AS BIGINT) AS total_obs_today,
       {O.avg_scale6('SUM(CAST(pct_on_time * 100 AS BIGINT))', 'COUNT(pct_on_time)', 2, 'DECIMAL(9,6)')} AS network_avg_on_time_pct,
       {O.avg_scale6('SUM(CAST(avg_arrival_delay_mins * 100 AS BIGINT))', 'COUNT(avg_arrival_delay_mins)', 2, 'DECIMAL(12,6)')} AS network_avg_delay_mins,
       MAX(max_delay_mins) AS worst_delay_mins,
       first(route_short_name ORDER BY pct_on_time DESC NULLS LAST, route_id) AS best_route,
       first(route_short_name ORDER BY pct_on_time ASC NULLS FIRST, route_id) AS worst_route
FROM (SELECT *, dense_rank() OVER (ORDER BY date_key DESC) AS age FROM route_daily)
WHERE age = 1 GROUP BY date_key"""))
def q_vw_network_kpi(spark, sf_dir):
    return V.network_kpi(_tv(spark, sf_dir).route_daily())


@register("vw_delay_trend", O.with_ctes(f"""
SELECT now.*, CASE sign(now.rolling_7d_avg_delay - was.rolling_7d_avg_delay)
                WHEN 1 THEN '{O.C.TREND_WORSENING}' WHEN -1 THEN '{O.C.TREND_IMPROVING}'
                ELSE '{O.C.TREND_STABLE}' END AS trend_label
FROM trend now LEFT JOIN trend was ON was.date_key = (SELECT MAX(e.date_key) FROM trend e WHERE e.date_key < now.date_key)"""))
def q_vw_delay_trend(spark, sf_dir):
    return V.vw_delay_trend(_tv(spark, sf_dir).trend())


# --- merges -------------------------------------------------------------------

from ferrovia.operators import merge as MG  # noqa: E402
from ferrovia.plans import jobs as JOBS  # noqa: E402
from ferrovia.session import scratch_dir, shuffles_dropped  # noqa: E402
from ferrovia.sources import lake as LK  # noqa: E402
from ferrovia.operators.gold import ROUTE_DAILY_COLUMNS  # noqa: E402

SCORECARD_COLUMNS = ["week_start_date", "week_label", "agency_name", "operator_type", "route_count",
                     "total_delay_obs", "avg_delay_mins", "pct_on_time", "pct_severe_delay",
                     "reliability_score", "reliability_band"]
EARLY_LOAD_END = 20250215     # first load: days before this key
LATE_LOAD_START = 20250201    # second load re-delivers from this day on


def _cut(df: DataFrame) -> DataFrame:
    """The state of a fact at an earlier refresh (2025-03-01 12:00)."""
    k, h = F.col("fetched_date_key"), F.col("fetched_hour")
    return df.where((k < 20250301) | ((k == 20250301) & (h < 12)))


def _loads(df: DataFrame):
    k = F.col("fetched_date_key")
    return df.where(k < EARLY_LOAD_END), df.where(k >= LATE_LOAD_START)


def _tv_parts(spark, sf_dir):
    """The views, for a query that cuts the realtime facts."""
    tv = _tv(spark, sf_dir)
    _ = tv.kept_facts
    return tv


def _two_loads(spark, fact: DataFrame, keys: list[str]) -> DataFrame:
    """The stored fact after both loads: the second one only adds absent keys, and
    reads only the days it brings."""
    early, late = _loads(fact)
    path = f"{scratch_dir(spark, 'silver')}/fact"
    for load in (early, late):
        MG.insert_if_absent_table(spark, load, path, keys, "fetched_date_key")
    return spark.read.parquet(path)


_LOAD_CTES = {
    "d_tgt": f"SELECT * FROM delays WHERE fetched_date_key < {EARLY_LOAD_END}",
    "d_src": f"SELECT * FROM delays WHERE fetched_date_key >= {LATE_LOAD_START}",
    "p_tgt": f"SELECT * FROM positions WHERE fetched_date_key < {EARLY_LOAD_END}",
    "p_src": f"SELECT * FROM positions WHERE fetched_date_key >= {LATE_LOAD_START}",
}


@register("merge_delays", O.with_ctes(
    O.insert_absent_sql("d_tgt", "d_src", ["trip_id", "stop_id", "fetched_at_ts"], DELAYS_SQL_COLS),
    _LOAD_CTES))
def q_merge_delays(spark, sf_dir):
    return delays_out(_two_loads(spark, _tv_parts(spark, sf_dir).delays, ["trip_id", "stop_id", "fetched_at_ts"]))


@register("merge_positions", O.with_ctes(
    O.insert_absent_sql("p_tgt", "p_src", ["vehicle_id", "fetched_at_ts"], POS_SQL_COLS),
    _LOAD_CTES))
def q_merge_positions(spark, sf_dir):
    return positions_out(_two_loads(spark, _tv_parts(spark, sf_dir).positions, ["vehicle_id", "fetched_at_ts"]))


def _upserted(spark, name: str, target: DataFrame, source: DataFrame, stale: str) -> DataFrame:
    """The stored Gold table after an upsert of ``source`` into ``target``."""
    path = f"{scratch_dir(spark, 'gold')}/{name}"
    LK.overwrite_table(target, path, JOBS.GOLD_PARTITION[name])
    MG.upsert_table(spark, source, path, MG.GOLD_KEYS[name], MG.UPDATE_COLUMNS[name], stale, JOBS.GOLD_PARTITION[name])
    return spark.read.parquet(path).select(*source.columns)


def _upsert_oracle(cte: str, columns: list[str], stale: str = "keep") -> str:
    return O.with_ctes(O.upsert_sql(f"{cte}_cut", cte, O.C.KEYS[cte], columns,
                                    O.C.UPDATES[cte] if stale == "keep" else None), O.MERGE_CTES)


def _route_daily_twice(spark, sf_dir, stale):
    tv = _tv_parts(spark, sf_dir)
    target = tv.route_daily(delays=_cut(tv.delays), positions=_cut(tv.positions))
    return _upserted(spark, "route_daily_performance", target, tv.route_daily(), stale)


@register("upsert_route_daily_keep", _upsert_oracle("route_daily", ROUTE_DAILY_COLUMNS))
def q_upsert_route_daily_keep(spark, sf_dir):
    return _route_daily_twice(spark, sf_dir, "keep")


@register("upsert_route_daily_refresh", _upsert_oracle("route_daily", ROUTE_DAILY_COLUMNS, "refresh"))
def q_upsert_route_daily_refresh(spark, sf_dir):
    return _route_daily_twice(spark, sf_dir, "refresh")


@register("upsert_scorecard_keep", _upsert_oracle("scorecard", SCORECARD_COLUMNS))
def q_upsert_scorecard_keep(spark, sf_dir):
    tv = _tv_parts(spark, sf_dir)
    return _upserted(spark, "operator_weekly_scorecard", tv.scorecard(delays=_cut(tv.delays)), tv.scorecard(), "keep")


HOTSPOT_COLUMNS = ["stop_id", "stop_name", "stop_lat", "stop_lon", "county", "is_city_centre", "date_key",
                   "total_observations", "avg_arrival_delay_mins", "pct_on_time", "worst_route"]
HOURLY_COLUMNS = ["date_key", "hour_of_day", "time_period", "day_name", "is_weekend", "scheduled_departures",
                  "delay_observations", "avg_delay_mins", "pct_on_time", "active_vehicles", "avg_speed_kmh"]
TREND_COLUMNS = ["date_key", "full_date", "day_name", "is_weekend", "total_observations", "avg_delay_mins",
                 "pct_on_time", "rolling_7d_avg_delay", "rolling_7d_pct_on_time"]


@register("upsert_hotspot_keep", _upsert_oracle("hotspot", HOTSPOT_COLUMNS))
def q_upsert_hotspot_keep(spark, sf_dir):
    tv = _tv_parts(spark, sf_dir)
    return _upserted(spark, "stop_delay_hotspot", tv.hotspots(delays=_cut(tv.delays)), tv.hotspots(delays=tv.delays), "keep")


@register("upsert_hourly_keep", _upsert_oracle("hourly", HOURLY_COLUMNS))
def q_upsert_hourly_keep(spark, sf_dir):
    tv = _tv_parts(spark, sf_dir)
    target = tv.hourly(delays=_cut(tv.delays), positions=_cut(tv.positions))
    return _upserted(spark, "hourly_network_pattern", target, tv.hourly(), "keep")


@register("upsert_trend_keep", _upsert_oracle("trend", TREND_COLUMNS))
def q_upsert_trend_keep(spark, sf_dir):
    tv = _tv_parts(spark, sf_dir)
    return _upserted(spark, "delay_trend_daily", tv.trend(delays=_cut(tv.delays)), tv.trend(), "keep")


# --- quality and JSON flattening ----------------------------------------------------

from functools import reduce  # noqa: E402

from ferrovia.operators import facts as FACTS  # noqa: E402
from ferrovia.operators import flatten as FL  # noqa: E402
from ferrovia.operators import quality as Q  # noqa: E402
from ferrovia.plans import testviews as TVM  # noqa: E402


@register("null_profile", O.with_ctes("SELECT * FROM np", O.QUALITY_CTES))
def q_null_profile(spark, sf_dir):
    feeds = TVM.bronze_feeds(spark, sf_dir)
    return reduce(DataFrame.unionByName,
                  [Q.null_profile(df).select(F.lit(name).alias("feed"), "*") for name, df in feeds.items()])


@register("validate_feeds", O.with_ctes(O.VALIDATE_SQL, O.QUALITY_CTES))
def q_validate_feeds(spark, sf_dir):
    """Every feed's verdict; the calendar feed has landed empty."""
    return Q.validate_all(TVM.bronze_feeds(spark, sf_dir) | {"calendar": FD.empty_feed(spark, "calendar")})


@register("static_gate", O.with_ctes(O.GATE_SQL, O.QUALITY_CTES))
def q_static_gate(spark, sf_dir):
    """The batch gate over the verdicts: one failed feed closes it."""
    return Q.batch_gate(q_validate_feeds(spark, sf_dir))


@register("feed_row_counts", O.with_ctes(O.ROW_COUNTS_SQL))
def q_feed_row_counts(spark, sf_dir):
    return Q.feed_row_counts(TVM.bronze_feeds(spark, sf_dir))


@register("trip_updates_flat", O.with_ctes("SELECT * FROM b_trip_updates"))
def q_trip_updates_flat(spark, sf_dir):
    return FL.flatten_trip_updates(TVM.trip_update_docs(spark, sf_dir))


@register("vehicle_positions_flat", O.with_ctes("SELECT * FROM vp_flat"))
def q_vehicle_positions_flat(spark, sf_dir):
    return FL.flatten_vehicle_positions(TVM.vehicle_position_docs(spark, sf_dir))


# --- streaming ------------------------------------------------------------------

from ferrovia.streaming import realtime as ST  # noqa: E402

STREAM_FILES_PER_TRIGGER = 16


@register("stream_realtime_delays", O.with_ctes(f"SELECT {DELAYS_SQL_COLS} FROM delays"))
def q_stream_realtime_delays(spark, sf_dir):
    """Land trip-update documents, catch up with an ``availableNow`` stream
    (several micro-batches), read the Silver delay fact it built.  Equal to
    ``realtime_delays``: batch and stream give the same table."""
    root = scratch_dir(spark, "stream-rt")
    landing = _tv(spark, sf_dir).trip_update_landing
    qs = ST.start_realtime(spark, landing, None, f"{root}/lake",
                           f"{root}/checkpoints", trigger="availableNow", refresh_gold=False,
                           max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    ST.await_all(qs)
    return delays_out(spark.read.parquet(f"{root}/lake/silver/fact_realtime_delays"))


@register("stream_hourly_window", O.with_ctes(O.STREAM_WINDOW_SQL))
def q_stream_hourly_window(spark, sf_dir):
    """Event-time hourly windows over streamed vehicle positions (watermark
    wide enough for the back-filled, unordered landing files)."""
    root = scratch_dir(spark, "stream-win")
    q = ST.start_hourly_windows(spark, _tv(spark, sf_dir).vehicle_position_landing, f"{root}/windows",
                                f"{root}/checkpoint", trigger="availableNow", watermark="70 days",
                                max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    ST.await_all([q])
    return spark.read.parquet(f"{root}/windows").select(*ST.WINDOW_COLUMNS)


# --- static feed scan and Bronze loads -------------------------------------------

from ferrovia.sources import feeds as FD  # noqa: E402


@register("static_feed_scan", O.with_ctes("SELECT * FROM b_stop_times"))
def q_static_feed_scan(spark, sf_dir):
    """Land the stop-times feed as CSV part files, scan it back by header name
    (typed by the feed's column map) — the largest static feed."""
    root = scratch_dir(spark, "landing-static")
    FD.land_feed_csv(TVM.bronze_stop_times(spark, sf_dir), root, "stop_times")
    return FD.read_feed_csv(spark, root, "stop_times", ingested_at="fixed").drop("_ingested_at")


@register("bronze_latest_routes", O.with_ctes("SELECT * FROM b_routes"))
def q_bronze_latest_routes(spark, sf_dir):
    """Two weekly snapshots of the routes feed; the full-refresh load keeps
    the latest one only (no duplicated keys on the second run)."""
    root = scratch_dir(spark, "bronze")
    routes = TVM.bronze_routes(spark, sf_dir)
    older = routes.withColumn("route_long_name", F.concat(F.coalesce("route_long_name", F.lit("")), F.lit(" (old)")))
    LK.write_snapshot(older, f"{root}/snapshots", "routes", "20250106T030000Z")
    LK.write_snapshot(routes, f"{root}/snapshots", "routes", "20250113T030000Z")
    LK.load_bronze_full(LK.read_latest_snapshot(spark, f"{root}/snapshots", "routes"), f"{root}/bronze/routes")
    return spark.read.parquet(f"{root}/bronze/routes").drop("snapshot")


@register("static_text_scan", O.with_ctes("""
SELECT * REPLACE (stop_name || ', "' || stop_id || '"' || chr(10) || '(stop)' AS stop_name) FROM b_stops"""))
def q_static_text_scan(spark, sf_dir):
    """The stops feed with commas, doubled quotes and line breaks in the names,
    landed as fully quoted CSV, scanned back by header name."""
    root = scratch_dir(spark, "landing-text")
    stops = TVM.bronze_stops(spark, sf_dir)
    named = stops.withColumn("stop_name", F.concat("stop_name", F.lit(', "'), "stop_id", F.lit('"\n(stop)')))
    quoted = [F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in stops.columns]
    # Written as text, field by field: every line break below is the feed's own.
    lines = named.select(F.concat_ws(",", *[F.coalesce(q, F.lit("")) for q in quoted]).alias("value"))
    header = spark.createDataFrame([(",".join(stops.columns),)], "value string")
    path = f"{root}/stops.txt"
    header.unionByName(lines).coalesce(1).write.text(path)
    return FD.read_feed_csv(spark, root, "stops", ingested_at="fixed").drop("_ingested_at")


@register("bronze_append", O.with_ctes(f"SELECT {DELAYS_SQL_COLS} FROM delays"))
def q_bronze_append(spark, sf_dir):
    """Trip updates of two sources whose batches both count from 0, appended to one
    Bronze table; the delay fact over all of it."""
    root = f"{scratch_dir(spark, 'bronze')}/trip_updates"
    rows = TVM.bronze_trip_updates(spark, sf_dir)
    first = F.col("start_date") < "20250215"
    for source, part in (("a", rows.where(first)), ("b", rows.where(~F.coalesce(first, F.lit(False))))):
        LK.load_bronze_append(part, root, 0, source)
    return delays_out(FACTS.build_realtime_delays(spark.read.parquet(root)))


# --- calendar dimensions over observed days --------------------------------------

_DATE_COLS = ", ".join(["date_key", "full_date", "year", "month", "month_name", "day_of_month",
                        "day_of_week", "day_name", "quarter", "week_number", "is_weekend",
                        "is_bank_holiday", "period_label"])


def _days(df: DataFrame) -> DataFrame:
    return df.select(F.col("fetched_date_key").alias("date_key")).distinct()


@register("dim_date_observed", O.with_ctes(
    "SELECT * FROM dim_date WHERE date_key IN (SELECT fetched_date_key FROM delays)"))
def q_dim_date_observed(spark, sf_dir):
    """Calendar attributes of every day present in the delay fact."""
    tv = _tv(spark, sf_dir)
    return tv.dim_date.join(_days(tv.delays), "date_key", "left_semi")


@register("dim_time_of_day_observed", O.with_ctes(
    "SELECT * FROM dim_tod WHERE time_key IN "
    "(SELECT CAST(hour(fetched_at_ts) * 100 + minute(fetched_at_ts) AS INTEGER) FROM delays)"))
def q_dim_time_of_day_observed(spark, sf_dir):
    """Time-of-day rows of every snapshot minute present in the delay fact."""
    tv = _tv(spark, sf_dir)
    keys = tv.delays.select((F.hour("fetched_at_ts") * 100 + F.minute("fetched_at_ts"))
                            .cast("int").alias("time_key")).distinct()
    return tv.dim_tod.join(keys, "time_key", "left_semi")


@register("insert_absent_dates", O.with_ctes(
    O.insert_absent_sql("dd_tgt", "dd_src", ["date_key"], _DATE_COLS),
    {**_LOAD_CTES,
     "dd_tgt": "SELECT * FROM dim_date WHERE date_key IN (SELECT fetched_date_key FROM d_tgt)",
     "dd_src": "SELECT * FROM dim_date WHERE date_key IN (SELECT fetched_date_key FROM d_src)"}))
def q_insert_absent_dates(spark, sf_dir):
    """Calendar rows of the first load's days, plus the second load's days
    that are not there yet (insert-if-absent on date_key)."""
    tv = _tv_parts(spark, sf_dir)
    early, late = _loads(tv.delays)
    tgt = tv.dim_date.join(_days(early), "date_key", "left_semi")
    src = tv.dim_date.join(_days(late), "date_key", "left_semi")
    return MG.insert_if_absent(tgt, src, ["date_key"])


@register("stream_hourly_delays", O.with_ctes(O.STREAM_DELAY_WINDOW_SQL))
def q_stream_hourly_delays(spark, sf_dir):
    """Streaming form of the hourly pattern: event-time hourly windows over
    streamed trip updates (watermark wide enough for the back-filled,
    unordered landing files), upserted per micro-batch."""
    root = scratch_dir(spark, "stream-delay-win")
    q = ST.start_hourly_delay_windows(spark, _tv(spark, sf_dir).trip_update_landing, f"{root}/windows",
                                      f"{root}/checkpoint", trigger="availableNow", watermark="70 days",
                                      max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    ST.await_all([q])
    return spark.read.parquet(f"{root}/windows").select(*ST.DELAY_WINDOW_COLUMNS)


# --- the whole realtime job --------------------------------------------------------

def _store_static(tv, lake: str) -> None:
    """The dimensions and the schedule of a lake that feeds are streamed into."""
    with shuffles_dropped(tv.spark):
        for table, df in (("dim_route", tv.dim_route), ("dim_agency", tv.dim_agency), ("dim_stop", tv.dim_stop),
                          ("dim_date", tv.dim_date), ("dim_time_of_day", tv.dim_tod),
                          ("fact_scheduled_departures", tv.sched)):
            LK.overwrite_table(df, f"{lake}/silver/{table}")


def _streamed_gold(spark, sf_dir, name: str) -> DataFrame:
    """Both landings caught up by one ``availableNow`` query with Gold on; the Gold
    table read back from the lake.  Built once per session and folder."""
    tv = _tv(spark, sf_dir)
    if tv.streamed_lake is None:
        root = tv.scratch("stream-gold")
        lake = f"{root}/lake"
        _store_static(tv, lake)
        ST.await_all(ST.start_realtime(spark, tv.trip_update_landing, tv.vehicle_position_landing, lake,
                                       f"{root}/checkpoints", trigger="availableNow",
                                       max_files_per_trigger=STREAM_FILES_PER_TRIGGER))
        tv.streamed_lake = lake
    return spark.read.parquet(f"{tv.streamed_lake}/gold/{name}").drop("_refreshed_at")


@register("stream_gold_route_daily", O.with_ctes("SELECT * FROM route_daily_doc", O.DOCUMENT_CTES))
def q_stream_gold_route_daily(spark, sf_dir):
    return _streamed_gold(spark, sf_dir, "route_daily_performance")


@register("stream_gold_hourly", O.with_ctes("SELECT * FROM hourly_doc", O.DOCUMENT_CTES))
def q_stream_gold_hourly(spark, sf_dir):
    return _streamed_gold(spark, sf_dir, "hourly_network_pattern")


@register("stream_gold_trend", O.with_ctes("SELECT * FROM trend"))
def q_stream_gold_trend(spark, sf_dir):
    return _streamed_gold(spark, sf_dir, "delay_trend_daily")


# --- feeds that go wrong -------------------------------------------------------------

from ferrovia.sources import manifest as MF  # noqa: E402
from ferrovia.sources.realtime import land_documents  # noqa: E402


def _poisoned(spark, sf_dir) -> str:
    """A lake that both feeds were streamed into, with speeds and delays that no
    column can hold, stamps that don't parse and documents that break off.  Built
    once per session and folder."""
    tv = _tv(spark, sf_dir)
    if tv.poisoned_lake is None:
        root = tv.scratch("stream-poison")
        key = lambda c, n: F.substring(c, n, 20).cast("long")
        tu = tv.bronze_trip_updates.withColumn("arrival_delay_secs", F.when(
            (key("trip_id", 2) % 103 == 7) & F.col("arrival_delay_secs").isNotNull(), 2_000_000_000).otherwise(F.col("arrival_delay_secs")))
        vp = tv.bronze_vehicle_positions.withColumn("speed_mps", F.when(
            (key("entity_id", 3) % 101 == 3) & F.col("speed_mps").isNotNull(), 1e9).otherwise(F.col("speed_mps")))
        broken = TVM.read_table(spark, sf_dir, "nation").select(
            F.lit(None).cast("string").alias("fetched_at"),
            F.concat(F.lit('{"fetched_at":"20250120T080000Z","entity":[{"id":"'), "n_name", F.lit('",')).alias("value"))
        for feed, docs in (("tu", FL.trip_update_documents(tu)),
                           ("vp", FL.vehicle_position_documents(vp, with_vehicle=F.col("current_stop_seq") != 7))):
            land_documents(docs.unionByName(broken), f"{root}/{feed}")
        ST.await_all(ST.start_realtime(spark, f"{root}/tu", f"{root}/vp", f"{root}/lake", f"{root}/checkpoints",
                                       trigger="availableNow", refresh_gold=False))
        tv.poisoned_lake = f"{root}/lake"
    return tv.poisoned_lake


@register("stream_poison_rows", O.with_ctes(O.POISON_SQL, O.POISON_CTES))
def q_stream_poison_rows(spark, sf_dir):
    """Where the rows of a poisoned feed are: good ones in Silver (reason ''), the
    others and unreadable documents in quarantine, with the reason."""
    lake = _poisoned(spark, sf_dir)
    none = lambda kind: F.lit(None).cast(kind)
    delays, positions = (MF.read_live(spark, f"{lake}/silver/{t}") for t in ("fact_realtime_delays", "fact_vehicle_positions"))
    parts = [
        delays.groupBy(F.col("fetched_date_key").alias("date_key")).agg(
            F.count("*").alias("rows"), F.sum("arrival_delay_secs").alias("delay_sum"))
        .select(F.lit("trip_updates").alias("feed"), F.lit("").alias("reason"), "date_key", "rows", "delay_sum"),
        positions.groupBy(F.col("fetched_date_key").alias("date_key")).agg(F.count_distinct("vehicle_id", "fetched_at_ts").alias("rows"))
        .select(F.lit("vehicle_positions").alias("feed"), F.lit("").alias("reason"), "date_key", "rows", none("bigint").alias("delay_sum"))]
    for feed in JOBS.FEEDS:
        total = F.sum("arrival_delay_secs") if feed == "trip_updates" else F.max(none("bigint"))
        for table, summed in ((feed, total), (f"{feed}_documents", F.max(none("bigint")))):
            parts.append(MF.read_live(spark, f"{lake}/quarantine/{table}").groupBy("reason").agg(
                F.count("*").alias("rows"), summed.alias("delay_sum"))
                .select(F.lit(feed).alias("feed"), "reason", none("int").alias("date_key"), "rows", "delay_sum"))
    return reduce(DataFrame.unionByName, parts)


@register("stream_batch_metrics", O.with_ctes(O.METRICS_SQL, O.POISON_CTES))
def q_stream_batch_metrics(spark, sf_dir):
    """The stored figures of the poisoned run's batches, summed per feed."""
    batches = MF.read_live(spark, f"{_poisoned(spark, sf_dir)}/metrics/feed_batches")
    return batches.groupBy("feed").agg(*[F.sum(c).alias(c) for c in ("documents", "unreadable", "rows", "rejected")])


@register("stream_late_landing", O.with_ctes(O.LATE_LANDING_SQL))
def q_stream_late_landing(spark, sf_dir):
    """Half of the trip updates are landed and loaded before the positions' landing
    appears; the second start loads the rest.  Bronze has every row once."""
    tv = _tv(spark, sf_dir)
    root = tv.scratch("stream-late")
    # of a document's keys, so that each half's documents are made once
    early = F.crc32(F.col("entity_id").cast("binary")) % 2 == 0
    rows = tv.bronze_trip_updates

    def catch_up():
        ST.await_all(ST.start_realtime(spark, f"{root}/tu", f"{root}/vp", f"{root}/lake", f"{root}/checkpoints",
                                       trigger="availableNow", refresh_gold=False))

    land_documents(FL.trip_update_documents(rows.where(early)), f"{root}/tu")
    catch_up()
    land_documents(FL.trip_update_documents(rows.where(~early)), f"{root}/tu")
    land_documents(TVM.vehicle_position_docs(spark, sf_dir), f"{root}/vp")
    catch_up()
    return reduce(DataFrame.unionByName, [
        MF.read_live(spark, f"{root}/lake/bronze/{feed}").groupBy("start_date").agg(F.count("*").alias("rows"))
        .select(F.lit(feed).alias("feed"), "start_date", "rows") for feed in JOBS.FEEDS])


@register("stream_gold_two_starts", O.with_ctes("SELECT * FROM scorecard"))
def q_stream_gold_two_starts(spark, sf_dir):
    """The weekly scorecard after two starts that split a week: the second refresh
    reads the first one's stored cells, no fact, and gives what a full recompute gives."""
    tv = _tv(spark, sf_dir)
    root = tv.scratch("stream-two")
    _store_static(tv, f"{root}/lake")
    # of a document's keys, so that each part's documents are made once
    early = F.col("start_date") < "20250212"     # a Wednesday
    for part in (early, ~early):
        land_documents(FL.trip_update_documents(tv.bronze_trip_updates.where(part)), f"{root}/tu")
        ST.await_all(ST.start_realtime(spark, f"{root}/tu", None, f"{root}/lake", f"{root}/checkpoints", trigger="availableNow"))
    return spark.read.parquet(f"{root}/lake/gold/operator_weekly_scorecard").drop("_refreshed_at")


@register("stream_snapshot_sink", O.with_ctes("SELECT * FROM vp_flat"))
def q_stream_snapshot_sink(spark, sf_dir):
    """Positions as one folder per snapshot stamp, through the streaming file sink; a
    second start adds nothing."""
    tv = _tv(spark, sf_dir)
    root = tv.scratch("stream-snapshots")
    for _ in range(2):
        ST.await_all([ST.start_snapshots(spark, "vehicle_positions", tv.vehicle_position_landing, root,
                                         f"{root}/checkpoint", "availableNow")])
    return spark.read.parquet(f"{root}/vehicle_positions").drop("snapshot")


@register("bronze_compaction", O.with_ctes(f"SELECT {DELAYS_SQL_COLS} FROM delays"))
def q_bronze_compaction(spark, sf_dir):
    """Trip updates in six batches, five of them merged behind a manifest and their
    folders deleted; the delay fact over what the table has now."""
    tv = _tv(spark, sf_dir)
    path = f"{tv.scratch('bronze-compact')}/trip_updates"
    for k in range(6):
        LK.load_bronze_append(tv.bronze_trip_updates.where(F.crc32(F.col("trip_id").cast("binary")) % 6 == k), path, k, "s")
    LK.compact_bronze(spark, path, "s", before=5)
    MF.vacuum(spark, path)
    return delays_out(FACTS.build_realtime_delays(MF.read_live(spark, path)))


@register("static_rejected_rows", O.with_ctes(O.REJECTED_SQL))
def q_static_rejected_rows(spark, sf_dir):
    """Stop times with lines that have too many fields or an open quote: the rows read
    (reason '') and those kept whole in the bad-record table add up to the lines."""
    root = _tv(spark, sf_dir).scratch("landing-rejects")
    rows = TVM.bronze_stop_times(spark, sf_dir)
    key = F.substring("trip_id", 2, 20).cast("long")
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
    lines = rows.select(F.when(key % 101 == 3, F.concat(line, F.lit(",more,fields")))
                        .when(key % 103 == 5, F.concat(line, F.lit('"'))).otherwise(line).alias("value"))
    # one text column under a header that reads as the feed's: every part file gets it
    (lines.toDF(",".join(rows.columns)).write.option("header", True).option("quote", "\u0000").option("delimiter", "\u0001")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/feed/stop_times.txt"))
    good = FD.read_feed_csv(spark, f"{root}/feed", "stop_times", ingested_at="fixed")
    rejected = FD.write_rejected(spark, f"{root}/feed", "stop_times", f"{root}/rejected")
    return (good.select(F.lit("").alias("reason"), "trip_id")
            .unionByName(rejected.select("reason", F.col("first_field").alias("trip_id")))
            .groupBy("reason").agg(F.count("*").alias("rows"), F.count_distinct("trip_id").alias("trips")))
