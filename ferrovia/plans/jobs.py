"""Batch jobs: static load, realtime micro-batch, Gold refresh.

Lake layout under ``lake``::

    bronze_snapshots/<feed>/snapshot=<stamp>/   static feeds as landed
    bronze/<feed>/                              latest static snapshot
    rejected/<feed>/snapshot=<stamp>/           rows of a static feed that can't be read, whole
    verdicts/snapshot=<stamp>/                  one row per feed: the gate that the load reads
    bronze/trip_updates/source=<id>/batch_id=<n>/   realtime Bronze, one folder per checkpoint and batch
    quarantine/<feed>/, <feed>_documents/       rows and documents that can't be loaded, with the reason
    silver/<table>/                             dimensions and facts
    partials/<cells>/                           partial sums per day, from which Gold is refreshed
    changes/<source>/                           days with new rows, read by the Gold refresh
    metrics/feed_batches/                       one row per feed and batch
    gold/<table>/                               aggregates

Realtime facts and cells have a folder per day and batch, Gold tables one per day
or week, so every incremental step reads and rewrites only what it touches.
``sources.manifest`` merges batch folders without a moment in which rows are there
twice or not at all.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ferrovia.functions import timeparse as T
from ferrovia.operators import dims, facts, flatten, gold, merge, quality
from ferrovia.schemas import TRIP_UPDATES_DOC, VEHICLE_POSITIONS_DOC
from ferrovia.session import apply_conf, child_folders, delete_path, path_exists
from ferrovia.sources import feeds, lake, manifest

STATIC_FEEDS = ["agency", "routes", "stops", "trips", "stop_times", "calendar", "calendar_dates"]
GOLD_PARTITION = {
    "route_daily_performance": "date_key",
    "stop_delay_hotspot": "date_key",
    "hourly_network_pattern": "date_key",
    "operator_weekly_scorecard": "week_start_date",
    "delay_trend_daily": "date_key",
    "route_type_summary": "date_key",
}


def _p(lake_root: str, *parts: str) -> str:
    return "/".join([lake_root.rstrip("/"), *parts])


# ---------------------------------------------------------------------------
# R1 static


def run_static(spark: SparkSession, landing: str, lake_root: str, as_of, stamp: str | None = None,
               null_tokens=None, raise_on_fail: bool = False, samples: str | None = None) -> DataFrame:
    """Landing CSV feeds -> validated snapshots -> Bronze (latest snapshot)
    -> Silver dimensions and the scheduled-departure fact.

    Good feeds are written even when another feed fails; the returned verdict
    frame (one row per feed: rows, worst null share, status, and how many
    malformed rows were dropped: they are in ``rejected/<feed>``, whole) tells which failed, and ``raise_on_fail`` turns
    a failed feed into an error after everything else has been written.
    ``samples`` is a folder for a small CSV sample of each feed.
    """
    apply_conf(spark)
    stamp = stamp or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    snapshots = _p(lake_root, "bronze_snapshots")
    rows = []
    for feed in STATIC_FEEDS:
        # parsed once: the counts behind the verdict are observed while the
        # snapshot is written
        raw = feeds.read_feed_csv(spark, landing, feed, null_tokens=null_tokens, bad_rows="flag")
        bad, seen = Observation(), Observation()
        columns = [c for c in raw.columns if c != feeds.LONG_ROW]
        good = (raw.observe(bad, F.count_if(feeds.LONG_ROW).alias("dropped"))
                .where(~F.col(feeds.LONG_ROW)).select(*columns)
                .observe(seen, F.count(F.lit(1)).alias("rows"),
                         *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(columns)]))
        path = lake.write_snapshot(good, snapshots, feed, stamp)
        counts = seen.get
        rows.append((*quality.verdict(feed, counts["rows"], {c: counts[f"null_{i}"] for i, c in enumerate(columns)}),
                     bad.get["dropped"]))
        if bad.get["dropped"]:
            feeds.write_rejected(spark, landing, feed, _p(lake_root, "rejected", feed, f"snapshot={stamp}"))
        if not counts["rows"]:
            delete_path(spark, path)  # an empty feed never replaces an earlier snapshot
            continue
        latest = lake.read_latest_snapshot(spark, snapshots, feed)
        lake.load_bronze_full(feeds.with_audit(latest, "_loaded_at", now), _p(lake_root, "bronze", feed))
        if samples:
            lake.write_sample(latest, _p(samples, feed))
    verdicts = spark.createDataFrame(
        rows, "name string, row_count long, max_null_pct decimal(5,2), status string, dropped_rows long")
    # the gate: the load reads the verdicts of this snapshot, as stored
    gate = _p(lake_root, "verdicts", f"snapshot={stamp}")
    lake.overwrite_table(verdicts.coalesce(1), gate)
    stored = spark.read.parquet(gate)
    failed = sorted(r["name"] for r in stored.where("status = 'FAIL'").collect())     # one row per feed
    bronze = {f: spark.read.parquet(_p(lake_root, "bronze", f))
              for f in STATIC_FEEDS if path_exists(spark, _p(lake_root, "bronze", f))}
    silver = _p(lake_root, "silver")
    if "agency" in bronze:
        lake.overwrite_table(feeds.with_audit(dims.build_dim_agency(bronze["agency"]), "_updated_at", now),
                             f"{silver}/dim_agency")
    if "routes" in bronze:
        lake.overwrite_table(feeds.with_audit(dims.build_dim_route(bronze["routes"]), "_updated_at", now),
                             f"{silver}/dim_route")
    if "stops" in bronze:
        lake.overwrite_table(feeds.with_audit(dims.build_dim_stop(bronze["stops"]), "_updated_at", now),
                             f"{silver}/dim_stop")
    ensure_calendar(spark, lake_root, as_of)
    if {"stop_times", "trips", "routes"} <= set(bronze):
        sched = facts.build_scheduled_departures(bronze["stop_times"], bronze["trips"],
                                                 bronze["routes"], as_of)
        lake.overwrite_table(feeds.with_audit(sched, "_loaded_at", now), f"{silver}/fact_scheduled_departures")
        schedule_counts(spark, lake_root, rebuild=True)
    if raise_on_fail and not quality.batch_gate(stored).first()["ok"]:
        raise RuntimeError(f"static feeds failed validation: {failed}")
    return verdicts


def ensure_calendar(spark: SparkSession, lake_root: str, as_of) -> None:
    """dim_date: add the missing days of the as_of window (insert-if-absent);
    dim_time_of_day: build once."""
    silver = _p(lake_root, "silver")
    days = dims.build_dim_date(spark, as_of)
    merge.insert_if_absent_table(spark, days, f"{silver}/dim_date", ["date_key"])
    merge.ensure_built(spark, f"{silver}/dim_time_of_day", lambda: dims.build_dim_time_of_day(spark))


# ---------------------------------------------------------------------------
# R2 realtime


def fact_schemas(spark: SparkSession) -> dict:
    """Schemas of the facts, for tables that don't exist before their first row."""
    docs = spark.createDataFrame([], "fetched_at string, value string")
    stops, trips, routes = (feeds.empty_feed(spark, f) for f in ("stop_times", "trips", "routes"))
    loaded = F.lit(None).cast("timestamp")
    return {
        "fact_realtime_delays": facts.build_realtime_delays(flatten.flatten_trip_updates(docs))
        .withColumn("_loaded_at", loaded).schema,
        "fact_vehicle_positions": facts.build_vehicle_positions(flatten.flatten_vehicle_positions(docs))
        .withColumn("_loaded_at", loaded).schema,
        "fact_scheduled_departures": facts.build_scheduled_departures(stops, trips, routes, "2000-01-01")
        .withColumn("_loaded_at", loaded).schema,
    }


@dataclass(frozen=True)
class Feed:
    """What the job knows about a realtime feed."""

    fact: str
    document: StructType
    flatten: Callable[..., DataFrame]
    build: Callable[[DataFrame], DataFrame]
    keys: list[str]
    problem: Callable[[], Column]
    cells: dict[str, Callable[[DataFrame], DataFrame]]


FEEDS = {
    "trip_updates": Feed("fact_realtime_delays", TRIP_UPDATES_DOC, flatten.flatten_trip_updates, facts.build_realtime_delays,
                         ["trip_id", "stop_id", "fetched_at_ts"], facts.delay_problem, gold.DELAY_CELLS),
    "vehicle_positions": Feed("fact_vehicle_positions", VEHICLE_POSITIONS_DOC, flatten.flatten_vehicle_positions,
                              facts.build_vehicle_positions, ["vehicle_id", "fetched_at_ts"], facts.position_problem,
                              gold.POSITION_CELLS),
}
UNREADABLE = "document is not valid"
DAY = "fetched_date_key"


class FeedError(RuntimeError):
    """A feed of a batch failed; the other one and Gold were brought up to date."""


def load_documents(spark: SparkSession, feed: str, docs: DataFrame, lake_root: str, batch_id: int,
                   source: str = "manual") -> dict:
    """One micro-batch of a feed's documents (``fetched_at``, ``value``).  Documents
    that can't be read go whole to ``quarantine/<feed>_documents``; the others are
    flattened and loaded by :func:`load_feed_batch`."""
    f = FEEDS[feed]
    seen = Observation()
    parsed = flatten.parsed_documents(docs, f.document).observe(
        seen, F.count(F.lit(1)).alias("documents"), F.count_if(flatten.is_unreadable()).alias("unreadable"))
    # one pass: the documents are counted while their rows land in Bronze
    out = load_feed_batch(spark, feed, f.flatten(parsed, "doc"), lake_root, batch_id, source, seen)
    if out["unreadable"]:
        bad = flatten.parsed_documents(docs, f.document).where(flatten.is_unreadable())
        manifest.write_batch(bad.select("fetched_at", "value", F.lit(UNREADABLE).alias("reason")),
                             _p(lake_root, "quarantine", f"{feed}_documents"), source, batch_id)
    return out


def load_feed_batch(spark: SparkSession, feed: str, rows: DataFrame, lake_root: str, batch_id: int,
                    source: str = "manual", documents: Observation | None = None) -> dict:
    """One micro-batch of a feed's flattened rows: Bronze, quarantine, Silver, cells.

    Bronze keeps every row as it came.  Rows that can't become facts go to
    ``quarantine/<feed>`` with the reason, so a bad row never stops the batch.
    Silver takes the rows whose key no other batch has, ``partials/`` the sums of
    those rows (see ``gold.delay_cells``), and ``changes/`` the days touched, which
    the Gold refresh follows.  Every table has folders of the batch's own, so a
    replay writes the same again.  Gives the batch's figures, which are also a row
    of ``metrics/feed_batches``.
    """
    apply_conf(spark)
    f = FEEDS[feed]
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    problem, seen = f.problem(), Observation()
    bronze = _p(lake_root, "bronze", feed)
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(problem.isNotNull()).alias("rejected"),
                           F.max(F.when(problem.isNull(), T.parse_snapshot_ts("fetched_at"))).alias("latest"))
    lake.load_bronze_append(feeds.with_audit(counted, "_loaded_at", now), bronze, batch_id, source)
    figures = {"documents": None, "unreadable": 0} | (documents.get if documents else {}) | seen.get
    landed = spark.read.schema(rows.schema).parquet(lake.batch_folder(bronze, source, batch_id))
    if figures["rejected"]:
        manifest.write_batch(landed.withColumn("reason", problem).where("reason is not null"),
                             _p(lake_root, "quarantine", feed), source, batch_id)
    table = _p(lake_root, "silver", f.fact)
    # not kept: the days are read from the stamps alone, and the rows are built as they are written
    fact = feeds.with_audit(f.build(landed.where(problem.isNull())), "_loaded_at", now)
    # the distinct day keys of one batch: a handful of integers
    days = merge.insert_batch(spark, fact, table, f.keys, DAY, source, batch_id, fact.schema)
    own = [manifest.folder_of(DAY, d, source, batch_id) for d in days]
    own = [o for o in own if path_exists(spark, f"{table}/{o}")]
    if own:
        inserted = manifest.read_folders(spark, table, own, fact.schema)
        for name, cells in f.cells.items():
            manifest.write_batch(cells(inserted), _p(lake_root, "partials", name), source, batch_id, DAY)
    if days:
        _note_changes(spark, lake_root, days, source)
    lag = None if figures["latest"] is None else int((now - figures["latest"]).total_seconds())
    row = (feed, figures["documents"], figures["unreadable"], figures["rows"], figures["rejected"], len(days), lag, now)
    manifest.write_batch(spark.createDataFrame([row], METRICS).coalesce(1), _p(lake_root, "metrics", "feed_batches"),
                         source, batch_id, "feed")
    return {k: figures[k] for k in ("documents", "unreadable", "rows", "rejected")} | {"days": sorted(days)}


METRICS = ("feed string, documents long, unreadable long, rows long, rejected long, days int, lag_seconds long, "
           "loaded_at timestamp_ntz")


def _note_changes(spark: SparkSession, lake_root: str, days: list[int], source: str) -> None:
    """Tell the Gold refresh which days have new rows: a small file more, so that a
    replay is told again.  A source has a folder of its own: two appends to one folder
    at a time delete each other's unfinished files."""
    (spark.createDataFrame([(d,) for d in days], CHANGES).coalesce(1).write.mode("append")
     .parquet(_p(lake_root, "changes", source)))


CHANGES = "fetched_date_key int"


def run_realtime_batch(spark: SparkSession, trip_updates: DataFrame | None,
                       positions: DataFrame | None, lake_root: str, batch_id: int,
                       refresh_gold: bool = True, stale: str = "refresh", source: str = "manual") -> dict:
    """One batch of flattened rows of both feeds, then Gold once for the days they
    touched.  A failing feed doesn't stop the other: its error is raised at the end,
    so that the batch is run again.  Returns the rows put aside, per feed."""
    touched: set[int] = set()
    rejected, errors = {}, {}
    for feed, rows in (("trip_updates", trip_updates), ("vehicle_positions", positions)):
        if rows is None:
            continue
        try:
            done = load_feed_batch(spark, feed, rows, lake_root, batch_id, source)
            rejected[feed] = done["rejected"]
            touched.update(done["days"])
        except Exception as e:  # noqa: BLE001 - raised below, after the other feed
            errors[feed] = e
    if refresh_gold and touched:
        run_gold(spark, lake_root, days=sorted(touched), stale=stale)
    if errors:
        raise FeedError(f"feeds that failed in batch {batch_id}: {sorted(errors)}") from next(iter(errors.values()))
    return rejected


# ---------------------------------------------------------------------------
# R3 Gold


def _date(k: int) -> _dt.date:
    return _dt.datetime.strptime(str(k), "%Y%m%d").date()


def _key(d: _dt.date) -> int:
    return int(d.strftime("%Y%m%d"))


def _around(keys, lo: int, hi: int) -> list[int]:
    """Every day key within [k+lo, k+hi] of some key."""
    return sorted({_key(_date(k) + _dt.timedelta(days=i)) for k in keys for i in range(lo, hi + 1)})


def _week_days(keys) -> list[int]:
    """All seven day keys of each Sunday-start week containing a key."""
    out = set()
    for k in keys:
        d = _date(k)
        ws = d - _dt.timedelta(days=(d.weekday() + 1) % 7)
        out.update(_key(ws + _dt.timedelta(days=i)) for i in range(7))
    return sorted(out)


def schedule_counts(spark: SparkSession, lake_root: str, rebuild: bool = False) -> tuple[DataFrame, DataFrame]:
    """Scheduled trips and stops per route, and departures per hour: made when the
    schedule is loaded, so that no refresh reads the schedule itself."""
    silver, out = _p(lake_root, "silver"), []
    schema = fact_schemas(spark)["fact_scheduled_departures"]
    for name, count in (("schedule_by_route", gold.schedule_by_route), ("schedule_by_hour", gold.schedule_by_hour)):
        path = f"{silver}/{name}"
        if rebuild or not path_exists(spark, path):
            lake.overwrite_table(count(lake.table_or_empty(spark, f"{silver}/fact_scheduled_departures", schema)), path)
        out.append(spark.read.parquet(path))
    return tuple(out)


def rebuild_cells(spark: SparkSession, lake_root: str, feed: str, days: list[int]) -> None:
    """The cells of whole days from the fact (of a lake that has none yet)."""
    f = FEEDS[feed]
    schema = fact_schemas(spark)[f.fact]
    rows = manifest.read_live(spark, _p(lake_root, "silver", f.fact), schema, [f"{DAY}={d}" for d in days])
    for name, cells in f.cells.items():
        manifest.write_batch(cells(rows), _p(lake_root, "partials", name), "rebuilt", 0, DAY)


def _cells(spark: SparkSession, lake_root: str, days: list[int]) -> dict[str, DataFrame]:
    """All cells of the given days, by name; days of the facts that have none yet get
    theirs first."""
    out, schemas = {}, fact_schemas(spark)
    for feed, f in FEEDS.items():
        have = {d for name in f.cells for d in child_folders(spark, _p(lake_root, "partials", name))}
        stored = set(child_folders(spark, _p(lake_root, "silver", f.fact)))
        lacking = [d for d in days if f"{DAY}={d}" in stored - have]
        if lacking:
            rebuild_cells(spark, lake_root, feed, lacking)
        empty = spark.createDataFrame([], schemas[f.fact])
        for name, cells in f.cells.items():
            schema = cells(empty).schema
            rows = manifest.read_live(spark, _p(lake_root, "partials", name), schema, [f"{DAY}={d}" for d in days])
            rows = spark.createDataFrame([], schema) if rows is None else rows
            out[name] = rows.withColumnsRenamed({DAY: "date_key", "fetched_hour": "hour_of_day"})
    return out


def gold_from_cells(spark: SparkSession, lake_root: str, days: list[int], rolling_mode: str = "calendar") -> dict[str, DataFrame]:
    """The six Gold tables of the touched ``days`` from stored cells: the day-grained
    tables of exactly those days, the scorecard of the whole weeks around them, the
    rolling trend of the days and the six that follow (fed from six days back).  No
    fact and no schedule is read; the cost follows the cells of these days."""
    silver = _p(lake_root, "silver")
    d_route, d_agency, d_stop, d_date, d_tod = (
        spark.read.parquet(f"{silver}/{name}")
        for name in ("dim_route", "dim_agency", "dim_stop", "dim_date", "dim_time_of_day"))
    by_route, by_hour = schedule_counts(spark, lake_root)
    weeks, around, affected = _week_days(days), _around(days, -6, 6), _around(days, 0, 6)
    cells = _cells(spark, lake_root, sorted({*weeks, *around}))
    of = lambda name, keys: cells[name].where(F.col("date_key").isin(keys))
    delays, vehicles = of("delay_cells", days), of("vehicle_cells", days)
    by_day_route = gold.merged_delays(delays, "date_key", "route_id")
    stops = of("stop_cells", days).groupBy("date_key", "stop_id", "route_id").agg(
        *[F.sum(c).alias(c) for c in ("n", "arr_sum", "arr_n", "k_on_time")])
    per_vehicle = vehicles.groupBy("date_key", "route_id", "vehicle_id").agg(
        F.sum("kmh_sum").alias("kmh_sum"), F.sum("kmh_n").alias("kmh_n"))
    return {
        "route_daily_performance": gold.route_daily_from(
            by_day_route, d_route, d_agency, by_route, gold.merged_vehicles(vehicles, "route_id", "date_key")),
        "stop_delay_hotspot": gold.hotspots_from(stops, d_stop),
        "hourly_network_pattern": gold.hourly_from(
            gold.merged_delays(delays, "date_key", "hour_of_day"), d_tod, d_date, by_hour,
            gold.merged_vehicles(vehicles, "date_key", "hour_of_day")),
        "route_type_summary": gold.route_types_from(
            by_day_route, of("trip_cells", days).select("date_key", "route_id", "trip_id").distinct(), per_vehicle, d_route),
        "operator_weekly_scorecard": gold.scorecard_from(
            gold.merged_delays(of("delay_cells", weeks), "date_key", "route_id"), d_route, d_agency, d_date),
        "delay_trend_daily": gold.trend_from(gold.merged_delays(of("delay_cells", around), "date_key"), d_date, rolling_mode)
        .where(F.col("date_key").isin(affected)),
    }


def gold_from_facts(spark: SparkSession, lake_root: str, rolling_mode: str = "calendar") -> dict[str, DataFrame]:
    """The six Gold tables of all days, from the facts."""
    silver = _p(lake_root, "silver")
    frames = []
    for name, schema in fact_schemas(spark).items():
        rows = (lake.table_or_empty(spark, f"{silver}/{name}", schema) if name == "fact_scheduled_departures"
                else manifest.read_live(spark, f"{silver}/{name}", schema))
        frames.append(spark.createDataFrame([], schema) if rows is None else rows)
    delays, positions, sched = frames
    d_route, d_agency, d_stop, d_date, d_tod = (
        spark.read.parquet(f"{silver}/{name}")
        for name in ("dim_route", "dim_agency", "dim_stop", "dim_date", "dim_time_of_day"))
    return {
        "route_daily_performance": gold.route_daily_performance(delays, d_route, d_agency, sched, positions),
        "stop_delay_hotspot": gold.stop_delay_hotspot(delays, d_stop),
        "hourly_network_pattern": gold.hourly_network_pattern(delays, d_tod, d_date, sched, positions),
        "route_type_summary": gold.route_type_summary(delays, d_route, positions),
        "operator_weekly_scorecard": gold.operator_weekly_scorecard(delays, d_route, d_agency, d_date),
        "delay_trend_daily": gold.delay_trend_daily(delays, d_date, rolling_mode),
    }


def run_gold(spark: SparkSession, lake_root: str, days: list[int] | None = None,
             stale: str = "refresh", rolling_mode: str = "calendar",
             parallel_writes: int = 6) -> dict[str, str]:
    """Bring Gold up to date and upsert it: from the stored cells of the touched
    ``days``, or, without ``days``, all of it from the facts.  ``stale='keep'``
    reproduces the source system's column-subset updates.  Returns the tables'
    folders."""
    apply_conf(spark)
    out = gold_from_facts(spark, lake_root, rolling_mode) if days is None else gold_from_cells(spark, lake_root, days, rolling_mode)
    gold_root = _p(lake_root, "gold")
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    def write(name: str) -> None:
        update = merge.UPDATE_COLUMNS.get(name)
        merge.upsert_table(spark, feeds.with_audit(out[name], "_refreshed_at", now),
                           f"{gold_root}/{name}", merge.GOLD_KEYS[name],
                           update + ["_refreshed_at"] if update else None, stale, GOLD_PARTITION[name])

    # the six tables are independent: submit their jobs concurrently so the
    # cluster works on all of them instead of idling between small jobs
    with ThreadPoolExecutor(max_workers=min(parallel_writes, len(out))) as pool:
        for f in [pool.submit(write, name) for name in out]:
            f.result()
    return {name: f"{gold_root}/{name}" for name in out}
