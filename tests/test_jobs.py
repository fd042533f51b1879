"""Batch jobs and streaming: static load, micro-batch replay, stream = batch."""

import datetime as dt
import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ferrovia.operators import dims, facts, flatten, gold
from ferrovia.plans import jobs
from ferrovia.plans import testviews as TV
from ferrovia.session import SHUFFLE_CLEANUP
from ferrovia.sources import lake as lake_io
from ferrovia.sources import manifest
from ferrovia.sources.realtime import land_documents, stamped_documents
from ferrovia.streaming import realtime as ST
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def test_dim_date_and_time_of_day(spark):
    dd = dims.build_dim_date(spark, dt.date(2025, 6, 1))
    assert dd.count() == 121 and dd.select("date_key").distinct().count() == 121
    r = {x.date_key: x for x in dd.collect()}
    sun, mon = r[20250601], r[20250602]
    assert sun.day_of_week == 7 and sun.is_weekend and sun.day_name == "Sunday" and sun.month_name == "June"
    assert mon.day_of_week == 1 and not mon.is_weekend and mon.is_bank_holiday and mon.week_number == 23
    tod = dims.build_dim_time_of_day(spark)
    t = {x.time_key: x for x in tod.collect()}
    assert len(t) == 1440 and t[930].period == "AM Peak" and t[931].period == "Off-Peak" and t[559].is_night


def test_schedule_guards(spark):
    st = spark.createDataFrame([("T1", "07:00:00", "07:00:00", "S", 1, None), ("T1", "08:00:00", None, "S", 2, 0),
                                ("T1", "09:00:00", "12:3 ", "S", 3, 1), ("T1", "9:10:00", "9:10:00", "S", 4, 1),
                                ("T9", "10:00:00", "10:00:00", "S", 1, 1)],
                               "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int, timepoint int")
    st = st.select("*", F.lit(None).cast("int").alias("pickup_type"), F.lit(None).cast("int").alias("drop_off_type"))
    tr = spark.createDataFrame([("T1", "R1", "SV", 0), ("T9", "RX", "SV", 0)], "trip_id string, route_id string, service_id string, direction_id int")
    ro = spark.createDataFrame([("R1", "A")], "route_id string, agency_id string")
    out = {r.stop_sequence: r for r in facts.build_scheduled_departures(st, tr, ro, "2025-01-10").collect()}
    assert set(out) == {1, 4}                      # NULL / short departure and unknown route dropped
    assert out[1].is_timepoint and out[1].time_period == "AM Peak" and out[1].date_key == 20250110
    assert out[4].departure_hour == 9 and out[4].departure_minute == 10


def _write_csv(df, path):
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def test_run_static_from_csv_feeds(spark, tmp):
    landing = f"{tmp}/landing"
    for name, df in TV.bronze_feeds(spark, SF).items():
        if name in ("agency", "routes", "stops", "trips", "stop_times"):
            out = f"{tmp}/csv/{name}"
            _write_csv(df, out)
            part = [f for f in os.listdir(out) if f.endswith(".csv")][0]
            os.makedirs(landing, exist_ok=True)
            os.rename(f"{out}/{part}", f"{landing}/{name}.txt")
    with open(f"{landing}/agency.txt", "a", encoding="utf-8") as f:
        f.write("too,many,fields,in,this,row,for,the,header,of,agency\n")
    out = jobs.run_static(spark, landing, f"{tmp}/lake", TV.AS_OF, samples=f"{tmp}/samples").collect()
    verdicts = {r.name: r.status for r in out}
    assert {r.name: r.dropped_rows for r in out if r.dropped_rows} == {"agency": 1}
    assert spark.read.option("header", True).csv(f"{tmp}/samples/stops").count() == 200
    assert "_loaded_at" in spark.read.parquet(f"{tmp}/lake/bronze/stops").columns
    assert verdicts["calendar"] == "FAIL" and verdicts["stops"] in ("PASS", "WARN")
    silver = f"{tmp}/lake/silver"
    tv = TV.TransitViews(spark, SF, persist=None)
    written = spark.read.parquet(f"{silver}/dim_route")
    assert "_updated_at" in written.columns
    assert rows(written.drop("_updated_at")) == rows(tv.dim_route)
    assert spark.read.parquet(f"{silver}/fact_scheduled_departures").count() == tv.sched.count()
    assert spark.read.parquet(f"{silver}/dim_date").count() == 121
    # second weekly run: latest snapshot only, no duplicated keys; a failed
    # feed (calendar is absent) is an error once the good feeds are written
    import pytest
    with pytest.raises(RuntimeError, match="calendar"):
        jobs.run_static(spark, landing, f"{tmp}/lake", TV.AS_OF, raise_on_fail=True)
    assert spark.read.parquet(f"{tmp}/lake/bronze/routes").count() == tv.dim_route.count()


def _static_silver(spark, lake):
    tv = TV.TransitViews(spark, SF, persist=None)
    s = f"{lake}/silver"
    for name, df in [("dim_route", tv.dim_route), ("dim_agency", tv.dim_agency), ("dim_stop", tv.dim_stop),
                     ("dim_date", tv.dim_date), ("dim_time_of_day", tv.dim_tod),
                     ("fact_scheduled_departures", tv.sched)]:
        df.write.mode("overwrite").parquet(f"{s}/{name}")
    return tv


def test_realtime_batches_replay_and_incremental_gold(spark, tmp):
    lake = f"{tmp}/lake"
    tv = _static_silver(spark, lake)
    tu = TV.bronze_trip_updates(spark, SF)
    vp = TV.bronze_vehicle_positions(spark, SF)
    k = F.col("fetched_at")
    first, second = tu.where(k < "2025-02"), tu.where(k >= "2025-02")
    jobs.run_realtime_batch(spark, first, vp, lake, 0)
    jobs.run_realtime_batch(spark, second, None, lake, 1)
    jobs.run_realtime_batch(spark, second, None, lake, 1)        # replayed batch
    silver = spark.read.parquet(f"{lake}/silver/fact_realtime_delays")
    assert silver.count() == tv.delays.count()
    got = spark.read.parquet(f"{lake}/gold/route_daily_performance")
    want = tv.route_daily()
    cols = want.columns
    assert rows(got.select(*cols)) == rows(want)
    trend = spark.read.parquet(f"{lake}/gold/delay_trend_daily")
    assert rows(trend.select(*tv.trend().columns)) == rows(tv.trend())
    sc = spark.read.parquet(f"{lake}/gold/operator_weekly_scorecard")
    assert rows(sc.select(*tv.scorecard().columns)) == rows(tv.scorecard())


def test_one_feed_alone_and_a_failing_feed(spark, tmp):
    import pytest
    lake = f"{tmp}/lake"
    tv = _static_silver(spark, lake)
    tu = TV.bronze_trip_updates(spark, SF)
    dropped = jobs.run_realtime_batch(spark, tu, None, lake, 0)    # no position was ever landed
    got = spark.read.parquet(f"{lake}/gold/route_daily_performance")
    assert got.count() == tv.route_daily().count() and got.where("active_vehicles is not null").isEmpty()
    assert dropped == {"trip_updates": tu.count() - tv.delays.count()}
    # positions that can't be built into facts: the other feed and Gold go on
    broken = TV.bronze_vehicle_positions(spark, SF).drop("speed_mps")
    late = tu.limit(5).withColumn("fetched_at", F.lit("20250401T080000Z"))
    with pytest.raises(jobs.FeedError, match="vehicle_positions"):
        jobs.run_realtime_batch(spark, late, broken, lake, 1)
    assert spark.read.parquet(f"{lake}/silver/fact_realtime_delays").where("fetched_date_key = 20250401").count() == 5


def test_both_feeds_stream_with_gold(spark, tmp):
    lake = f"{tmp}/lake"
    tv = _static_silver(spark, lake)
    land_documents(TV.trip_update_docs(spark, SF).repartition(2, F.get_json_object("value", "$.entity[0].tripUpdate.trip.tripId")),
                   f"{tmp}/tu")
    land_documents(TV.vehicle_position_docs(spark, SF).repartition(2), f"{tmp}/vp")
    for _ in range(2):   # the second start finds nothing new
        ST.await_all(ST.start_realtime(spark, f"{tmp}/tu", f"{tmp}/vp", lake, f"{tmp}/chk", trigger="availableNow",
                                       max_files_per_trigger=1))
    assert spark.read.parquet(f"{lake}/silver/fact_realtime_delays").count() == tv.delays.count()
    trend = spark.read.parquet(f"{lake}/gold/delay_trend_daily")
    assert rows(trend.select(*tv.trend().columns)) == rows(tv.trend())
    # another checkpoint counts its batches from 0 again; Bronze keeps both
    before = spark.read.parquet(f"{lake}/bronze/trip_updates").count()
    ST.await_all(ST.start_realtime(spark, f"{tmp}/tu", f"{tmp}/nowhere", lake, f"{tmp}/chk2", trigger="availableNow",
                                   refresh_gold=False))
    assert spark.read.parquet(f"{lake}/bronze/trip_updates").count() == 2 * before
    assert spark.read.parquet(f"{lake}/silver/fact_realtime_delays").count() == tv.delays.count()


def test_feeds_note_changes_at_the_same_time(spark, tmp):
    lake = f"{tmp}/lake"

    def note(k):
        for _ in range(10):
            jobs._note_changes(spark, lake, [20250101 + k], f"s{k}")

    with ThreadPoolExecutor(max_workers=2) as pool:
        for f in [pool.submit(note, k) for k in range(2)]:
            f.result()
    jobs._note_changes(spark, lake, [20250103], "")        # as an earlier version left them
    notes = spark.readStream.schema(jobs.CHANGES).option("recursiveFileLookup", "true").parquet(f"{lake}/changes")
    q = notes.writeStream.format("memory").queryName("noted").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("noted").groupBy("fetched_date_key").count()) == [(20250101, 10), (20250102, 10), (20250103, 1)]


def test_bronze_compaction(spark, tmp):
    base, want = f"{tmp}/b", sorted(i for k in range(4) for i in range(k, k + 3))
    ids = lambda df: sorted(r.id for r in df.collect())
    for k in range(4):
        lake_io.load_bronze_append(spark.range(k, k + 3).withColumn("fetched_at", F.lit("x")), base, k, "s")
    before = manifest.read_live(spark, base)
    assert lake_io.compact_bronze(spark, base, "s", before=3) == 3
    # a reader that listed the table before sees the same rows as one that lists it now
    assert ids(before) == ids(manifest.read_live(spark, base)) == want
    assert len(manifest.live_folders(spark, base)) == 2
    # a copy that was written but never named by a manifest is not part of the table
    spark.range(5).write.parquet(f"{base}/_merged/source=s/batch_id=9")
    assert ids(manifest.read_live(spark, base)) == want
    lake_io.load_bronze_append(spark.range(9).withColumn("fetched_at", F.lit("x")), base, 4, "s")
    assert lake_io.compact_bronze(spark, base, "s", before=5) == 3      # the merged folder, 3 and 4
    assert manifest.vacuum(spark, base) == 7      # five batches, the copy, the first merged folder
    assert ids(manifest.read_live(spark, base)) == sorted(want + list(range(9)))
    assert lake_io.compact_bronze(spark, base, "s", before=5) == 0 and manifest.vacuum(spark, base) == 0


def test_fact_compaction_keeps_gold(spark, tmp):
    lake = f"{tmp}/lake"
    tv = _static_silver(spark, lake)
    tu = TV.bronze_trip_updates(spark, SF)
    day = F.col("start_date") == "20250120"
    for k in range(3):
        jobs.run_realtime_batch(spark, tu.where(day & (F.crc32("trip_id") % 3 == k)), None, lake, k, refresh_gold=False)
    fact = f"{lake}/silver/fact_realtime_delays"
    want = tv.delays.where("fetched_date_key = 20250120").count()
    assert lake_io.compact_facts(spark, fact, 20250120) == 3
    for name in jobs.FEEDS["trip_updates"].cells:
        assert lake_io.compact_facts(spark, f"{lake}/partials/{name}", 20250120) == 3
    assert manifest.read_live(spark, fact).count() == want > 0
    manifest.vacuum(spark, fact)
    jobs.run_realtime_batch(spark, tu.where(day), None, lake, 3)        # all of it is there already
    assert manifest.read_live(spark, fact).count() == want
    got = spark.read.parquet(f"{lake}/gold/route_daily_performance").drop("_refreshed_at", "active_vehicles", "avg_speed_kmh")
    assert rows(got.select(*sorted(got.columns))) == rows(
        tv.route_daily().where("date_key = 20250120").select(*sorted(got.columns)))


def _land(path, *documents):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{len(os.listdir(path))}.json", "w", encoding="utf-8") as f:
        f.writelines(d + "\n" for d in documents)


def _position(vehicle, speed, stamp="20250120T080000Z"):
    return json.dumps({"fetched_at": stamp, "entity": [{"id": vehicle, "vehicle": {
        "trip": {"tripId": "T1", "routeId": "R1"}, "vehicle": {"id": vehicle}, "position": {"speed": speed}}}]})


def _update(trip, delay, stamp="20250120T080000Z"):
    return json.dumps({"fetched_at": stamp, "entity": [{"id": trip, "tripUpdate": {
        "trip": {"tripId": trip, "routeId": "R1"}, "stopTimeUpdate": [{"stopId": "S1", "arrival": {"delay": delay}}]}}]})


def test_poison_rows_are_put_aside(spark, tmp):
    lake = f"{tmp}/lake"
    _static_silver(spark, lake)
    start = lambda: ST.await_all(ST.start_realtime(
        spark, f"{tmp}/tu", f"{tmp}/vp", lake, f"{tmp}/chk", trigger="availableNow"))
    _land(f"{tmp}/vp", _position("V1", 10), _position("V2", 1e9), _position("V3", None), _position("V4", 5, "junk"),
          '{"fetched_at": "20250120T080000Z", "entity": [', _position("V5", 5, "+250000-01-01T00:00:00Z"))
    _land(f"{tmp}/tu", _update("T1", 60), _update("T2", 2_000_000_000), "not a document", _update("T3", None))
    start()
    _land(f"{tmp}/vp", _position("V9", 7, "20250121T080000Z"))
    _land(f"{tmp}/tu", _update("T9", 60, "20250121T080000Z"))
    start()
    read = lambda t: manifest.read_live(spark, f"{lake}/{t}")
    assert rows(read("silver/fact_vehicle_positions"), "vehicle_id") == [("V1",), ("V3",), ("V9",)]
    assert rows(read("silver/fact_realtime_delays"), "trip_id") == [("T1",), ("T3",), ("T9",)]
    assert rows(read("quarantine/vehicle_positions"), "vehicle_id", "reason") == [
        ("V2", "speed_mps out of range"), ("V4", facts.NO_STAMP), ("V5", facts.NO_STAMP)]
    assert rows(read("quarantine/trip_updates"), "trip_id", "reason") == [("T2", "arrival_delay_secs out of range")]
    assert rows(read("quarantine/trip_updates_documents"), "value", "reason") == [("not a document", jobs.UNREADABLE)]
    assert read("quarantine/vehicle_positions_documents").count() == 1
    figures = read("metrics/feed_batches").groupBy("feed").agg(
        *[F.sum(c).cast("int") for c in ("documents", "unreadable", "rows", "rejected")])
    assert rows(figures) == [("trip_updates", 5, 1, 4, 1), ("vehicle_positions", 7, 1, 6, 3)]
    assert read("bronze/vehicle_positions").count() == 6       # Bronze keeps every row
    trend = spark.read.parquet(f"{lake}/gold/delay_trend_daily")
    assert rows(trend, "date_key", "total_observations") == [(20250120, 2), (20250121, 1)]


def test_landing_that_appears_later(spark, tmp):
    lake = f"{tmp}/lake"
    _static_silver(spark, lake)
    start = lambda: ST.await_all(ST.start_realtime(
        spark, f"{tmp}/tu", f"{tmp}/vp", lake, f"{tmp}/chk", trigger="availableNow"))
    _land(f"{tmp}/tu", *[_update(f"T{i}", 60) for i in range(20)])
    with pytest.warns(UserWarning, match="vehicle_positions"):
        start()
    _land(f"{tmp}/vp", _position("V1", 10))
    _land(f"{tmp}/tu", _update("T99", 60))
    start()
    assert manifest.read_live(spark, f"{lake}/bronze/trip_updates").count() == 21
    assert manifest.read_live(spark, f"{lake}/silver/fact_vehicle_positions").count() == 1


def test_a_failing_feed_stops_alone(spark, tmp, monkeypatch):
    lake = f"{tmp}/lake"
    _static_silver(spark, lake)
    _land(f"{tmp}/tu", _update("T1", 60))
    _land(f"{tmp}/vp", _position("V1", 10))
    real = jobs.load_documents

    def fails(spark_, feed, *a):
        if feed == "vehicle_positions":
            raise OSError("store is away")
        return real(spark_, feed, *a)

    monkeypatch.setattr(jobs, "load_documents", fails)
    with pytest.raises(RuntimeError, match="store is away"):
        ST.await_all(ST.start_realtime(spark, f"{tmp}/tu", f"{tmp}/vp", lake, f"{tmp}/chk", trigger="availableNow"))
    assert spark.read.parquet(f"{lake}/gold/delay_trend_daily").count() == 1        # Gold follows the other feed
    monkeypatch.setattr(jobs, "load_documents", real)
    ST.await_all(ST.start_realtime(spark, f"{tmp}/tu", f"{tmp}/vp", lake, f"{tmp}/chk", trigger="availableNow"))
    assert manifest.read_live(spark, f"{lake}/silver/fact_vehicle_positions").count() == 1
    assert spark.read.parquet(f"{lake}/gold/route_daily_performance").first()["active_vehicles"] == 1


def test_gold_from_cells_equals_gold_from_facts(spark, tmp):
    lake = f"{tmp}/lake"
    _static_silver(spark, lake)
    fortnight = F.col("start_date").between("20250201", "20250214")
    tu, vp = TV.bronze_trip_updates(spark, SF).where(fortnight), TV.bronze_vehicle_positions(spark, SF).where(fortnight)
    for k in range(2):
        jobs.run_realtime_batch(spark, tu.where(F.crc32("trip_id") % 2 == k), vp.where(F.crc32("vehicle_id") % 2 == k),
                                lake, k, refresh_gold=False)
    days = [r[0] for r in manifest.read_live(spark, f"{lake}/silver/fact_realtime_delays").select(jobs.DAY).distinct().collect()]
    some = sorted(days)[3:6]
    full, part = jobs.gold_from_facts(spark, lake), jobs.gold_from_cells(spark, lake, some)
    for name, column in jobs.GOLD_PARTITION.items():
        keys = [r[0] for r in part[name].select(column).distinct().collect()]
        assert len(keys) == {"operator_weekly_scorecard": 1, "delay_trend_daily": 9}.get(name, 3), name
        assert rows(part[name]) == rows(full[name].where(F.col(column).isin(keys))), name
        # neither a fact nor the schedule is read
        files = part[name].inputFiles()
        assert files and not any("/silver/fact_" in f for f in files), name
    # cells that are missing come from the fact
    import shutil
    for name in gold.DELAY_CELLS:
        shutil.rmtree(f"{lake}/partials/{name}/fetched_date_key={some[0]}")
    assert rows(jobs.gold_from_cells(spark, lake, some)["delay_trend_daily"]) == rows(part["delay_trend_daily"])


def test_polls_end_by_themselves(spark, tmp):
    lake = f"{tmp}/lake"
    _static_silver(spark, lake)
    for i in range(3):
        _land(f"{tmp}/tu", _update(f"T{i}", 60))
    failed = ST.run_polls(spark, f"{tmp}/tu", None, lake, f"{tmp}/chk", polls=4, interval="2 seconds", timeout=120,
                          max_files_per_trigger=1)
    assert failed == {}
    progress = spark.read.parquet(f"{lake}/metrics/progress")
    assert progress.where("query like 'trip_updates%'").agg(F.sum("input_rows")).first()[0] == 3
    assert spark.read.parquet(f"{lake}/gold/delay_trend_daily").first()["total_observations"] == 3


def test_late_rows_are_counted(spark, tmp):
    progress = ST.ProgressTable(spark, f"{tmp}/progress")
    spark.streams.addListener(progress)
    for i, stamp in enumerate(["20250120T200000Z", "20250120T210000Z", "20250120T010000Z", "20250120T010500Z"]):
        _land(f"{tmp}/vp", _position(f"V{i}", 10, stamp))
        os.utime(f"{tmp}/vp/{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    q = ST.start_hourly_windows(spark, f"{tmp}/vp", f"{tmp}/w", f"{tmp}/chk", "availableNow", "2 hours", 1)
    ST.await_all([q])
    deadline = time.monotonic() + 30
    while progress.late_rows[str(q.id)] < 2 and time.monotonic() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(progress)
    progress.flush()
    assert progress.late_rows[str(q.id)] == 2 == spark.read.parquet(f"{tmp}/progress").agg(F.sum("late_rows")).first()[0]


def test_snapshot_sink(spark, tmp):
    docs = TV.vehicle_position_docs(spark, SF)
    land_documents(docs, f"{tmp}/vp")
    want = flatten.flatten_vehicle_positions(docs)
    for _ in range(2):      # the second start finds nothing new
        ST.await_all([ST.start_snapshots(spark, "vehicle_positions", f"{tmp}/vp", f"{tmp}/snap", f"{tmp}/chk", "availableNow")])
    got = spark.read.parquet(f"{tmp}/snap/vehicle_positions")
    assert rows(got.select(*want.columns)) == rows(want)
    assert got.where("snapshot <> fetched_at").isEmpty()
    # files of a batch that was never committed are not read
    import shutil
    name = next(os.path.join(d, f) for d, _, fs in os.walk(f"{tmp}/snap/vehicle_positions") for f in fs if f.endswith(".parquet"))
    shutil.copy(name, name.replace("part-", "part-x"))
    assert spark.read.parquet(f"{tmp}/snap/vehicle_positions").count() == want.count()


def test_stream_equals_batch(spark, tmp):
    docs = TV.trip_update_docs(spark, SF)
    trip = F.get_json_object("value", "$.entity[0].tripUpdate.trip.tripId")
    land_documents(docs.repartition(4, trip), f"{tmp}/landing/tu")
    qs = ST.start_realtime(spark, f"{tmp}/landing/tu", None, f"{tmp}/lake", f"{tmp}/chk",
                           trigger="availableNow", refresh_gold=False, max_files_per_trigger=1)
    ST.await_all(qs)
    streamed = spark.read.parquet(f"{tmp}/lake/silver/fact_realtime_delays")
    batch = facts.build_realtime_delays(flatten.flatten_trip_updates(docs))
    cols = [c for c in batch.columns]
    assert rows(streamed.select(*cols)) == rows(batch)
    # a restart over the same checkpoint finds nothing new
    qs = ST.start_realtime(spark, f"{tmp}/landing/tu", None, f"{tmp}/lake", f"{tmp}/chk",
                           trigger="availableNow", refresh_gold=False)
    ST.await_all(qs)
    assert spark.read.parquet(f"{tmp}/lake/silver/fact_realtime_delays").count() == streamed.count()


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def _left_over(spark, before: set[str], wait: float = 20) -> set[str]:
    """Shuffle files that came since ``before`` and are still there after a while."""
    until = time.monotonic() + wait
    while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    return left


def test_landing_is_compressed_and_leaves_no_shuffle(spark, tmp):
    docs = TV.trip_update_docs(spark, SF)
    before = _shuffle_files(spark)
    for _ in range(2):      # a landing is appended to
        land_documents(docs, f"{tmp}/tu")
    assert not _left_over(spark, before)
    names = [n for n in os.listdir(f"{tmp}/tu") if n.startswith("part-")]
    assert names and all(n.endswith(".txt.gz") for n in names)
    raw = stamped_documents(docs).agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert sum(os.path.getsize(f"{tmp}/tu/{n}") for n in names) < 2 * raw / 5
    assert rows(spark.read.text(f"{tmp}/tu")) == rows(stamped_documents(docs.unionByName(docs)))


def test_batches_leave_no_shuffle(spark, tmp):
    land_documents(TV.vehicle_position_docs(spark, SF), f"{tmp}/vp")
    before = _shuffle_files(spark)
    ST.await_all(ST.start_realtime(spark, None, f"{tmp}/vp", f"{tmp}/lake", f"{tmp}/chk", trigger="availableNow", refresh_gold=False))
    assert not _left_over(spark, before)
    assert manifest.read_live(spark, f"{tmp}/lake/silver/fact_vehicle_positions").count() > 0
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"       # the session's own queries are as before


def test_dedupe_within_watermark_stream(spark, tmp):
    import json
    os.makedirs(f"{tmp}/land", exist_ok=True)
    doc = {"entity": [{"id": "e", "tripUpdate": {"trip": {"tripId": "T"}, "stopTimeUpdate": [{"stopId": "S"}]}}]}
    for i in range(2):
        with open(f"{tmp}/land/f{i}.json", "w") as f:
            f.write(json.dumps({"fetched_at": "20250110T080000Z", **doc}) + "\n")
    from ferrovia.sources.realtime import stream_feed_json
    src = stream_feed_json(spark, f"{tmp}/land", max_files_per_trigger=1)
    fact = facts.build_realtime_delays(flatten.flatten_trip_updates(src))
    d = ST.dedupe_within_watermark(fact, ["trip_id", "stop_id", "fetched_at_ts"])
    q = (d.writeStream.format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/chk").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp}/out").count() == 1


def test_command_line_static(spark, tmp):
    from ferrovia.__main__ import main
    os.makedirs(f"{tmp}/landing", exist_ok=True)
    with open(f"{tmp}/landing/agency.txt", "w", encoding="utf-8") as f:
        f.write("agency_id,agency_name,agency_url,agency_timezone\nA,LUAS,https://x,Europe/Dublin\n")
    with open(f"{tmp}/landing/routes.txt", "w", encoding="utf-8") as f:
        f.write("route_id,agency_id,route_short_name,route_long_name,route_type\nR,A,G,Green Line,0\n")
    assert main(["static", "--landing", f"{tmp}/landing", "--lake", f"{tmp}/lake", "--as-of", "2025-01-10"]) == 0
    assert spark.read.parquet(f"{tmp}/lake/silver/dim_agency").first().operator_type == "Luas"
    assert main(["static", "--landing", f"{tmp}/landing", "--lake", f"{tmp}/lake2",
                 "--as-of", "2025-01-10", "--fail-on-error"]) == 1


def test_hourly_windows_have_few_state_partitions(spark, tmp):
    land_documents(TV.vehicle_position_docs(spark, SF).limit(50), f"{tmp}/vp")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        q = ST.start_hourly_windows(spark, f"{tmp}/vp", f"{tmp}/w", f"{tmp}/chk", "availableNow", "70 days")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20"
        ST.await_all([q])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = [n for n in os.listdir(f"{tmp}/chk/state/0") if n.isdigit()]
    assert len(parts) == ST.WINDOW_PARTITIONS
    assert spark.read.parquet(f"{tmp}/w").agg(F.sum("positions")).first()[0] > 0


def test_a_batch_keeps_no_fact(spark, tmp, monkeypatch):
    kept = []
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda df, *a: kept.append(df) or df)
    rows_in = TV.bronze_trip_updates(spark, SF).where("start_date = '20250120'")
    out = jobs.load_feed_batch(spark, "trip_updates", rows_in, f"{tmp}/lake", 0)
    assert not kept and out["days"] == [20250120]
