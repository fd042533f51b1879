"""Plan guards: the scale properties the README claims, checked on the plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ferrovia.operators import merge
from ferrovia.plans import catalog, jobs
from ferrovia.plans import testviews as TV
from ferrovia.sources import lake as LK

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream_")))
def test_no_python_no_cross_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for node in [*FORBIDDEN, "RoundRobin"]:
        assert node not in plan, f"{name}: {node}"


def test_merges_and_loads_open_touched_folders_only(spark, tmp, monkeypatch):
    """What the table functions themselves read: the folders of the batch."""
    opened = []
    real = LK.read_partitions

    def spy(spark, path, column, values, schema=None):
        df = real(spark, path, column, values, schema)
        if df is not None:
            opened.extend(sorted({f.rsplit("/", 2)[1] for f in df.inputFiles()}))
        return df

    monkeypatch.setattr(merge, "read_partitions", spy)
    rows = spark.range(30).selectExpr("id", "cast(id % 3 as int) as day", "'old' as v")
    LK.overwrite_table(rows, f"{tmp}/fact", "day")
    batch = spark.range(25, 40).selectExpr("id", "1 as day", "'new' as v")
    merge.insert_if_absent_table(spark, batch, f"{tmp}/fact", ["id"], "day")
    assert opened == ["day=1"] and spark.read.parquet(f"{tmp}/fact").count() == 30 + 15 - 2  # 25 and 28 are there already
    opened.clear()
    LK.overwrite_table(rows, f"{tmp}/gold", "day")
    merge.upsert_table(spark, rows.where("day = 2").withColumn("v", F.lit("new")), f"{tmp}/gold", ["id", "day"], ["v"],
                       "keep", "day")
    assert opened == ["day=2"]
    assert {(r["day"], r["v"]) for r in spark.read.parquet(f"{tmp}/gold").collect()} == {(0, "old"), (1, "old"), (2, "new")}
    for stamp in ("20250101T000000Z", "20250108T000000Z"):
        LK.write_snapshot(rows, f"{tmp}/snapshots", "feed", stamp)
    latest = LK.read_latest_snapshot(spark, f"{tmp}/snapshots", "feed")
    assert {f.rsplit("/", 2)[1] for f in latest.inputFiles()} == {"snapshot=20250108T000000Z"}


def test_incremental_gold_prunes_silver_partitions(spark, tmp):
    tv = TV.TransitViews(spark, SF, persist=None)
    lake = f"{tmp}/lake"
    tv.delays.write.partitionBy("fetched_date_key").parquet(f"{lake}/silver/fact_realtime_delays")
    delays = spark.read.parquet(f"{lake}/silver/fact_realtime_delays")
    part = delays.where(delays.fetched_date_key.isin([20250301]))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fetched_date_key" in plan and "20250301" in plan
    assert jobs._around([20250301], 0, 6)[-1] == 20250307
    assert jobs._week_days([20250301]) == [20250223, 20250224, 20250225, 20250226, 20250227,
                                            20250228, 20250301]


def test_gold_aggregates_partially_before_shuffle(spark):
    plan = _plan(TV.TransitViews(spark, SF, persist=None).route_daily())
    # map-side partial aggregation feeds the first exchange of the fact
    assert "partial_count" in plan and "partial_sum" in plan


def test_facts_are_kept_on_request_only(spark):
    tv = TV.TransitViews(spark, SF)
    assert "InMemoryTableScan" not in _plan(tv.sched) and "InMemoryTableScan" not in _plan(tv.delays)
    tv.hourly(delays=tv.delays.limit(0))        # a table derived twice finds the schedule's counts
    assert "InMemoryTableScan" in _plan(tv.sched.groupBy("departure_hour").agg(F.count(F.lit(1)).alias("scheduled_departures")))
    tv.build_silver()
    try:
        assert "InMemoryTableScan" in _plan(tv.sched.select("trip_id"))
    finally:
        tv.release()
