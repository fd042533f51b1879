"""Static feed scans, realtime documents and their flattening."""

import json
import os

from ferrovia.operators import flatten, quality
from ferrovia.schemas import TRIP_UPDATE_COLUMNS, VEHICLE_POSITION_COLUMNS
from ferrovia.sources import feeds, realtime


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_routes_parsed_by_name(spark, tmp):
    _write(f"{tmp}/feed/routes.txt",
           "route_type,route_id,route_short_name,agency_id,route_long_name\n"
           "3,RA,10,OP1,Harbour - Airport\n0,RB,T1,OP2,Green Line\n")
    df = feeds.read_feed_csv(spark, f"{tmp}/feed", "routes", ingested_at="now")
    assert df.count() == 2
    r = {x.route_id: x for x in df.collect()}
    assert r["RA"].route_type == 3 and r["RB"].route_short_name == "T1" and r["RB"].agency_id == "OP2"
    assert dict(df.dtypes)["route_type"] == "int" and r["RA"].route_color is None
    assert {x._ingested_at for x in df.collect()} == {"now"}


def test_stop_coordinates_are_doubles(spark, tmp):
    _write(f"{tmp}/feed/stops.txt", "stop_id,stop_name,stop_lat,stop_lon\nX1,Quay Street,51.8985,-8.4756\n")
    row = feeds.read_feed_csv(spark, f"{tmp}/feed", "stops").first()
    assert abs(row.stop_lat - 51.8985) < 1e-12 and abs(row.stop_lon + 8.4756) < 1e-12


def test_missing_feed_gives_empty_frame(spark, tmp):
    _write(f"{tmp}/feed/agency.txt", "agency_id,agency_name\nA,B\n")
    df = feeds.read_feed_csv(spark, f"{tmp}/feed", "calendar")
    assert df.count() == 0 and "monday" in df.columns


def test_bom_blanks_nested_and_extra_columns(spark, tmp):
    _write(f"{tmp}/feed/nested/agency.txt",
           "﻿agency_id , agency_name,agency_url,note\nA1,Coach One,http://a,hello\n")
    df = feeds.read_feed_csv(spark, f"{tmp}/feed", "agency")
    assert "agency_id" in df.columns and "agency_name" in df.columns and "note" in df.columns
    assert df.first().agency_id == "A1" and df.first().note == "hello"


def test_bad_rows_and_null_tokens(spark, tmp):
    _write(f"{tmp}/feed/trips.txt",
           "route_id,service_id,trip_id,trip_headsign\n"
           "R1,S1,T1,\"Centre, North\"\n"
           "R1,S1,T2\n"
           "R1,S1,T3,Too,Many,Fields\n"
           "R1,NA,T4,None\n")
    df = feeds.read_feed_csv(spark, f"{tmp}/feed", "trips")
    got = {r.trip_id: r for r in df.collect()}
    assert set(got) == {"T1", "T2", "T4"}                   # long row dropped
    assert got["T1"].trip_headsign == "Centre, North"         # quoted comma kept
    assert got["T2"].trip_headsign is None                    # short row padded
    assert got["T4"].service_id == "NA" and got["T4"].trip_headsign == "None"
    df2 = feeds.read_feed_csv(spark, f"{tmp}/feed", "trips", null_tokens=feeds.PANDAS_NA_TOKENS)
    t4 = [r for r in df2.collect() if r.trip_id == "T4"][0]
    assert t4.service_id is None and t4.trip_headsign is None
    kept = feeds.read_feed_csv(spark, f"{tmp}/feed", "trips", bad_rows="keep")
    assert kept.count() == 4


def test_quoting_and_column_order_per_file(spark, tmp):
    _write(f"{tmp}/feed/stops.txt/a.csv",
           'stop_id,stop_name,stop_lat,stop_lon\n'
           'A,"St ""Quay"", North",51.1,-8.1\nB,"He ""x""",52.0,-7.0\nC,"two\nlines",53.0,-6.0\n')
    _write(f"{tmp}/feed/stops.txt/b.csv", "stop_lon,stop_lat,stop_name,stop_id\n-5.5,54.5,Last,D\n")
    got = {r.stop_id: (r.stop_name, r.stop_lat, r.stop_lon) for r in feeds.read_feed_csv(spark, f"{tmp}/feed", "stops").collect()}
    assert got == {"A": ('St "Quay", North', 51.1, -8.1), "B": ('He "x"', 52.0, -7.0), "C": ("two\nlines", 53.0, -6.0),
                   "D": ("Last", 54.5, -5.5)}
    path = feeds.land_feed_csv(feeds.read_feed_csv(spark, f"{tmp}/feed", "stops").drop("_ingested_at"), f"{tmp}/again", "stops")
    assert path.endswith("stops.txt")
    again = {r.stop_id: (r.stop_name, r.stop_lat, r.stop_lon) for r in feeds.read_feed_csv(spark, f"{tmp}/again", "stops").collect()}
    assert again == got


def test_dirty_numbers_become_null(spark, tmp):
    _write(f"{tmp}/feed/stop_times.txt",
           "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT,7:05:00,7:05:00,S,x\n")
    assert feeds.read_feed_csv(spark, f"{tmp}/feed", "stop_times").first().stop_sequence is None


def test_validation_empty_fails_valid_passes(spark, tmp):
    _write(f"{tmp}/feed/agency.txt", "agency_id,agency_name\nA,One\nB,Two\n")
    good = feeds.read_feed_csv(spark, f"{tmp}/feed", "agency")
    empty = feeds.read_feed_csv(spark, f"{tmp}/feed", "routes")
    v = {r.name: r for r in quality.validate_all({"agency": good, "routes": empty}).collect()}
    assert v["routes"].status == "FAIL" and v["routes"].row_count == 0
    # agency_lang / agency_url / timezone are missing -> 100 % NULL -> WARN, still not a failure
    assert v["agency"].status == "WARN"
    ok = quality.validate(good.select("agency_id", "agency_name"), "agency").first()
    assert ok.status == "PASS" and ok.max_null_pct == 0
    gate = quality.batch_gate(quality.validate_all({"agency": good, "routes": empty})).first()
    assert gate.ok is False and gate.failed_feeds == 1


def test_null_profile_and_row_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None), (4, "y")], "a int, b string")
    prof = {r.column_name: r for r in quality.null_profile(df).collect()}
    assert prof["a"].null_count == 1 and str(prof["a"].null_pct) == "25.00"
    assert prof["b"].null_count == 2 and str(prof["b"].null_pct) == "50.00"
    counts = {r.feed: r.rows for r in quality.feed_row_counts({"x": df, "y": df.limit(1)}).collect()}
    assert counts == {"x": 4, "y": 1, "TOTAL": 5}


TRIP_DOC = {
    "entity": [
        {"id": "e1", "tripUpdate": {
            "trip": {"tripId": "T9", "routeId": "R4", "directionId": 1, "startDate": "20250110"},
            "vehicle": {"id": "BUS7"},
            "stopTimeUpdate": [
                {"stopSequence": 1, "stopId": "SA", "arrival": {"delay": 150, "time": "1736500000"},
                 "departure": {"delay": 95, "time": "1736500030", "uncertainty": 0}},
                {"stopSequence": 2, "stopId": "SB", "arrival": {"delay": 45}},
                {"stopSequence": 3, "stopId": "SC"},
            ]}},
        {"id": "alert-only"},
    ]
}
VEHICLE_DOC = {
    "entity": [
        {"id": "v1", "vehicle": {"trip": {"tripId": "T9", "routeId": "R4"},
                                 "vehicle": {"id": "BUS7", "label": "7"},
                                 "position": {"latitude": 52.66, "longitude": -8.63, "speed": 8.5},
                                 "timestamp": "1736500100"}},
        {"id": "v2"},
    ]
}


def _raw(spark, docs):
    return spark.createDataFrame([(s, json.dumps(d) if not isinstance(d, str) else d) for s, d in docs],
                                 "fetched_at string, value string")


def test_trip_updates_flatten(spark):
    flat = flatten.flatten_trip_updates(_raw(spark, [("2025-01-10T09:00:00Z", TRIP_DOC)]))
    assert flat.columns == TRIP_UPDATE_COLUMNS and len(flat.columns) == 18
    got = {r.stop_id: r for r in flat.collect()}
    assert set(got) == {"SA", "SB", "SC"}                  # entity without tripUpdate -> no rows
    assert got["SA"].arrival_delay_secs == 150 and got["SA"].departure_delay_secs == 95
    assert got["SA"].arrival_time_unix == 1736500000 and got["SA"].vehicle_id == "BUS7"
    assert got["SB"].arrival_time_unix is None and got["SB"].departure_delay_secs is None
    assert got["SC"].arrival_delay_secs is None and got["SC"].stu_schedule_rel == ""
    assert got["SA"].start_time == "" and got["SA"].direction_id == 1


def test_vehicle_positions_flatten(spark):
    flat = flatten.flatten_vehicle_positions(_raw(spark, [("20250110T090000Z", VEHICLE_DOC)]))
    assert flat.columns == VEHICLE_POSITION_COLUMNS
    got = {r.entity_id: r for r in flat.collect()}
    assert set(got) == {"v1", "v2"}                        # vehicle-less entity still one row
    assert got["v1"].latitude == 52.66 and got["v1"].speed_mps == 8.5 and got["v1"].timestamp_unix == 1736500100
    assert got["v2"].vehicle_id == "" and got["v2"].latitude is None


def test_empty_and_invalid_documents(spark):
    raw = _raw(spark, [("s1", {"entity": []}), ("s2", "{not json"), ("s3", {})])
    assert flatten.flatten_trip_updates(raw).count() == 0
    assert flatten.flatten_vehicle_positions(raw).count() == 0


def test_flatten_count_equals_update_array_sizes(spark):
    docs = [(f"s{i}", {"entity": [{"id": "e", "tripUpdate": {"stopTimeUpdate": [{"stopId": str(j)} for j in range(i)]}}]})
            for i in range(6)]
    assert flatten.flatten_trip_updates(_raw(spark, docs)).count() == sum(range(6))


def test_landing_roundtrip_file_and_lines_layouts(spark, tmp):
    _write(f"{tmp}/land/trip_updates_20250110T090000Z.json", json.dumps(TRIP_DOC))
    docs = realtime.read_feed_json(spark, f"{tmp}/land", layout="file")
    assert docs.first().fetched_at == "20250110T090000Z"
    realtime.land_documents(docs, f"{tmp}/lines")
    back = realtime.read_feed_json(spark, f"{tmp}/lines", layout="lines")
    assert back.first().fetched_at == "20250110T090000Z"
    assert flatten.flatten_trip_updates(back).count() == 3


def test_write_sample_and_non_empty(spark, tmp):
    from ferrovia.sources import lake
    df = spark.range(2000).withColumnRenamed("id", "n")
    lake.write_sample(df, f"{tmp}/sample", n=500)
    back = spark.read.option("header", True).csv(f"{tmp}/sample")
    assert back.count() == 500 and back.columns == ["n"]
    assert len([f for f in os.listdir(f"{tmp}/sample") if f.endswith(".csv")]) == 1
    assert quality.check_non_empty(df, "x").first().ok is True
    assert quality.check_non_empty(df.limit(0), "x").first().ok is False


def test_agency_dimension_golden_semantics(spark, tmp):
    from ferrovia.operators import dims
    names = {"G1": "Go-Ahead Ireland", "D1": "Bus Átha Cliath – Dublin Bus", "L1": "LUAS",
             "B1": "Bus Éireann", "G2": "Go-Ahead Ireland", "R1": "Iarnród Éireann / Irish Rail",
             "B2": "Bus Éireann Waterford", None: "Lone Operator"}
    _write(f"{tmp}/feed/agency.txt", "agency_id,agency_name,agency_url,agency_timezone\n"
           + "".join(f"{k or ''},{v},https://op.example/{i},Europe/Dublin\n" for i, (k, v) in enumerate(names.items())))
    dim = {r.agency_id: r.operator_type for r in dims.build_dim_agency(feeds.read_feed_csv(spark, f"{tmp}/feed", "agency")).collect()}
    assert dim == {"G1": "Go-Ahead Ireland", "D1": "Dublin Bus", "L1": "Luas", "B1": "Bus Éireann",
                   "G2": "Go-Ahead Ireland", "R1": "Irish Rail", "B2": "Bus Éireann",
                   "Lone Operator": "Other"}


def test_streaming_file_layout_and_unquoted_numbers(spark, tmp):
    doc = {"entity": [{"id": "e", "tripUpdate": {"trip": {"tripId": "T"}, "stopTimeUpdate": [
        {"stopId": "S", "arrival": {"delay": 5, "time": 1736500000}}]}}]}
    for stamp in ("20250110T080000Z", "20250110T080100Z"):
        _write(f"{tmp}/land/trip_updates_{stamp}.json", json.dumps(doc))
    src = realtime.stream_feed_json(spark, f"{tmp}/land", layout="file", max_files_per_trigger=1)
    flat = flatten.flatten_trip_updates(src)
    q = (flat.writeStream.format("parquet").option("path", f"{tmp}/out")
         .option("checkpointLocation", f"{tmp}/chk").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp}/out").collect()
    assert sorted(r.fetched_at for r in out) == ["20250110T080000Z", "20250110T080100Z"]
    assert {r.arrival_time_unix for r in out} == {1736500000}     # unquoted 64-bit number accepted


def test_first_member_lookup_and_header_cleanup(spark, tmp):
    _write(f"{tmp}/feed/a/stops.txt", "stop_id\nFIRST\n")
    _write(f"{tmp}/feed/b/stops.txt", "stop_id\nSECOND\n")
    files = feeds.find_feed_files(spark, f"{tmp}/feed", "stops")
    assert len(files) == 1 and files[0].endswith("a/stops.txt")
    assert len(feeds.find_feed_files(spark, f"{tmp}/feed", "stops", first_only=False)) == 2
    assert [r.stop_id for r in feeds.read_feed_csv(spark, f"{tmp}/feed", "stops").collect()] == ["FIRST"]
    assert feeds.find_feed_files(spark, f"{tmp}/nowhere", "stops") == []
    df = spark.createDataFrame([(1, 2)], ["﻿a", " b "])
    assert feeds.clean_columns(df).columns == ["a", "b"]


def test_unparsed_stamps_are_counted_and_dropped(spark):
    from ferrovia.operators import facts
    raw = spark.createDataFrame([("20250110T080000Z", "T", 5), ("junk", "T", 6), (None, "T", 7)],
                                "fetched_at string, trip_id string, arrival_delay_secs int")
    raw = raw.select("*", *[__import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast(t).alias(c)
                            for c, t in [("route_id", "string"), ("stop_id", "string"), ("stop_sequence", "int"),
                                         ("direction_id", "int"), ("vehicle_id", "string"),
                                         ("departure_delay_secs", "int"), ("schedule_relationship", "string")]])
    assert facts.unparsed_stamp_count(raw).first().dropped_rows == 2
    assert facts.build_realtime_delays(raw).count() == 1


def test_rejected_rows_are_kept_whole(spark, tmp):
    head = "trip_id,arrival_time,departure_time,stop_id,stop_sequence"
    lines = [head, "T1,07:00:00,07:00:00,S1,1", "", 'T2,07:00:00,07:00:00,"S,2",2', "T3,1,2,S3,3,more,fields",
             'T4,07:00:00,07:00:00,"S4,4', "T5,07:00:00", head]
    _write(f"{tmp}/feed/stop_times.txt", "\n".join(lines) + "\n")
    good = feeds.read_feed_csv(spark, f"{tmp}/feed", "stop_times")
    assert {(r.trip_id, r.stop_id) for r in good.collect()} == {("T1", "S1"), ("T2", "S,2"), ("T5", None)}
    bad = feeds.write_rejected(spark, f"{tmp}/feed", "stop_times", f"{tmp}/rejected")
    assert sorted((r.line, r.reason, r.first_field, r.raw) for r in bad.collect()) == [
        (5, feeds.TOO_MANY_FIELDS, "T3", lines[4]), (6, feeds.UNBALANCED, "T4", lines[5])]
    _write(f"{tmp}/feed/trips.txt", 'route_id,service_id,trip_id\nR1,S1,"T\n1"\nR1,S1,T2,x,"y\nz"\nR1,S1,T3\n')
    bad = feeds.write_rejected(spark, f"{tmp}/feed", "trips", f"{tmp}/rejected2")
    assert [(r.line, r.reason, r.first_field, r.raw.strip()) for r in bad.collect()] == [
        (3, feeds.TOO_MANY_FIELDS, "R1", 'R1,S1,T2,x,"y\nz"')]
    assert feeds.write_rejected(spark, f"{tmp}/feed", "agency", f"{tmp}/rejected3").isEmpty()
