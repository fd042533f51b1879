"""Boundary tables for the classification and time expressions."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ferrovia.functions import classify as C
from ferrovia.functions import metrics as M
from ferrovia.functions import timeparse as T


def _one(spark, expr, value, typ):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_delay_band_boundaries(spark):
    cases = {None: "Unknown", -121: "Early", -61: "Early", -60: "On-Time", 0: "On-Time",
             60: "On-Time", 61: "Minor", 300: "Minor", 301: "Moderate", 900: "Moderate",
             901: "Severe", 5000: "Severe"}
    for secs, band in cases.items():
        assert _one(spark, C.delay_band, secs, "int") == band, secs


def test_minute_period_boundaries(spark):
    cases = {0: "Night", 359: "Night", 360: "Off-Peak", 419: "Off-Peak", 420: "AM Peak",
             570: "AM Peak", 571: "Off-Peak", 1019: "Off-Peak", 1020: "PM Peak",
             1170: "PM Peak", 1171: "Off-Peak", 1439: "Off-Peak"}
    for m, p in cases.items():
        assert _one(spark, C.period_from_minute, m, "int") == p, m


def test_hour_period_boundaries_and_wrap(spark):
    cases = {5: "Night", 6: "Off-Peak", 7: "AM Peak", 9: "AM Peak", 10: "Off-Peak",
             16: "Off-Peak", 17: "PM Peak", 19: "PM Peak", 20: "Off-Peak", 23: "Off-Peak",
             24: "Off-Peak", 25: "Off-Peak", None: "Off-Peak"}
    for h, p in cases.items():
        assert _one(spark, C.period_from_hour, h, "int") == p, h
    assert _one(spark, lambda c: C.period_from_hour(c, wrap=True), 25, "int") == "Night"
    assert _one(spark, lambda c: C.period_from_hour(c, wrap=True), 31, "int") == "AM Peak"


def test_tiers(spark):
    cases = {None: "Poor", "59.99": "Poor", "60.00": "Fair", "74.99": "Fair", "75.00": "Good",
             "89.99": "Good", "90.00": "Excellent", "100.00": "Excellent"}
    for p, t in cases.items():
        v = Decimal(p) if p else None
        assert _one(spark, C.tier, v, "decimal(5,2)") == t
    assert _one(spark, lambda c: C.tier(c, C.DELAY_LABELS), Decimal("75.00"), "decimal(5,2)") == "Minor delays"
    assert _one(spark, lambda c: C.tier(c, C.TIER_COLOURS), None, "decimal(5,2)") == "#E74C3C"


def test_operator_classifier_order_and_case(spark):
    cases = {
        "Bus Átha Cliath – Dublin Bus": "Dublin Bus",
        "bus éireann": "Bus Éireann",
        "Bus Eireann": "Other",            # accent-sensitive
        "Iarnród Éireann / Irish Rail": "Irish Rail",
        "LUAS": "Luas",
        "Go-Ahead Ireland": "Go-Ahead Ireland",
        "Transport for Ireland": "TFI",
        "Some Coach Co": "Other",
        None: "Other",
    }
    for name, op in cases.items():
        assert _one(spark, C.operator_type, name, "string") == op, name


def test_route_type_decode_and_flags(spark):
    df = spark.createDataFrame(
        [(0, "x"), (2, None), (3, "Cross City Link"), (None, "City Express"), (7, "commuter line"), (4, None)],
        "t int, n string")
    out = df.select(C.decode_route_type("t").alias("d"), C.is_cross_city("n").alias("cc"),
                    C.is_commuter("t", "n").alias("cm")).collect()
    assert [r.d for r in out] == ["Tram", "Rail", "Bus", "Unknown", "Unknown", "Ferry"]
    assert [r.cc for r in out] == [False, False, True, False, False, False]
    assert [r.cm for r in out] == [False, True, False, True, True, False]


def test_bbox_corners(spark):
    pts = [(53.25, -6.45, "Dublin"), (53.45, -6.05, "Dublin"), (53.2499, -6.45, "Other"),
           (53.46, -6.2, "Other"), (51.85, -8.65, "Cork"), (52.10, -8.35, "Cork"),
           (53.27, -9.0, "Galway"), (52.65, -8.6, "Limerick"), (52.26, -7.1, "Waterford"),
           (None, None, "Other"), (53.34, -6.25, "Dublin")]
    df = spark.createDataFrame([(a, b) for a, b, _ in pts], "lat double, lon double")
    got = [r.c for r in df.select(C.classify_bbox("lat", "lon").alias("c")).collect()]
    assert got == [c for *_, c in pts]
    cc = [r.c for r in df.select(C.is_city_centre("lat", "lon").alias("c")).collect()]
    assert cc[-1] is True and cc[-2] is False and cc[0] is False


def test_reliability_and_severity(spark):
    df = spark.createDataFrame([(Decimal("80.00"), Decimal("10.00")), (Decimal("50.00"), None), (None, Decimal("5.00"))],
                               "p decimal(5,2), s decimal(5,2)")
    out = df.select(C.reliability_score("p", "s").alias("r"), C.severity_index("p").alias("x")).collect()
    assert out[0].r == Decimal("83.00") and out[1].r == Decimal("65.00") and out[2].r is None
    assert out[0].x == Decimal("20.00") and out[2].x == Decimal("0.00")


def test_exact_metrics_round_half_up(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (0, 0)], "k long, n long")
    got = [r.p for r in df.select(M.pct_from_counts("k", "n").alias("p")).collect()]
    assert got == [Decimal("33.33"), Decimal("66.67"), Decimal("12.50"), None]
    df = spark.createDataFrame([(-3, 1), (3, 1), (-90, 1), (1, 0)], "s long, n long")
    got = [r.m for r in df.select(M.minutes_from_sums("s", "n").alias("m")).collect()]
    assert got == [Decimal("-0.05"), Decimal("0.05"), Decimal("-1.50"), None]


def test_snapshot_stamp_parse_d1(spark):
    df = spark.createDataFrame([("20250101T083500Z",), ("2025-01-01T08:35:00Z",), ("ts",), (None,),
                                ("20251301T083500Z",)], "s string")
    got = [r.t for r in df.select(T.parse_snapshot_ts("s").alias("t")).collect()]
    assert got[0] == got[1] == dt.datetime(2025, 1, 1, 8, 35)
    assert got[2:] == [None, None, None]
    keys = df.select(T.date_key(T.parse_snapshot_ts("s")).alias("k"),
                     F.hour(T.parse_snapshot_ts("s")).alias("h")).collect()
    assert (keys[0].k, keys[0].h) == (20250101, 8) and (keys[1].k, keys[1].h) == (20250101, 8)


def test_service_time_parts_d10(spark):
    df = spark.createDataFrame([("07:05:00",), ("7:05:00",), ("25:59:00",), ("bad",), (None,)], "t string")
    out = df.select(T.service_time_part("t", 1).alias("h"), T.service_time_part("t", 2).alias("m")).collect()
    assert [(r.h, r.m) for r in out] == [(7, 5), (7, 5), (25, 59), (None, None), (None, None)]
    assert df.select(T.trimmed_length(F.lit("12:3 ")).alias("n")).first().n == 4


def test_week_label_one_per_week_d3(spark):
    days = [dt.date(2025, 6, 1) + dt.timedelta(days=i) for i in range(7)]   # Sunday .. Saturday
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select(T.week_start_sunday("d").alias("ws")).select("ws", T.week_label("ws").alias("l")).distinct().collect()
    assert len(out) == 1 and out[0].ws == dt.date(2025, 6, 1) and out[0].l == "2025-W23"
    # across a year end: week starting Sun 28 Dec 2025 is ISO week 1 of 2026, labelled by its start year
    df = spark.createDataFrame([(dt.date(2025, 12, 31),)], "d date")
    r = df.select(T.week_start_sunday("d").alias("ws")).select("ws", T.week_label("ws").alias("l")).first()
    assert r.ws == dt.date(2025, 12, 28) and r.l == "2025-W01"


def test_hour_label_and_trend(spark):
    df = spark.createDataFrame([(7, Decimal("2.00"), Decimal("1.00")), (17, Decimal("1.00"), Decimal("2.00")),
                                (0, Decimal("1.00"), None)], "h int, c decimal(8,2), p decimal(8,2)")
    out = df.select(C.hour_label("h").alias("l"), C.trend_label("c", "p").alias("t")).collect()
    assert [r.l for r in out] == ["07:00", "17:00", "00:00"]
    assert [r.t for r in out] == ["↑ Worsening", "↓ Improving", "→ Stable"]
