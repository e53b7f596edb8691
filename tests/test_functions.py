import math
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hourgrid.functions import calendar, geo, scores, text


@pytest.mark.parametrize("name, expected", [
    ("IncidentNumber", "incident_number"), ("NIBRS Offense", "nibrs_offense"), ("Zone-Int.", "zone_int"),
    ("A (b)", "a_b"), ("x1Y", "x1_y"), ("ABCode", "ab_code"), ("a/b", "ab"), ("__a__b__", "a_b"),
    ("reportDate2Day", "report_date2_day"), ("[x]{y}", "x_y"), ("a#_b", "a_b"),
])
def test_clean_name(name, expected):
    assert text.clean_name(name) == expected


def test_dates_in_all_layouts(spark):
    given = {
        "1/2/2024 3:04:05 PM": datetime(2024, 1, 2, 15, 4, 5), "01/02/2024 03:04:05 pm": datetime(2024, 1, 2, 15, 4, 5),
        " 12/31/2023 12:00:00 AM ": datetime(2023, 12, 31), "2024-01-02T03:04:05": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04": datetime(2024, 1, 2, 3, 4), "2024-01-02": datetime(2024, 1, 2),
        "1/2/2024": datetime(2024, 1, 2), "1/2/2024 13:14": datetime(2024, 1, 2, 13, 14),
        "January 2, 2024": datetime(2024, 1, 2), "Jan 2 2024": datetime(2024, 1, 2), "2 Jan 2024": datetime(2024, 1, 2),
        "20240102": datetime(2024, 1, 2), "": None, "nan": None, "garbage": None, "13/45/2024": None,
        "13/01/2024 3:04:05 PM": None,
    }
    df = spark.createDataFrame([(k,) for k in given] + [(None,)], "s string")
    got = dict(df.select("s", text.parse_datetime(F.col("s"))).collect())
    assert got == {**given, None: None}


def test_text_rules(spark):
    df = spark.createDataFrame([("Zone 05b",), ("none",), (None,), ("MOTOR VEHICLE THEFT",), ("Armed Robbery",)], "s string")
    out = df.select(
        text.first_number(F.col("s")), text.matches_any(F.col("s"), text.TARGET_TERMS), text.classify(F.col("s"))).collect()
    assert [tuple(r) for r in out] == [
        (5, False, "Other/Misc."), (None, False, "Other/Misc."), (None, False, "Other/Misc."),
        (None, True, "Motor Vehicle Theft"), (None, True, "Burglary/Robbery")]


def test_codes_match_whole_values(spark):
    df = spark.createDataFrame([("220",), ("23A",), ("1220",), (None,)], "c string")
    assert [r[0] for r in df.select(text.matches_code(F.col("c"), ["220", "23.*"])).collect()] == [True, True, False, False]


def test_areas(spark):
    df = spark.createDataFrame([(" a ",), ("zz",), (None,), ("0",), ("nan",)], "s string")
    out = df.select(text.normalise_area(F.col("s"), list("ABC"), "OUT"), text.is_blank_area(F.col("s")))
    assert [tuple(r) for r in out.collect()] == [
        ("A", False), ("OUT", False), ("OUT", True), ("OUT", True), ("OUT", True)]


def test_hour_blocks_at_their_edges(spark):
    df = spark.createDataFrame([(h,) for h in (0, 4, 5, 8, 9, 12, 13, 16, 17, 20, 21, 23, 24)], "h int")
    got = [r[0] for r in df.select(calendar.hour_block(F.col("h"))).collect()]
    assert got == [label for label in calendar.BLOCK_LABELS for _ in (0, 1)] + [None]


def test_week_days(spark):
    sunday = date(2024, 1, 7)
    df = spark.createDataFrame([(sunday + timedelta(days=i),) for i in range(7)], "d date")
    got = df.select(F.dayofweek("d"), calendar.is_weekend(F.col("d")), calendar.hour_of_week(F.col("d").cast("timestamp_ntz")))
    assert [tuple(r) for r in got.collect()] == [(i + 1, i in (0, 6), i * 24) for i in range(7)]


def test_holidays_of_a_year(spark):
    days = spark.sql("SELECT explode(sequence(date'2022-01-01', date'2022-12-31')) AS d")
    got = [r[0].isoformat() for r in days.where(calendar.is_holiday(F.col("d"))).orderBy("d").collect()]
    assert got == [
        "2022-01-01", "2022-01-17", "2022-05-30", "2022-06-19", "2022-06-20", "2022-07-04", "2022-09-05",
        "2022-10-10", "2022-11-11", "2022-11-24", "2022-12-25", "2022-12-26"]


def test_local_hours_collide_in_autumn(spark):
    df = spark.createDataFrame([(1699162200,), (1699165800,)], "e long")
    got = [r[0] for r in df.select(calendar.local_hour(F.col("e"), "America/New_York")).collect()]
    assert got == [datetime(2023, 11, 5, 1, 30)] * 2


def test_haversine_and_mercator(spark):
    one = spark.range(1).select(
        geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), geo.mercator_x(F.lit(180.0)),
        geo.mercator_y(F.lit(0.0))).first()
    assert one[0] == pytest.approx(6371000 * math.pi / 180)
    assert one[1] == pytest.approx(20037508.342789244)
    assert one[2] == pytest.approx(0, abs=1e-6)


def test_cells_at_edges(spark):
    df = spark.createDataFrame([(10.0,), (10.1,), (510.0,), (510.1,)], "x double")
    assert [r[0] for r in df.select(geo.cell_index(F.col("x"), F.lit(10.0), 500)).collect()] == [-1, 0, 0, 1]


SQUARE_WITH_HOLE = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]]


def rings(polygon):
    return [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in polygon]


@pytest.mark.parametrize("x, y, within, intersects", [
    (0.5, 0.5, True, True), (2, 2, False, False), (5, 2, False, False), (4, 2, False, True), (0, 0, False, True),
    (1, 2, False, True), (3.5, 4, False, True), (2, 0.5, True, True), (-1, 4, False, False), (-1, 0, False, False),
])
def test_polygon_with_hole(spark, x, y, within, intersects):
    df = spark.createDataFrame([(rings(SQUARE_WITH_HOLE), float(x), float(y))],
                               "rings array<array<struct<x:double,y:double>>>, x double, y double")
    df = df.select(geo.ring_edges(F.col("rings")).alias("e"), "x", "y")
    got = df.select(geo.covers(F.col("e"), F.col("x"), F.col("y")),
                    geo.covers(F.col("e"), F.col("x"), F.col("y"), "intersects")).first()
    assert tuple(got) == (within, intersects)


def test_polygon_distance(spark):
    df = spark.createDataFrame([(rings(SQUARE_WITH_HOLE), x, y) for x, y in ((7.0, 8.0), (2.0, 2.0), (0.5, 0.5), (6.0, 2.0))],
                               "rings array<array<struct<x:double,y:double>>>, x double, y double")
    df = df.select(geo.ring_edges(F.col("rings")).alias("e"), "x", "y")
    assert [r[0] for r in df.select(geo.polygon_distance(F.col("e"), F.col("x"), F.col("y"))).collect()] == [5, 1, 0, 2]


def test_scores_on_edge_cases(spark):
    df = spark.createDataFrame([("constant", 2.0, 2.0), ("constant", 2.0, 2.0), ("missed", 2.0, 3.0), ("missed", 2.0, 1.0),
                                ("zero", 0.0, 1.0), ("zero", 4.0, 3.0)], "k string, y double, p double")
    got = {r["k"]: r for r in df.groupBy("k").agg(
        *scores.score_columns(F.col("y"), F.col("p")), scores.mape_nonzero(F.col("y"), F.col("p")).alias("nz")).collect()}
    assert got["constant"]["r2"] == 1 and got["constant"]["mae"] == 0
    assert got["missed"]["r2"] == 0 and got["missed"]["rmse"] == 1
    assert got["zero"]["r2"] == pytest.approx(0.75) and got["zero"]["mape"] > 1e11 and got["zero"]["nz"] == pytest.approx(25)


def test_cyclic_wraps(spark):
    sin, cos = calendar.cyclic(F.lit(24), 24)
    got = spark.range(1).select(sin, cos).first()
    assert got[0] == pytest.approx(0, abs=1e-12) and got[1] == pytest.approx(1)


def test_blocks_are_complete():
    assert len(calendar.BLOCK_LABELS) == len(calendar.MODEL_BLOCK_LABELS) == len(calendar.BLOCK_EDGES) - 1


def test_bind_computes_once(spark):
    assert rows(spark.range(2).select(geo.bind(F.col("id") + 1, lambda v: v * v))) == [(1,), (4,)]
