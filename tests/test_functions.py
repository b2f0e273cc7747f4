"""Scalar functions on literal rows, including every awkward input."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wayline import constants as K
from wayline.functions import geo, matching, parsing, scoring, text


def one(spark, value, expr, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [("  a b ", "a b"), ("　가　", "가"), ("", None), (" \t\n\x1c", None), (None, None), ("\xa0x\x85", "x")],
)
def test_clean_text(spark, raw, want):
    assert one(spark, raw, text.clean_text) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("127.5", Decimal("127.5000000000")), (" 37 ", Decimal("37.0000000000")), ("NaN", None), ("north", None),
        ("99999", None), ("", None), (None, None), ("1.00000000005", Decimal("1.0000000001")),
    ],
)
def test_safe_decimal(spark, raw, want):
    assert one(spark, raw, parsing.safe_decimal) == want


@pytest.mark.parametrize(
    "raw, want", [("12", 12), (" 007 ", 7), ("-3", None), ("1.0", None), ("²", None), ("", None), ("9" * 30, None)]
)
def test_safe_int(spark, raw, want):
    assert one(spark, raw, parsing.safe_int) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("20240102030405", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("20240102", dt.datetime(2024, 1, 2)),
        ("20240102030405999", dt.datetime(2024, 1, 2, 3, 4, 5)),
        ("2024", None), ("20240230", None), ("20240102030460", None), ("20240102240000", None), ("00000101", None),
        ("2024-01-02", None), ("", None), (None, None),
        # Hours that a zone with clock changes would skip stay what they are.
        ("20240310023000", dt.datetime(2024, 3, 10, 2, 30)),
    ],
)
def test_parse_datetime14(spark, raw, want):
    assert one(spark, raw, parsing.parse_datetime14) == want


def test_parsed_time_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, "20240310023000", parsing.parse_datetime14) == dt.datetime(2024, 3, 10, 2, 30)
        day = one(spark, dt.datetime(2024, 1, 1, 16, 0), parsing.run_date, "x timestamp_ntz")
        assert day == dt.date(2024, 1, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("value, want", [(124.0, 124.0), (132.0, 132.0), (123.99, None), (None, None)])
def test_in_range(spark, value, want):
    assert one(spark, value, lambda c: parsing.in_range(c, 124, 132), "x double") == want


def test_truncate_counts_code_points(spark):
    assert one(spark, "가나다라마", lambda c: text.truncate_text(c, 3)) == "가나다"


@pytest.mark.parametrize(
    "code, want",
    [
        (("FD", "FD01"), 1), (("FD", "FD05"), 2), (("SH", "SH01"), 3), (("VE", "VE01"), 4), (("HS", "HS01"), 4),
        (("C01", "C0112"), 4), (("EV", "EV01"), 4), (("NA", "NA01"), 5), (("EX", "EX01"), 6), (("LS", "LS01"), 6),
        (("AC", "AC01"), 7), (("UNKNOWN", None), None), (("FD", None), 1), ((None, None), None),
    ],
)
def test_classify_category(spark, code, want):
    df = spark.createDataFrame([code], "a string, b string")
    assert df.select(scoring.classify_category(F.col("a"), F.col("b"))).first()[0] == want


def test_content_hash_uses_raw_values_and_keeps_empty_places(spark):
    df = spark.createDataFrame([("1", None, " a "), ("1", "", "a")], "x string, y string, z string")
    got = [r[0] for r in df.select(scoring.content_hash([F.col(c) for c in "xyz"], "v1")).collect()]
    assert got[0] == hashlib.sha256("v1|1|| a ".encode()).hexdigest()
    assert got[1] == hashlib.sha256("v1|1||a".encode()).hexdigest()


def test_names_and_suffixes(spark):
    assert one(spark, "강릉 Café (본점) #1", text.normalize_name_strict) == "강릉caf본점1"
    assert one(spark, " 오죽 헌　A ", text.normalize_name_ws) == "오죽헌a"
    assert one(spark, "춘천시", text.strip_region_suffix) == "춘천"
    assert one(spark, "시군시", text.strip_region_suffix) == "시군"
    assert sorted(one(spark, "세종특별자치시", text.region_aliases)) == ["세종", "세종특별자치", "세종특별자치시"]
    assert one(spark, "경기도", text.region_aliases) == ["경기도"]


def test_markup(spark):
    raw = "<b>오죽헌</b>&nbsp;A1&#39;강릉 <a\nhref='x'>맛집"
    assert one(spark, raw, text.strip_markup_keep_script).split() == ["오죽헌", "강릉", "맛집"]
    assert one(spark, raw, text.script_words) == ["오죽헌", "강릉", "맛집"]
    assert one(spark, "가<나", text.strip_markup_keep_script) == "가 나"


def test_document_text(spark):
    df = spark.createDataFrame([(None, "b"), ("a", None)], "t string, c string")
    assert [r[0] for r in df.select(text.document_text(F.col("t"), F.col("c"))).collect()] == [" b", "a "]


def test_rank_tag(spark):
    df = spark.createDataFrame([("카페", 10), ("카페", 11), (None, 1)], "n string, r int")
    assert [r[0] for r in df.select(scoring.rank_tag(F.col("n"), F.col("r"))).collect()] == ["인기 카페 10위", None, None]


def test_distance_of_equal_points_is_zero_and_of_missing_ones_null(spark):
    df = spark.createDataFrame([(37.1234567, 127.7654321), (None, 127.0)], "la double, lo double")
    d = geo.great_circle_distance(F.col("la"), F.col("lo"), F.col("la"), F.col("lo"))
    got = [r[0] for r in df.select(d).collect()]
    assert got[0] == pytest.approx(0, abs=0.2) and got[1] is None


@pytest.mark.parametrize("lat, lon", [(37.5, 127.0), (38.999, 131.9999), (-33.0, 179.9999), (89.9999, 10.0), (0.0, -180.0)])
def test_cells_hold_every_point_in_reach(spark, lat, lon):
    import math

    points = []
    for bearing in range(0, 360, 15):
        for metres in (1.0, 500.0, 999.0):
            b, r = math.radians(bearing), metres / K.EARTH_RADIUS_M
            la, lo = math.radians(lat), math.radians(lon)
            la2 = math.asin(math.sin(la) * math.cos(r) + math.cos(la) * math.sin(r) * math.cos(b))
            lo2 = lo + math.atan2(math.sin(b) * math.sin(r) * math.cos(la), math.cos(r) - math.sin(la) * math.sin(la2))
            points.append((lat, lon, math.degrees(la2), (math.degrees(lo2) + 540) % 360 - 180))
    df = spark.createDataFrame(points, "lat double, lon double, la double, lo double")
    cells = geo.cells_within(F.col("lat"), F.col("lon"), 1000.0)
    own = F.struct(geo.lat_cell(F.col("la")).alias("lat_cell"), geo.lon_cell(F.col("lo")).alias("lon_cell"))
    assert df.where(~F.array_contains(cells, own)).count() == 0
    wide = geo.cells_within(F.col("lat"), F.col("lon"), 150_000.0)
    own = F.struct(geo.lat_cell(F.col("la"), 150_000.0).alias("lat_cell"), geo.lon_cell(F.col("lo"), 150_000.0).alias("lon_cell"))
    assert df.where(~F.array_contains(wide, own)).count() == 0
    assert abs(lat) > 60 or df.where(F.size(wide) > 9).count() == 0


@pytest.mark.parametrize(
    "probe, title, want",
    [
        ("abcd", "abcd", True), ("abcd", "xxabcdxx", True), ("abcdef", "bc", True), ("abc", "abcd", False),
        ("abc", "abc", True), ("abcd", "", False), ("", "", False), ("abcdx", "abcdy", False),
    ],
)
def test_name_containment(spark, probe, title, want):
    df = spark.createDataFrame([(probe, title)], "a string, b string")
    assert df.select(matching.name_containment(F.col("a"), F.col("b"))).first()[0] is want


def test_name_score_and_address(spark):
    df = spark.createDataFrame(
        [("오죽헌", "오죽 헌"), ("오죽헌", "강릉오죽헌점"), ("오죽헌", "경포대"), ("", "")], "k string, n string"
    )
    assert [r[0] for r in df.select(matching.name_score(F.col("k"), F.col("n"))).collect()] == [2, 1, None, None]
    df = spark.createDataFrame([("", "강원 강릉시"), ("길 1", "x"), (None, None)], "r string, a string")
    assert [r[0] for r in df.select(matching.best_address(F.col("r"), F.col("a"))).collect()] == ["강원 강릉시", "길 1", ""]
    df = spark.createDataFrame([("강원 강 릉시 1",), (None,)], "a string")
    assert [r[0] for r in df.select(matching.address_has_token(F.col("a"), [F.lit("강릉"), F.lit("")])).collect()] == [True, False]
