"""Pure functions: normal forms, scores, numbers and display names."""

import pytest
from pyspark.sql import functions as F

from curatio.functions import display, numbers, text
from curatio.functions.similarity import name_similarity, token_set


def one(spark, column, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("f", "name", "expected"),
    [
        (text.normalize_lookup, "Hornady® Inc.", "hornady inc"),
        (text.normalize_lookup, "ELD-X  (.308)", "eld x .308"),
        (text.normalize_match, "ELD–X™ Match,", "eld-x match"),
        (text.normalize_caliber, ".308 Win.", "308 win"),
        (text.normalize_product_line, "Barnes Triple-Shock X Bullet (TSX)", "tsx"),
        (text.normalize_product_line, "Sierra MatchKing Bullets", "matchking"),
        (text.normalize_product_line, "ELD-X (50ct)", "eld-x"),
        (text.slugify, "Gold Medal™ Match!", "gold-medal-match"),
    ],
)
def test_normal_forms(spark, f, name, expected):
    assert one(spark, f(F.col("n")), n=name) == expected


def test_abbreviations_go_both_ways(spark):
    a = one(spark, text.expand_abbreviations(F.split("n", " ")), n="hpbt matchking")
    assert {"hollow", "point", "boat", "tail", "bthp", "hp", "bt"} <= set(a)
    assert "hpbt" in one(spark, text.expand_abbreviations(F.split("n", " ")), n="boat tail hollow point")


def test_containment(spark):
    score = lambda a, b: one(spark, text.containment_score(F.col("a"), F.col("b")), a=a, b=b)
    assert score("ELD-X", "30 Cal .308 178 gr ELD-X®") == 1.0
    assert score("SST (Super Shock Tip)", "30 Cal 150 gr SST®") == 0.75
    assert score("ELD-X", "30 Cal 178 gr ELD Match") < 0.5
    assert score("140 gr", "anything") == 0.0


def test_token_sets(spark):
    assert token_set("a b c", "c b a") == 1.0
    assert token_set("eld match", "30 cal eld match") == 1.0
    assert token_set("hornady", "federal") == pytest.approx(2 / 7)
    assert token_set("hornday", "hornady") == pytest.approx(6 / 7)
    assert token_set("", "x") == 0.0
    assert one(spark, name_similarity(F.col("a"), F.col("b")), a="Hornady®", b="hornady") == 1.0


def test_numbers(spark):
    assert one(spark, numbers.lenient_float(F.col("x")), x=" 6,5 ") == 6.5
    assert one(spark, numbers.lenient_float(F.col("x")), x="n/a") is None
    assert one(spark, numbers.twist_inches(F.col("x")), x="1:8") == 8.0
    assert one(spark, numbers.safe_int(F.col("x")), x="2700.5") is None
    assert one(spark, numbers.python_round2(F.col("x")), x=2.675) == 2.67
    assert one(spark, numbers.close(F.col("a"), F.col("b"), 0.005, 0.01), a=100.0, b=100.4)


@pytest.mark.parametrize(
    ("name", "maker", "expected"),
    [
        ("30 Cal .308 178 gr ELD-X®", "Hornady", "ELD-X"),
        ("6.5mm 140 GR HPBT MATCHKING (SMK) (100ct)", "Sierra Bullets", "HPBT MatchKing"),
        ("Norma Oryx 9,3mm 15,0g", "Norma", "Oryx"),
        ("Scenar GB547 9,7 g / 150 gr .308", "Lapua", "Scenar"),
    ],
)
def test_bullet_display_names_and_that_they_are_stable(spark, name, maker, expected):
    got = one(spark, display.bullet_display_name(F.col("n"), None, F.col("m")), n=name, m=maker)
    assert got == expected
    assert one(spark, display.bullet_display_name(F.col("n"), None, F.col("m")), n=got, m=maker) == got


@pytest.mark.parametrize(
    ("name", "line", "bullet", "expected"),
    [
        ("x", "Gold Medal Sierra MatchKing", "MatchKing", "Gold Medal MatchKing"),
        ("x", "Barnes TSX", "TSX", "Barnes TSX"),
        ("x", "Precision Hunter", "ELD-X", "Precision Hunter ELD-X"),
        ("6.5 Creedmoor 143 gr ELD-X Precision Hunter", "Precision Hunter", None, "Precision Hunter ELD-X"),
        ("308 Win 150 gr SP American Whitetail", "American Whitetail", None, "American Whitetail"),
        ("Fusion Rifle, 308 Win, 150 Grain, Fusion Soft Point, 2820", None, None, "Fusion"),
        ("Gold Medal, 308 Win, 168 Grain, Sierra Open Tip Match, 2650", "Gold Medal", None, "Gold Medal OTM"),
        ("x", None, "MATCHKING®", "MatchKing"),
    ],
)
def test_cartridge_display_names(spark, name, line, bullet, expected):
    columns = [F.col("n"), F.lit(line).cast("string"), F.lit(bullet).cast("string")]
    assert one(spark, display.cartridge_display_name(*columns), n=name) == expected
