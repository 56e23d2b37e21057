"""Column functions against hand-made rows, and against Python on many odd texts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallybook import functions as fn
from tallybook.functions.text import NARRATIVE_LIMIT, TRUNCATION_NOTE, WHITESPACE

ODD = list("aB cDeé'Ñ9/_-&.\t\n\x01\x0b   　ßǆअ") + ["₹", "İ", "́", "\x1c"]


def apply(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(7)
    return ["".join(rng.choices(ODD, k=rng.randrange(14))) for _ in range(3000)]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_like_python(spark, odd_texts):
    assert apply(spark, odd_texts, fn.strip) == [t.strip() for t in odd_texts]


def test_title_case_like_python(spark, odd_texts):
    # Python writes a capital sharp s as "Ss" and a dotted capital I in two characters when lowered.
    texts = [t for t in odd_texts if "ß" not in t]
    assert apply(spark, texts, fn.title_case) == [t.title() for t in texts]


@pytest.mark.parametrize(
    ("text", "title"),
    [
        ("punjab/mohali 2ND o'neil x_y", "Punjab/Mohali 2Nd O'Neil X_Y"),
        ("ANDAMAN & NICOBAR", "Andaman & Nicobar"),
        ("TAMIL NADU", "Tamil Nadu"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, text, title):
    assert apply(spark, [text], fn.title_case) == [title]


def test_upper_code(spark):
    assert apply(spark, [" jne3797-kr-l\t", None], fn.upper_code) == ["JNE3797-KR-L", None]


def test_blank_to_null_takes_whole_cells_only(spark):
    given = ["NA", "null", "", "#N/A", " NA", "NAN", "none", "x"]
    assert apply(spark, given, fn.blank_to_null) == [None] * 4 + [" NA", "NAN", "none", "x"]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12", 12.0),
        ("-3095", -3095.0),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("+7", 7.0),
        ("1d", None),
        ("2f", None),
        ("NaN", None),
        ("Infinity", None),
        ("1_000", None),
        ("0x1A", None),
        (".", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_number(spark, text, number):
    assert apply(spark, [text], fn.parse_number) == [number]


def test_money_text(spark):
    assert apply(spark, ["₹ 1,234.50 ", " ₹4.00"], fn.money_text) == ["1234.50", "4.00"]


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("04-30-22", dt.date(2022, 4, 30)),
        ("4-5-95", dt.date(1995, 4, 5)),
        ("12-31-68", dt.date(2068, 12, 31)),
        ("01-01-69", dt.date(1969, 1, 1)),
        ("02-29-96", dt.date(1996, 2, 29)),
        ("02-29-00", dt.date(2000, 2, 29)),
        ("02-29-97", None),
        ("04-30-2022", dt.date(2022, 4, 30)),
        ("4/30/2022", dt.date(2022, 4, 30)),
        ("2022-04-30", dt.date(2022, 4, 30)),
        ("2022-04-30 23:59:59", dt.date(2022, 4, 30)),
        ("2022-13-01", None),
        ("30-04-22", None),
        ("Unknown", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, day):
    assert apply(spark, [text], fn.parse_date) == [day]


def test_parse_timestamp_keeps_the_clock(spark):
    given = ["2022-04-30 23:59:58", "04-30-22", "soon"]
    wanted = [dt.datetime(2022, 4, 30, 23, 59, 58), dt.datetime(2022, 4, 30), None]
    assert apply(spark, given, fn.parse_timestamp) == wanted


def test_months(spark):
    day = [dt.date(2022, 4, 30)]
    assert apply(spark, day, fn.month_key, "date") == ["2022-04"]
    assert apply(spark, day, fn.month_label, "date") == ["Apr 2022"]


def test_round2(spark):
    given = [53.125, 0.005, 2.675, -1.005, -53.125, 0.0, None]
    wanted = [53.13, 0.01, 2.68, -1.0, -53.13, 0.0, None]
    got = apply(spark, given, fn.round2, "double")
    assert got == pytest.approx(wanted, abs=1e-2) and got[0] == 53.13 and got[4] == -53.13


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 3)], "a int, b int")
    got = df.select(
        fn.ratio(F.col("a"), F.col("b")).alias("r"), fn.share_pct(F.col("a"), F.col("b")).alias("s")
    )
    assert [tuple(r) for r in got.collect()] == [(None, None), (None, None), (0.33, 33.33)]


def test_sanitize(spark):
    given = ["━═ café — 😀 x…", "“a” ‘b’ • ★▶", None]
    assert apply(spark, given, fn.sanitize) == ["?= café - ? x...", "\"a\" 'b' - *>", None]


def test_sanitize_leaves_latin1_only(spark, odd_texts):
    for text, clean in zip(odd_texts, apply(spark, odd_texts, fn.sanitize), strict=True):
        assert clean == text.encode("latin-1", "replace").decode("latin-1")


def test_truncate_counts_characters(spark):
    fits, long = "é" * NARRATIVE_LIMIT, "é" * (NARRATIVE_LIMIT + 1)
    assert apply(spark, [fits, long], fn.truncate) == [fits, fits + TRUNCATION_NOTE]
