from __future__ import annotations

import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from salesloom.functions import parse


def read(spark, rule, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string").select("i", rule(F.col("t")).alias("v"))
    return [r.v for r in sorted(df.collect())]


def test_strict_int(spark):
    texts = ["12", "007", " 12 ", "-3", "+5", "12.7", "1e3", "", "12\n", None]
    assert read(spark, parse.strict_int, texts) == [12, 7] + [None] * 8


def test_strict_decimal(spark):
    values = read(spark, parse.strict_decimal, ["1.5", "5", ".5", "5.", "NaN", "1.5d"])
    assert [None if v is None else float(v) for v in values] == [1.5, 5.0, None, None, None, None]


def test_permissive_int(spark):
    texts = ["12.7", " 12 ", "-3", "1e3", "abc", "99999999999", "", None]
    assert read(spark, parse.permissive_int, texts) == [12, 12, -3] + [None] * 5


def test_permissive_double(spark):
    values = read(spark, parse.permissive_double, ["1e3", "1.5d", "NaN", "abc", ""])
    assert values[:2] == [1000.0, 1.5] and math.isnan(values[2]) and values[3:] == [None, None]


def test_permissive_date(spark):
    texts = ["1/5/2021", "01/05/2021", "1/5/21", "13/1/2021", "2/30/2021", ""]
    day = datetime.date(2021, 1, 5)
    assert read(spark, parse.permissive_date, texts) == [day, day, None, None, None, None]


def test_strict_date(spark):
    assert read(spark, parse.strict_date, ["1/5/2021", "", None]) == [
        datetime.date(2021, 1, 5), None, None
    ]


@pytest.mark.parametrize(
    "rule, text",
    [
        (parse.strict_int, "99999999999"),
        (parse.strict_decimal, "9" * 30),
        (parse.strict_date, "1/5/21"),
        (parse.strict_date, "13/1/2021"),
        (parse.strict_date, "2/30/2021"),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_raises_in_either_ansi_mode(spark, rule, text, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="out of range"):
            read(spark, rule, [text])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(
    st.text(alphabet="0123456789+-. \t\n\x00\x1f\x7feEdx\u00a0", max_size=13),
    min_size=40, max_size=200,
))
def test_permissive_int_is_the_lenient_cast(spark, texts):
    """The same value as a cast with ANSI mode off, for any text."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert read(spark, parse.permissive_int, texts) == read(
            spark, lambda t: t.cast("int"), texts
        )
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_null_to_empty_and_filled(spark):
    assert read(spark, parse.null_to_empty, [None, "", "a"]) == ["", "", "a"]
    assert [bool(v) for v in read(spark, parse.is_filled, [None, "", "a"])] == [False, False, True]
