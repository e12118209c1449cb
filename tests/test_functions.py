"""Score formulas, coercion, formatting and text functions, with every threshold."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from segrisk.functions import formatting as fmt
from segrisk.functions import scores, text, values

X = "x double"


def many(spark, expression, inputs, schema=X):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, {schema}")
    rows = df.select("i", expression.alias("v")).orderBy("i").collect()
    return [r.v for r in rows]


def test_hhi_labels(spark):
    got = many(spark, scores.classify_hhi(F.col("x")), [10000.0, 2500.01, 2500.0, 1500.01, 1500.0, 0.0, None])
    assert got == ["High", "High", "Moderate", "Moderate", "Low", "Low", "Low"]


def test_tiers(spark):
    got = many(
        spark,
        scores.classify_tier(F.col("x")),
        [75.0, 70.0, 69.99, 55.0, 40.0, 39.99, 25.0, 1.0, 0.99, 0.5, 0.0, None, math.nan],
    )
    assert got == (
        ["High"] * 2 + ["Medium"] * 3 + ["Low"] * 3 + ["Minimal"] * 3 + ["Unknown"] * 2
    )


def test_peak_score(spark):
    got = many(spark, scores.peak_score(F.col("x")), [0.0, 2.5, 5.0, 7.5, 10.0, 10.5, 25.0, 40.0, 90.0, None])
    assert got[:-1] == pytest.approx([0, 15, 30, 50, 70, 70.5, 85, 100, 100])
    assert got[-1] is None


def test_volatility_score(spark):
    got = many(spark, scores.volatility_score(F.col("x")), [0.0, 1.0, 2.0, 3.5, 5.0, 6.0, 10.0, 30.0, None])
    assert got[:-1] == pytest.approx([0, 15, 30, 50, 70, 76, 100, 100])
    assert got[-1] is None


def test_geo_risk(spark):
    df = spark.createDataFrame(
        [(0, 50.0, 60), (1, 10.0, 30), (2, 10.0, 31), (3, 100.0, 1000), (4, None, 5)], "i int, s double, n long"
    )
    got = [
        r.v
        for r in df.select("i", scores.geo_risk(F.col("s"), F.col("n")).alias("v")).orderBy("i").collect()
    ]
    assert got == [85.0, 100.0, 100.0, 73.0, None]


def test_workforce_parts(spark):
    drop = many(spark, scores.percent_drop(F.lit(200.0), F.col("x")), [200.0, 180.0])
    assert drop == pytest.approx([0.0, 10.0])
    assert many(spark, scores.percent_drop(F.col("x"), F.lit(-5.0)), [0.0, -1.0, None]) == [0.0, 0.0, None]
    assert many(spark, scores.trend_penalty(F.col("x")), [-0.1, 0.0, 3.0, None]) == [20.0, 0.0, 0.0, None]
    full = scores.workforce_risk(F.lit(100.0), F.lit(100.0), F.col("x"))
    assert many(spark, full, [20.0, 0.0, None]) == [84.0, 80.0, None]


def test_composites(spark):
    df = spark.createDataFrame(
        [(0, 60.42, 32.44), (1, 60.42, None), (2, None, 32.44), (3, None, None)], "i int, g double, w double"
    )
    both = scores.composite_sector(F.col("g"), F.col("w"))
    mean = scores.weighted_mean([(F.col("g"), 0.5), (F.col("w"), 0.5)])
    rows = df.select("i", both.alias("a"), mean.alias("b")).orderBy("i").collect()
    assert [r.a for r in rows[:3]] == pytest.approx([46.43, 60.42, 32.44]) and rows[3].a is None
    assert [r.b for r in rows[:3]] == pytest.approx([46.43, 60.42, 32.44]) and rows[3].b is None
    assert many(spark, scores.composite_state(F.col("x")), ["10000", "5000", "0", "", None], "x string") == [
        100.0, 50.0, 0.0, None, None,
    ]


def test_parse_number(spark):
    got = many(
        spark,
        values.parse_number(F.col("x")),
        ["12.5", " 7 ", "1e3", "-3", "n/a", "", "1,000", "nan", "inf", "5d", "5f", None],
        "x string",
    )
    assert got == [12.5, 7.0, 1000.0, -3.0] + [None] * 8


def test_state_and_periods(spark):
    got = many(
        spark, values.normalize_state(F.col("x")), [" tx ", "Tx", "\tdc\u00a0", "ZZ", "", "  ", None, "Texas", "GU"],
        "x string",
    )
    assert got == ["TX", "TX", "DC", None, None, None, None, None, "GU"]
    assert many(spark, values.month_of_period(F.col("x")), ["M07", "M12", "7", "Mx"], "x string") == [7, 12, 7, None]
    assert many(spark, values.year_of_period(F.col("x")), ["2022-12", "x"], "x string") == [2022, None]
    days = F.to_date(F.col("x"))
    assert many(
        spark, values.fiscal_year(days), ["2021-09-30", "2021-10-01", "2022-09-30", "2022-12-31"], "x string"
    ) == [2021, 2022, 2022, 2023]


def test_cents_are_exact_and_skip_non_numbers(spark):
    got = many(spark, values.cents(F.col("x")), [0.1 + 0.2, 2.675, -1.0, math.nan, math.inf, None])
    assert got == [30, 268, -100, None, None, None]
    many_dimes = spark.range(100_000).select(F.lit(0.1).alias("x"))
    assert many_dimes.agg(values.dollars(F.sum(values.cents(F.col("x"))))).first()[0] == 10_000.0


def test_rounding(spark):
    inputs = [0.125, 2.675, 7.235, 1.005, -0.125, None]
    even = many(spark, values.round_even(F.col("x")), inputs)
    assert even[:-1] == [float(np.round(x, 2)) for x in inputs[:-1]] and even[-1] is None
    exact = many(spark, values.round_exact(F.col("x")), inputs)
    assert exact[:-1] == [round(x, 2) for x in inputs[:-1]] and exact[-1] is None
    assert many(spark, values.round_even(F.col("x"), 0), [0.5, 1.5, 2.4]) == [0.0, 2.0, 2.0]


def test_clip_and_missing(spark):
    assert many(spark, values.clip(F.col("x"), 25.0, 800.0), [1.5, 100.0, 5000.0, None]) == [25.0, 100.0, 800.0, None]
    assert many(spark, values.is_missing(F.col("x"), "string"), ["a", " \t", "", None], "x string") == [
        False, True, True, True,
    ]
    assert many(spark, values.is_missing(F.col("x"), "double"), [0.0, math.nan, None]) == [False, True, True]
    assert many(spark, values.code_text(F.col("x")), ["336411.0", " 336411 ", "336411"], "x string") == ["336411"] * 3


def test_prompt_formats(spark):
    assert many(spark, fmt.prompt_number(F.col("x")), [1234567.0, 0.125, 2.675, None, math.nan]) == [
        "1,234,567.00", "0.12", "2.67", "N/A", "N/A",
    ]
    assert many(spark, fmt.prompt_int(F.col("x")), [1636.9, -2.9, None]) == ["1,636", "-2", "N/A"]
    assert many(spark, fmt.prompt_money(F.col("x")), [1234567.4, 0.0, None]) == ["$1,234,567", "$0", "N/A"]
    assert many(spark, fmt.prompt_text(F.col("x")), [" a ", " ", None], "x string") == ["a", "N/A", "N/A"]
    assert many(spark, fmt.prompt_any(F.col("x"), "double"), [10002227966.0, 0.5, None]) == [
        "10002227966.0", "0.5", "N/A",
    ]


def test_plain_numbers(spark):
    inputs = [10002227966.0, 0.0, -2.5, 93609999.83, 1e-9, 1e300, None, 0.1 + 0.2]
    assert many(spark, fmt.plain_number(F.col("x")), inputs) == [
        "10002227966.0", "0.0", "-2.5", "93609999.83", "1.0E-9", "1.0E300", None, "0.30000000000000004",
    ]


def test_dashboard_formats(spark):
    assert many(spark, fmt.dashboard_number(F.col("x")), [1234.5, None]) == ["1,234.50", "—"]
    assert many(spark, fmt.dashboard_metric(F.col("x")), [1234.5, None]) == ["1,234.50", "N/A"]
    assert many(spark, fmt.dashboard_money(F.col("x")), [1.25e12, 1e9, 2.5e6, 999999.0, 0.0, None]) == [
        "$1,250.00B", "$1.00B", "$2.50M", "$999,999", "$0", "N/A",
    ]


def test_report_formats(spark):
    assert many(spark, fmt.report_score(F.col("x")), [9986.09, 100.0, None]) == ["9986.09", "100.00", "n/a"]
    assert many(spark, fmt.report_int(F.col("x")), [1636.0, None]) == ["1,636", "n/a"]
    assert many(spark, fmt.report_money(F.col("x")), [1.25e12, 2.5e6, 2500.0, 999.6, None]) == [
        "$1250.00B", "$2.50M", "$2.50K", "$1,000", "n/a",
    ]


ROWS = [
    ("STATE", " wi ", None, None),
    ("NAICS", None, "336411.0", "Aircraft Manufacturing"),
    ("NAICS", None, "336499", None),
    ("OTHER", None, None, None),
    (None, None, None, None),
]


def test_identifiers_and_labels(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "i int, t string, s string, c string, l string")
    t, s, c, label = (F.col(n) for n in "tscl")
    rows = df.select(
        "i",
        fmt.segment_identifier(t, s, c).alias("id"),
        fmt.log_label(t, s, c).alias("log"),
        fmt.panel_label(t, s, c, label).alias("panel"),
        fmt.report_title(t, s, c, label).alias("title"),
    ).orderBy("i").collect()
    assert [r.id for r in rows] == ["WI", "336411", "336499", None, None]
    assert [r.log for r in rows] == ["STATE  wi ", "NAICS 336411", "NAICS 336499", "OTHER", "UNKNOWN"]
    assert rows[1].panel == "NAICS 336411 — Aircraft Manufacturing"
    assert rows[0].panel == "State:  wi "
    assert [r.title for r in rows[1:]] == [
        "NAICS 336411 — Aircraft Manufacturing", "NAICS 336499", "OTHER", "UNKNOWN",
    ]
    with pytest.raises(Exception, match="without identifier"):
        df.select(fmt.segment_identifier(t, s, c, strict=True)).collect()


def test_fold_and_clean(spark):
    dirty = [
        "• a – b — c ‘d’ “e” f… g\u00a0h",
        "hard\u00a0space \u2013\u2014",
        "a--b",
        "a---b",
        "--x-- ----",
        "__x__ **y**",
        None,
    ]
    assert many(spark, text.clean_markup(F.col("x")), dirty, "x string") == [
        "- a - b - c 'd' \"e\" f... g h", "hard space -", "a-b", "a---b", "-x- ----", "x **y**", None,
    ]


LINES = ["", "   ", "# title", "## head ", "- b1", "  • b2 ", "* b3", "### sub", "plain  ", "##no", "-", "- "]


def test_line_classes(spark):
    kinds = many(spark, text.line_kind(F.col("x")), LINES, "x string")
    assert kinds == (
        ["blank", "blank", "title", "heading", "bullet", "bullet", "bullet"] + ["paragraph"] * 5
    )
    payload = many(spark, text.line_payload(F.col("x"), text.line_kind(F.col("x"))), LINES, "x string")
    assert payload[3:] == ["head", "b1", "b2", "b3", "### sub", "plain", "##no", "-", "-"]


def test_split_lines_equals_python(spark):
    texts = ["", "a", "a\n", "a\n\n", "\n", "a\r\nb\rc\x0bd\x85e\u2028f", "x\r\n", "\r\n\n", "a\x1cb"]
    assert [v or [] for v in many(spark, text.split_lines(text.single_line_ends(F.col("x"))), texts, "x string")] == [
        t.splitlines() for t in texts
    ]
