"""Landed files, CSV and Parquet scans, and sinks, on real files."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from segrisk.functions.values import iso_utc, pad_left
from segrisk.operators import filters
from segrisk.operators.shape import select_present, unique_headers
from segrisk.plans import briefs
from segrisk.schemas import AWARDS, EMPLOYMENT, MANIFEST, SEGMENTS, TRADE
from segrisk.sources import landed, sinks, tables

RECORDS = [
    {"Recipient Name": "Co1", "Award Amount": 500000.0, "Place of Performance State Code": "BB",
     "NAICS Code": None, "Start Date": "2021-10-01", "internal_id": 5},
    {"Recipient Name": None, "Award Amount": "n/a", "Place of Performance State Code": None, "Start Date": "soon"},
]
AWARD_ROWS = [
    ("Co1", 500000.0, "BB", None, datetime.date(2021, 10, 1)),
    (None, None, None, None, None),
]


def kinds(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def ordered(df, *keys):
    return [tuple(r) for r in df.orderBy(*keys).collect()]


def test_award_pages_from_files(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps(RECORDS, indent=2))
    (tmp_path / "p2.json").write_text(json.dumps(RECORDS[:1]))
    (tmp_path / "p3.json").write_text("[]")
    (tmp_path / "p4.json").write_text("  ")
    for df in (
        landed.read_award_files(spark, str(tmp_path / "p[123].json")),
        landed.parse_awards(landed.read_bodies(spark, str(tmp_path))),
    ):
        assert df.dtypes == kinds(AWARDS)
        rows = ordered(df, F.col("recipient_name").desc())
        assert sorted(map(str, rows)) == sorted(map(str, AWARD_ROWS[:1] * 2 + AWARD_ROWS[1:]))


def test_clean_awards_keeps_only_present_columns(spark, frame):
    df = landed.clean_awards(frame("`Award Amount` string, other int", ("7", 1)))
    assert df.dtypes == [("award_amount", "double")] and df.first()[0] == 7.0
    assert select_present(frame("b int, a int", (1, 2)), ["a", "x", "b"]).columns == ["a", "b"]


HEADER = ["CTY_CODE", "CTY_NAME", "ALL_VAL_YR", "E_COMMODITY", "E_COMMODITY_LDESC", "E_COMMODITY", "time"]


def test_trade_matrices(spark, tmp_path):
    first = [
        HEADER,
        ["5170", "UAE", "100", "8802", "Aircraft", "8802", "2022-12"],
        ["-", "WORLD", "999", "8802", "Aircraft", "8802", "2022-12"],
        ["5XXX", "ASIA", "999", "8802", "Aircraft", "8802", "2022-12"],
        ["0022", "OECD", "999", "8802", "Aircraft", "8802", "2022-12"],
        [None, "NOWHERE", "1", "8802", "Aircraft", "8802", "2022-12"],
        ["4120", "UK", None, "8802", "Aircraft", "8802", "2022-12"],
    ]
    second = [
        ["time", "CTY_NAME", "CTY_CODE", "E_COMMODITY", "ALL_VAL_YR"],
        ["2023-12", "UK", "4120", "8801", "7"],
    ]
    for name, content in (("a", json.dumps(first)), ("b", json.dumps(second)), ("c", ""), ("d", json.dumps([HEADER]))):
        (tmp_path / f"{name}.json").write_text(content)
    bodies = landed.read_bodies(spark, str(tmp_path))
    df = landed.parse_trade(bodies)
    assert df.dtypes == kinds(TRADE)
    assert ordered(df, "hs_code", "country_code") == [
        ("8801", None, "4120", "UK", 7, 2023),
        ("8802", "Aircraft", "4120", "UK", None, 2022),
        ("8802", "Aircraft", "5170", "UAE", 100, 2022),
    ]
    scope = filters.in_trade_scope(F.col("hs_code"), F.col("period"), ["8801"], ["2023-12"])
    assert landed.clean_trade(landed.trade_matrix(bodies).where(scope)).count() == 1
    (tmp_path / "e.json").write_text(json.dumps([["CTY_CODE"], ["1"]]))
    with pytest.raises(Exception, match="no column"):
        landed.parse_trade(landed.read_bodies(spark, str(tmp_path))).collect()


def test_unique_headers(spark, frame):
    row = frame("x array<string>", (["H", "a", "H", "H", "a"],)).select(unique_headers(F.col("x")).alias("x")).first()
    assert row.x == ["H", "a", "H_1", "H_2", "a_1"]
    bodies = frame("body string", ('[["E", "E", "t"], ["1", "2", "3"]]',))
    assert [tuple(r) for r in landed.trade_matrix(bodies, {"E_1": "second", "t": "t"}, []).collect()] == [("2", "3")]


def answer(status="REQUEST_SUCCEEDED", **series):
    return {
        "status": status,
        "message": ["too many requests"] if status != "REQUEST_SUCCEEDED" else [],
        "Results": {
            "series": [
                {"seriesID": sid, "data": [{"year": y, "period": p, "periodName": "x", "value": v} for y, p, v in data]}
                for sid, data in series.items()
            ]
        },
    }


def test_series_answers(spark, tmp_path):
    good = answer(CEU3133641101=[("2022", "M02", "241.0"), ("2022", "M01", "240.9")], OTHER=[("2023", "M01", "5")], EMPTY=[])
    (tmp_path / "a.json").write_text(json.dumps(good))
    df = landed.chronological(landed.parse_employment(landed.read_bodies(spark, str(tmp_path))))
    assert df.dtypes == kinds(EMPLOYMENT)
    assert [tuple(r) for r in df.collect()] == [
        ("CEU3133641101", 2022, "M01", "x", 240.9, "Aircraft Manufacturing"),
        ("CEU3133641101", 2022, "M02", "x", 241.0, "Aircraft Manufacturing"),
        ("OTHER", 2023, "M01", "x", 5.0, "OTHER"),
    ]
    (tmp_path / "b.json").write_text(json.dumps(answer("REQUEST_FAILED", X=[("2022", "M01", "1")])))
    failed = landed.parse_employment(landed.read_bodies(spark, str(tmp_path)))
    with pytest.raises(Exception, match="REQUEST_FAILED: too many requests"):
        failed.collect()
    with pytest.raises(Exception, match="REQUEST_FAILED"):
        failed.groupBy("series_id").count().collect()


def test_scopes(spark, frame):
    days = ["2021-09-30", "2021-10-01", "2022-09-30", "2022-10-01", "2024-09-30", "2024-10-01"]
    df = frame("d string", *[(d,) for d in days]).withColumn("d", F.to_date("d"))
    kept = df.where(filters.in_fiscal_years(F.col("d"), [2022, 2024])).orderBy("d").collect()
    assert [str(r.d) for r in kept] == ["2021-10-01", "2022-09-30", "2024-09-30"]
    assert df.where(filters.in_fiscal_years(F.col("d"), [])).count() == 0


def test_csv_round_trip_keeps_text_as_it_is(spark, tmp_path, frame):
    df = frame(
        "recipient_name string, award_amount string, state string, naics_code string, start_date string",
        ("NA", "12.5", " tx ", "336411", "2022-01-02"), ('Say "x", y', "bad", None, "", "??"),
        ("line one", "1e3", "TX", "0012", None),
    )
    path = str(tmp_path / "csv")
    sinks.write_clean_csv(df, path)
    typed = tables.read_awards(spark, path)
    assert typed.dtypes == kinds(AWARDS)
    assert ordered(typed, "recipient_name") == [
        ("NA", 12.5, " tx ", "336411", datetime.date(2022, 1, 2)),
        ('Say "x", y', None, None, None, None),
        ("line one", 1000.0, "TX", "0012", None),
    ]
    assert {k for _, k in tables.read_csv_text(spark, path, AWARDS).dtypes} == {"string"}


def test_raw_layer_keeps_bodies(spark, tmp_path, frame):
    bodies = ['[["a"],\n ["b"]]', '{"x": "é \\" \\\\ "}\n', "plain"]
    path = str(tmp_path / "raw")
    sinks.write_raw(frame("body string", *[(b,) for b in bodies]), path)
    assert sorted(r.body for r in spark.read.schema("body string").json(path).collect()) == sorted(bodies)


def segment_rows(spark):
    return spark.createDataFrame(
        [
            ("STATE", None, None, "WY", 0.0, 0, None, None, 0.0, "Low", None, None, 0.0, "Minimal"),
            ("STATE", None, None, "WI", 7314869.744, 2, None, None, 10000.0, "High", None, None, 100.0, "High"),
            ("STATE", None, None, "AL", 5.0, 599, None, None, 3055.965, "High", None, None, 30.55965, "Low"),
            ("NAICS", "336411", "Aircraft Manufacturing", None, None, None, 10002227966.0, 240989, None, "N/A", 60.42, 32.44, 46.43, "Medium"),
        ],
        SEGMENTS,
    ).withColumn("is_padded", F.col("state") == "WY")


def test_export(spark, tmp_path):
    path = str(tmp_path / "segments.csv")
    returned = sinks.export_segments(segment_rows(spark), path)
    files = sorted(f for f in os.listdir(path) if f.endswith(".csv"))
    lines = "".join((tmp_path / "segments.csv" / f).read_text() for f in files).splitlines()
    assert lines[0] == ",".join(SEGMENTS.names)
    assert lines[1] == "NAICS,336411,Aircraft Manufacturing,,,,10002227966.0,240989,,N/A,60.42,32.44,46.43,Medium"
    assert [line.split(",")[3] for line in lines[2:]] == ["AL", "WI", "WY"]
    back = tables.read_segments_csv(spark, path)
    assert back.dtypes == kinds(SEGMENTS)
    assert back.exceptAll(returned.select(back.columns)).count() == 0 and back.count() == 4
    al = back.where("state = 'AL'").first()
    assert (al.hhi_score, al.composite_risk_score) == (3055.96, 30.56), "ties go to the even digit"


def test_stored_segments_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "segments")
    sinks.write_segments(segment_rows(spark).drop("risk_tier"), path)
    df = tables.read_segments(spark, path, ["naics_code", "risk_tier"], F.col("row_type") == "NAICS")
    assert [tuple(r) for r in df.collect()] == [("336411", None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(row_type,NAICS)" in plan and "hhi_score" not in plan


def test_brief_files_and_store(spark, tmp_path, frame):
    folder = tmp_path / "briefs"
    folder.mkdir()
    (folder / "WI.txt").write_text("# t\n\nbody\n", encoding="utf-8")
    (folder / "336411.txt").write_text("x", encoding="utf-8")
    (folder / "manifest.json").write_text("[]")
    texts = tables.read_briefs(spark, str(folder))
    found = {r.identifier: r.brief_text for r in texts.collect()}
    assert found == {"WI": "# t\n\nbody\n", "336411": "x"}
    loaded = tables.load_briefs(briefs.identified(segment_rows(spark)), texts).collect()
    assert {r.identifier: r.brief_text for r in loaded}["WY"] is None

    store = str(tmp_path / "store")
    schema = "identifier string, brief_text string"
    sinks.write_briefs(frame(schema, ("WI", "one"), ("336411", "two")), store)
    sinks.write_briefs(frame(schema, ("WI", "three"), ("AK", "four")), store)
    kept = {r.identifier: r.brief_text for r in tables.read_brief_store(spark, store).collect()}
    assert kept == {"WI": "three", "336411": "two", "AK": "four"}


def test_manifest_files(spark, tmp_path):
    record = {n: None for n in MANIFEST.names} | {"row_type": "STATE", "state": "ID", "tokens_used": 0, "composite_risk_score": 100.0}
    (tmp_path / "manifest.json").write_text(json.dumps([record, record], indent=2))
    df = tables.read_manifest(spark, str(tmp_path / "manifest.json"), array_file=True)
    assert df.dtypes == kinds(MANIFEST) and df.count() == 2
    out = str(tmp_path / "out")
    sinks.write_manifest(df.limit(1), out)
    (line,) = (tmp_path / "out").glob("v-*/*.txt")
    assert json.loads(line.read_text()) == record
    assert tables.read_manifest(spark, out).first() == df.first()


BODIES = {
    "awards": ['[{"Recipient Name": "A"}', '{"detail": "busy"}', "<html>busy</html>"],
    "trade": ['[["CTY_CODE"], ["1"]', '{"error": 1}', "<html>busy</html>"],
    "employment": ['{"status": "REQUEST_FAILED"}', "<html>", "[1]"],
}
PARSE = {"awards": landed.parse_awards, "trade": landed.parse_trade, "employment": landed.parse_employment}


@pytest.mark.parametrize("kind", sorted(BODIES))
def test_no_response_vanishes(spark, frame, kind):
    bodies = frame("body string", *[(b,) for b in BODIES[kind]], ("",), (" \n",))
    assert landed.rejects(bodies, kind).count() == 3
    assert PARSE[kind](bodies, strict=False).count() == 0
    for body in BODIES[kind]:
        with pytest.raises(Exception, match="response"):
            PARSE[kind](frame("body string", (body,))).collect()


def test_csv_keeps_line_ends(spark, tmp_path):
    names = ["A\nB", "A\\nB", "\r\n", "back\\", 'quote "x"\n', " blank ", "plain"]
    rows = [(n, float(i), "TX", None, None) for i, n in enumerate(names)]
    path = str(tmp_path / "awards")
    sinks.write_clean_csv(spark.createDataFrame(rows, AWARDS), path)
    back = tables.read_awards(spark, path).orderBy("award_amount").collect()
    assert [r.recipient_name for r in back] == names


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_text_in_any_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, shown in (
            ("2024-03-10 02:30:00Z", "2024-03-10T02:30:00+00:00"),
            ("2024-11-03 05:30:00.000001Z", "2024-11-03T05:30:00.000001+00:00"),
            ("1969-12-31 23:59:59.5Z", "1969-12-31T23:59:59.500000+00:00"),
        ):
            moment = spark.range(1).select(F.lit(text).cast("timestamp").alias("t"))
            assert moment.select(iso_utc(F.col("t"))).first()[0] == shown
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_pad_left_never_cuts(value):
    assert value(pad_left(F.col("x"), 4), "x string", "12345") == "12345"
    assert value(pad_left(F.col("x"), 4), "x string", "7") == "0007"
