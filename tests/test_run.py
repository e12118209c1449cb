"""Landed files to segments, prompts and manifest, through the command line functions."""

import json

import pytest

from segrisk import run
from segrisk.schemas import AWARDS, EMPLOYMENT, TRADE
from segrisk.sources import sinks, tables

ORDER = {"awards": AWARDS, "trade": TRADE, "employment": EMPLOYMENT}

SERIES = ["CEU3133641101", "CEU3133641201", "CEU3133641301"]


@pytest.fixture(scope="module")
def landed_dir(tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    for name in ("awards", "trade", "employment"):
        (base / name).mkdir()
    for page in range(3):
        records = [
            {"Recipient Name": f"Co{i % 4}", "Award Amount": 1000.0 + i, "Place of Performance State Code": state,
             "NAICS Code": None, "Start Date": "2022-03-01"}
            for i, state in enumerate(["TX", "TX", "WA", "PR", None, "TX"])
        ]
        (base / "awards" / f"page{page}.json").write_text(json.dumps(records))
    header = ["CTY_CODE", "CTY_NAME", "ALL_VAL_YR", "E_COMMODITY", "E_COMMODITY_LDESC", "E_COMMODITY", "time"]
    for code in ("8801", "8802", "8805"):
        for period in ("2022-12", "2023-12", "2021-12"):
            rows = [[str(1000 + i), f"Country {i}", str(100 * (i + 1)), code, "x", code, period] for i in range(40)]
            total = ["-", "WORLD", "99999", code, "x", code, period]
            (base / "trade" / f"{code}-{period}.json").write_text(json.dumps([header, total, *rows]))
    (base / "trade" / "empty.json").write_text("")
    data = [
        {"year": str(y), "period": f"M{m:02d}", "periodName": "m", "value": f"{200 + m * 0.3 + (y - 2022):.1f}"}
        for y in (2024, 2023, 2022) for m in range(12, 0, -1)
    ]
    answer = {"status": "REQUEST_SUCCEEDED", "message": [], "Results": {"series": [{"seriesID": s, "data": data} for s in SERIES]}}
    (base / "employment" / "a.json").write_text(json.dumps(answer))
    return base


def test_whole_run(spark, landed_dir, tmp_path):
    out = tmp_path / "lake"
    run.ingest(spark, str(landed_dir), str(out))
    assert sorted(p.name for p in (out / "clean" / "trade").iterdir() if p.is_dir()) == ["year=2022", "year=2023"]
    exported = run.score(spark, f"{out}/clean", str(out))
    rows = {r.state or r.naics_code: r for r in exported.collect()}
    assert len(rows) == 4 + 51
    assert rows["TX"].recipient_count == 9 and rows["TX"].total_contract_value == 3 * (1000 + 1001 + 1005)
    assert rows["336411"].export_value == 2 * 2 * sum(100 * (i + 1) for i in range(40))
    assert rows["336411"].employment_count == 202950 and rows["336412"].workforce_risk_score is not None
    assert rows["336414"].workforce_risk_score is None and rows["336414"].geo_risk_score is not None
    assert tables.read_segments_csv(spark, f"{out}/segments_csv").count() == 55

    for name in ("awards", "trade", "employment"):
        sinks.write_clean_csv(spark.read.parquet(f"{out}/clean/{name}").select(*ORDER[name].names), f"{out}/csv/{name}")
    again = run.score(spark, f"{out}/csv", f"{out}/from_csv", csv=True)
    assert again.exceptAll(exported).count() == 0 and again.count() == 55

    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "PR.txt").write_text("text")
    run.prompts(spark, f"{out}/segments", str(tmp_path / "texts"), f"{out}/prompts", 2)
    todo = spark.read.json(f"{out}/prompts")
    assert sorted(r.identifier for r in todo.collect()) == ["336411", "336412", "336413", "336414", "WA"]

    done = [{"identifier": i, "tokens_used": 10, "generated_at": "2024-01-01T00:00:00Z"} for i in ("WA", "336411")]
    (tmp_path / "written.json").write_text("\n".join(map(json.dumps, done)))
    run.manifest(spark, f"{out}/segments", str(tmp_path / "texts"), str(tmp_path / "written.json"), f"{out}/manifest", 2)
    records = {r.state or r.naics_code: r for r in tables.read_manifest(spark, f"{out}/manifest").collect()}
    assert {k: r.tokens_used for k, r in records.items()} == {"PR": 0, "WA": 10, "336411": 10}
    assert records["WA"].generated_at == "2024-01-01T00:00:00+00:00"


def test_command_line(landed_dir):
    with pytest.raises(SystemExit):
        run.main(["score"])
    with pytest.raises(SystemExit):
        run.main(["unknown"])


def test_missing_series_stops_the_run(spark, landed_dir, tmp_path):
    out = tmp_path / "lake"
    run.ingest(spark, str(landed_dir), str(out))
    only = spark.read.parquet(f"{out}/clean/employment").where("series_id = 'CEU3133641101'")
    only.write.parquet(str(tmp_path / "less" / "employment"))
    for name in ("awards", "trade"):
        spark.read.parquet(f"{out}/clean/{name}").write.parquet(str(tmp_path / "less" / name))
    with pytest.raises(ValueError, match="no rows for required series_id"):
        run.score(spark, str(tmp_path / "less"), str(tmp_path / "x"))
