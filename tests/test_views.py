"""Views, charts, summaries, briefs and ranking over a small segments table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segrisk.operators import filters, keyed, ranking, totals
from segrisk.plans import briefs, eda, explore, summaries
from segrisk.schemas import SEGMENTS


@pytest.fixture(scope="module")
def segments(spark):
    def state(code, score, value=1.0, count=1):
        tier = "Unknown" if score is None else "High" if score >= 70 else "Medium" if score >= 40 else "Low" if score >= 1 else "Minimal"
        hhi = None if score is None else score * 100
        return ("STATE", None, None, code, value, count, None, None, hhi, "High", None, None, score, tier)

    def sector(code, label, geo, work, score, tier):
        return ("NAICS", code, label, None, None, None, 1e10, 1000, None, "N/A", geo, work, score, tier)

    rows = [
        state("WI", 100.0, 7e6, 2), state("ID", 100.0, 2.5e6, 1), state("TX", 59.77, 4.5e11, 1636),
        state("ND", 0.0, 0.0, 0), state("NV", None, 5.0, 3), state("CA", 16.82, 1.25e11, 1396),
        sector("336411", "Aircraft Manufacturing", 60.42, 32.44, 46.43, "Medium"),
        sector("336414", "Guided Missiles", 37.98, None, 37.98, "Low"),
        sector("336499", "Odd Parts", None, None, None, "Unknown"),
    ]
    return spark.createDataFrame(rows, SEGMENTS)


def keys(df):
    return [r.state or r.naics_code for r in df.collect()]


def test_filtered_view(segments):
    assert keys(explore.filtered_view(segments)) == ["ID", "WI", "TX", "336411", "336414", "CA", "ND"]
    assert keys(explore.filtered_view(segments, ["Medium"], "STATE")) == ["TX"]
    assert keys(explore.filtered_view(segments, explore.TIERS, "NAICS", 40)) == ["336411"]
    assert explore.filtered_view(segments, []).count() == 0
    assert segments.where(filters.at_least(F.col("composite_risk_score"), 0)).count() == 9, "NULL counts as 0"
    shown = explore.display_view(explore.filtered_view(segments))
    assert shown.columns == list(explore.DISPLAY_NAMES.values())
    assert shown.first()["Sector"] == "" and shown.first()["Geo Risk"] is None


def test_kpis_map_and_selection(segments):
    row = explore.kpis(segments).first()
    assert (row.total_segments, row.high_risk_segments, row.highest_score) == (9, 2, 100.0)
    assert row.contract_value_bn == pytest.approx(575.0095, abs=1e-4)
    assert explore.state_map(segments).count() == 5
    assert keys(explore.default_selection(segments)) == ["ID"]
    assert keys(explore.panel_row(segments, picked=("NAICS", None, "336411"))) == ["336411"]
    assert keys(explore.panel_row(segments, picked=("STATE", "TX", None), clicked_state="CA")) == ["TX"]
    assert keys(explore.panel_row(segments, clicked_state="CA")) == ["CA"]
    assert keys(explore.panel_row(segments, clicked_state="QQ")) == ["ID"]
    assert keys(explore.panel_row(segments, picked=("STATE", None, None))) == ["ID"]
    assert keys(explore.panel_row(segments)) == ["ID"]
    assert keys(explore.find_segment(segments, "STATE", "NV", None)) == ["NV"]
    assert explore.panel_row(segments.where("row_type = 'NAICS'")).count() == 0


def test_panel_and_cards(segments):
    rows = {r.identifier: r for r in explore.panel_metrics(segments).collect()}
    assert tuple(rows["TX"]) == (
        "TX", "State: TX", "Medium", "59.77", "N/A", "N/A", "5,977.00", "$450.00B", "1,636",
    )
    assert rows["336411"].hhi == "N/A" and rows["336411"].title == "NAICS 336411 — Aircraft Manufacturing"
    cards = explore.sector_cards(segments).collect()
    assert [(r.sector, r.composite, r.workforce) for r in cards] == [
        ("Aircraft Mfg", "46.43", "32.44"), ("Missiles & Space", "37.98", "—"), ("Odd Parts", "—", "—"),
    ]


def test_charts(segments):
    top = eda.top_states(segments, 3).collect()
    assert [(r.rank, r.state) for r in top] == [(3, "TX"), (2, "WI"), (1, "ID")]
    bins = eda.score_distribution(segments).orderBy("bin").collect()
    assert [r.row_count for r in bins] == [1, 0, 0, 1] + [0] * 7 + [1] + [0] * 7 + [2]
    assert bins[0].bin_low == 0.0 and bins[-1].bin_high == 100.0
    assert eda.sector_heatmap(segments).count() == 3 and eda.heatmap_cells(segments).count() == 9
    sizes = {r.state: r.marker_size for r in eda.value_against_risk(segments).collect()}
    assert sizes == {"WI": 25.0, "ID": 25.0, "TX": 800.0, "CA": 800.0}
    assert keys(eda.annotated_states(segments, 2).withColumn("naics_code", F.lit(None))) == ["TX", "CA"]
    row = eda.summary(segments).first()
    assert (row.top_state, row.top_score, row.high_count, row.minimal_count) == ("ID", 100.0, 2, 1)
    assert row.median_score == 59.77 and row.mean_score == pytest.approx(276.59 / 5)
    assert (row.top_contract_state, row.top_contract_score) == ("TX", 59.77)


def test_histogram_edges(frame):
    one = totals.histogram(frame("x double", (5.0,), (5.0,), (None,)), "x", 4).orderBy("bin").collect()
    assert [r.row_count for r in one] == [0, 0, 2, 0] and one[0].bin_low == 4.5
    rows = totals.histogram(frame("x double", *[(float(i),) for i in range(11)]), "x", 5).orderBy("bin").collect()
    assert [r.row_count for r in rows] == [2, 2, 2, 2, 3], "the largest value is in the last bin"


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(2).normal(50, 20, 3000).round(1)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r.row_count for r in totals.histogram(df, "x", 20).orderBy("bin").collect()]
    low, high = values.min(), values.max()
    place = np.minimum(np.floor((values - low) * 20 / (high - low)), 19).astype(int)
    assert got == np.bincount(place, minlength=20).tolist() and sum(got) == 3000
    assert np.abs(np.array(got) - np.histogram(values, 20)[0]).sum() <= 4, "only values on an edge may move"


def test_summaries(frame):
    df = frame("recipient_name string, award_amount double", ("A", 1e9), (None, 3e9), ("B", 1e9), ("A", None))
    total, top = summaries.award_summary(df, 2)
    assert tuple(total.first()) == (4, 5e9, 5.0)
    assert [(r.rank, r.recipient_name, r.total_bn) for r in top.collect()] == [(1, None, 3.0), (2, "A", 1.0)]
    trade = frame("country_code string, country_name string, export_value long", ("1", "X", 10), ("2", "X", 20), ("1", "X", None))
    total, top = summaries.trade_summary(trade)
    assert total.first().total_value == 30.0
    assert [(r.rank, r.country_code) for r in top.collect()] == [(1, "2"), (2, "1")]


def test_row_numbers_over_many_parts(spark):
    df = spark.range(0, 5000, 1, 16).select("id", (F.col("id") * 7919 % 1000).alias("v"))
    rows = ranking.number_rows(df, ranking.descending("v", "id")).orderBy("rank").collect()
    expected = sorted(((i * 7919 % 1000, i) for i in range(5000)), key=lambda t: (-t[0], t[1]))
    assert [(r.v, r.id) for r in rows] == expected and [r["rank"] for r in rows] == list(range(1, 5001))


def test_batch_prompts_and_manifest(spark, frame, segments):
    known = segments.where("naics_code is null or naics_code <> '336499'")
    batch = briefs.select_batch(known, 2)
    assert sorted(keys(batch)) == ["336411", "336414", "ID", "WI"]
    existing = frame("identifier string, modified_at timestamp")
    moment = F.lit("2024-01-31 10:20:30.5").cast("timestamp")
    existing = spark.range(1).select(F.lit("WI").alias("identifier"), moment.alias("modified_at"))
    split = {r.identifier: r.cached for r in briefs.cache_split(batch, existing).collect()}
    assert split == {"WI": True, "ID": False, "336411": False, "336414": False}
    assert sorted(r.identifier for r in briefs.to_write(batch, existing).collect()) == ["336411", "336414", "ID"]
    written = frame("identifier string, tokens_used long", ("ID", 1147), ("336411", 900), ("WI", 5)).withColumn("generated_at", moment)
    manifest = briefs.manifest(batch, existing, written, "out")
    rows = manifest.collect()
    assert [r.state or r.naics_code for r in rows] == ["ID", "WI", "336411"], "336414 has no text yet"
    assert [r.tokens_used for r in rows] == [1147, 0, 900]
    assert rows[1].generated_at == "2024-01-31T10:20:30.500000+00:00" and rows[0].brief_file_path == "out/ID.txt"
    assert tuple(briefs.token_usage(manifest).first()) == (3, 2, 2047)
    assert [r.key for r in briefs.manifest_listing(manifest).collect()] == ["ID", "WI", "336411"]


STATE_PROMPT = """Supplier Segment: U.S. State — TX

Risk metrics for this segment:
- Row type: STATE
- State: TX
- Total contract value: $450,000,000,000
- Recipient count: 1,636
- HHI score (0-10000): 5,977.00
- Concentration risk label: High
- Composite risk score (0-100): 59.77
- Risk tier: Medium

Using only the metrics above, write the one-page risk brief in the exact four-section format defined in your instructions."""


def test_prompt_texts(segments):
    rows = {r.identifier: r for r in briefs.prompts(segments).collect()}
    assert rows["TX"].prompt == STATE_PROMPT and rows["TX"].label == "STATE TX"
    lines = rows["336414"].prompt.split("\n")
    assert lines[0] == "Supplier Segment: NAICS 336414 — Guided Missiles"
    assert "- Employment count: 1,000" in lines and "- Workforce risk score (0-100): N/A" in lines
    other = segments.where("state = 'TX'").withColumn("row_type", F.lit("region"))
    text = other.select(briefs.prompt(other).alias("p")).first().p
    assert text.startswith("Supplier Segment: Unknown row_type (REGION)\n\nRisk metrics")
    assert "\n- total_contract_value: 450000000000.0\n" in text and "\n- naics_code: N/A\n" in text


def test_metric_panel(segments):
    rows = briefs.metric_panel(segments.where("state = 'TX' or naics_code = '336414'")).orderBy("identifier", "position").collect()
    assert [(r.identifier, r.label, r.value) for r in rows] == [
        ("336414", "Composite Risk", "37.98"), ("336414", "Geo Risk", "37.98"), ("336414", "Workforce Risk", "n/a"),
        ("TX", "Composite Risk", "59.77"), ("TX", "HHI Score", "5977.00"), ("TX", "Contract Value", "$450.00B"), ("TX", "Recipients", "1,636"),
    ]
    assert rows[0].title == "NAICS 336414 — Guided Missiles" and rows[-1].title == "State of TX"


def test_document_lines(frame):
    df = frame("id int, t string", (1, "# Title\n\n## Head\n- a\nplain\n"), (2, ""), (3, None))
    rows = briefs.document_lines(df, "id", "t").orderBy("id", "line_no").collect()
    assert [(r.id, r.line_no, r.kind, r.payload) for r in rows] == [
        (1, 2, "blank", ""), (1, 3, "heading", "Head"), (1, 4, "bullet", "a"), (1, 5, "paragraph", "plain"),
    ]


def test_existing_keys_do_not_multiply_rows(frame):
    left = frame("k int", (1,), (2,), (None,))
    right = frame("k int", (1,), (1,), (None,))
    rows = keyed.split_by_existing(left, right, "k").collect()
    assert sorted(str(tuple(r)) for r in rows) == sorted(["(1, True)", "(2, False)", "(None, False)"])
    assert keyed.only_new(left, right, "k").count() == 2
