"""Registered queries against SQL, and the shape of their plans."""

import datetime
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from oracle_check import connect, spark_rows, sql_rows
from segrisk.operators.ranking import descending, number_rows
from segrisk.plans import concentration, unify
from segrisk.workload import facts
from segrisk.workload.oracle import ORACLE
from segrisk.workload.queries import QUERIES



@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    wanted = sql_rows(connection, ORACLE[name])
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert got[1] == wanted[1]


@pytest.mark.parametrize("hidden", ["public_tokenizers", "segrisk.llm", "corpus_pipeline"])
def test_entry_without_the_text_operators(hidden):
    """What only the operators over documents need may be missing."""
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = str(Path(entry_points.__file__).parent)
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    n, sql = map(int, out.split()[-2:])
    assert n >= len(QUERIES) and sql >= len(ORACLE)


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() > 50


def test_summing_below_the_join_changes_nothing(spark, sf_dir):
    early = concentration.recipient_totals(facts.award_parts(spark, sf_dir))
    plain = concentration.recipient_totals(concentration.award_parts(facts.awards(spark, sf_dir)))
    assert early.exceptAll(plain).count() == 0 and plain.exceptAll(early).count() == 0


def test_sums_by_key_agree_at_both_grains(spark, sf_dir):
    rows = unify.awards_by_key(facts.awards(spark, sf_dir))
    parts = unify.parts_by_key(facts.award_parts(spark, sf_dir))
    assert rows.exceptAll(parts).count() == 0 and parts.exceptAll(rows).count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "scored_segments", "hhi_by_nation", "entity_shares", "dest_dependence", "dest_rollup_worst", "series_stress",
    "series_changes", "unify_segments", "segment_prompts", "text_fold", "line_classes", "ingest_trade",
    "ingest_awards", "ingest_employment", "filtered_view", "eda_summary", "cache_split", "coverage_report",
]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_distributed(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_flagship_reads_each_table_once_per_use(spark, sf_dir):
    """Line items feed awards and employment, the other tables one of them each."""
    text = plan(QUERIES["scored_segments"](spark, sf_dir))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    with_keys = [s for s in scans if "l_suppkey" in s]
    assert len(with_keys) == 1 and len(scans) == 5
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert not any("l_comment" in r or "l_orderkey" in r for r in read), "only the needed columns are read"


def test_hhi_combines_before_shuffle(spark, sf_dir):
    text = plan(QUERIES["hhi_by_nation"](spark, sf_dir))
    assert text.count("partial_sum") >= 2 and "Window" not in text


def test_top_k_never_sorts_everything(spark, sf_dir):
    text = plan(QUERIES["largest_awards"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_fiscal_scope_reaches_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    text = plan(QUERIES["fiscal_year_totals"](spark, sf_dir))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text, re.S).group(1)
    assert "In(o_orderstatus" in pushed and "GreaterThanOrEqual(o_orderdate" in pushed


def test_row_numbers_use_no_single_task(spark, sf_dir):
    orders = facts.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    text = plan(number_rows(orders, descending("o_totalprice", "o_orderkey")))
    # Lines that begin with a colon are of the subquery over part sizes; outside of it nothing is dealt.
    outside = "\n".join(line for line in text.split("\n") if not line.lstrip().startswith(":"))
    assert "FileScan parquet [o_orderkey" in outside
    assert "Exchange" not in outside and "Join" not in outside, "the table is not dealt by part"
    windows = [line for line in text.split("\n") if "Window [" in line]
    assert windows and all("_size" in line and "o_orderkey" not in line for line in windows)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_detail_rows_do_not_meet_on_few_keys(no_broadcast, sf_dir):
    shares = plan(QUERIES["entity_shares"](no_broadcast, sf_dir))
    detail = [line for line in shares.split("\n") if "hashpartitioning(n_name" in line]
    assert len(detail) <= 1, "only the totals are dealt by group"
    trade = plan(facts.trade(no_broadcast, sf_dir))
    assert "Exchange" not in trade and "Join" not in trade


def test_views_share_one_stored_table(spark, sf_dir):
    first, second = (facts.segments(spark, sf_dir) for _ in range(2))
    assert first.inputFiles() == second.inputFiles() and "lineitem" not in plan(QUERIES["state_map"](spark, sf_dir))


def test_row_level_run_scans_awards_once(spark, sf_dir):
    text = plan(QUERIES["scored_row_level"](spark, sf_dir))
    scans = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "l_extendedprice" in s]
    assert not scans, "awards are read from the table of recipient totals"


@pytest.fixture(scope="module")
def gaps(spark, tmp_path_factory):
    """Tables in which some awards have no amount or recipient, some exports no destination or value."""
    folder = tmp_path_factory.mktemp("gaps")
    items = [
        (n, n % 4 + 1, n % 5 + 1, n % 7 + 1, float(n % 9), None if n % 6 == 0 else 100.25 + n, [0.0, 0.1][n % 2], [0.01, 0.0, 0.08][n % 8 // 3],
         "ANR"[n % 3], "F", datetime.datetime(1997, n % 12 + 1, 2))
        for n in range(240)
    ]
    kinds = ["click", "error", "purchase", "signup", "view"]
    events = [
        (n, datetime.datetime(1998, 1, 1), [None, 7, 8, 57][n // 5 % 4], kinds[n % 5], None if n % 11 == 0 else n % 13 / 2, None) for n in range(200)
    ]
    made = {
        "lineitem": items,
        "events": events,
        "supplier": [(1, "a", 3, 1.0), (2, "b", 3, 1.0), (3, None, 4, 1.0), (4, "d", 4, -1.0), (5, "e", 5, 1.0)],
        "part": [(k, "p", "Brand#1", ["ECONOMY", "LARGE", "MEDIUM", "SMALL"][k - 1], 1, 1.0) for k in range(1, 5)],
    }
    connection = duckdb.connect()
    for name, given in made.items():
        spark.createDataFrame(given, facts.SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return str(folder), connection, made


@pytest.mark.parametrize(
    "name",
    ["unmapped_products", "scored_row_level", "coded_awards_by_key", "panel_metrics", "token_usage", "exported_segments", "manifest_array"],
)
def test_query_equals_sql_where_values_are_missing(spark, gaps, name):
    folder, connection, _ = gaps
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(connection, ORACLE[name])


def test_every_given_amount_and_destination_counts(spark, gaps):
    """Those of any discount, nation and user; an export without a destination is one, of no destination."""
    folder, _, made = gaps
    amounts = [r[5] for r in made["lineitem"] if r[5] is not None]
    by_key = QUERIES["coded_awards_by_key"](spark, folder).collect()
    assert sum(r["recipient_count"] for r in by_key) == len(amounts)
    assert sum(r["total_contract_value"] for r in by_key) == pytest.approx(sum(amounts))
    sold = [r for r in made["events"] if r[3] == "purchase"]
    (product,) = QUERIES["unmapped_products"](spark, folder).collect()
    assert product["export_value"] == sum(round(r[4] * 100) for r in sold if r[4] is not None and r[4] >= 1)
    assert product["country_count"] == len({r[2] for r in sold} - {None}) == 3
    assert any(r[2] is None and (r[4] or 0) >= 1 for r in sold)
