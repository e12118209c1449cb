"""CSV of other writers, against Python's reader and DuckDB's."""

import csv
import random

import duckdb
import pytest

from segrisk.sources import sinks, tables
from segrisk.sources.delimited import file_lines, files_of, numbered_lines, read_delimited, records
from segrisk.schemas import AWARDS

PIECES = ["a", "é", "\n", "\r\n", '"', ",", " ", "\\n", "\\", "日本", ";", "x" * 40, "\n\n", '""', "NA", "\r"]


def made(seed, n, columns):
    rng = random.Random(seed)
    return [["".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 2, 5, 9]))) for _ in columns] for _ in range(n)]


def written(path, columns, rows, end="\r\n", sep=",", quoting=csv.QUOTE_MINIMAL, mark=""):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(mark)
        writer = csv.writer(f, lineterminator=end, delimiter=sep, quoting=quoting)
        writer.writerows([columns, *rows])


def plain(rows):
    return sorted((tuple(v or None for v in r) for r in rows if any(r)), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def small_blocks(spark):
    """Files are cut every 700 bytes, so that records span blocks."""
    setting = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(setting, "700")
    yield spark
    spark.conf.unset(setting)


@pytest.mark.parametrize(("seed", "end", "sep"), [(1, "\r\n", ","), (2, "\n", ","), (3, "\n", ";"), (4, "\r\n", ",")])
def test_records_across_blocks_equal_python(small_blocks, tmp_path, seed, end, sep):
    columns = ["id", "first,name", "text"]
    rows = [[str(i), *r] for i, r in enumerate(made(seed, 400, columns[1:]))]
    quoting = csv.QUOTE_ALL if seed == 4 else csv.QUOTE_MINIMAL
    written(tmp_path / "f.csv", columns, rows, end, sep, quoting, "﻿" if seed % 2 else "")
    df = read_delimited(small_blocks, str(tmp_path / "f.csv"), columns, sep)
    assert found(df) == plain(rows)
    assert file_lines(small_blocks, str(tmp_path / "f.csv")).select("block").distinct().count() > 10


def test_one_record_over_many_blocks(small_blocks, tmp_path):
    rows = [["1", "x\n" * 3000], ["2", 'q"\n'], ["3", "\n" * 2000], ["4", "end"]]
    written(tmp_path / "f.csv", ["id", "text"], rows, "\n")
    assert found(read_delimited(small_blocks, str(tmp_path / "f.csv"), ["id", "text"])) == plain(rows)


def test_equals_duckdb(small_blocks, tmp_path):
    rows = [[str(i), *r] for i, r in enumerate(made(9, 300, ["a", "b"]))]
    rows = [[c.replace("\r", "") for c in r] for r in rows]
    written(tmp_path / "f.csv", ["id", "a", "b"], rows, "\n", quoting=csv.QUOTE_ALL)
    theirs = duckdb.sql(f"SELECT * FROM read_csv('{tmp_path}/f.csv', header=true, all_varchar=true, quote='\"', escape='\"', delim=',')")
    mine = found(read_delimited(small_blocks, str(tmp_path / "f.csv"), ["id", "a", "b"]))
    assert mine == sorted((tuple(v or None for v in r) for r in theirs.fetchall()), key=str)


def test_files_with_headers_of_their_own(small_blocks, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    rows = {c: made(k, 30, ["a", "b"]) for k, c in enumerate("xyz")}
    rows = {c: [[a or "-", b] for a, b in r] for c, r in rows.items()}
    written(folder / "x.csv", ["a", "b"], rows["x"])
    written(folder / "y.csv", ["b", "extra\nline", "a"], [[b, "e", a] for a, b in rows["y"]], "\n")
    written(folder / "z.csv", ["a"], [[a] for a, _ in rows["z"]], "\n")
    (folder / "empty.csv").write_text("")
    wanted = plain(rows["x"]) + plain(rows["y"]) + [(a, None) for a, _ in rows["z"]]
    assert found(read_delimited(small_blocks, str(folder), ["a", "b"])) == sorted(wanted, key=str)


def test_plain_files_stay_with_the_native_reader(spark, tmp_path):
    written(tmp_path / "f.csv", ["a", "b"], [["1", 'x "y", z'], ["", " t "]], "\n")
    df = read_delimited(spark, str(tmp_path / "f.csv"), ["b", "missing"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "Exchange" not in plan
    assert found(df) == [(" t ", None), ('x "y", z', None)]


def test_only_records_that_span_lines_are_grouped(small_blocks, tmp_path):
    quiet, busy = [[str(i), "t" * 30] for i in range(300)], [["n", "a\nb"]]
    written(tmp_path / "f.csv", ["id", "text"], quiet[:200] + busy + quiet[200:], "\n")
    lines = file_lines(small_blocks, str(tmp_path / "f.csv"))
    numbered = numbered_lines(lines)
    odd = numbered.where("odd = 1 OR before % 2 = 1").collect()
    assert len(odd) == 2 and {r["before"] for r in odd} == {0, 1}
    assert records(numbered).count() == 302


def test_open_quote_stops_and_empty_input_has_no_rows(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="never closed in .*bad.csv"):
        read_delimited(spark, str(tmp_path / "bad.csv"), ["a", "b"])
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    assert read_delimited(spark, str(tmp_path / "none"), ["a", "b"]).count() == 0
    (tmp_path / "head.csv").write_text("a,b\r\n")
    assert read_delimited(spark, str(tmp_path / "head.csv"), ["a", "b"]).count() == 0


def test_other_readers_read_our_files_alike(spark, tmp_path):
    names = ["A\nB", "A\\nB", "x\r\ny", "back\\", 'quote "x"\n', "C:\\new", "a,b", "plain", "\r"]
    path = str(tmp_path / "awards")
    sinks.write_clean_csv(spark.createDataFrame([(n, float(i), "TX", None, None) for i, n in enumerate(names)], AWARDS).coalesce(1), path)
    with open(next((tmp_path / "awards").glob("part-*.csv")), encoding="utf-8", newline="") as f:
        theirs = {r["recipient_name"] for r in csv.DictReader(f)}
    assert theirs == set(names)
    assert {r.recipient_name for r in tables.read_awards(spark, path).collect()} == set(names)


def test_first_lines_are_found_without_sorting_all_lines(small_blocks, tmp_path):
    for name, end in (("a", "\n"), ("b", "\r\n")):
        written(tmp_path / f"{name}.csv", [name, "text"], [[str(i), "x"] for i in range(900)], end)
    of_file = files_of(file_lines(small_blocks, str(tmp_path)))
    assert sorted(r["first"] for r in of_file.collect()) == ["a,text", "b,text\r"]
    text = of_file._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in text and "Sort" not in text
