"""Command line: ingest landed responses, score segments, prepare and record briefs.

    spark-submit segrisk/run.py ingest --landed DIR --out DIR
    spark-submit segrisk/run.py score --silver DIR --out DIR
    spark-submit segrisk/run.py prompts --segments DIR --briefs DIR --out DIR
    spark-submit segrisk/run.py manifest --segments DIR --briefs DIR --written DIR --out DIR

Every path may be any file system Spark can reach.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from segrisk.dims import REQUESTED_HS_CODES, REQUESTED_PERIODS, series_crosswalk  # noqa: E402
from segrisk.operators.filters import in_trade_scope  # noqa: E402
from segrisk.operators.keyed import require_rows  # noqa: E402
from segrisk.plans import briefs  # noqa: E402
from segrisk.plans.scoring import score_segments  # noqa: E402
from segrisk.plans.workforce import require_series  # noqa: E402
from segrisk.schemas import AWARDS, EMPLOYMENT, TRADE  # noqa: E402
from segrisk.sources import landed, sinks, tables  # noqa: E402


def ingest(spark: SparkSession, landed_dir: str, out: str, skip_damaged: bool = False) -> None:
    """Responses in ``awards/``, ``trade/``, ``employment/`` to a raw and a clean layer.

    The clean tables are parsed from the raw layer just written, split by year
    where they have one. A response that cannot be read stops the run; with
    ``skip_damaged`` it is left out and written to ``rejects``. Without any
    award record the run stops too.
    """
    strict = not skip_damaged
    for name in ("awards", "trade", "employment"):
        sinks.write_raw(landed.read_bodies(spark, f"{landed_dir}/{name}"), f"{out}/raw/{name}")

    def raw(name: str) -> DataFrame:
        return spark.read.schema("body string").json(f"{out}/raw/{name}")

    if skip_damaged:
        for name in ("awards", "trade", "employment"):
            landed.rejects(raw(name), name).write.mode("overwrite").json(f"{out}/rejects/{name}")
    sinks.write_clean(landed.parse_awards(raw("awards"), strict), f"{out}/clean/awards")
    require_rows(spark.read.schema(AWARDS).parquet(f"{out}/clean/awards"), "awards")
    scope = in_trade_scope(F.col("hs_code"), F.col("period"), REQUESTED_HS_CODES, REQUESTED_PERIODS)
    trade = landed.clean_trade(landed.trade_matrix(raw("trade"), strict=strict).where(scope))
    sinks.write_clean(trade, f"{out}/clean/trade", "year")
    sinks.write_clean(landed.parse_employment(raw("employment"), strict=strict), f"{out}/clean/employment", "year")


def score(spark: SparkSession, silver: str, out: str, csv: bool = False) -> DataFrame:
    """Clean tables, Parquet or CSV, to the segments table and its CSV export."""
    if csv:
        awards = tables.read_awards(spark, f"{silver}/awards")
        trade = tables.read_trade(spark, f"{silver}/trade")
        employment = tables.read_employment(spark, f"{silver}/employment")
    else:
        awards = spark.read.schema(AWARDS).parquet(f"{silver}/awards")
        trade = spark.read.schema(TRADE).parquet(f"{silver}/trade")
        employment = spark.read.schema(EMPLOYMENT).parquet(f"{silver}/employment")
    require_series(employment, series_crosswalk(spark))
    sinks.write_segments(score_segments(awards, trade, employment), f"{out}/segments")
    return sinks.export_segments(tables.read_segments(spark, f"{out}/segments"), f"{out}/segments_csv")


def prompts(spark: SparkSession, segments: str, brief_dir: str, out: str, n: int) -> None:
    """Prompts of the selected segments that have no brief yet."""
    batch = briefs.select_batch(tables.read_segments(spark, segments), n)
    todo = briefs.to_write(batch, tables.read_briefs(spark, brief_dir))
    todo.write.mode("overwrite").json(out)


def manifest(spark: SparkSession, segments: str, brief_dir: str, written: str, out: str, n: int) -> None:
    """Manifest of the selection; ``written`` holds the new briefs as JSON lines."""
    batch = briefs.select_batch(tables.read_segments(spark, segments), n)
    fresh = spark.read.schema("identifier string, tokens_used long, generated_at timestamp").json(written)
    existing = tables.read_briefs(spark, brief_dir)
    sinks.write_manifest(briefs.manifest(batch, existing, fresh, brief_dir), out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    for name, paths in {
        "ingest": ["landed", "out"],
        "score": ["silver", "out"],
        "prompts": ["segments", "briefs", "out"],
        "manifest": ["segments", "briefs", "written", "out"],
    }.items():
        command = commands.add_parser(name)
        for path in paths:
            command.add_argument(f"--{path}", required=True)
        if name == "ingest":
            command.add_argument("--skip-damaged", action="store_true", help="write unreadable responses to rejects")
        if name == "score":
            command.add_argument("--csv", action="store_true", help="the clean tables are CSV")
        if name in ("prompts", "manifest"):
            command.add_argument("--top", type=int, default=10)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"segrisk-{args.command}").getOrCreate()
    if args.command == "ingest":
        ingest(spark, args.landed, args.out, args.skip_damaged)
    elif args.command == "score":
        score(spark, args.silver, args.out, args.csv)
    elif args.command == "prompts":
        prompts(spark, args.segments, args.briefs, args.out, args.top)
    else:
        manifest(spark, args.segments, args.briefs, args.written, args.out, args.top)


if __name__ == "__main__":
    main()
