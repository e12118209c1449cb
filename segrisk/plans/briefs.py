"""Brief batch: selection, cache split, prompts, manifest, and text clean-up.

The texts themselves come from outside as a table (identifier, brief_text,
tokens_used, generated_at); writing them is no data processing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segrisk.functions.formatting import (
    log_label,
    prompt_any,
    prompt_int,
    prompt_kind,
    prompt_money,
    prompt_number,
    prompt_text,
    report_int,
    report_money,
    report_score,
    report_title,
    segment_identifier,
)
from segrisk.functions.text import (
    clean_markup,
    is_title,
    line_kind,
    line_payload,
    single_line_ends,
    split_lines,
)
from segrisk.functions.values import code_text, iso_utc
from segrisk.operators.keyed import only_new, split_by_existing
from segrisk.operators.ranking import descending, top_k_plus_all
from segrisk.operators.shape import conform, entries
from segrisk.plans.scoring import canonical_keys, marked
from segrisk.schemas import MANIFEST

# --- fixed values: the prompt -------------------------------------------------

STATE_LINES = [
    ("Row type", "row_type", prompt_kind),
    ("State", "state", prompt_text),
    ("Total contract value", "total_contract_value", prompt_money),
    ("Recipient count", "recipient_count", prompt_int),
    ("HHI score (0-10000)", "hhi_score", prompt_number),
    ("Concentration risk label", "concentration_risk_label", prompt_text),
    ("Composite risk score (0-100)", "composite_risk_score", prompt_number),
    ("Risk tier", "risk_tier", prompt_text),
]
SECTOR_LINES = [
    ("Row type", "row_type", prompt_kind),
    ("NAICS code", "naics_code", prompt_text),
    ("NAICS label", "naics_label", prompt_text),
    ("Export value", "export_value", prompt_money),
    ("Employment count", "employment_count", prompt_int),
    (
        "Export concentration risk score (0-100) — measures dependency on single export destination country",
        "geo_risk_score",
        prompt_number,
    ),
    ("Workforce risk score (0-100)", "workforce_risk_score", prompt_number),
    ("Composite risk score (0-100)", "composite_risk_score", prompt_number),
    ("Risk tier", "risk_tier", prompt_text),
]
STATE_HEADER = "Supplier Segment: U.S. State — "
SECTOR_HEADER = "Supplier Segment: NAICS "
UNKNOWN_HEADER = "Supplier Segment: Unknown row_type ("
METRICS_HEADING = "Risk metrics for this segment:"
CLOSING = (
    "Using only the metrics above, write the one-page risk brief in the exact "
    "four-section format defined in your instructions."
)

# Metric panel: label, column, formatter.
STATE_PANEL = [
    ("Composite Risk", "composite_risk_score", report_score),
    ("HHI Score", "hhi_score", report_score),
    ("Contract Value", "total_contract_value", report_money),
    ("Recipients", "recipient_count", report_int),
]
SECTOR_PANEL = [
    ("Composite Risk", "composite_risk_score", report_score),
    ("Geo Risk", "geo_risk_score", report_score),
    ("Workforce Risk", "workforce_risk_score", report_score),
]

# ------------------------------------------------------------------------------


def identified(segments: DataFrame, strict: bool = False) -> DataFrame:
    key = segment_identifier(F.col("row_type"), F.col("state"), F.col("naics_code"), strict)
    return segments.withColumn("identifier", key)


def batch_order() -> list[Column]:
    return [*descending("composite_risk_score"), *canonical_keys()]


def select_batch(segments: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` worst states, then every industry; ``branch`` and score give the order.

    Equal scores stay in the canonical order of the table.
    """
    segments = marked(segments)
    return top_k_plus_all(
        segments.where(F.col("row_type") == "STATE"),
        n,
        batch_order(),
        segments.where(F.col("row_type") == "NAICS"),
    )


def _bullets(lines) -> list[Column]:
    return [F.concat(F.lit(f"- {label}: "), show(F.col(name))) for label, name, show in lines]


def prompt(df: DataFrame) -> Column:
    """Prompt text of a row of ``df``: header, bullets by row type, closing line.

    A row of another type lists all its columns. Numbers and codes are written
    as plain digits.
    """
    kind = prompt_kind(F.col("row_type"))
    state, code, label = (prompt_text(F.col(c)) for c in ("state", "naics_code", "naics_label"))

    def text(header: Column, bullets: list[Column]) -> Column:
        heading = F.lit(METRICS_HEADING)
        blank = F.lit("")
        return F.concat_ws("\n", header, blank, heading, *bullets, blank, F.lit(CLOSING))

    every = [F.concat(F.lit(f"- {name}: "), prompt_any(F.col(name), t)) for name, t in df.dtypes if name != "is_padded"]
    return (
        F.when(kind == "STATE", text(F.concat(F.lit(STATE_HEADER), state), _bullets(STATE_LINES)))
        .when(
            kind == "NAICS",
            text(F.concat(F.lit(SECTOR_HEADER), code, F.lit(" — "), label), _bullets(SECTOR_LINES)),
        )
        .otherwise(text(F.concat(F.lit(UNKNOWN_HEADER), kind, F.lit(")")), every))
    )


def prompts(segments: DataFrame) -> DataFrame:
    """(identifier, label, prompt) per segment."""
    keyed = identified(segments)
    return keyed.select(
        "identifier",
        log_label(F.col("row_type"), F.col("state"), F.col("naics_code")).alias("label"),
        prompt(segments).alias("prompt"),
    )


def to_write(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Prompts of the segments that have no brief yet."""
    return prompts(only_new(identified(batch, strict=True), existing, "identifier").drop("identifier"))


def cache_split(batch: DataFrame, existing: DataFrame) -> DataFrame:
    return split_by_existing(identified(batch, strict=True), existing, "identifier")


def manifest(batch: DataFrame, existing: DataFrame, written: DataFrame, folder: str = "briefs") -> DataFrame:
    """One record per selected segment.

    ``existing`` (identifier, modified_at) were reused: no tokens, their file
    time. ``written`` (identifier, tokens_used, generated_at) are new. A brief
    in both counts as reused, as it would not have been written again.
    """
    rows = identified(batch, strict=True)
    reused = existing.select("identifier", F.col("modified_at"))
    fresh = written.select("identifier", F.col("tokens_used").alias("_tokens"), F.col("generated_at").alias("_at"))
    joined = rows.join(reused, "identifier", "left").join(fresh, "identifier", "left")
    is_reused = F.col("modified_at").isNotNull()
    order = ["branch"] if "branch" in batch.columns else []
    table = joined.withColumns(
        {
            "row_type": F.upper("row_type"),
            "naics_code": code_text(F.col("naics_code")),
            "brief_file_path": F.concat(F.lit(f"{folder}/"), F.col("identifier"), F.lit(".txt")),
            "tokens_used": F.when(is_reused, F.lit(0)).otherwise(F.col("_tokens")).cast("long"),
            "generated_at": F.when(is_reused, iso_utc(F.col("modified_at"))).otherwise(iso_utc(F.col("_at"))),
        }
    )
    done = table.where(is_reused | F.col("_at").isNotNull())
    ordered = done.orderBy(*order, *descending("composite_risk_score", "state", "naics_code")) if order else done
    return conform(ordered, MANIFEST)


def token_usage(manifest: DataFrame) -> DataFrame:
    """Briefs covered, newly written ones (calls) and their tokens."""
    return manifest.agg(
        F.count(F.lit(1)).alias("briefs"),
        F.count_if(F.col("tokens_used") > 0).alias("calls"),
        F.coalesce(F.sum("tokens_used"), F.lit(0)).alias("total_tokens"),
    )


def manifest_listing(manifest: DataFrame) -> DataFrame:
    """Printable columns: key of the row's own type, score with two digits."""
    key = F.when(F.col("row_type") == "STATE", F.col("state")).otherwise(F.col("naics_code"))
    return manifest.select(
        "row_type",
        F.coalesce(key, F.lit("")).alias("key"),
        report_score(F.col("composite_risk_score")).alias("score"),
        F.coalesce("risk_tier", F.lit("")).alias("tier"),
        "tokens_used",
        "brief_file_path",
    )


def metric_panel(segments: DataFrame) -> DataFrame:
    """Wide to long: the panel's (label, value) pairs, four for a state, else three."""

    def pairs(panel) -> Column:
        return F.array(
            *[
                F.struct(F.lit(label).alias("label"), show(F.col(name)).alias("value"))
                for label, name, show in panel
            ]
        )

    panel = F.when(F.upper("row_type") == "STATE", pairs(STATE_PANEL)).otherwise(pairs(SECTOR_PANEL))
    title = report_title(F.col("row_type"), F.col("state"), F.col("naics_code"), F.col("naics_label"))
    keyed = identified(segments).select("identifier", title.alias("title"), panel.alias("panel"))
    return keyed.select("identifier", "title", F.posexplode("panel").alias("position", "pair")).select(
        "identifier",
        "title",
        (F.col("position") + 1).cast("long").alias("position"),
        F.col("pair.label").alias("label"),
        F.col("pair.value").alias("value"),
    )


def clean_texts(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn(text, clean_markup(F.col(text)))


def document_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every line of every text with its kind and payload; title lines are left out."""
    plain = df.select(key, single_line_ends(F.col(text)).alias("text"))
    lines = entries(plain, split_lines(F.col("text")), key).withColumnRenamed("entry", "line")
    kinds = lines.where(~is_title(F.col("line"))).withColumn("kind", line_kind(F.col("line")))
    return kinds.select(
        key,
        (F.col("position") + 1).cast("long").alias("line_no"),
        "kind",
        line_payload(F.col("line"), F.col("kind")).alias("payload"),
    )
