"""Quality rates of a normalised batch, and the thresholds they must meet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_of, blank, rate

# Metric, comparison, limit.
THRESHOLDS = [
    ("parse_success_rate", ">=", 0.99),
    ("empty_text_rate", "<=", 0.005),
    ("duplicate_rate", "<=", 0.02),
    ("missing_metadata_rate", "<=", 0.01),
    ("missing_license_rate", "<=", 0.01),
    ("malformed_article_rate", "<=", 0.01),
]
PROVENANCE = ["record_id", "source_dataset", "source_url", "license", "retrieved_at", "transform_version"]


def quality_metrics(records: DataFrame, error: str = "error") -> DataFrame:
    """One row of counts and six rates over normalised records with their error column.

    One aggregation; the distinct count is the only part with a second
    exchange. An empty table gives zeros.
    """
    good = F.col(error).isNull()
    count = lambda c: F.count_if(good & F.coalesce(c, F.lit(False)))
    unlicensed = blank("license") | (F.upper("license") == "UNKNOWN")
    a = records.agg(
        F.count("*").alias("total_seen"), F.count_if(good).alias("total_normalized"), F.count_if(~good).alias("total_rejected"), count(blank("text")).alias("empty"),
        F.count_distinct(F.when(good, F.col("record_id"))).alias("distinct_ids"), count(any_of(blank(c) for c in PROVENANCE)).alias("missing_metadata"), count(unlicensed).alias("missing_license"), count(F.col("article_number") < 1).alias("malformed"),
    )
    n = F.col("total_normalized")
    return a.select(
        "total_seen", "total_normalized", "total_rejected", rate(n, F.col("total_seen")).alias("parse_success_rate"), rate(F.col("empty"), n).alias("empty_text_rate"), rate(n - F.col("distinct_ids"), n).alias("duplicate_rate"),
        rate(F.col("missing_metadata"), n).alias("missing_metadata_rate"), rate(F.col("missing_license"), n).alias("missing_license_rate"), rate(F.col("malformed"), n).alias("malformed_article_rate"),
    )


def violations(metrics: DataFrame) -> DataFrame:
    """``metric, value, bound, message`` for each threshold that the one row of metrics misses."""
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(op).alias("op"), F.lit(limit).alias("bound")) for m, op, limit in THRESHOLDS])
    t = metrics.select(F.explode(rows).alias("t")).select("t.*").where("(op = '>=' and value < bound) or (op = '<=' and value > bound)")
    words = F.when(F.col("op") == ">=", "< required").otherwise("> allowed")
    return t.select("metric", "value", "bound", F.concat(F.col("metric"), F.format_string("=%.4f ", "value"), words, F.format_string(" %.4f", "bound")).alias("message"))
