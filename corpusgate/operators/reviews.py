"""Reviewers' rows: validation, adjudication per candidate, audit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rate, reasons, text_or

# The decision labels, those that take precedence, and the confidence levels.
LABELS = [
    "accept_for_later_corpus_candidate", "reject_not_article", "reject_duplicate", "reject_too_short", "reject_too_long", "reject_missing_metadata", "needs_legal_expert_review", "needs_parser_fix", "uncertain",
]
PRIORITY = {"needs_parser_fix": "parser_fix_required", "needs_legal_expert_review": "legal_expert_review_required", "uncertain": "uncertain_requires_adjudication"}
LEVELS = ["high", "medium", "low"]
REQUIRED = ["reviewer_id", "review_date", "candidate_id", "decision_label", "confidence", "notes", "legal_ground_truth_approved", "rag_index_approved"]
FALSE, TRUE = ["false", "0", "no", "n"], ["true", "1", "yes", "y"]
ACCEPT = "accept_for_later_corpus_candidate"


def _flag_errors(field: str) -> list[tuple[Column, str]]:
    low = F.lower(field)  # trimmed before
    return [(low.isin(TRUE), f"{field} must remain false."), ((low != "") & ~low.isin(TRUE + FALSE), f"{field} must be a boolean false value.")]


def validate_reviews(df: DataFrame) -> DataFrame:
    """Rows with trimmed fields, labels and confidences in lower case, and ``invalid_reasons``, sorted and distinct.

    A valid row has no reasons. Dates must be ``YYYY-MM-DD``. Missing required
    columns count as blank; other columns are passed through.
    """
    for c in REQUIRED:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    tidy = {c: text_or(c) for c in REQUIRED}
    tidy |= {c: F.lower(tidy[c]) for c in ("decision_label", "confidence")}
    staged = df.withColumns(tidy)
    label, level, date = F.col("decision_label"), F.col("confidence"), F.col("review_date")
    good_date = date.rlike(r"^\d{4}-\d{2}-\d{2}$") & date.try_cast("date").isNotNull()
    checks = [(F.col(c) == "", f"{c} is required.") for c in REQUIRED]
    checks += [((date != "") & ~F.coalesce(good_date, F.lit(False)), "review_date must be ISO format YYYY-MM-DD.")]
    checks += _flag_errors("legal_ground_truth_approved") + _flag_errors("rag_index_approved")
    named = F.array_compact(F.array(
        F.when((label != "") & ~label.isin(LABELS), F.concat(F.lit("decision_label is invalid: "), label)), F.when((level != "") & ~level.isin(LEVELS), F.concat(F.lit("confidence is invalid: "), level)),
    ))
    return staged.withColumn("invalid_reasons", F.array_sort(F.array_distinct(F.concat(reasons(*checks), named))))


def adjudicate(valid: DataFrame) -> DataFrame:
    """One row per candidate: review count, sorted distinct reviewers, labels and confidences, status and consensus.

    The sets are of labels, levels and the reviewers of one candidate. One
    label is a consensus unless it asks for more work; of several labels the
    ones that do come first, in fixed order.
    """
    a = valid.groupBy("candidate_id").agg(
        F.count("*").alias("review_count"), F.array_sort(F.collect_set("reviewer_id")).alias("reviewer_ids"), F.array_sort(F.collect_set("decision_label")).alias("decision_labels"), F.array_sort(F.collect_set("confidence")).alias("confidence_values")
    )
    alone = F.size("decision_labels") == 1
    status = F.coalesce(*[F.when(F.array_contains("decision_labels", label), s) for label, s in PRIORITY.items()], F.when(alone, "consensus"), F.lit("label_conflict_requires_adjudication"))
    return a.withColumns({"adjudication_status": status, "consensus_label": F.when(alone, F.col("decision_labels")[0])})


def outcome() -> Column:
    """``accepted``, ``rejected`` or ``unresolved`` for an adjudicated candidate."""
    settled = F.col("adjudication_status") == "consensus"
    return F.when(settled & (F.col("consensus_label") == ACCEPT), "accepted").when(settled & F.startswith("consensus_label", F.lit("reject_")), "rejected").otherwise("unresolved")


def label_audit(validated: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """One row of counts over all rows, the valid ones, and the candidates."""
    valid = F.size("invalid_reasons") == 0
    truth = lambda c: F.lower(text_or(c)).isin(TRUE)
    rows = validated.agg(
        F.count("*").alias("rows"), F.count_if(valid).alias("valid_rows"), F.count_if(~valid).alias("invalid_rows"), F.count_if(truth("legal_ground_truth_approved") | truth("rag_index_approved")).alias("forbidden_flags"),
        F.count_distinct(F.when(valid, F.col("reviewer_id"))).alias("reviewers"), F.count_if(text_or("candidate_id") == "").alias("missing_candidate_ids"),
        F.count_if(truth("legal_ground_truth_approved")).alias("legal_ground_truth_true"), F.count_if(truth("rag_index_approved")).alias("rag_index_true"),
        rate(F.count_if(valid & (F.col("confidence") == "low")), F.count_if(valid)).alias("low_confidence_rate"),
    )
    items = adjudicated.agg(
        F.count("*").alias("candidates"), F.count_if(F.col("review_count") > 1).alias("reviewed_more_than_once"), F.count_if(outcome() == "accepted").alias("accepted"), F.count_if(outcome() == "rejected").alias("rejected"),
        F.count_if(outcome() == "unresolved").alias("unresolved"), F.count_if(F.col("adjudication_status") == "label_conflict_requires_adjudication").alias("label_conflicts"),
    )
    return rows.crossJoin(F.broadcast(items))  # one row each


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``field, value, count`` for every value of the columns; each row is read once and counted with partial sums."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("count"))
