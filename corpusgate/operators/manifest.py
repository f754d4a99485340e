"""Joining accepted candidates with their reviews, samples and filter rows into one auditable manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_of, blank, first_truthy, rate, reasons, text_or
from .reviews import ACCEPT, TRUE

# The order in which the first row of a candidate is chosen.
REVIEW_ORDER = ["review_date", "reviewer_id", "decision_label", "confidence", "review_sample_id"]
RECORD_ORDER = ["parent_record_id", "source_id", "review_sample_id", "filter_decision"]
COMPLETE = ["candidate_id", "parent_record_id", "source_dataset", "license", "parser_version", "filter_version"]
PROVENANCE = ["candidate_id", "parent_record_id", "source_dataset", "license", "text_hash", "parser_version", "filter_version"]
MERGED = ["parent_record_id", "source_dataset", "source_id", "source_url", "license", "title", "article_title", "parser_version", "filter_version"]

# What the manifest reads of a review, and of a sample or filter row: no texts.
REVIEW_FIELDS = ["candidate_id", "reviewer_id", "review_date", "decision_label", "confidence", "notes", "legal_ground_truth_approved", "rag_index_approved"]
RECORD_FIELDS = ["candidate_id", *MERGED, "article_number", "text_hash", "article_hash", "review_sample_id", "sampling_bucket", "filter_decision"]


def first_rows(df: DataFrame, order: list[str], tie: str | None = None, keep: list[str] | None = None, among: DataFrame | None = None) -> DataFrame:
    """The first row of each candidate id by trimmed text of the ``order`` columns, then by ``tie``.

    An aggregation with partial results, so rows need not be sorted. Rows with a
    blank id are left out. Only the columns to ``keep`` (all, if not given) are
    carried, and of ids only those ``among`` a table's ``candidate_id``.
    """
    own = [text_or(c) for c in order if c in df.columns] + ([F.col(tie)] if tie else [])
    kept = [c for c in df.columns if keep is None or c in keep]
    slim = df.where(~blank("candidate_id")).select(text_or("candidate_id").alias("_id"), F.struct(*own).alias("_order"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    if among is not None:
        slim = slim.join(among.select(F.col("candidate_id").alias("_id")), "_id", "left_semi")
    best = slim.groupBy("_id").agg(F.min_by("_row", "_order").alias("r"))
    return best.select(F.col("_id").alias("candidate_id"), F.struct(F.col("r.*")).alias("r"))


def first_occurrences(df: DataFrame, ordinal: str) -> DataFrame:
    """``candidate_id, first_seen, repeats`` of the trimmed, non-blank ids."""
    return df.where(~blank("candidate_id")).groupBy(text_or("candidate_id").alias("candidate_id")).agg(F.min(ordinal).alias("first_seen"), (F.count("*") - 1).alias("repeats"))


def join_manifest(accepted: DataFrame, reviews: DataFrame, samples: DataFrame, filtered: DataFrame, tie: str | None = None) -> DataFrame:
    """One row per accepted candidate with the merged fields, ``problems`` and ``missing_fields``.

    Of several reviews of a candidate the earliest holds. A field comes from
    the sample row, and from the filter row where that is empty; the filter
    decision the other way round. A candidate is sound if both lists are empty.
    """
    a = accepted.where(~blank("candidate_id")).groupBy(text_or("candidate_id").alias("candidate_id")).agg(F.first("bucket", True).alias("accepted_audit_bucket"), F.first("consensus_label", True).alias("accepted_consensus_label"), F.max("review_count").alias("accepted_review_count"))
    ids = a.select("candidate_id")
    sides = {
        "review": first_rows(reviews, REVIEW_ORDER, tie if tie in reviews.columns else None, REVIEW_FIELDS, ids),
        "sample": first_rows(samples, RECORD_ORDER, None, RECORD_FIELDS, ids), "filter": first_rows(filtered, RECORD_ORDER, None, RECORD_FIELDS, ids),
    }
    joined = a
    for name, side in sides.items():
        joined = joined.join(side.withColumnRenamed("r", name), "candidate_id", "left")
    fields = {name: set(joined.schema[name].dataType.names) for name in sides}

    def of(name: str, field: str) -> Column:
        return F.col(name)[field] if field in fields[name] else F.lit(None).cast("string")

    def merged(field: str) -> Column:
        return text_or(first_truthy(of("sample", field), of("filter", field)))

    truth = lambda f: F.lower(text_or(of("review", f))).isin(TRUE)
    unlike = text_or(of("review", "decision_label")) != ACCEPT
    match = reasons(
        (unlike, "review_decision_not_accept_for_later_corpus_candidate"), (truth("legal_ground_truth_approved"), "review_row_legal_ground_truth_approved_true"), (truth("rag_index_approved"), "review_row_rag_index_approved_true"),
    )
    problems = F.when(F.col("review").isNull(), F.array(F.lit("missing_completed_review_row"))).when(F.col("sample").isNull(), F.array(F.lit("missing_review_sample_row"))).otherwise(match)
    lacking = reasons(*[(text_or(first_truthy(of("sample", f), of("filter", f))) == "", f) for f in COMPLETE])
    return joined.select(
        "candidate_id", *[merged(f).alias(f) for f in MERGED], F.coalesce(of("sample", "article_number"), of("filter", "article_number")).cast("string").alias("article_number"),
        text_or(first_truthy(of("sample", "text_hash"), of("filter", "text_hash"), of("filter", "article_hash"))).alias("text_hash"), *[text_or(of("review", f)).alias(f) for f in ("reviewer_id", "review_date", "decision_label", "confidence")], text_or(of("review", "notes")).alias("review_notes"),
        *[text_or(of("sample", f)).alias(f) for f in ("review_sample_id", "sampling_bucket")], text_or(first_truthy(of("filter", "filter_decision"), of("sample", "filter_decision"))).alias("filter_decision"),
        "accepted_audit_bucket", "accepted_consensus_label", "accepted_review_count", problems.alias("problems"), lacking.alias("missing_fields"),
    )


def accepted_counts(accepted: DataFrame) -> DataFrame:
    """One row: accepted rows that name a candidate, the candidates they name, and rows beyond the first of each."""
    ids = text_or("candidate_id")
    named = accepted.where(~blank("candidate_id")).agg(F.count("*").alias("accepted_rows"), F.count_distinct(ids).alias("accepted_candidates"))
    return named.withColumn("repeated_rows", F.col("accepted_rows") - F.col("accepted_candidates"))


def manifest_metrics(manifest: DataFrame) -> DataFrame:
    """One row of counts over joined candidates; every candidate is written, rejected or unresolved."""
    sound = (F.size("problems") == 0) & (F.size("missing_fields") == 0)
    distinct = lambda c: F.count_distinct(F.when(sound, F.nullif(c, F.lit(""))))
    has = lambda p: F.array_contains("problems", p)
    counts = manifest.agg(
        F.count("*").alias("accepted_in"), F.count_if(sound).alias("written"), F.count_if(F.size("problems") > 0).alias("rejected"), F.count_if((F.size("problems") == 0) & (F.size("missing_fields") > 0)).alias("unresolved"),
        distinct("parent_record_id").alias("parents"), distinct("reviewer_id").alias("reviewers"), distinct("source_id").alias("source_ids"), distinct("source_dataset").alias("source_datasets"),
        F.count_if(has("missing_completed_review_row")).alias("without_review"), F.count_if(has("missing_review_sample_row")).alias("without_sample"), F.count_if(has("review_decision_not_accept_for_later_corpus_candidate")).alias("unlike_review"),
        F.count_if(has("review_row_legal_ground_truth_approved_true")).alias("legal_ground_truth_true"), F.count_if(has("review_row_rag_index_approved_true")).alias("rag_index_true"), F.count_if(F.array_contains("missing_fields", "filter_version")).alias("without_filter_version"),
    )
    return counts.withColumn("counts_reconcile", F.col("written") + F.col("rejected") + F.col("unresolved") == F.col("accepted_in"))


def provenance_coverage(df: DataFrame) -> DataFrame:
    """Share of rows that have all provenance fields and a source id or URL."""
    lacks = any_of(blank(c) for c in PROVENANCE if c in df.columns) | (blank("source_id") & blank("source_url"))
    return df.agg(F.count("*").alias("rows"), F.count_if(~lacks).alias("covered")).withColumn("coverage", rate(F.col("covered"), F.col("rows")))
