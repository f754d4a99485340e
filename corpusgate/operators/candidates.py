"""Candidates: ids, duplicates, rule-based decisions and their metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import blank, hash16, piped, rate, reasons, sorted_set, utrim, word_count

MIN_CHARS, MIN_WORDS, SHORT_CHARS, LONG_CHARS = 80, 12, 100, 50_000
PARENT_FIELDS = ["parent_record_id", "source_dataset", "source_id", "source_url", "license", "retrieved_at"]
KEEP = "keep_candidate_for_human_review"


def candidate_hash(df: DataFrame) -> Column:
    """``article_hash``, else ``text_hash``, else the hash of the trimmed text, else empty."""
    own = [F.when(~blank(c), F.col(c)) for c in ("article_hash", "text_hash") if c in df.columns]
    return F.coalesce(*own, F.when(~blank("text"), hash16(utrim("text"))), F.lit(""))


def candidate_id(hash_: Column) -> Column:
    """Hash of parent, source, article number, chunk and text hash; a number 0 counts as empty."""
    zero = lambda c: F.nullif(F.col(c).cast("string"), F.lit("0"))
    return hash16(piped("parent_record_id", "source_id", zero("article_number"), zero("chunk_index"), hash_))


def warning_index(warnings: DataFrame) -> DataFrame:
    """Warning codes and messages by parent, sorted; warnings without a parent are left out.

    Equal warnings of a parent count once, so a list is as long as there are
    kinds of warnings.
    """
    rows = warnings.where(~blank("parent_record_id")).select("parent_record_id", "code", "message").distinct()
    lists = rows.groupBy("parent_record_id").agg(F.sort_array(F.collect_list(F.struct("code", "message"))).alias("w"))
    return lists.select("parent_record_id", F.col("w.code").alias("parent_document_warning_codes"), F.col("w.message").alias("parent_document_warning_messages"))


def with_warnings(candidates: DataFrame, warnings: DataFrame) -> DataFrame:
    joined = candidates.join(warning_index(warnings), "parent_record_id", "left")
    none = F.array().cast("array<string>")
    return joined.withColumns({c: F.coalesce(c, none) for c in ("parent_document_warning_codes", "parent_document_warning_messages")})


def canonical(df: DataFrame, hash_: str = "article_hash", order: str = "input_index", id_: str = "candidate_id") -> DataFrame:
    """Adds ``canonical_index`` and ``canonical_id`` of the first row with the same hash; rows with a blank hash have none.

    The first of each group comes from an aggregation with partial results over
    hashes, order and ids only. Only groups of several rows are joined back;
    a row alone is its own canonical row. So the joined side is as large as
    there are duplicates, and a hash that a third of the rows share neither
    sits in one task nor is sorted.
    """
    slim = df.where(~blank(hash_)).select(F.col(hash_).alias("_hash"), F.col(order).alias("_order"), F.col(id_).alias("_id"))
    first = slim.groupBy("_hash").agg(F.min(F.struct("_order", "_id")).alias("_first"), F.count("*").alias("_size")).where("_size > 1")
    joined = df.join(first, F.col(hash_) == F.col("_hash"), "left")
    own = ~blank(hash_)
    return joined.withColumns({
        "canonical_index": F.coalesce(F.col("_first._order"), F.when(own, F.col(order))), "canonical_id": F.coalesce(F.col("_first._id"), F.when(own, F.col(id_))), "group_size": F.coalesce("_size", F.when(own, 1).otherwise(0).cast("long")),
    }).drop("_first", "_hash", "_size")


def duplicate_groups(df: DataFrame, hash_: str = "article_hash") -> DataFrame:
    return df.where(~blank(hash_)).groupBy(hash_).agg(F.count("*").alias("group_size")).where("group_size > 1")


def decide(df: DataFrame) -> DataFrame:
    """Candidates with ``filter_reasons``, ``risk_flags``, ``duplicate_of`` and ``filter_decision``.

    Rules are tried in order and all that hold are kept; the first rejecting
    one decides, else the first at all, else the candidate is kept, which is then
    its reason. Needs
    ``input_index``; other missing columns count as null. A missing
    text column counts as a missing required text, a null or blank text as
    empty. Flags of approval are reset to false.
    """
    if "parent_document_warning_codes" not in df.columns:
        df = df.withColumn("parent_document_warning_codes", F.array().cast("array<string>"))
    has_text = "text" in df.columns
    needed = {c: "string" for c in ["text", *PARENT_FIELDS, "article_number", "chunk_index"]} | {"parse_flags": "array<string>", "uncertain_parse": "boolean"}
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in needed.items() if c not in df.columns})
    hashed = df.withColumn("article_hash", candidate_hash(df))
    # rows that name their candidate keep the name
    own = candidate_id(F.col("article_hash"))
    hashed = hashed.withColumn("candidate_id", F.coalesce(F.when(~blank("candidate_id"), F.col("candidate_id")), own) if "candidate_id" in df.columns else own)
    hashed = hashed.withColumns({"text_char_count": F.length(F.coalesce(utrim("text"), F.lit(""))), "text_word_count": word_count("text")})
    staged = canonical(hashed)
    lacking = [(blank(f), f"missing_{f}") for f in PARENT_FIELDS]
    unparented = F.size(reasons(*lacking)) > 0
    empty, chars, words = blank("text"), F.col("text_char_count"), F.col("text_word_count")
    loser = ~blank("article_hash") & (F.col("canonical_index") != F.col("input_index"))
    near = ~empty & ((chars < MIN_CHARS) | (words < MIN_WORDS))
    odd = ~empty & ((chars < SHORT_CHARS) | (chars > LONG_CHARS))
    flag = lambda f: F.coalesce(F.array_contains("parse_flags", f), F.lit(False))
    header = flag("markdown_heading_marker") | F.startswith(F.coalesce(utrim("text"), F.lit("")), F.lit("#"))
    unsure = F.coalesce("uncertain_parse", F.lit(False)) | flag("article_title_missing") | flag("article_number_unparsed")
    no_hash = blank("article_hash")
    why = reasons(
        (unparented, "reject_missing_parent_provenance"), (empty, "reject_empty" if has_text else "reject_missing_required_text"), (no_hash, "reject_missing_required_hash"), (loser, "reject_duplicate_hash"),
        (near, "reject_near_empty"), (odd, "needs_review_suspicious_length"), (header, "needs_review_preamble_or_header_noise"), (unsure, "needs_review_marker_uncertainty"),
    )
    risk = F.concat(
        reasons(*lacking, (empty, "empty_text" if has_text else "missing_text_field"), (no_hash, "missing_article_hash"), (loser, "duplicate_hash_loser"), (near, "near_empty_text"), (odd, "suspicious_length_text"), (header, "candidate_header_noise"), (unsure, "marker_uncertainty")),
        F.transform("parent_document_warning_codes", lambda c: F.concat(F.lit("parent_document_warning:"), c)),
    )
    out = staged.withColumns({"_why": why, "risk_flags": sorted_set(risk), "duplicate_of": F.when(loser, F.col("canonical_id"))})
    decision = F.coalesce(F.get(F.filter("_why", lambda r: F.startswith(r, F.lit("reject_"))), F.lit(0)), F.get("_why", F.lit(0)), F.lit(KEEP))
    out = out.withColumns({"filter_decision": decision, "filter_reasons": F.when(F.size("_why") > 0, sorted_set(F.col("_why"))).otherwise(F.array(F.lit(KEEP))), "is_legal_ground_truth": F.lit(False), "approved_for_rag_index": F.lit(False)})
    return out.drop("_why", "canonical_index", "canonical_id")


def bucket(decision: Column) -> Column:
    """The three disjoint outputs: ``rejected``, ``needs_review``, ``keep``."""
    return F.when(F.startswith(decision, F.lit("reject_")), "rejected").when(F.startswith(decision, F.lit("needs_review_")), "needs_review").otherwise("keep")


def decision_counts(decided: DataFrame) -> DataFrame:
    """``bucket, filter_decision, candidates``: how often each reason decided, within its output."""
    return decided.groupBy(bucket(F.col("filter_decision")).alias("bucket"), "filter_decision").agg(F.count("*").alias("candidates"))


def union_outputs(outputs: list[DataFrame]) -> DataFrame:
    """The rows of several filter outputs as one table; a column that an output lacks is null there."""
    if not outputs:
        raise ValueError("no filter output is given")
    whole = outputs[0]
    for other in outputs[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole


def filter_metrics(decided: DataFrame) -> DataFrame:
    """One row of counts over decided candidates; duplicates rejected are all but one of each group."""
    has = lambda r: F.array_contains("filter_reasons", r)
    chars = F.col("text_char_count")
    loser = F.array_contains("risk_flags", "duplicate_hash_loser")
    missing = has("reject_missing_parent_provenance")
    a = decided.agg(
        F.count("*").alias("total_input_candidates"), F.count_if(bucket(F.col("filter_decision")) == "rejected").alias("total_rejected"), F.count_if(bucket(F.col("filter_decision")) == "needs_review").alias("total_needs_review"),
        F.count_if(F.col("filter_decision") == KEEP).alias("total_keep"), F.count_if(loser).alias("duplicate_candidates_rejected"), F.count_if(F.col("filter_decision") == "reject_missing_parent_provenance").alias("missing_required_fields_count"), F.count_if(chars == 0).alias("empty_count"), F.count_if(F.size("parent_document_warning_codes") > 0).alias("with_parent_warning"), F.count_if(has("reject_near_empty")).alias("near_empty_count"),
        F.count_if((chars < SHORT_CHARS) | (chars > LONG_CHARS)).alias("suspicious_length_count"), F.count_if(has("needs_review_preamble_or_header_noise")).alias("preamble_warning_count"),
        F.count_if(has("needs_review_marker_uncertainty")).alias("marker_uncertainty_count"), F.count_if(~missing).alias("with_parent"),
        F.count("*").alias("total_output_records"), F.count_if((F.col("group_size") > 1) & ~loser).alias("duplicate_hash_groups"),
        F.count_if("approved_for_rag_index").alias("approved_for_rag_index_true_count"), F.count_if("is_legal_ground_truth").alias("is_legal_ground_truth_true_count"),
    )
    reconciled = F.col("total_rejected") + F.col("total_needs_review") + F.col("total_keep") == F.col("total_input_candidates")
    return a.withColumn("parent_provenance_coverage", rate(F.col("with_parent"), F.col("total_input_candidates"))).withColumn("counts_reconcile", reconciled).drop("with_parent")
