"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import blank, contains_all, contains_any, preview, text_or
from ..operators import articles as art
from ..operators import audit, candidates, contracts, instructions, manifest, normalize, quality, reviews, sampling
from ..sources import registry
from ..sources.readers import table
from ..sources.shared import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the demonstration rows: value lists with strides, and templates.
DEMO_DIMENSIONS = {"topic": (["permit renewal", "address change", "invoice check"], 5), "actor": (["shop owner", "branch clerk"], 7), "place": (["north office", "south office", "harbour desk", "market hall"], 11)}
DEMO_TEMPLATES = {
    "instruction": ["Explain the next step of {topic} for case {case_anchor}.", "Draft a synthetic note on {topic} for the {place}."],
    "input": ["Scenario {index}: a {actor} at the {place} asks about {topic}."],
    "output": ["Demo answer for {case_anchor}: check the {topic} with the {actor} first.", "Synthetic reply: the {place} files the {topic}.", "Demo note: a {actor} keeps the {topic}."],
}
TASK_NOTES = {"explanation": "may leave out conditions", "drafting_demo": "may overstate effect"}
POLICY_PHRASES = ["thời hạn", "complaint box", "not legal advice"]
ALL_PHRASES = ["thời hạn", "hồ sơ"]
SOURCE_ALIASES = {"mock_archive": "mock-archive", "drill": "template-drill"}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _csv(c: Column) -> Column:
    return F.array_join(c, ",")


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "synthetic_legal_articles")
    return normalize.normalize(raw, F.col("source_dataset"), F.col("source_url"), F.col("license"), F.col("retrieved_at")).drop("raw_metadata")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").cast("string").alias("record_id"), F.col("source").alias("source_dataset"), F.col("doc_id").cast("string").alias("source_id"), F.lit(None).cast("string").alias("source_url"), "license", F.col("retrieved_at").cast("string").alias("retrieved_at"),
        "title", "document_type", "document_number", "text",
    )


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.parse_documents(spread(_documents(spark, sf_dir)))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "article_candidates")


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.decide(_candidates(spark, sf_dir))


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.validate_reviews(table(spark, sf_dir, "reviewer_decisions_completed"))


def _adjudicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.adjudicate(_reviews(spark, sf_dir).where(F.size("invalid_reasons") == 0))


def _qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "sample_qa")


@query
def q_filter_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decided(spark, sf_dir).select("input_index", "candidate_id", "filter_decision", _csv(F.col("filter_reasons")).alias("filter_reasons"), "duplicate_of", "text_char_count", "text_word_count")


@query
def q_filter_risk_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.histogram(_decided(spark, sf_dir).select(F.explode("risk_flags").alias("risk_flag")), "risk_flag")


@query
def q_filter_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.histogram(_decided(spark, sf_dir).select(candidates.bucket(F.col("filter_decision")).alias("bucket")), "bucket")


@query
def q_filter_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.filter_metrics(_decided(spark, sf_dir))


@query
def q_filter_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.decision_counts(_decided(spark, sf_dir))


@query
def q_union_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three filter outputs as one table again, counted by decision."""
    decided = _decided(spark, sf_dir).withColumn("bucket", candidates.bucket(F.col("filter_decision")))
    parts = [decided.where(F.col("bucket") == b).select("candidate_id", "filter_decision", *extra) for b, extra in (("keep", []), ("needs_review", ["filter_reasons"]), ("rejected", ["duplicate_of"]))]
    whole = candidates.union_outputs(parts)
    return whole.groupBy("filter_decision").agg(F.count("*").alias("candidates"), F.count("duplicate_of").alias("with_original"), F.count("filter_reasons").alias("with_reasons"))


@query
def q_candidate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _candidates(spark, sf_dir)
    return df.select("input_index", candidates.candidate_id(candidates.candidate_hash(df)).alias("made_id"), candidates.candidate_hash(df).alias("article_hash"))


@query
def q_duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _candidates(spark, sf_dir)
    return candidates.duplicate_groups(df.withColumn("article_hash", candidates.candidate_hash(df)))


@query
def q_canonical_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _candidates(spark, sf_dir)
    found = candidates.canonical(df.withColumn("article_hash", candidates.candidate_hash(df)))
    return found.where("canonical_index <> input_index").select("input_index", "canonical_index", "canonical_id", "group_size")


@query
def q_parent_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    joined = candidates.with_warnings(parsed.select(F.col("record_id").alias("parent_record_id")), art.parse_warnings(parsed))
    return joined.select("parent_record_id", _csv(F.col("parent_document_warning_codes")).alias("codes"))


@query
def q_normalize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.split_errors(_normalized(spark, sf_dir))[0].drop("transform_version")


@query
def q_rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.split_errors(_normalized(spark, sf_dir))[1].select("source_id", "title", "error")


@query
def q_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_metrics(_normalized(spark, sf_dir))


@query
def q_quality_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(quality.quality_metrics(_normalized(spark, sf_dir))).select("metric", "value", "bound")


@query
def q_source_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by source, with what the manifest says of it; a source it does not list has nulls."""
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("records"))
    m = table(spark, sf_dir, "source_manifest").select(F.col("source_dataset").alias("source"), F.col("license").alias("manifest_license"), "license_confirmed", "attribution_required")
    return counts.join(m, "source", "left")


@query
def q_source_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by the registered source that their source name or alias stands for; unknown names have none."""
    known = registry.from_table(table(spark, sf_dir, "source_manifest"), SOURCE_ALIASES)
    docs = table(spark, sf_dir, "documents").select(known.resolved(F.lower(F.trim("source"))).alias("source_dataset"))
    return docs.groupBy("source_dataset").agg(F.count("*").alias("records"))


@query
def q_content_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.content_summary(table(spark, sf_dir, "documents"))


@query
def q_field_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.completeness(table(spark, sf_dir, "documents"), ["title", "document_type", "document_number", "effective_status", "license", "source", "lang"])


@query
def q_doc_type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.histogram(table(spark, sf_dir, "documents"), "document_type", "MISSING")


@query
def q_marker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", art.audit_marker_count(F.col("text")).cast("bigint").alias("markers"))


@query
def q_citation_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _qa(spark, sf_dir).select("row_no", audit.cites(F.col("output")).alias("cites"))


@query
def q_cross_source_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles, docs = table(spark, sf_dir, "synthetic_legal_articles").select("title", "text", "license"), table(spark, sf_dir, "documents").select("title", "text", "license")
    return audit.cross_overlap(articles, docs, {"title": F.col("title"), "text": F.col("text"), "license": F.col("license")})


@query
def q_turn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction rows as conversations of a user and an assistant."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    rows = _qa(spark, sf_dir).select(F.array(turn("user", "instruction"), turn("assistant", "output")).alias("conversations"), F.col("instruction").alias("text"))
    return audit.turn_summary(rows)


@query
def q_rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.rejected_documents(_parsed(spark, sf_dir)).select("parent_record_id", "reason", _csv(F.col("missing_fields")).alias("missing_fields"))


@query
def q_parse_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return art.parse_warnings(_parsed(spark, sf_dir)).select("parent_record_id", "code")


@query
def q_article_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = art.articles(_parsed(spark, sf_dir), ["record_id"])
    return rows.select("record_id", "article_pos", "article_number", "article_title", F.md5("text").alias("text_md5"), _csv(F.col("parse_flags")).alias("parse_flags"))


@query
def q_chunk_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in chunks of up to 600 characters, so that many have several."""
    return art.candidates(_parsed(spark, sf_dir), 600).select("parent_record_id", "article_pos", "chunk_index", F.length("text").alias("chars"), "text_hash", _csv(F.col("parse_flags")).alias("parse_flags"))


@query
def q_parse_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return art.parse_metrics(parsed, art.candidates(parsed))


@query
def q_round_robin_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _candidates(spark, sf_dir).select("input_index", "candidate_id", "parent_record_id", F.coalesce("text_hash", F.lit("")).alias("article_hash"))
    return sampling.round_robin(df, 42, "keep", 100).select("sample_index", "input_index", "parent_record_id")


@query
def q_duplicate_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.duplicate_representatives(_decided(spark, sf_dir), 42).select("input_index", "duplicate_group_key", "duplicate_group_size")


@query
def q_review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.review_sample(_decided(spark, sf_dir)).select("review_sample_id", "sampling_bucket", "sample_index", "input_index", "candidate_id", "text_length")


@query
def q_bucket_shortfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.shortfalls(sampling.review_sample(_decided(spark, sf_dir)), 150)


@query
def q_test_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty test rows by a seeded hash: a sampling operator."""
    return sampling.seeded_sample(_qa(spark, sf_dir).where("split = 'test'").select("row_no", "id"), "row_no", 50)


@query
def q_sample_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = sampling.sample_coverage(sampling.review_sample(_decided(spark, sf_dir)))
    return c.withColumns({x: _csv(F.col(x)) for x in ("source_datasets", "licenses")})


@query
def q_duplicate_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = _decided(spark, sf_dir)
    return decided.where(sampling.duplicate_related(decided)).select("input_index", "group_size")


@query
def q_subset_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by whether reviews, candidates or both name them; a consistent pair of tables has none in reviews only."""
    reviewed = table(spark, sf_dir, "reviewer_decisions_completed").where(~blank("candidate_id")).select("candidate_id", F.lit(1).alias("bit"))
    both = reviewed.unionByName(_candidates(spark, sf_dir).where(~blank("candidate_id")).select("candidate_id", F.lit(2).alias("bit")))
    held = both.groupBy("candidate_id").agg(F.bit_or("bit").alias("bits"))
    named = F.when(F.col("bits") == 1, "reviews_only").when(F.col("bits") == 2, "candidates_only").otherwise("both")
    return held.groupBy(named.alias("held_by")).agg(F.count("*").alias("candidates"))


@query
def q_reviewed_not_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed candidates that the filter did not keep, by an anti join."""
    reviewed = table(spark, sf_dir, "reviewer_decisions_completed").where(~blank("candidate_id")).select("candidate_id").distinct()
    kept = _decided(spark, sf_dir).where(F.col("filter_decision") == candidates.KEEP).select("candidate_id")
    return reviewed.join(kept, "candidate_id", "left_anti")


@query
def q_review_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir).where(F.size("invalid_reasons") > 0).select("review_row", "candidate_id", F.array_join("invalid_reasons", "; ").alias("reasons"))


@query
def q_review_invalid_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.histogram(_reviews(spark, sf_dir).select(F.explode("invalid_reasons").alias("reason")), "reason")


@query
def q_adjudication(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _adjudicated(spark, sf_dir)
    return a.select("candidate_id", "review_count", *[_csv(F.col(c)).alias(c) for c in ("reviewer_ids", "decision_labels", "confidence_values")], "adjudication_status", "consensus_label")


@query
def q_review_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.histogram(_adjudicated(spark, sf_dir).select(reviews.outcome().alias("outcome")), "outcome")


@query
def q_label_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.label_audit(_reviews(spark, sf_dir), _adjudicated(spark, sf_dir))


@query
def q_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.value_counts(_reviews(spark, sf_dir).where(F.size("invalid_reasons") == 0), ["decision_label", "confidence"])


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = _adjudicated(spark, sf_dir).withColumn("bucket", reviews.outcome()).where("bucket = 'accepted'")
    raw = table(spark, sf_dir, "reviewer_decisions_completed")
    samples = raw.select("candidate_id", "review_sample_id", "parent_record_id", "source_dataset", "source_id", "source_url", "license", "title", "article_number", "article_title", "sampling_bucket", "filter_decision")
    filtered = _decided(spark, sf_dir).withColumn("filter_version", F.lit("corpusgate_filter_v1"))
    return manifest.join_manifest(accepted, raw, samples, filtered, tie="review_row")


@query
def q_manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _manifest(spark, sf_dir)
    return m.withColumns({c: _csv(F.col(c)) for c in ("problems", "missing_fields")})


@query
def q_manifest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest_metrics(_manifest(spark, sf_dir))


@query
def q_manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _manifest(spark, sf_dir)
    return reviews.value_counts(m.where((F.size("problems") == 0) & (F.size("missing_fields") == 0)), ["decision_label", "confidence"])


@query
def q_accepted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "reviewer_decisions_completed")
    return manifest.accepted_counts(raw.where(F.lower(text_or("decision_label")) == reviews.ACCEPT))


@query
def q_provenance_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.provenance_coverage(_candidates(spark, sf_dir))


@query
def q_first_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.first_occurrences(table(spark, sf_dir, "reviewer_decisions_completed"), "review_row")


@query
def q_instruction_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instructions.validate_rows(spread(_qa(spark, sf_dir)), source="template-drill", id_prefix="mock-qa-")
    return rows.select("row_no", F.array_join("errors", "; ").alias("errors"))


@query
def q_instruction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instructions.validate_rows(spread(_qa(spark, sf_dir)), source="template-drill", id_prefix="mock-qa-")
    return instructions.instruction_audit(rows, "template-drill")


@query
def q_instruction_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instructions.validate_rows(spread(_qa(spark, sf_dir)), source="template-drill", id_prefix="mock-qa-")
    return audit.histogram(rows.select(F.explode("errors").alias("issue")), "issue")


@query
def q_split_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    qa = _qa(spark, sf_dir)
    return instructions.split_overlaps({s: qa.where(F.col("split") == s).select("id") for s in ("train", "validation", "test")})


@query
def q_phrase_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold any, and all, of some phrases."""
    docs = table(spark, sf_dir, "documents")
    return docs.agg(F.count_if(contains_any("text", POLICY_PHRASES)).alias("any_phrase"), F.count_if(contains_all("text", ALL_PHRASES)).alias("all_phrases"))


@query
def q_instruction_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instructions.duplicate_counts(_qa(spark, sf_dir))


@query
def q_instruction_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _qa(spark, sf_dir).groupBy("task_type", "difficulty").agg(F.count("*").alias("rows"))


@query
def q_split_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_rows(_qa(spark, sf_dir).select("row_no"), "row_no")


@query
def q_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_rows(_qa(spark, sf_dir).select("row_no"), "row_no").groupBy("split_name").agg(F.count("*").alias("rows"))


@query
def q_prompt_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _qa(spark, sf_dir).select("row_no", F.md5(instructions.prompt()).alias("training_md5"), F.md5(instructions.prompt(False)).alias("inference_md5"))


@query
def q_overlap_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instructions.response_scores(_qa(spark, sf_dir), "input", "output").select("row_no", "format_valid", F.round("overlap", 6).alias("overlap"), "task_pass")


@query
def q_overlap_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = instructions.response_scores(_qa(spark, sf_dir), "input", "output")
    return scored.agg(*[F.bround(F.avg(F.col(c).cast("int")), 6).alias(f"{c}_rate") for c in ("format_valid", "task_pass")])


@query
def q_task_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.annotated(audit.histogram(_qa(spark, sf_dir), "task_type"), "task_type", TASK_NOTES)


@query
def q_contract_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contracts.contract_errors(table(spark, sf_dir, "synthetic_legal_articles"))
    return rows.where(F.size("contract_errors") > 0).select("record_no", preview("title").alias("title"), F.array_join("contract_errors", "; ").alias("errors"))


@query
def q_contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.split_contract(contracts.contract_errors(table(spark, sf_dir, "synthetic_legal_articles")))[2]


@query
def q_fixed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"source": "template-drill", "is_synthetic": True, "is_legal_ground_truth": False, "approved_for_rag_index": False}
    return contracts.fixed_fields(_qa(spark, sf_dir), wanted, 2000)


@query
def q_true_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.true_counts(table(spark, sf_dir, "reviewer_decisions_completed"), ["legal_ground_truth_approved", "rag_index_approved"])


@query
def q_policy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instructions.lines_holding(table(spark, sf_dir, "documents"), "doc_id", "text", POLICY_PHRASES)


@query
def q_template_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = instructions.render_templates(spark, 2500, DEMO_TEMPLATES, DEMO_DIMENSIONS)
    return rows.select("index", "id", "instruction", "input", "output")
