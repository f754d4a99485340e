from corpusgate.operators import manifest, reviews

FIELDS = "review_row long, candidate_id string, reviewer_id string, review_date string, decision_label string, confidence string, notes string, legal_ground_truth_approved string, rag_index_approved string, review_sample_id string, parent_record_id string, license string"


def frame(spark, *rows):
    base = {"review_row": 0, "candidate_id": "c", "reviewer_id": "r", "review_date": "2026-06-10", "decision_label": "uncertain", "confidence": "high", "notes": "n", "legal_ground_truth_approved": "false", "rag_index_approved": "no", "review_sample_id": "s", "parent_record_id": "p", "license": "MIT"}
    return spark.createDataFrame([tuple((base | {"review_row": i} | r).values()) for i, r in enumerate(rows)], FIELDS)


def test_validation_reasons(spark):
    got = reviews.validate_reviews(frame(
        spark, {}, {"decision_label": " UNCERTAIN ", "confidence": "LOW"}, {"decision_label": "ok", "confidence": "sure", "rag_index_approved": "YES", "legal_ground_truth_approved": "maybe", "notes": " ", "candidate_id": None},
        {"review_date": "20260610"}, {"review_date": "2026-02-30"}, {"review_date": None},
    )).orderBy("review_row").collect()
    assert got[0].invalid_reasons == [] and (got[1].decision_label, got[1].confidence, got[1].invalid_reasons) == ("uncertain", "low", [])
    assert got[2].invalid_reasons == [
        "candidate_id is required.", "confidence is invalid: sure", "decision_label is invalid: ok", "legal_ground_truth_approved must be a boolean false value.", "notes is required.", "rag_index_approved must remain false.",
    ]
    assert got[3].invalid_reasons == got[4].invalid_reasons == ["review_date must be ISO format YYYY-MM-DD."] and got[5].invalid_reasons == ["review_date is required."]
    assert reviews.validate_reviews(frame(spark, {}).drop("notes")).first().invalid_reasons == ["notes is required."]


def test_adjudication_precedence(spark):
    accept, dup = "accept_for_later_corpus_candidate", "reject_duplicate"
    labels = {"a": [accept, accept], "b": [accept, dup], "c": [accept, "uncertain"], "d": ["uncertain", "needs_legal_expert_review"], "e": ["needs_parser_fix", "needs_legal_expert_review"], "f": [dup], "g": ["needs_parser_fix"]}
    df = frame(spark, *[{"candidate_id": c, "decision_label": x, "reviewer_id": f"r{i}"} for c, ls in labels.items() for i, x in enumerate(ls)])
    got = {r.candidate_id: r for r in reviews.adjudicate(reviews.validate_reviews(df)).withColumn("o", reviews.outcome()).collect()}
    assert {c: r.adjudication_status for c, r in got.items()} == {
        "a": "consensus", "b": "label_conflict_requires_adjudication", "c": "uncertain_requires_adjudication", "d": "legal_expert_review_required", "e": "parser_fix_required", "f": "consensus", "g": "parser_fix_required",
    }
    assert {c: r.o for c, r in got.items() if r.o != "unresolved"} == {"a": "accepted", "f": "rejected"} and got["a"].reviewer_ids == ["r0", "r1"]
    audit = reviews.label_audit(reviews.validate_reviews(df), reviews.adjudicate(reviews.validate_reviews(df))).first()
    assert (audit.rows, audit.invalid_rows, audit.candidates, audit.reviewed_more_than_once, audit.accepted) == (12, 0, 7, 5, 1)


def test_manifest_takes_the_earliest_review_and_prefers_sample_fields(spark):
    accept = "accept_for_later_corpus_candidate"
    r = frame(spark, {"review_date": "2026-02-01", "decision_label": "uncertain"}, {"review_date": "2026-01-01", "decision_label": accept, "reviewer_id": "early"}, {"candidate_id": "d", "decision_label": accept.upper(), "rag_index_approved": "y"})
    accepted = spark.createDataFrame([("c", "accepted", accept, 2), ("d", "accepted", accept, 1), ("e", "accepted", accept, 1), (" ", "accepted", accept, 1), ("c", "accepted", accept, 2)], "candidate_id string, bucket string, consensus_label string, review_count long")
    samples = spark.createDataFrame([("c", "p1", "set", "", "MIT", "s1", "bucket", "keep"), ("d", "p2", "set", "v1", "", "s2", "bucket", "keep")], "candidate_id string, parent_record_id string, source_dataset string, parser_version string, license string, review_sample_id string, sampling_bucket string, filter_decision string")
    filtered = spark.createDataFrame([("c", "v2", "f1", "h", "reject_x"), ("d", "v2", "f1", "h", None)], "candidate_id string, parser_version string, filter_version string, article_hash string, filter_decision string")
    got = {x.candidate_id: x for x in manifest.join_manifest(accepted, r, samples, filtered, tie="review_row").collect()}
    assert set(got) == {"c", "d", "e"}
    c, d, e = got["c"], got["d"], got["e"]
    assert (c.reviewer_id, c.parser_version, c.filter_decision, c.text_hash, c.problems, c.missing_fields) == ("early", "v2", "reject_x", "h", [], [])
    assert d.problems == ["review_decision_not_accept_for_later_corpus_candidate", "review_row_rag_index_approved_true"] and d.missing_fields == ["license"] and d.filter_decision == "keep"
    assert e.problems == ["missing_completed_review_row"]
    m = manifest.manifest_metrics(manifest.join_manifest(accepted, r, samples, filtered)).first()
    assert (m.accepted_in, m.written, m.rejected, m.unresolved) == (3, 1, 2, 0)


def test_first_occurrences_and_coverage(spark):
    r = frame(spark, {}, {"candidate_id": " c "}, {"candidate_id": ""}, {"candidate_id": "z", "license": None})
    assert sorted(map(tuple, manifest.first_occurrences(r, "review_row").collect())) == [("c", 0, 1), ("z", 3, 0)]
    p = manifest.provenance_coverage(r.withColumnRenamed("review_sample_id", "source_id").withColumnRenamed("notes", "source_url")).first()
    assert (p["rows"], p.covered, p.coverage) == (4, 2, 0.5)
