import hashlib

import pytest

from corpusgate.operators import candidates, sampling

SCHEMA = (
    "candidate_id string, input_index long, parent_record_id string, source_dataset string, source_id string, source_url string, license string, retrieved_at string, title string, article_number int, chunk_index int, "
    "text string, text_hash string, parse_flags array<string>, uncertain_parse boolean"
)
LONG = "từ " * 60


def frame(spark, rows):
    base = {"candidate_id": None, "input_index": 0, "parent_record_id": "p", "source_dataset": "s", "source_id": "1", "source_url": "u", "license": "MIT", "retrieved_at": "now", "title": "t", "article_number": 1, "chunk_index": 0, "text": LONG, "text_hash": None, "parse_flags": [], "uncertain_parse": False}
    return spark.createDataFrame([tuple((base | {"input_index": i, "text_hash": f"h{i}"} | r).values()) for i, r in enumerate(rows)], SCHEMA)


def decided(spark, *rows):
    return {r.input_index: r for r in candidates.decide(frame(spark, rows)).collect()}


def test_rules_in_order(spark):
    got = decided(
        spark, {}, {"license": " "}, {"text": None}, {"text": " "}, {"text_hash": "h0"}, {"text": "ngắn"}, {"text": "x" * 99}, {"text": "# " + LONG}, {"uncertain_parse": True}, {"parse_flags": ["article_title_missing"]},
        {"text": "y" * 50_001 + " a" * 20}, {"license": None, "text_hash": "h0"}, {"text": "một " * 20},
    )
    assert [got[i].filter_decision for i in range(13)] == [
        "keep_candidate_for_human_review", "reject_missing_parent_provenance", "reject_empty", "reject_empty", "reject_duplicate_hash", "reject_near_empty", "reject_near_empty", "needs_review_preamble_or_header_noise", "needs_review_marker_uncertainty",
        "needs_review_marker_uncertainty", "needs_review_suspicious_length", "reject_missing_parent_provenance", "reject_near_empty",
    ]
    assert got[11].filter_reasons == ["reject_duplicate_hash", "reject_missing_parent_provenance"] and "missing_license" in got[11].risk_flags
    assert got[4].duplicate_of == got[0].candidate_id


def test_text_column_missing_and_flags_reset(spark):
    df = frame(spark, [{}]).drop("text").withColumn("is_legal_ground_truth", candidates.F.lit(True))
    r = candidates.decide(df).first()
    assert r.filter_decision == "reject_missing_required_text" and r.is_legal_ground_truth is False


def test_id_renders_zero_as_empty(spark):
    r = candidates.decide(frame(spark, [{}])).first()
    assert r.candidate_id == hashlib.sha256(b"p|1|1||h0").hexdigest()[:16]


def test_metrics_reconcile_and_count_losers_by_group(spark):
    d = candidates.decide(frame(spark, [{}, {"text_hash": "h0"}, {"text_hash": "h0", "license": None}, {"text": ""}]))
    m = candidates.filter_metrics(d).first()
    assert m.counts_reconcile and m.duplicate_candidates_rejected == 2 and m.total_rejected == 3 and m.total_keep == 1
    assert candidates.filter_metrics(d.limit(0)).first().total_input_candidates == 0


def test_warnings_join(spark):
    w = spark.createDataFrame([("p", "b", "2"), ("p", "a", "1"), ("p", "a", "1"), (" ", "c", "3")], "parent_record_id string, code string, message string")
    r = candidates.decide(candidates.with_warnings(frame(spark, [{}, {"parent_record_id": "q"}]), w)).orderBy("input_index").collect()
    assert r[0].parent_document_warning_codes == ["a", "b"] and "parent_document_warning:a" in r[0].risk_flags
    assert r[1].parent_document_warning_codes == []


def test_apportionment():
    assert sampling.apportion(150) == {"duplicate_related": 10, "suspicious_length": 10, "keep_candidate_for_human_review": 60, "needs_review": 50, "rejected": 20}
    for n in range(0, 400, 7):
        assert sum(sampling.apportion(n).values()) == n
    with pytest.raises(ValueError):
        sampling.apportion(-1)


def turns(rows, seed, salt):
    """Plain model: one row of each parent in turn."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    groups = {}
    for r in rows:
        groups.setdefault(r["parent"] or "", []).append(r)
    for p in groups:
        groups[p].sort(key=lambda r: (sha(f"{seed}|{salt}|{r['i']}|{r['c']}|{r['parent'] or ''}|{r['h']}"), str(r["i"])))
    order, out = sorted(groups, key=lambda p: (sha(f"{seed}|{salt}:parent|{p}"), p)), []
    while any(groups.values()):
        out += [groups[p].pop(0) for p in order if groups[p]]
    return [r["i"] for r in out]


def test_round_robin_matches_the_plain_model(spark):
    rows = [{"i": i, "c": f"c{i}", "parent": [None, "a", "b", "a", "a"][i % 5], "h": f"h{i % 3}"} for i in range(40)]
    df = spark.createDataFrame([(r["i"], r["c"], r["parent"], r["h"]) for r in rows], "input_index long, candidate_id string, parent_record_id string, article_hash string")
    for most in (0, 7, 100):
        got = [r.input_index for r in sampling.round_robin(df, 42, "keep", most).orderBy("sample_index").collect()]
        assert got == turns(rows, 42, "keep")[:most]


def test_review_sample_is_disjoint_and_repeatable(spark):
    rows = [{"text_hash": f"h{i // 2}" if i < 20 else f"u{i}", "text": LONG if i % 4 else "x" * 95 + " a" * 12, "parent_record_id": f"p{i % 9}", "uncertain_parse": i % 3 == 0} for i in range(120)]
    d = candidates.decide(frame(spark, rows))
    first = sampling.review_sample(d, 50, 7).collect()
    assert len({r.row_key for r in first}) == len(first) <= 50
    again = sampling.review_sample(d.repartition(7), 50, 7).collect()
    assert sorted(r.review_sample_id for r in first) == sorted(r.review_sample_id for r in again)
    short = {r.sampling_bucket: r.shortfall for r in sampling.shortfalls(sampling.review_sample(d, 50, 7), 50).collect()}
    assert len(short) == 5 and sum(short.values()) == 50 - len(first)


def test_split_sizes_are_exact(spark):
    df = spark.createDataFrame([(i % 50 if i % 7 else None, i) for i in range(333)], "k long, split_x long")
    got = sampling.split_rows(df, "k")
    sizes = {r.split_name: r["count"] for r in got.groupBy("split_name").count().collect()}
    assert sizes == {"train": 266, "validation": 33, "test": 34} and got.columns == ["k", "split_x", "split_name"]
    key = lambda r: tuple(map(str, r))
    assert sorted(got.collect(), key=key) == sorted(sampling.split_rows(df.repartition(5), "k").collect(), key=key)
    with pytest.raises(ValueError):
        sampling.split_rows(df, "k", train=0.5)
    assert sampling.split_rows(df.limit(0), "k").count() == 0
