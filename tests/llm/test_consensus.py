import numpy as np
import pandas as pd
import pytest

from corpusgate.llm.consensus import LABELS, annotator_reliability, chance_corrected, consensus_labels, fit_consensus, votes_by_item

SCHEMA = "review_row long, candidate_id string, reviewer_id string, decision_label string, confidence string, kind string, item string"


def simulated(items=400, annotators=8, seed=3):
    rng = np.random.default_rng(seed)
    skill = np.array([0.95, 0.9, 0.9, 0.85, 0.6, 0.5, 0.15, 0.15])[:annotators]
    truth = rng.integers(0, len(LABELS), items)
    rows, n = [], 0
    for i, t in enumerate(truth):
        for a in rng.choice(annotators, 5, replace=False):
            said = t if rng.random() < skill[a] else rng.integers(0, len(LABELS))
            n += 1
            rows.append((n, f"c{i}", f" R{a} ", LABELS[said].upper().replace("_", "-"), "High", "x", "clash"))
    return rows, truth


def run(spark, rows, least=1):
    df = spark.createDataFrame(rows, SCHEMA)
    items = votes_by_item(df, "candidate_id", "reviewer_id", "decision_label", "confidence", ["kind"], "review_row", LABELS, least)
    return fit_consensus(items)


def test_beats_majority_and_ranks_annotators(spark):
    rows, truth = simulated()
    coded, model = run(spark, rows)
    got = {r.item: r.decision_label for r in consensus_labels(coded, model).collect()}
    right = np.mean([LABELS[t] == got[f"c{i}"] for i, t in enumerate(truth)])
    votes = {}
    for r in rows:
        votes.setdefault(r[1], []).append(r[3].lower().replace("-", "_"))
    majority = np.mean([max(sorted(set(v)), key=v.count) == LABELS[t] for v, t in ((votes[f"c{i}"], t) for i, t in enumerate(truth))])
    assert right >= majority and right > 0.9
    skill = {r.reviewer_id: r.reliability for r in annotator_reliability(coded, model).collect()}
    assert min(skill["r0"], skill["r1"], skill["r2"]) > max(skill["r4"], skill["r5"]) > max(skill["r6"], skill["r7"])


def test_dirty_rows_and_repeats(spark):
    good = [(i, "c", f"r{i}", "uncertain", "low", None, None) for i in range(3)]
    dirty = [(9, None, "r1", "uncertain", None, None, None), (10, "c", None, "uncertain", None, None, None), (11, "d", "r1", "no label", None, None, None), (12, "c", "R0", "needs parser fix", "high", None, None), (13, "", "r1", "uncertain", "", None, None)]
    coded, model = run(spark, good + dirty, 3)
    (row,) = consensus_labels(coded, model).collect()
    assert (row.item, row.decision_label, row.annotators, row.agreement) == ("c", "uncertain", 3, 1.0)


def test_empty(spark):
    coded, model = run(spark, [])
    assert consensus_labels(coded, model).count() == 0 and annotator_reliability(coded, model).count() == 0 and model.converged


def test_any_number_of_annotators_gives_the_same(spark):
    rows, _ = simulated(items=120)
    df = spark.createDataFrame(rows, SCHEMA)
    items = votes_by_item(df, "candidate_id", "reviewer_id", "decision_label", "confidence", ["kind"], "review_row", LABELS, 1)
    sent = fit_consensus(items, rounds=4)
    joined = fit_consensus(items, rounds=4, most_sent=2)
    assert sent[1].confusion is not None and joined[1].confusion is None and (sent[1].rounds, sent[1].converged) == (joined[1].rounds, joined[1].converged) == (4, False)
    for f, key in ((consensus_labels, "item"), (annotator_reliability, "reviewer_id")):
        a, b = (f(*x).toPandas().sort_values(key, ignore_index=True) for x in (sent, joined))
        pd.testing.assert_frame_equal(a, b[a.columns], check_dtype=False, atol=1e-6)
    assert fit_consensus(items)[1].converged


def test_features_decide_where_votes_do_not(spark):
    """Labels follow a feature; annotators guess between two labels. With the feature the classifier tells them apart."""
    rng = np.random.default_rng(7)
    rows, truth, n = [], {}, 0
    for i in range(300):
        t = i % 2
        truth[f"c{i}"] = LABELS[t]
        for a in range(4):
            said = t if rng.random() < 0.62 else 1 - t
            n += 1
            rows.append((n, f"c{i}", f"r{a}", LABELS[said], "high", f"kind {t}", None))
    df = spark.createDataFrame(rows, SCHEMA)
    right = {}
    for features in ([], ["kind"]):
        for cells in (5_000, 1):
            items = votes_by_item(df, "candidate_id", "reviewer_id", "decision_label", "confidence", features, "review_row", LABELS, 1)
            got = {r.item: r.decision_label for r in consensus_labels(*fit_consensus(items, ridge=1.0, most_cells=cells)).collect()}
            assert len(got) == 300
            right[bool(features), cells] = np.mean([got[c] == t for c, t in truth.items()])
    assert right[True, 5_000] > 0.95 > right[False, 5_000] + 0.1


def test_agreement_beyond_chance(spark):
    rows = [(n, c, f"r{n % 3}", label, "high", None, None) for n, (c, label) in enumerate([("a", "uncertain")] * 3 + [("b", "uncertain"), ("b", "needs_parser_fix"), ("b", "reject_too_long")])] + [(9, "c", "r1", "uncertain", None, None, None)]
    coded, model = run(spark, rows)
    got = {r.item: (r.pair_agreement, r.kappa) for r in chance_corrected(consensus_labels(coded, model), coded).collect()}
    chance = (25 + 1 + 1) / 49
    assert got["a"] == (1.0, pytest.approx(1.0)) and got["b"] == (0.0, pytest.approx(-chance / (1 - chance))) and got["c"] == (None, None)
