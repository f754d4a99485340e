import random

import pytest

from corpusgate.llm.shared_spans import coverage, merged_spans, shared_pairs, shared_spans, span_classes, super_kmers


def brute(rows, k):
    held = {}
    for doc, t in rows:
        if t and doc is not None:
            for s in range(len(t) - k + 1):
                held.setdefault(t[s : s + k], {}).setdefault(doc, []).append(s)
    pairs, marks = set(), {}
    for docs in held.values():
        if len(docs) > 1:
            ordered = sorted(docs)
            pairs |= {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :]}
            for d, starts in docs.items():
                for s in starts:
                    marks.setdefault(d, set()).update(range(s, s + k))
    return pairs, {d: len(m) for d, m in marks.items()}


def corpus(seed=11):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abđệ \n🙂") for _ in range(n))
    shared = [text(90) for _ in range(6)]
    rows = []
    for doc in range(60):
        parts = [text(rng.randint(0, 150))]
        for s in rng.sample(shared, rng.randint(0, 2)):
            a = rng.randint(0, 50)
            parts += [s[a:], text(rng.randint(0, 60))]
        rows.append((doc, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, ""), (104, "aaaa" * 60), (105, "aaaa" * 60 + "b"), (None, rows[3][1])]
    return rows


@pytest.mark.parametrize("hot", [20_000, 3])
def test_against_brute_force(spark, hot):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc long, body string, start string")
    spans, classes, copies = shared_spans(df, "doc", "body", span=40, grain=16, hot=hot)
    pairs, marks = brute(rows, 40)
    assert {tuple(r) for r in shared_pairs(classes, copies).collect()} == pairs
    got = shared_pairs(classes, copies).collect()
    assert len(got) == len(set(got))
    sets = {}
    for r in span_classes(classes, copies).collect():
        sets.setdefault(r["class"], []).append((r.doc, r.members))
    assert all(len(m) == n for m in sets.values() for _, n in m)
    assert {(a, b) for m in sets.values() for a, _ in m for b, _ in m if a < b} == pairs
    whole = {r.copy_no for r in copies.collect()}
    assert {d: n for d, n in marks.items() if d not in whole} == {r.doc: r.n for r in merged_spans(spans).groupBy("doc").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect() if r.doc not in whole}
    assert {r.doc: r.shared_chars for r in coverage(df, "doc", "body", spans, copies).collect()} == marks


def test_super_kmers_hold_every_window_once():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab cđ") for _ in range(n)) for n in (500, 39, 0, 40, 1000)]
    t, start, n, _ = super_kmers(texts, 40, 10)
    seen = sorted((i, s + d) for i, s, w in zip(t.tolist(), start.tolist(), n.tolist()) for d in range(w))
    assert seen == [(i, s) for i, x in enumerate(texts) for s in range(max(0, len(x) - 39))]


def test_empty_and_unshared(spark):
    df = spark.createDataFrame([(1, "a" * 100), (2, "b" * 100)], "doc long, body string")
    for d in (df, df.limit(0)):
        spans, classes, copies = shared_spans(d, "doc", "body", span=40, grain=16)
        assert spans.count() == classes.count() == copies.count() == 0
        assert shared_pairs(classes, copies).count() == coverage(d, "doc", "body", spans, copies).count() == 0


@pytest.mark.parametrize("hot", [20_000, 20])
def test_a_footer_of_very_many_texts_is_one_class(spark, hot):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdeđ ") for _ in range(n))
    footer = text(400)
    df = spark.createDataFrame([(n, text(60) + chr(0x4E00 + n) + footer + (chr(0x4E00 + n) if n % 2 else "")) for n in range(60)], "doc long, body string")
    spans, classes, copies = shared_spans(df, "doc", "body", span=40, grain=16, hot=hot)
    assert classes.distinct().groupBy("class").count().count() == 1
    assert shared_pairs(classes, copies).count() == 60 * 59 // 2 and copies.count() == 0
    assert merged_spans(spans).groupBy("doc").count().count() == 60
