import random
from collections import Counter

import numpy as np
import pytest

from corpusgate.llm import split_overlap
from corpusgate.llm.split_overlap import _hashed, _Hashes, _most_changed, _parities, _spread_out, _squeezed, class_pairs, cross_split_overlaps, cut, held_runs, record_words, spelled_out, train_runs, words_differing


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_words_differing_is_the_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.choice("abcdef") for _ in range(rng.randint(1, 30))]
        b = [c for c in a if rng.random() > 0.1]
        b = [rng.choice("abcdef") if rng.random() < 0.1 else c for c in b] or ["a"]
        want = edit_distance(a, b) / max(len(a), len(b))
        got = words_differing(" ".join(a), " ".join(b), 0.2)
        assert got == pytest.approx(want) if want <= 0.2 and edit_distance(a, b) <= int(0.2 * max(len(a), len(b))) else got == 1.0


def test_chunks_do_not_depend_on_place_or_neighbours():
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    whole, moved = " ".join(words), " ".join(["x", "y", "z", *words])
    h, start, size = _hashed([whole, moved, "one"], _Hashes())
    t, d, n = cut(h, start, size)
    parity = _parities(h, start)
    assert size.tolist() == [300, 303, 1] and n[t == 0].sum() <= 300
    assert len(set(d[t == 0]) & set(d[t == 1])) >= len(d[t == 0]) - 2
    odd = np.bitwise_xor(parity[0], parity[1])
    assert sum(int(x).bit_count() for x in odd) <= 3


def test_record_words_orders_fields():
    a = record_words(["Hỏi?"], ["b: hai\na: một"])
    assert a == record_words(["hỏi"], ['{"a": "một", "b": "hai"}']) == "hỏi a một b hai"
    assert record_words([None], [None]) == ""


def _rows():
    rng = random.Random(5)
    vocabulary = [f"từ{n}" for n in range(400)]
    rows, pairs, n = [], set(), 0
    for i in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 90))]
        rows.append((n, " ".join(words), None, "Trả lời chung.", "train"))
        base, n = n, n + 1
        kind = i % 5
        if kind < 3:  # copies with few words changed
            other = list(words)
            for at in rng.sample(range(len(other)), kind * len(other) // 40):
                other[at] = "khác"
            rows.append((n, " ".join(other).upper() + "!", "", "trả lời chung", "test" if kind else "validation"))
            pairs.add((base, n))
            n += 1
        elif kind == 3:  # half of it is new
            rows.append((n, " ".join(words[: len(words) // 2] + [rng.choice(vocabulary) for _ in words[len(words) // 2 :]]), None, "Trả lời chung.", "test"))
            n += 1
    return rows, pairs


def test_against_planted_pairs(spark):
    rows, pairs = _rows()
    rows += [(None, rows[0][1], None, "x", "test"), (9001, rows[0][1], None, "Trả lời chung.", None), (9002, None, None, None, "test"), (9003, " ", "", "...", "train")]
    rows += [(9100 + k, rows[0][1], None, "Trả lời chung.", "train") for k in range(3)]
    df = spark.createDataFrame(rows, "id long, instruction string, input string, output string, side string")
    found, members = cross_split_overlaps(df, "id", "side", ["instruction", "input"], ["output"])
    got = {(r.train_key, r.held_key) for r in spelled_out(found, members).collect()}
    extra = {(9100 + k, 1) for k in range(3)}
    assert got == pairs | extra
    classes, membership = class_pairs(found, members)
    firsts = {}
    for r in membership.collect():
        firsts[r.side, r.key] = r.first_key
    assert {(r.train_first, r.held_first, r.train_copies) for r in classes.collect()} == {(firsts[0, a], firsts[1, b], 4 if firsts[0, a] == 0 else 1) for a, b in got}
    assert all(0.5 <= r.overlap_fraction <= 1 and r.differing_words <= 0.12 for r in found.collect())


def test_empty_table_and_long_texts(spark):
    schema = "id long, instruction string, input string, output string, side string"
    empty = spark.createDataFrame([], schema)
    assert spelled_out(*cross_split_overlaps(empty, "id", "side", ["instruction", "input"], ["output"])).count() == 0
    long = " ".join(f"w{n}" for n in range(60_000))
    df = spark.createDataFrame([(1, long, None, "a", "train"), (2, long + " end", None, "a", "test")], schema)
    assert spelled_out(*cross_split_overlaps(df, "id", "side", ["instruction", "input"], ["output"])).count() == 1


@pytest.mark.parametrize("words", [9, 20, 40, 100, 200, 500])
def test_no_pair_with_a_tenth_of_its_words_changed_is_lost(words):
    rng = random.Random(words)
    hashes, trained, held = _Hashes(), [], []
    for k in range(150):
        a = [f"w{rng.randint(0, 3000)}" for _ in range(words)]
        b = [[w] for w in a]
        for i in rng.sample(range(words), int(words * (0.08, 0.1, 0.12)[k % 3])):
            b[i] = rng.choice([["khác"], ["khác"], [], [a[i], "thêm"]])
        trained.append(" ".join(a))
        held.append(" ".join(w for x in b for w in x))
    offered = held_runs(*_hashed(held, hashes), 0.12)
    counts = np.bincount((offered[1] % np.uint64(1 << 16)).astype(np.int64), minlength=1 << 16)
    h, start, size = _hashed(trained, hashes)
    chosen = train_runs(h, start, size, counts, 0.12)
    least = np.maximum(1, np.bincount(chosen[0], minlength=len(size)) - _most_changed(size, 0.12))
    shared = Counter(t for t, _ in set(zip(*map(np.ndarray.tolist, chosen))) & set(zip(*map(np.ndarray.tolist, offered))))
    met = {t for t, n in shared.items() if n >= least[t]}
    near = {k for k, (a, b) in enumerate(zip(trained, held)) if words_differing(a, b, 0.12) <= 0.12}
    assert len(near) > 140 and near <= met


def test_pairs_that_share_few_chunks_are_found(spark):
    rng = random.Random(8)
    rows = []
    for k in range(120):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(40)]
        other = list(words)
        for i in rng.sample(range(40), 4):
            other[i] = "khác"
        rows += [(2 * k, " ".join(words), None, None, "train"), (2 * k + 1, " ".join(other), None, None, "test")]
    df = spark.createDataFrame(rows, "id long, instruction string, input string, output string, side string")
    found, members = cross_split_overlaps(df, "id", "side", ["instruction", "input"], ["output"])
    got = {(r.train_key, r.held_key) for r in spelled_out(found, members).collect()}
    assert got == {(2 * k, 2 * k + 1) for k in range(120)}
    assert found.where("overlap_fraction < 0.5").count() > 0


def test_a_long_text_of_one_word_pairs_with_its_copy(spark):
    df = spark.createDataFrame([(1, "w " * 40_000, None, None, "train"), (2, "w " * 40_000, None, None, "test")], "id long, instruction string, input string, output string, side string")
    assert spelled_out(*cross_split_overlaps(df, "id", "side", ["instruction", "input"], ["output"])).count() == 1


def test_repetitive_texts_with_one_edit_and_squeezed_counts(spark):
    rows = [(2 * n, "w " * size, None, None, "train") for n, size in enumerate((10, 300, 3000))] + [(2 * n + 1, "w " * (size // 2) + "khác " + "w " * (size - size // 2 - 1), None, None, "test") for n, size in enumerate((10, 300, 3000))]
    df = spark.createDataFrame(rows, "id long, instruction string, input string, output string, side string")
    got = {(r.train_key, r.held_key) for r in spelled_out(*cross_split_overlaps(df, "id", "side", ["instruction", "input"], ["output"])).collect()}
    assert got == {(0, 1), (2, 3), (4, 5)}
    n = np.array([0, 1, 127, 128, 1000, 10**6])
    again = _spread_out(_squeezed(n))
    assert (again[:3] == n[:3]).all() and (np.abs(again - n) <= n * 0.1).sum() >= 5 and (again > 0).tolist() == (n > 0).tolist()


def test_hot_runs_meet_within_bands_of_length(spark, monkeypatch):
    monkeypatch.setattr(split_overlap, "HOT", 3)
    rng = random.Random(12)
    stock = [f"mẫu{n}" for n in range(30)]
    rows = []
    for k in range(60):
        own = [f"riêng{k}x{n}" for n in range(rng.choice([2, 3, 20, 60]))]
        other = [w if rng.random() > 0.05 else "khác" for w in own]
        rows += [(2 * k, " ".join(stock + own), None, None, "train"), (2 * k + 1, " ".join(stock[: 30 - k % 3] + other), None, None, "test")]
    df = spark.createDataFrame(rows, "id long, instruction string, input string, output string, side string")
    got = {(r.train_key, r.held_key) for r in spelled_out(*cross_split_overlaps(df, "id", "side", ["instruction", "input"], ["output"])).collect()}
    texts = {n: t for n, t, *_ in rows}
    assert got == {(a, b) for a in texts for b in texts if a % 2 == 0 and b % 2 and words_differing(texts[a], texts[b], 0.12) <= 0.12}
    bands = split_overlap._bands(np.arange(1, 2000), 0.12)
    assert all(abs(int(bands[a - 1]) - int(bands[b - 1])) <= 1 for a in range(1, 1500, 7) for b in (int(a / 0.88), a + 1) if b < 2000 and b - a <= 0.12 * b)
