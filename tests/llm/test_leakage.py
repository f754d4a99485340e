import random
import re
import unicodedata

import numpy as np

from corpusgate.llm.leakage import _find, covered_words, edit_distance_within, find_edited, find_leaks, fold, prepare


def words_of(s):
    s = "".join(c for c in unicodedata.normalize("NFD", s.lower().replace("đ", "d")) if not unicodedata.combining(c))
    return re.findall(r"[^\W_]+", s)


def test_fold_parts_words_and_drops_marks():
    folded, at = fold(["Điều 1: Hội—đồng", "", "a\u200bb é"])
    texts = ["".join(map(chr, folded[a:b])) for a, b in zip(at, at[1:])]
    assert texts[0].split("\0")[:-1] == ["dieu", "1", "hoi", "dong"] and texts[2].split("\0")[:-1] == ["ab", "e"]


def test_covered_words_rules():
    p = [f"w{n}" for n in range(40)]
    assert covered_words(p, ["x", *p[5:30], "y"], 8, 1.5) == 25
    assert covered_words(p, p[20:30] + ["x"] + p[0:12], 8, 1.5) == 12  # not in order
    assert covered_words(p, p[0:12] + ["x"] * 5 + p[20:32], 8, 1.5) == 24
    assert covered_words(p, p[0:12] + ["x"] * 60 + p[20:32], 8, 1.5) == 12  # too far apart
    assert covered_words(p, p[0:7] + ["x"] + p[8:15], 8, 1.5) == 0


def test_against_brute_force():
    rng = random.Random(7)
    vocabulary = ["kho", "lưu", "trữ", "được", "bảo", "quản", "đồng", "thời", "biên", "bản", "kiểm", "tra", "số", "phiếu", "thu", "cấp", "xã", "giấy"]
    item = lambda: [rng.choice(vocabulary) + (str(rng.randint(0, 9)) if rng.random() < 0.3 else "") for _ in range(rng.randint(30, 60))]
    items = [item() for _ in range(25)]
    texts = []
    for _ in range(300):
        body = [w for _ in range(rng.randint(0, 4)) for w in item()]
        for w in rng.sample(items, rng.randint(0, 2)):
            cut = rng.randint(0, len(w) // 2)
            quoted = w[cut : cut + rng.randint(10, len(w))]
            if rng.random() < 0.5:
                quoted.insert(rng.randint(0, len(quoted)), "chen")
            at = rng.randint(0, len(body))
            body[at:at] = [x.upper() if rng.random() < 0.2 else unicodedata.normalize("NFD", x) for x in quoted]
        texts.append(rng.choice([" ", "  ", " - "]).join(body))
    got = {(t, p.ids[o]) for p in prepare(list(range(25)), [", ".join([" ".join(w)]) for w in items], 8, 0.5) for t, o, _ in _find(*fold(texts), p, 8, 0.5, 1.5)}
    folded = [words_of(" ".join(w)) for w in items]
    want = {(t, i) for t, x in enumerate(texts) for i, w in enumerate(folded) if covered_words(w, words_of(x), 8, 1.5) > len(w) / 2}
    assert want and got == want


def test_operator(spark):
    passage = " ".join(f"chữ{n}" for n in range(30))
    docs = [(1, f"Mở đầu. {passage.upper()}!", 0), (1, f"Mở đầu. {passage.upper()}!", 0), (2, None, 0), (3, "", 0), (4, "khác hẳn " * 50_000 + passage[: len(passage) * 2 // 3], 0), (None, passage, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    i = spark.createDataFrame([(7, passage, "x"), (8, "ngắn", "x"), (9, None, "x"), (10, "", "x")], "item_id long, text string, doc_id string")
    got = [(r.doc_id, r.item_id) for r in find_leaks(d, "doc_id", "text", i, "item_id", "text").orderBy("doc_id").collect()]
    assert got == [(1, 7), (1, 7), (4, 7)]
    assert find_leaks(d.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0
    assert find_leaks(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0


def test_passages_in_blocks_give_the_same(spark):
    passages = [" ".join(f"chữ{n}x{k}" for n in range(20)) for k in range(12)]
    d = spark.createDataFrame([(k, f"đầu {p} cuối {passages[(k * 5) % 12]}") for k, p in enumerate(passages)], "doc_id long, text string")
    i = spark.createDataFrame(list(enumerate(passages)), "item_id long, text string")
    for find in (find_leaks, find_edited):
        whole, blocks = (sorted((r.doc_id, r.item_id) for r in find(d, "doc_id", "text", i, "item_id", "text", most_passage_chars=n).collect()) for n in (10**6, 300))
        assert whole == blocks and {(k, k) for k in range(12)} <= set(whole)


def test_short_words_of_one_passage_do_not_shorten_all_q_grams():
    long = " ".join(f"dài{n}hơn" for n in range(30))
    assert [(p.q, p.ids) for p in prepare([1, 2], [long, "a b c d e f g h i k"], 8, 0.5)] == [(12, [2]), (58, [1])] and prepare([1], [long], 8, 0.5)[0].q == 58


def semi_global(part, region):
    row = [0] * (len(region) + 1)
    for x in part:
        new = [row[0] + 1]
        for j, y in enumerate(region, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_banded_alignment_is_the_semi_global_edit_distance():
    rng = random.Random(9)
    for _ in range(300):
        part = [rng.choice("abc") for _ in range(rng.randint(1, 25))]
        region = [rng.choice("abc") for _ in range(rng.randint(0, 20))] + [c for c in part if rng.random() > 0.1] + [rng.choice("abc") for _ in range(rng.randint(0, 20))]
        budget, want = rng.randint(0, 6), semi_global(part, region)
        got = edit_distance_within(np.array([ord(c) for c in part]), np.array([ord(c) for c in region]), budget)
        assert got == (want if want <= budget else None)


def test_edited_passages_are_found(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdeghiklmnopqrstuvxy") for _ in range(rng.randint(2, 7)))
    items = [[word() for _ in range(90)] for _ in range(8)]
    docs, want = [], set()
    for n in range(40):
        own = list(items[n % 8])
        kind = n % 4
        if kind == 0:  # one word in nine is another
            own = [word() if i % 9 == 4 else w for i, w in enumerate(own)]
        elif kind == 1:  # a part of it, with letters changed
            own = [w[:-1] + "z" if i % 4 == 0 else w for i, w in enumerate(own[20:75])]
        elif kind == 2:  # words left out and put in
            own = [x for i, w in enumerate(own) for x in ([] if i % 20 == 7 else [w, "thêm"] if i % 20 == 15 else [w])]
        else:
            own = [word() for _ in own]
        if kind < 3:
            want.add((n, n % 8))
        docs.append((n, " ".join([word() for _ in range(60)] + own + [word() for _ in range(60)])))
    docs += [(100, None), (101, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string")
    found = find_edited(d, "doc_id", "text", i, "item_id", "text", edits=0.12).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and all(0 < r.covered <= 1 for r in found)
    assert find_leaks(d, "doc_id", "text", i, "item_id", "text").where("doc_id % 4 = 1").count() == 0
