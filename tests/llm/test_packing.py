import os
import random
from collections import Counter

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusgate.llm import packing
from corpusgate.llm.common import tokenizer_dir
from corpusgate.llm.packing import configurations, pack, pack_windows, plan


def unfold(placed):
    load, seen = Counter(), Counter()
    for length, low, high, first in placed:
        assert low == seen[length]
        seen[length] = high
        for r in range(low, high):
            load[first + r - low] += length
    return load, seen


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=25), st.integers(1, 12), st.integers(2, 9))
def test_plan_places_every_item_and_overfills_nothing(counts, groups, small):
    placed, containers = plan(counts, 64, groups, small)
    load, seen = unfold(placed)
    assert dict(seen) == counts
    assert set(load) == set(range(containers)) and (not load or max(load.values()) <= 64)


def test_plan_leaves_little_space():
    rng = random.Random(3)
    for capacity in (512, 4096):
        counts = Counter(min(capacity, max(1, int(rng.lognormvariate(6, 0.8)))) for _ in range(20_000))
        _, containers = plan(dict(counts), capacity)
        least = sum(k * v for k, v in counts.items()) / capacity
        assert containers <= 1.02 * least + 1


def test_the_programme_finds_the_fewest_containers():
    # 60 + 40, 50 + 50 and 34 + 33 + 33 fill a container; the greatest first alone would do worse
    sizes, needed = [60, 50, 40, 34, 33], [300, 200, 300, 100, 200]
    used = Counter()
    for config, many in configurations(sizes, needed, 100):
        assert sum(sizes[j] for j in config) <= 100
        used.update({j: many * config.count(j) for j in config})
        assert many > 0
    assert [used[j] for j in range(5)] == needed
    assert plan(dict(zip(sizes, needed)), 100)[1] == 300 + 100 + 100


def test_most_pieces_full_and_hot_lengths(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_A_GROUP", 50)
    rows = [(n, 100) for n in range(900)] + [(2_000 + n, 350) for n in range(40)] + [(3_000 + n, 30) for n in range(700)]
    got = pack(spark.createDataFrame(rows, "item long, tokens int"), 100).toPandas()
    load = got.groupby("container")["tokens"].sum()
    assert load.max() <= 100 and sorted(load.index) == list(range(len(load))) and got["tokens"].sum() == sum(t for _, t in rows)
    assert len(load) <= 900 + 120 + (700 * 30 + 40 * 50) // 90 + 2
    salted = packing._salted(spark.createDataFrame(rows, "item long, tokens int"), "tokens", pd.DataFrame({"tokens": [100, 30], "n": [900, 700]}))
    assert salted.where("tokens = 100").groupBy("salt").count().agg({"count": "max"}).first()[0] < 110
    assert salted.where("tokens = 350").select("salt").distinct().count() == 1


def test_operator(spark):
    rng = random.Random(5)
    rows = [(n, rng.choice([7, 7, 7, rng.randint(1, 250)])) for n in range(500)] + [(1000, 0), (1001, None), (None, 5), (3, 9), (3, 9)]
    df = spark.createDataFrame(rows, "item long, tokens int")
    got = pack(df, 100).collect()
    load = Counter()
    for r in got:
        load[r.container] += r.tokens
    assert max(load.values()) <= 100 and set(load) == set(range(len(load)))
    assert sum(load.values()) == sum(t or 0 for i, t in rows if i is not None)
    cuts = Counter(r.item for r in got if r.piece > 0)
    assert all(dict(rows[:500]).get(i, 0) > 100 for i in cuts)
    for r in got:
        assert r.token_start == r.piece * 100 and (r.tokens == 100 or r.tokens == (dict(rows).get(r.item) or 9) - r.token_start or r.item == 3)
    assert pack(df.limit(0), 100).count() == 0
    with pytest.raises(ValueError):
        pack(df, 0)


@pytest.mark.skipif(not os.path.isdir(tokenizer_dir()), reason="no tokenizer files")
def test_texts(spark):
    d = spark.createDataFrame([(1, "một hai ba " * 500), (2, None), (3, ""), (4, "bốn"), (4, "bốn")], "id long, text string")
    w = spark.createDataFrame([("a", 64), ("b", 256), (None, 8), ("c", None)], "name string, capacity int")
    got = pack_windows(d, "id", "text", w, "name", "capacity", tokenizer_dir()).collect()
    assert {r.window_name for r in got} == {"a", "b"} and {r.item for r in got} == {1, 4}
    assert sum(r.tokens for r in got if r.window_name == "a") == sum(r.tokens for r in got if r.window_name == "b")
    assert sum(r.item == 4 for r in got if r.window_name == "a") == 2
