"""Long exact spans shared between records.

Every text is cut into super-k-mers: runs of consecutive windows of ``span``
characters that share their minimiser, the smallest hash of the ``grain``
characters long pieces in the window. A run travels as one packed string to
the bucket of its minimiser, where the windows are sorted and equal ones
counted. Equal windows have equal minimisers, so none is missed.

Most minimisers stand in one text only, and their runs stay at home: which
minimisers stand in several is found first from their hashes alone and sent
around as a Bloom filter of bounded size. Minimisers of very many texts are not
gathered in a bucket: their windows are sent singly, as digests, and combined
before the shuffle. They too are known by a Bloom filter; a minimiser that
passes it by chance is counted singly as well, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bloom, passes
from .codes import codes, mix, pieces, rolling, sliding_min
from .common import digest, sent_if_few, without, written

#: Characters worked on at a time in a Python worker.
_AT_ONCE = 400_000


def super_kmers(texts: list[str], span: int, grain: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, windows, minimiser`` of every run, texts by index and starts by character."""
    whole, at = codes(texts)
    sizes = np.diff(at)
    if not len(whole) or sizes.max() < span:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    least = sliding_min(rolling(whole, grain), span - grain + 1)
    text = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    place = np.arange(len(least)) - at[text]
    whole_window = place + span <= sizes[text]
    fresh = np.ones(len(least), dtype=bool)
    fresh[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh & whole_window)
    # a run ends where the next begins or the text runs out of windows
    bounds = np.flatnonzero(fresh)
    after = np.append(bounds, len(least))[np.searchsorted(bounds, first, side="right")]
    end = np.minimum(after, at[text[first] + 1] - span + 1)
    return text[first], place[first], end - first, least[first]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _in_pieces(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a, b in pieces([len(t) for t in batch[column]], _AT_ONCE):
            yield batch.iloc[a:b]


def _windows(strings: list[str], span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, offset and two hashes of every window in packed strings."""
    whole, at = codes(strings)
    n = np.diff(at) - span + 1
    row = np.repeat(np.arange(len(strings)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    where = at[row] + offset
    return row, offset, rolling(whole, span, 1)[where], rolling(whole, span, 2)[where]


def _shared_runs(bucketed: pd.DataFrame, span: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Of whole buckets: the stretches of windows that stand in several texts, and the sets of those texts.

    The first frame has ``doc, start, length``; the second ``class, doc``, a
    class for every different set of texts that hold a window in common.
    """
    docs, starts = bucketed["doc"].to_numpy(), bucketed["start"].to_numpy()
    row, offset, h1, h2 = _windows(bucketed["packed"].tolist(), span)
    order = np.lexsort((docs[row], h2, h1))
    r, a, b = row[order], h1[order], h2[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    d = docs[r]
    # one entry per text and window, though the text may hold it twice
    once = new.copy()
    once[1:] |= d[1:] != d[:-1]
    texts = np.bincount(group, weights=once).astype(np.int64)
    held = texts[group] > 1
    shared = np.zeros(len(row), dtype=bool)
    shared[order] = held
    # stretches of neighbouring shared windows in a row
    edge = np.flatnonzero(shared & np.concatenate([[True], (row[1:] != row[:-1]) | ~shared[:-1]]))
    stop = np.flatnonzero(shared & np.concatenate([(row[1:] != row[:-1]) | ~shared[1:], [True]]))
    runs = pd.DataFrame({"doc": docs[row[edge]], "start": starts[row[edge]] + offset[edge], "length": offset[stop] - offset[edge] + span})
    # the sets of texts, told apart by two sums of hashes of their members
    keep = held & once
    g, member = group[keep], d[keep]
    if not len(g):
        return runs, pd.DataFrame({"class": np.zeros(0, object), "doc": np.zeros(0, np.int64)})
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    size = np.diff(np.append(start, len(g)))
    own = member.astype(np.int64).view(np.uint64)
    one, two = (np.add.reduceat(mix(own ^ np.uint64(salt)), start) for salt in (0, 0x9E3779B97F4A7C15))
    order = np.lexsort((two, one))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    chosen = np.sort(order[new])
    pick = np.zeros(len(start), dtype=bool)
    pick[chosen] = True
    names = np.array([f"{one[i]:016x}{two[i]:016x}" for i in chosen], dtype=object)
    return runs, pd.DataFrame({"class": np.repeat(names, size[chosen]), "doc": member[np.repeat(pick, size)]})


def shared_spans(df: DataFrame, key: str, text: str, span: int = 300, grain: int = 120, hot: int = 20_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``spans, classes, copies`` of texts that share at least ``span`` equal characters.

    ``spans``: ``doc, start, length`` of each stretch of a distinct text that
    other distinct texts hold too (stretches may overlap; see ``coverage``).
    ``classes``: ``class, doc``, sets of distinct texts with a common span.
    ``copies``: ``doc, copy_no, n`` for each row of a text that several rows
    have; the smallest key stands for the text as ``doc``.

    Null keys and texts shorter than ``span``, also null and empty ones, take
    no part. A span that repeats within one text only is not shared. Other
    columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text")).where(F.length("text") >= span).where("doc is not null")
    keyed = rows.select("doc", digest(F.col("text")).alias("d"))
    groups = keyed.groupBy("d").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = written(keyed.join(groups, "d").select(F.col("first").alias("doc"), F.col("doc").alias("copy_no"), "n"))
    texts = without(rows, copies.where("copy_no <> doc").select(F.col("copy_no").alias("doc")), "doc")

    def minimisers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _in_pieces(batches, "text"):
            t, _, _, value = super_kmers(b["text"].tolist(), span, grain)
            yield pd.DataFrame({"value": _signed(value), "doc": b["doc"].to_numpy()[t]}).drop_duplicates()

    seen = texts.mapInPandas(minimisers, "value long, doc long").groupBy("value").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("n")).where("a <> b").select("value", "n")
    seen = seen.persist()
    shared = spark.sparkContext.broadcast(bloom(seen.select("value")))
    popular_values = seen.where(F.col("n") > hot).select("value")
    any_popular = popular_values.limit(1).count() > 0
    popular = spark.sparkContext.broadcast(bloom(popular_values, bits=32) if any_popular else None)
    seen.unpersist()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _in_pieces(batches, "text"):
            own, docs = b["text"].tolist(), b["doc"].to_numpy()
            t, start, n, value = super_kmers(own, span, grain)
            keep = passes(shared.value, value)
            if not keep.any():  # an empty column of strings has no type that Arrow could tell
                continue
            t, start, n, value = t[keep], start[keep], n[keep], _signed(value[keep])
            packed = [own[i][s : s + w + span - 1] for i, s, w in zip(t.tolist(), start.tolist(), n.tolist())]
            yield pd.DataFrame({"value": value, "doc": docs[t], "start": start, "packed": packed, "hot": passes(popular.value, value) if popular.value is not None else np.zeros(len(value), dtype=bool)})

    runs = texts.mapInPandas(pack, "value long, doc long, start long, packed string, hot boolean")
    out = "doc long, start long, length long, class string"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            values = held["value"].to_numpy()
            whole = int(np.searchsorted(values, values[-1])) if len(values) else 0
            if whole:
                yield from report(held.iloc[:whole])
                held = held.iloc[whole:].reset_index(drop=True)
        if held is not None and len(held):
            yield from report(held)

    def report(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        bounds = np.flatnonzero(np.concatenate([[True], np.diff(frame["value"].to_numpy()) != 0, [True]]))
        lengths = np.add.reduceat(frame["packed"].str.len().to_numpy(), bounds[:-1]).tolist()
        for a, b in pieces(lengths, _AT_ONCE):
            spans, classes = _shared_runs(frame.iloc[bounds[a] : bounds[b]], span)
            yield spans.assign(**{"class": pd.Series(None, index=spans.index, dtype=object)})
            yield classes.assign(start=None, length=None).astype({"start": "Int64", "length": "Int64"})[["doc", "start", "length", "class"]]

    plain = runs.where("not hot").select("value", "doc", "start", "packed").repartition("value").sortWithinPartitions("value").mapInPandas(count, out)

    def singly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _in_pieces(batches, "packed"):
            row, offset, h1, h2 = _windows(b["packed"].tolist(), span)
            yield pd.DataFrame({"h1": _signed(h1), "h2": _signed(h2), "doc": b["doc"].to_numpy()[row], "start": b["start"].to_numpy()[row] + offset})

    found = plain
    if any_popular:
        windows = runs.where("hot").mapInPandas(singly, "h1 long, h2 long, doc long, start long")
        held_by = windows.select("h1", "h2", "doc").distinct()
        # windows of one set of texts are one class, however many they are
        member = lambda n: F.bit_xor(F.xxhash64("doc", F.lit(n)))
        sets = held_by.groupBy("h1", "h2").agg(F.count("*").alias("n"), member(1).alias("a"), member(2).alias("b")).where("n > 1")
        common = written(sets.select("h1", "h2", F.concat(F.lower(F.hex("a")), F.lit("-"), F.lower(F.hex("b"))).alias("class")))
        one_each = common.groupBy("class").agg(F.min(F.struct("h1", "h2")).alias("w")).select("class", "w.h1", "w.h2")
        none = F.lit(None).cast("long")
        spans = windows.join(sent_if_few(common.select("h1", "h2")), ["h1", "h2"]).select("doc", "start", F.lit(span).cast("long").alias("length"), F.lit(None).cast("string").alias("class"))
        classes = held_by.join(sent_if_few(one_each), ["h1", "h2"]).select("doc", none.alias("start"), none.alias("length"), "class")
        found = plain.unionByName(spans).unionByName(classes)
    return found.where("class is null").select("doc", "start", "length"), found.where("class is not null").select("class", "doc"), copies


def span_classes(classes: DataFrame, copies: DataFrame) -> DataFrame:
    """``class, doc, members``: every row of every set of rows with a common span, and the size of the set; nothing is paired.

    Rows with equal texts are in the classes of their text, and in one of their own if no other text shares a span with it.
    """
    sets = classes.distinct()
    rows = copies.select("doc", "copy_no")
    spelled = sets.join(rows, "doc", "left").select("class", F.coalesce("copy_no", "doc").alias("doc"))
    alone = rows.join(sets.select("doc").distinct(), "doc", "left_anti").select(F.concat(F.lit("copies-"), F.col("doc").cast("string")).alias("class"), F.col("copy_no").alias("doc"))
    whole = spelled.unionByName(alone)
    return whole.join(whole.groupBy("class").agg(F.count("*").alias("members")), "class")


def merged_spans(spans: DataFrame) -> DataFrame:
    """``doc, start, length``: stretches that overlap or touch as one. A text's stretches are gathered; its own length bounds them."""
    zero = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def joined(out, x):
        last = F.element_at(out, -1)
        grown = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))))
        return F.when(F.size(out) == 0, F.array(x)).when(x["start"] <= last["stop"], grown).otherwise(F.concat(out, F.array(x)))

    own = F.struct(F.col("start").cast("long").alias("start"), (F.col("start") + F.col("length")).cast("long").alias("stop"))
    lists = spans.groupBy("doc").agg(F.array_sort(F.collect_set(own)).alias("s"))
    return lists.select("doc", F.explode(F.aggregate("s", zero, joined)).alias("m")).select("doc", F.col("m.start").alias("start"), (F.col("m.stop") - F.col("m.start")).alias("length"))


def shared_pairs(classes: DataFrame, copies: DataFrame) -> DataFrame:
    """``doc_a, doc_b`` (smaller first) for every two rows that share a span, copies spelled out."""
    sets = classes.distinct()
    a, b = sets.withColumnRenamed("doc", "doc_a"), sets.withColumnRenamed("doc", "doc_b")
    texts = a.join(b, "class").where("doc_a < doc_b").select("doc_a", "doc_b").distinct()
    rows = lambda side: copies.select(F.col("doc").alias(side), F.col("copy_no").alias(f"{side}_row"))
    both = texts.join(rows("doc_a"), "doc_a", "left").join(rows("doc_b"), "doc_b", "left")
    both = both.select(F.coalesce("doc_a_row", "doc_a").alias("x"), F.coalesce("doc_b_row", "doc_b").alias("y"))
    same = copies.select("doc", F.col("copy_no").alias("x")).join(copies.select("doc", F.col("copy_no").alias("y")), "doc").where("x < y").select("x", "y")
    return both.unionByName(same).select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"))


def coverage(df: DataFrame, key: str, text: str, spans: DataFrame, copies: DataFrame) -> DataFrame:
    """``doc, shared_chars, share`` for every row with a shared span: how much of it other rows hold.

    Overlapping stretches count once. A row whose text other rows have whole is
    shared whole. Empty or null texts give no row.
    """
    merged = spans.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("stop")))).alias("s"))
    # a text has at most as many stretches as runs, which its own length bounds
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    total = F.aggregate("s", zero, lambda z, x: F.struct((z["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], z["upto"]))).alias("n"), F.greatest(z["upto"], x["stop"]).alias("upto")))
    partly = merged.select("doc", total["n"].alias("n"))
    rows = df.select(F.col(key).cast("long").alias("doc"), F.length(F.col(text).cast("string")).cast("long").alias("chars")).where("chars > 0")
    twins = copies.select(F.col("copy_no").alias("doc"), F.lit(True).alias("twin"))
    joined = rows.join(partly, "doc", "left").join(twins, "doc", "left").where("n is not null or twin")
    chars = F.when(F.col("twin"), F.col("chars")).otherwise(F.col("n"))
    return joined.select("doc", chars.alias("shared_chars"), (chars / F.col("chars")).alias("share"))
