"""Evaluation texts leaking into training text.

Q-gram lemma filtering: a passage that a document quotes shares with it many
character q-grams on nearly one diagonal (place in the document less place in
the passage). Shared q-grams are counted in overlapping bands of diagonals;
bands whose count meets the edit budget are kept, and an alignment decides.

There are two measures. ``find_leaks`` wants unbroken runs of words: its edit
budget is what may stand between the runs, and the runs are aligned in the
passage's order. ``find_edited`` wants stretches within an edit distance, which
a banded alignment of characters works out.

The passages go to every task, in blocks of bounded size if they are many; a
document is looked at by itself, so there is no shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .codes import codes, pieces, rolling

_AT_ONCE = 500_000
#: Q-gram lengths. A passage takes the longest that its shortest run of words allows, so one of short words does not make all q-grams short.
_LADDER = (8, 12, 18, 27, 39, 58, 87)
#: A q-gram in more places of the passages than this is common.
COMMON = 24
#: Characters of passages in a block: at some 60 bytes each about 120 MB.
MOST_PASSAGE_CHARS = 2_000_000
#: Bits of the number of places in the first test of a q-gram, by the number of q-grams: 64 KB to 32 MB.
_TEST_BITS = range(16, 26)


@lru_cache(1)
def _folding() -> np.ndarray:
    """By code point: 0 for what parts words, 1 for what is dropped within them, else the folded letter or digit.

    Case and accents go; a letter that folds to several keeps the first.
    """
    table = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        ch = chr(c)
        kind = unicodedata.category(ch)
        if kind in ("Mn", "Me", "Cf"):
            table[c] = 1
        elif kind[0] in "LN" or kind == "Mc":
            base = unicodedata.normalize("NFD", ch.lower())[0].lower()
            table[c] = ord({"đ": "d", "ð": "d", "ø": "o", "ł": "l", "ı": "i", "ħ": "h"}.get(base, base))
    table[0x20000:0x32000] = np.arange(0x20000, 0x32000)
    return table


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded texts one after the other, words parted and each text ended by a single 0, and where each text starts."""
    whole, at = codes([t + "\n" for t in texts])
    folded = _folding()[whole]
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    keep = folded != 1
    folded, text = folded[keep], text[keep]
    first = np.ones(len(text), dtype=bool)
    first[1:] = text[1:] != text[:-1]
    before = np.zeros(len(folded), dtype=np.uint32)
    before[1:] = folded[:-1]
    before[first] = 0
    # of neighbouring separators one stays; a text may begin without any
    keep = (folded != 0) | (before != 0)
    folded, text = folded[keep], text[keep]
    return folded, np.searchsorted(text, np.arange(len(texts) + 1))


def _words(folded: np.ndarray) -> list[str]:
    return folded.astype("<u4").tobytes().decode("utf-32-le").split("\0")[:-1] if len(folded) else []


@dataclass
class Passages:
    """What tasks need of the passages: q-grams in order with their passages and places, and words by passage."""

    ids: list[int]
    words: list[list[str]]
    grams: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    least: np.ndarray
    chars: np.ndarray
    test: np.ndarray
    q: int


def _index(ids: list[int], words: list[list[str]], pieces_: list[np.ndarray], least: list[int], q: int) -> Passages:
    """Passages as folded characters, indexed by q-grams."""
    grams, owner, place = [], [], []
    for n, piece in enumerate(pieces_):
        g = rolling(piece, q)
        grams.append(g), owner.append(np.full(len(g), n)), place.append(np.arange(len(g)))
    none = np.zeros(0, dtype=np.int64)
    g = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    order = np.argsort(g, kind="stable")
    g = g[order]
    owners, places = (np.concatenate(x)[order] if x else none for x in (owner, place))
    # q-grams that stand in many places are left out for passages that have enough others: the count they must share is less by those left out
    _, inverse, many = np.unique(g, return_inverse=True, return_counts=True)
    common = many[inverse] > COMMON if len(g) else np.zeros(0, dtype=bool)
    wanted = np.array(least, dtype=np.int64)
    fewer = wanted - np.bincount(owners[common], minlength=len(wanted))
    enough = fewer >= 1
    wanted = np.where(enough, fewer, wanted)
    keep = ~common | ~enough[owners] if len(g) else common
    g, owners, places = g[keep], owners[keep], places[keep]
    distinct, first = np.unique(g, return_index=True)
    bits = min(_TEST_BITS[-1], max(_TEST_BITS[0], len(distinct).bit_length() + 5))
    test = np.zeros(1 << bits, dtype=bool)
    test[(distinct >> np.uint64(64 - bits)).astype(np.int64)] = True
    return Passages(
        ids, words, distinct, np.append(first, len(g)), owners, places,
        wanted, np.array([len(x) for x in pieces_], dtype=np.int64), test, q,
    )


def prepare(ids: list[int], texts: list[str], run: int, share: float) -> list[Passages]:
    """Indexes passages of at least ``run`` words, those with one q-gram length together.

    A q-gram is no longer than the shortest ``run`` words in a row of its
    passage, so every run holds one. The least count of a passage is what its
    covered part must share: runs that cover more than ``share`` of the words,
    each losing q - 1 characters at its end.
    """
    folded, at = fold(texts)
    words = [_words(folded[a:b]) for a, b in zip(at, at[1:])]
    by_q: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= run:
            longest = min(sum(map(len, w[j : j + run])) + run - 1 for j in range(len(w) - run + 1))
            by_q.setdefault(max((q for q in _LADDER if q <= longest), default=run), []).append(i)
    out = []
    for q, kept in sorted(by_q.items()):
        least = []
        for i in kept:
            need = int(len(words[i]) * share) + 1
            # the fewest q-grams over all ways to cover so many words by runs: the runs' own counts are at least those of the cheapest window of as many words
            sizes = np.array([len(w) + 1 for w in words[i]])
            runs = max(1, need // run)
            cheapest = int(np.sort(sizes)[:need].sum()) - runs - runs * (q - 1)
            least.append(max(1, min(runs, need // run), cheapest))
        out.append(_index([ids[i] for i in kept], [words[i] for i in kept], [folded[at[i] : at[i + 1]] for i in kept], least, q))
    return out


def covered_words(passage: list[str], region: list[str], run: int, stretch: float) -> int:
    """Most words of the passage that stand in the region in unbroken runs of ``run`` words or more.

    Runs follow each other in the passage's order, and lie within ``stretch``
    times as many words as the passage has.
    """
    at: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(passage) - run + 1):
        at.setdefault(tuple(passage[i : i + run]), []).append(i)
    runs, seen = [], set()
    for j in range(len(region) - run + 1):
        for i in at.get(tuple(region[j : j + run]), ()):
            if (i, j) in seen:
                continue
            n = run
            while i + n < len(passage) and j + n < len(region) and passage[i + n] == region[j + n]:
                n += 1
            seen.update((i + d, j + d) for d in range(n - run + 1))
            runs.append((i, j, n))
    best, width = 0, int(len(passage) * stretch)
    for low in {j for _, j, _ in runs} | {max(0, j + n - width) for _, j, n in runs}:
        high = low + width
        inside = []
        for i, j, n in runs:
            cut = max(0, low - j)
            n = min(n - cut, high - (j + cut))
            if n >= run:
                inside.append((i + cut, j + cut, n))
        inside.sort()
        total: list[int] = []
        for x, (i, j, n) in enumerate(inside):
            most = n
            for y in range(x):
                pi, pj, pn = inside[y]
                # a run that overlaps the one before begins behind it
                lost = max(0, pi + pn - i, pj + pn - j)
                if n - lost >= run:
                    most = max(most, total[y] + n - lost)
            total.append(most)
        best = max([best, *total])
    return best


def _regions(folded: np.ndarray, at: np.ndarray, p: Passages, width: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """``text, passage, first place, last place`` of the q-grams of every band of diagonals that shares enough; ``width`` of a band by passage.

    Each band overlaps the next by half.
    """
    hashes = rolling(folded, p.q)
    if not len(hashes) or not len(p.grams):
        return
    bits = len(p.test).bit_length() - 1
    maybe = np.flatnonzero(p.test[(hashes >> np.uint64(64 - bits)).astype(np.int64)])
    where = np.searchsorted(p.grams, hashes[maybe])
    where[where == len(p.grams)] = 0
    hit = p.grams[where] == hashes[maybe]
    maybe, where = maybe[hit], where[hit]
    text = np.searchsorted(at, maybe, side="right") - 1
    inside = maybe + p.q <= at[text + 1]
    maybe, where, text = maybe[inside], where[inside], text[inside]
    # every place of the q-gram in the passages
    n = p.first[where + 1] - p.first[where]
    entry = np.repeat(p.first[where], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    owner = p.owner[entry]
    # a passage with too few q-grams in the whole text has too few in any band
    pair = np.repeat(text, n) * len(p.least) + owner
    some = np.flatnonzero(np.bincount(pair)[pair] >= p.least[owner]) if len(pair) else pair
    if not len(some):
        return
    text, pos, owner, place = np.repeat(text, n)[some], np.repeat(maybe, n)[some], owner[some], p.place[entry[some]]
    diagonal = pos - at[text] - place + p.chars[owner]
    band = diagonal * 2 // width[owner]
    # a q-gram of the passage counts once in a band, wherever it stands
    key = np.stack([np.concatenate([text, text]), np.concatenate([owner, owner]), np.concatenate([band, band - 1]), np.concatenate([place, place])])
    order = np.lexsort(key[::-1])
    key = key[:, order]
    spot = np.concatenate([pos, pos])[order]
    new = np.ones(key.shape[1], dtype=bool)
    new[1:] = (key[:3, 1:] != key[:3, :-1]).any(0)
    once = new.copy()
    once[1:] |= key[3, 1:] != key[3, :-1]
    start = np.flatnonzero(new)
    count = np.add.reduceat(once.astype(np.int64), start)
    low, high = np.minimum.reduceat(spot, start), np.maximum.reduceat(spot, start)
    keep = count >= p.least[key[1, start]]
    yield from zip(key[0, start][keep].tolist(), key[1, start][keep].tolist(), low[keep].tolist(), high[keep].tolist())


def _find(folded: np.ndarray, at: np.ndarray, p: Passages, run: int, share: float, stretch: float) -> list[tuple[int, int, float]]:
    """``text, passage, covered share`` of every leak in folded texts, by index."""
    best: dict[tuple[int, int], float] = {}
    # bands of diagonals twice as wide as the stretch lets a quotation drift, as words differ in length
    width = (p.chars * max(0.5, stretch - 1) * 4).astype(np.int64) + 1
    for t, o, a, b in _regions(folded, at, p, width):
        words = p.words[o]
        if best.get((t, o), 0) * len(words) == len(words):
            continue
        # whole words around the band's q-grams
        margin = int(p.chars[o])
        a, b = max(int(at[t]), a - margin), min(int(at[t + 1]), b + p.q + margin)
        while a > at[t] and folded[a - 1]:
            a -= 1
        while b < at[t + 1] and folded[b - 1]:
            b += 1
        covered = covered_words(words, _words(folded[a:b]), run, stretch)
        if covered > share * len(words):
            best[t, o] = max(best.get((t, o), 0), covered / len(words))
    return [(t, o, c) for (t, o), c in best.items()]


def _blocks(passages: DataFrame, key: str, text: str, most: int) -> Iterator[tuple[list[int], list[str]]]:
    """Keys and texts of the passages that have both, in blocks of about ``most`` characters."""
    items = passages.select(passages[key].cast("long").alias("id"), passages[text].cast("string").alias("text")).where("id is not null and text is not null")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    many = -(-int(size) // most)
    for block in range(many):
        own = items if many == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(many)) == block)
        rows = own.collect()
        if rows:
            yield [r.id for r in rows], [r.text for r in rows]


def _each_text(documents: DataFrame, key: str, text: str, prepared: list, find, columns: str) -> DataFrame:
    """The findings of every block of passages in every document that has a key and a text."""
    spark = documents.sparkSession
    wanted = documents.select(documents[key].cast("long").alias("doc_id"), documents[text].cast("string").alias("text")).where("text is not null and doc_id is not null and text <> ''")
    names = ["item_id", *[c.split(" ")[0] for c in columns.split(", ")]]
    out = None
    for block in prepared:
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own, docs = batch["text"].tolist(), batch["doc_id"].to_numpy()
                for a, b in pieces([len(t) for t in own], _AT_ONCE):
                    folded, at = fold(own[a:b])
                    found = [x for p in sent.value for x in find(folded, at, p)]
                    if found:
                        t, *rest = zip(*found)
                        yield pd.DataFrame({"doc_id": docs[a:b][list(t)]} | dict(zip(names, rest)))

        part = wanted.mapInPandas(run, f"doc_id long, item_id long, {columns}")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], f"doc_id long, item_id long, {columns}")


def find_leaks(documents: DataFrame, key: str, text: str, passages: DataFrame, passage_key: str, passage_text: str, run: int = 8, share: float = 0.5, stretch: float = 1.5, most_passage_chars: int = MOST_PASSAGE_CHARS) -> DataFrame:
    """``doc_id, item_id, covered`` for each document and passage it gives away.

    A passage is given away if more than ``share`` of its words stand in the
    document in runs of at least ``run`` words, in order, within ``stretch``
    times its number of words; case, accents, spacing and punctuation do not
    count. ``covered`` is the largest such share of its words.

    Passages of fewer than ``run`` words, null or empty ones cannot be given
    away. Null and empty documents give no row, repeated rows give their own
    rows, and other columns are not read. Passages of more than
    ``most_passage_chars`` characters go to the tasks in blocks of that size, and the documents are read once for each.
    """
    prepared = (prepare(ids, texts, run, share) for ids, texts in _blocks(passages, passage_key, passage_text, most_passage_chars))

    def find(folded: np.ndarray, at: np.ndarray, p: Passages) -> list[tuple]:
        return [(t, p.ids[o], c) for t, o, c in _find(folded, at, p, run, share, stretch)]

    return _each_text(documents, key, text, prepared, find, "covered double")


def edit_distance_within(part: np.ndarray, region: np.ndarray, budget: int) -> int | None:
    """Least edits that turn the part into some stretch of the region, or None if over ``budget``; a stretch may begin anywhere.

    Row by row over the part, in the band of diagonals that the region's
    length and the budget leave.
    """
    m, n = len(part), len(region)
    slack = max(0, n - m) + budget  # a stretch begins at most so far from the region's start
    best = np.arange(-budget, slack + 1)  # diagonal = place in the region less place in the part
    row = np.where((best >= 0) & (best <= n), 0, budget + 1)
    step = np.arange(len(best))
    for i in range(m):
        at = best + i
        inside = (at >= 0) & (at < n)
        same = np.zeros(len(best), dtype=bool)
        same[inside] = region[at[inside]] == part[i]
        new = np.where(inside, row + ~same, budget + 1)  # kept or changed
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # left out of the part
        new = np.minimum.accumulate(new - step) + step  # put in
        new[(at + 1 < 0) | (at + 1 > n)] = budget + 1
        row = np.minimum(new, budget + 1)
        if row.min() > budget:
            return None
    return int(row.min()) if row.min() <= budget else None


@dataclass
class Parts:
    """Parts of passages: their index, characters, edits allowed, and passage and place each is of."""

    index: Passages
    chars: list[np.ndarray]
    budget: np.ndarray
    start: list[int]
    total: dict[int, int]


def prepare_parts(ids: list[int], texts: list[str], part: int, edits: float) -> list[Parts]:
    """Cuts passages into parts of ``part`` characters that overlap by half, indexed by q-grams that so many edits leave enough of."""
    folded, at = fold(texts)
    groups: dict[int, tuple[list, list, list, list, list]] = {}
    total: dict[int, int] = {}
    for n, (a, b) in enumerate(zip(at, at[1:])):
        size = int(b - a) - 1  # without the end
        if size < 1:
            continue
        total[ids[n]] = size
        starts = [0] if size <= part else [*range(0, size - part, part // 2), size - part]
        for s in starts:
            own = folded[a + s : a + min(size, s + part)]
            k = int(len(own) * edits)
            # k edits spoil k * q of the q-grams at the most: nine tenths may be spoilt
            q = max(1, int(0.9 * (len(own) + 1) / (k + 1)))
            q = min(q, 24)
            least = len(own) + 1 - q - k * q
            if least > 0:
                for x, v in zip(groups.setdefault(q, ([], [], [], [], [])), (ids[n], own, least, k, s)):
                    x.append(v)
    return [Parts(_index(i, [[]] * len(i), own, least, q), own, np.array(k), s, total) for q, (i, own, least, k, s) in sorted(groups.items())]


def _find_parts(folded: np.ndarray, at: np.ndarray, p: Parts) -> list[tuple[int, int, int, int]]:
    """``text, item, start, stop`` of the parts of passages that stand in texts within their edits."""
    found: set[tuple[int, int]] = set()
    out = []
    for t, o, a, b in _regions(folded, at, p.index, 4 * p.budget + 2):
        if (t, o) in found:
            continue
        k, own = int(p.budget[o]), p.chars[o]
        low, high = max(int(at[t]), b - len(own) - k), min(int(at[t + 1]) - 1, a + len(own) + k + p.index.q)
        region = folded[min(low, a) : max(high, b + p.index.q)]
        # with the common q-grams too, as many of the part's must stand in the region
        q = p.index.q
        if np.isin(rolling(own, q), rolling(region, q)).sum() < len(own) + 1 - q - k * q:
            continue
        if edit_distance_within(own, region, k) is not None:
            found.add((t, o))
            out.append((t, p.index.ids[o], p.start[o], p.start[o] + len(own)))
    return out


def find_edited(documents: DataFrame, key: str, text: str, passages: DataFrame, passage_key: str, passage_text: str, part: int = 240, edits: float = 0.05, most_passage_chars: int = MOST_PASSAGE_CHARS) -> DataFrame:
    """``doc_id, item_id, covered`` for each document and passage of which a part stands in it within an edit distance.

    A passage is cut into parts of ``part`` characters that overlap by half (a
    shorter one is one part); case, accents and punctuation do not count. A part is held if
    it can be turned into a stretch of the document by changing, leaving out or
    putting in at most ``edits`` of its characters; the more edits, the shorter
    the q-grams and the more candidates. ``covered`` is the share of the passage that held parts make up.

    Null and empty texts give no row, repeated rows give their own rows (but equal document keys count as one document), and other columns are not read.
    """
    prepared = (prepare_parts(ids, texts, part, edits) for ids, texts in _blocks(passages, passage_key, passage_text, most_passage_chars))

    def find(folded: np.ndarray, at: np.ndarray, p: Parts) -> list[tuple]:
        return [(t, item, start, stop, p.total[item]) for t, item, start, stop in _find_parts(folded, at, p)]

    held = _each_text(documents, key, text, prepared, find, "start long, stop long, total long")
    # a passage has as many parts as its length makes
    lists = held.groupBy("doc_id", "item_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("s"), F.max("total").alias("total"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    merged = F.aggregate("s", zero, lambda z, x: F.struct((z["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], z["upto"]))).alias("n"), F.greatest(z["upto"], x["stop"]).alias("upto")))
    return lists.select("doc_id", "item_id", (merged["n"] / F.col("total")).alias("covered"))
