"""Same or near-same records across splits, by content-defined chunks.

Records are normalised to words, and a rolling hash runs over windows of up to
five words. A training text is cut into chunks at places its content defines:
where the hashes of the windows are rarest among the held-out texts, as counted
in a table of bounded size. A held-out text offers the window at every place,
so a chunk is met wherever it has moved to. Chunk digests are joined across the
splits and the lengths of the chunks that two texts share are summed.

How much they must share follows from the number of words that may differ. One
changed word spoils one chunk at the most, as chunks do not overlap: of ``n``
chunks all but as many survive as words may differ, and one chunk more than
that is always cut. So no pair within the budget is lost. (Cutting both sides
where the hash falls on zero lost a third of the pairs of twenty words that
differ in a tenth, as one change spoils up to three such chunks.)

An alignment of the words decides on what is left, and the overlap fraction
that is reported is the length of all chunks, cut at hash zero, that both texts
have, over the longer text.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bloom, passes
from .codes import mix, run_hashes
from .common import sent_if_few, within, without, written

#: Mean chunk length in words.
CUT_EVERY = 3
#: Most words of a run; short texts have shorter ones.
RUN = 5
#: Chunks cut beyond the least number, where a text is long enough: so many more must be shared.
SPARE = 0
#: Bits of the number of counters of runs, of a byte each: about as many as there are runs, from 64 KB to 2 MB.
COUNTER_BITS = range(16, 22)
#: A run in about so many held-out texts, by its counter, is joined within bands of text length only.
HOT = 1_000
#: Counters travel in blocks of so many, and blocks of tasks with the same number modulo 1,024 are summed first.
BLOCK = 1 << 16
#: Runs are chosen within pieces of up to so many words.
PIECE = 128
#: More than any count in the choice of runs.
_NEVER = 1 << 28

_name = lambda words: hashlib.blake2b(words.encode(), digest_size=16).digest()
_gap = re.compile(r"[\W_]+")
_field = re.compile(r"^[^\w\n]*\w+(?:[ \t]+\w+){0,3}[ \t]*[:=]", re.M)


def _spaced(text: str) -> str:
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return _gap.sub(" ", text.lower()).strip()


def _fields_in_order(text: str) -> str:
    """Words of a text, the fields of a JSON object or of ``field: value`` lines sorted."""
    if text.lstrip().startswith("{"):
        try:
            found = json.loads(text)
        except ValueError:
            found = None
        if isinstance(found, dict) and len(found) > 1:
            return " ".join(sorted(_spaced(f"{k} {v}") for k, v in found.items()))
    elif "\n" in text:
        starts = [m.start() for m in _field.finditer(text)]
        if len(starts) > 1 and not text[: starts[0]].strip():
            return " ".join(sorted(_spaced(text[a:b]) for a, b in zip(starts, [*starts[1:], len(text)])))
    return _spaced(text)


def _spaced_column(column: pa.Array) -> pa.Array:
    """``_spaced`` of every text of a column at once; null as null."""
    texts = column.to_pylist()
    odd = {i: unicodedata.normalize("NFC", t) for i, t in enumerate(texts) if t and not t.isascii() and not unicodedata.is_normalized("NFC", t)}
    if odd:
        column = pa.array([odd.get(i, t) for i, t in enumerate(texts)], pa.string())
    return pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(column), pattern=r"[^\pL\pN]+", replacement=" "), characters=" ")


def words_of_records(plain: list[pa.Array], fielded: list[pa.Array]) -> pa.Array:
    """All words of each record with single spaces: lower case, no punctuation, null as empty, fields in order."""
    columns = [_spaced_column(c.cast(pa.string())) for c in plain]
    for c in fielded:
        texts = c.to_pylist()
        own = _spaced_column(c.cast(pa.string()))
        some = [i for i, t in enumerate(texts) if t and ("\n" in t or t.lstrip().startswith("{"))]
        if some:
            mask = np.zeros(len(texts), dtype=bool)
            mask[some] = True
            own = pc.replace_with_mask(own, pa.array(mask), pa.array([_fields_in_order(texts[i]) for i in some], pa.string()))
        columns.append(own)
    whole, *rest = [pc.fill_null(c, "") for c in columns]
    for c in rest:
        between = pc.if_else(pc.or_(pc.equal(whole, ""), pc.equal(c, "")), "", " ")
        whole = pc.binary_join_element_wise(whole, between, c, "")
    return whole


def record_words(plain: list[str | None], fielded: list[str | None]) -> str:
    """``words_of_records`` of one record."""
    return words_of_records([pa.array([x], pa.string()) for x in plain], [pa.array([x], pa.string()) for x in fielded])[0].as_py()


class _Hashes(dict):
    """Word -> 64-bit hash, worked out when first asked for."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _hashed(texts: list[str] | pa.Array, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of word-normalised texts, and where each text starts and how many words it has."""
    words = pc.split_pattern(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), pattern=" ")
    size = words.value_lengths().to_numpy().astype(np.int64)
    coded = words.flatten().dictionary_encode()
    known = np.fromiter(map(hashes.__getitem__, coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    return known[coded.indices.to_numpy()], np.cumsum(size) - size, size


def _parities(h: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For 128 buckets of words, whether a text has an odd number in each.

    Parities differ in at most as many bits as one must remove and add words to turn one text into the other.
    """
    one = np.uint64(1) << (h & np.uint64(63))
    high = (h >> np.uint64(6)) & np.uint64(1) == 1
    return np.stack([np.bitwise_xor.reduceat(np.where(high, np.uint64(0), one), start), np.bitwise_xor.reduceat(np.where(high, one, np.uint64(0)), start)], axis=1)


def cut(h: np.ndarray, start: np.ndarray, size: np.ndarray, every: int = CUT_EVERY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content-defined chunks of texts as hashes of words: ``text, digest, words`` of each distinct chunk of a text.

    A chunk ends after each word at which the rolling hash of it and the word
    before falls on zero.
    """
    before = np.zeros_like(h)
    before[1:] = h[:-1]
    before[start] = 0
    ends = mix(before * np.uint64(31) + h) % np.uint64(every) == 0
    ends[start + size - 1] = True
    stop = np.flatnonzero(ends) + 1
    first = np.concatenate([[0], stop[:-1]])
    digest_ = run_hashes(h, first, stop)
    text = np.searchsorted(start, first, side="right") - 1
    order = np.lexsort((digest_, text))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (digest_[order][1:] != digest_[order][:-1]) | (text[order][1:] != text[order][:-1])
    order = order[new]
    return text[order], digest_[order], (stop - first)[order]


def _most_changed(words: np.ndarray, differing: float) -> np.ndarray:
    """How many words may differ from texts of so many words: the longest text near enough has at most ``words / (1 - differing)``."""
    return (np.floor(words / (1 - differing) + 1e-9) * differing + 1e-9).astype(np.int64)


def _runs_needed(words: np.ndarray, differing: float) -> tuple[np.ndarray, np.ndarray]:
    """For training texts of so many words: the words of a run (0: the whole text), and how many runs to cut, one more than changes can spoil and ``SPARE`` more where they fit."""
    most = _most_changed(words, differing)
    width = np.where(most > 0, np.minimum(RUN, words // (most + 1)), 0)
    # pieces of a long text may each leave a rest of less than a run
    room = np.where(width > 0, words // np.maximum(width, 1) - -(-words // PIECE) - most - 1, 0)
    return width, most + 1 + np.clip(room, 0, SPARE)


def _bands(words: np.ndarray, differing: float) -> np.ndarray:
    """Bands of text length: texts near enough are in the same or in neighbouring ones."""
    return np.floor(np.log(words) / -np.log(1 - differing) + 1e-9).astype(np.int32) if differing else words.astype(np.int32)


def _squeezed(n: np.ndarray) -> np.ndarray:
    """Counts in a byte: up to 127 as they are, above by steps of an eighth of a power of two; zero only for zero."""
    return np.where(n < 128, n, np.minimum(255, 128 + 8 * (np.log2(np.maximum(n, 1)) - 7))).astype(np.uint8)


def _spread_out(b: np.ndarray) -> np.ndarray:
    """About the counts that ``_squeezed`` was given."""
    x = b.astype(np.float64)
    return np.where(x < 128, x, np.exp2((x - 128) / 8 + 7)).astype(np.int64)


def _runs(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the run of ``width`` words from each word on, also across the ends of texts."""
    found = h ^ np.uint64(width * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for k in range(1, width):
        after = np.zeros_like(h)
        after[:-k] = h[k:]
        found = mix(found * np.uint64(31) + after)
    return found


def held_runs(h: np.ndarray, start: np.ndarray, size: np.ndarray, differing: float) -> tuple[np.ndarray, np.ndarray]:
    """``text, run`` of every run that a training text near a text may have chosen."""
    at = np.arange(int(size.max() / (1 - differing)) + 3)
    widths = _runs_needed(at, differing)[0]
    least, most = size - (size * differing + 1e-9).astype(np.int64), (size / (1 - differing) + 1e-9).astype(np.int64)
    text = np.repeat(np.arange(len(size)), size)
    left = np.repeat(start + size, size) - np.arange(len(h))
    rows, found = [], []
    for width in range(RUN + 1):
        there = np.concatenate([[0], np.cumsum(widths == width)])
        wanted = there[most + 1] > there[least]
        if not wanted.any():
            continue
        if width:
            ok = (left >= width) & wanted[text]
            rows.append(text[ok])
            found.append(_runs(h, width)[ok])
        else:
            rows.append(np.flatnonzero(wanted))
            found.append(run_hashes(h, start, start + size)[wanted])
    return np.concatenate(rows), np.concatenate(found)


def _fewest(cost: np.ndarray, first: np.ndarray, size: np.ndarray, need: np.ndarray, width: int) -> np.ndarray:
    """Starts of ``need`` runs of each piece that do not overlap and whose costs have the least sum."""
    chosen = []
    order = np.argsort(size, kind="stable")
    for some in np.array_split(order, max(1, len(order) // 512)):
        n, f, many = size[some], first[some], need[some]
        longest = int(n.max())
        at = np.arange(longest - width + 1)[:, None]
        here = np.where(at <= n - width, cost[np.minimum(f + at, len(cost) - 1)], np.int32(_NEVER))
        best = np.zeros((longest + 1, len(some)), dtype=np.int32)
        steps = []
        for _ in range(int(many.max())):
            ending = np.full_like(best, _NEVER)
            np.minimum(best[: longest - width + 1] + here, _NEVER, out=ending[width:])
            best = ending.copy()
            for i in range(1, longest + 1):  # a loop over long rows takes a fifth of the time of accumulate
                np.minimum(best[i - 1], best[i], out=best[i])
            steps.append((ending, best))
        end = n.copy()
        for j in range(len(steps) - 1, -1, -1):
            on = np.flatnonzero(many > j)
            ending, best = steps[j]
            # the first place at which the least sum up to the end is reached
            reached = (ending[:, on] == best[end[on], on]).argmax(axis=0)
            end[on] = reached - width
            chosen.append(f[on] + end[on])
    return np.concatenate(chosen)


def train_runs(h: np.ndarray, start: np.ndarray, size: np.ndarray, counts: np.ndarray, differing: float) -> tuple[np.ndarray, np.ndarray]:
    """``text, run`` of the runs chosen for each text, sorted by text; a run a text has twice counts once."""
    widths, needs = _runs_needed(size, differing)
    rows, found = [], []
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        if not width:
            rows.append(which)
            found.append(run_hashes(h, start[which], start[which] + size[which]))
            continue
        # long texts in pieces, each with its share of the runs
        parts = -(-size[which] // PIECE)
        text = np.repeat(which, parts)
        k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        of = np.repeat(parts, parts)
        low, high = size[text] * k // of, size[text] * (k + 1) // of
        # shares by length, rounded down alike
        need = needs[text] * high // size[text] - needs[text] * low // size[text]
        runs = _runs(h, int(width))
        cost = np.minimum(counts[(runs % np.uint64(len(counts))).astype(np.int64)], 1 << 20).astype(np.int32)
        starts = _fewest(cost, start[text] + low, high - low, need, int(width))
        rows.append(np.searchsorted(start, starts, side="right") - 1)
        found.append(runs[starts])
    return _each_once(np.concatenate(rows), np.concatenate(found))


def _each_once(row: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every run of a row once, sorted by row."""
    order = np.lexsort((run, row))
    row, run = row[order], run[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (run[1:] != run[:-1])
    return row[new], run[new]


def words_differing(a: str | list, b: str | list, limit: float) -> float:
    """Share of the longer text's words that an alignment of both must change, or 1.0 if above ``limit``.

    Edit distance over words by furthest-reaching diagonals, which takes time
    in proportion to the texts and the square of the distance. Texts may also
    be lists of words, or of what stands for them.
    """
    x, y = (t.split(" ") if isinstance(t, str) else t for t in (a, b))
    longest = max(len(x), len(y))
    most = int(limit * longest)
    if abs(len(x) - len(y)) > most or longest - sum((Counter(x) & Counter(y)).values()) > most:
        return 1.0
    goal = len(x) - len(y)
    reach: dict[int, int] = {}
    for d in range(most + 1):
        now: dict[int, int] = {}
        for k in range(-d, d + 1):
            i = 0 if d == 0 else max(reach.get(k, -2) + 1, reach.get(k - 1, -2) + 1, reach.get(k + 1, -2))
            i = min(i, len(x))
            j = i - k
            if i < 0 or j < 0 or j > len(y):
                continue
            while i < len(x) and j < len(y) and x[i] == y[j]:
                i, j = i + 1, j + 1
            now[k] = i
        if now.get(goal, -1) >= len(x):
            return d / longest
        reach = now
    return 1.0


def cross_split_overlaps(
    df: DataFrame, key: str, split: str, plain: list[str], fielded: list[str], train: tuple[str, ...] = ("train",), held_out: tuple[str, ...] = ("validation", "test"), differing: float = 0.12
) -> tuple[DataFrame, DataFrame]:
    """Pairs of distinct texts across splits, and the records that hold each text.

    The pairs have ``train_text, held_text`` (16-byte digests of the word
    sequence), ``overlap_fraction`` (shared chunk length over the longer text)
    and ``differing_words`` (share of words an alignment changes); kept are
    those with at most ``differing``, which must be under a half. The members have ``text, side, key`` for
    every record: copies stay one text until a caller wants the pairs spelled out.

    Rows with a null key, a split outside both lists (also null), or no word at
    all take no part. Equal rows are members of one text. A text equal on both
    sides pairs with itself. Keys must be unique.
    """
    if not 0 <= differing < 0.5:
        raise ValueError("differing must be from 0 to under 0.5")
    spark = df.sparkSession
    side = F.when(F.col(split).isin(*train), 0).when(F.col(split).isin(*held_out), 1)
    names = [f"c{i}" for i in range(len(plain) + len(fielded))]
    rows = df.select(F.col(key).cast("long").alias("key"), side.alias("side"), *[F.col(c).cast("string").alias(n) for c, n in zip(plain + fielded, names)]).where("side is not null and key is not null")

    def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            words = words_of_records([b.column(n) for n in names[: len(plain)]], [b.column(n) for n in names[len(plain) :]])
            some = pa.array(np.flatnonzero(pc.not_equal(words, "").to_numpy(zero_copy_only=False)))
            if not len(some):
                continue
            words = words.take(some)
            h, start, size = _hashed(words, hashes)
            parity = _parities(h, start)
            own = b.select(["key", "side"]).take(some)
            p0, p1 = (pa.array(np.ascontiguousarray(parity[:, i]).view(np.int64)) for i in (0, 1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(h)).astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array([_name(w) for w in words.to_pylist()], pa.binary()), pa.array(size.astype(np.int32)), p0, p1, lists], names=["key", "side", "text", "words", "p0", "p1", "hashes"])

    table = written(rows.mapInArrow(word_rows, "key long, side int, text binary, words int, p0 long, p1 long, hashes array<long>"))
    members = table.select("text", "side", "key")
    # copies stand back behind the first of their text
    twins = written(members.groupBy("text", "side").agg(F.min("key").alias("id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    later = written(members.join(sent_if_few(twins), ["text", "side"]).where("key <> id").select("key"))
    texts = without(table, later, "key").withColumnRenamed("key", "id")
    own = ["id", "words", "p0", "p1"]
    trained, held = (texts.where(F.col("side") == n).select(*own, "hashes") for n in (0, 1))

    def hashes_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = b.column("words").to_numpy().astype(np.int64)
        return b.column("hashes").flatten().to_numpy().view(np.uint64), np.cumsum(size) - size, size

    sent = spark.sparkContext.broadcast(_count_runs(held, hashes_of, differing))

    least_hot = _squeezed(np.array([HOT]))[0]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _spread_out(sent.value)
        for b in batches:
            if b.num_rows:
                h, start, size = hashes_of(b)
                row, run = train_runs(h, start, size, counts, differing)
                # so many of its chunks a text near enough must have; those that no held-out text has cannot be among them
                least = np.maximum(1, np.bincount(row, minlength=b.num_rows) - _most_changed(size, differing))
                there = sent.value[(run % np.uint64(len(counts))).astype(np.int64)] > 0
                there &= (np.bincount(row[there], minlength=b.num_rows) >= least)[row]
                row, run = row[there], run[there]
                held_by = np.unique(row)
                ends = np.append(np.searchsorted(row, held_by), len(row)).astype(np.int32)
                hot = sent.value[(run % np.uint64(len(counts))).astype(np.int64)] >= least_hot
                bands = np.where(hot, _bands(size, differing)[row], -1).astype(np.int32)
                columns = b.select(own).take(pa.array(held_by)).columns
                yield pa.RecordBatch.from_arrays([*columns, pa.array(least[held_by].astype(np.int32)), *(pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (run.view(np.int64), bands))], names=[*[f"{c}0" for c in own], "least", "runs", "bands"])

    chosen = written(trained.mapInArrow(choose, "id0 long, words0 int, p00 long, p10 long, least int, runs array<long>, bands array<int>"))
    known = spark.sparkContext.broadcast(bloom(chosen.select(F.explode("runs").alias("value")), bits=8))

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                row, run = held_runs(*hashes_of(b), differing)
                ok = passes(known.value, run)
                # a window that a text has twice counts once
                row, run = _each_once(row[ok], run[ok])
                # texts of any length meet in most runs, those near enough in length in hot ones
                hot = np.flatnonzero(sent.value[(run % np.uint64(len(sent.value))).astype(np.int64)] >= least_hot)
                band = np.full(len(run), -1, dtype=np.int32)
                band[hot] = _bands(b.column("words").to_numpy(), differing)[row[hot]]
                row, run, band = (np.concatenate(x) for x in ((row, row[hot], row[hot]), (run, run[hot], run[hot]), (band, band[hot] - 1, band[hot] + 1)))
                yield pa.RecordBatch.from_arrays([*b.select(own).take(pa.array(row)).columns, pa.array(run.view(np.int64)), pa.array(band)], names=[*[f"{c}1" for c in own], "run", "band"])

    offered = held.mapInArrow(offer, "id1 long, words1 int, p01 long, p11 long, run long, band int")
    # what must hold of two texts that differ in so few words
    most = F.greatest("words0", "words1") * differing
    odd = F.bit_count(F.col("p00").bitwiseXOR(F.col("p01"))) + F.bit_count(F.col("p10").bitwiseXOR(F.col("p11")))
    near = (F.abs(F.col("words0") - F.col("words1")) <= most) & (odd <= most * 2)
    met = chosen.select("id0", "words0", "p00", "p10", "least", F.explode(F.arrays_zip("runs", "bands")).alias("r")).select("id0", "words0", "p00", "p10", "least", F.col("r.runs").alias("run"), F.col("r.bands").alias("band")).join(offered, ["run", "band"]).where(near)
    # chunks of a text have one length, so their number stands for the sum of it
    pairs = written(met.groupBy("id0", "id1").agg(F.count("*").alias("n"), F.first("least").alias("least")).where("n >= least").select("id0", "id1"))
    wanted = written(pairs.select(F.col("id0").alias("id")).unionByName(pairs.select(F.col("id1").alias("id"))).distinct())
    few = within(texts.select("id", "side", "text", "hashes"), wanted, "id")
    left, right = (few.where(F.col("side") == s).select(F.col("id").alias(f"id{s}"), F.col("text").alias(f"text{s}"), F.col("hashes").alias(f"h{s}")) for s in (0, 1))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [b.column(f"h{s}") for s in (0, 1)]
            share = np.array([words_differing(x, y, differing) for x, y in zip(lists[0].to_pylist(), lists[1].to_pylist())])
            good = pa.array(np.flatnonzero(share <= differing))
            if len(good):
                kept = [x.take(good) for x in lists]
                shared = overlap_fractions(*[(x.flatten().to_numpy().view(np.uint64), x.value_lengths().to_numpy().astype(np.int64)) for x in kept])
                yield pa.RecordBatch.from_arrays([*[b.column(f"text{s}").take(good) for s in (0, 1)], pa.array(shared), pa.array(share[share <= differing])], names=["train_text", "held_text", "overlap_fraction", "differing_words"])

    both = left.join(sent_if_few(pairs), "id0").join(right, "id1").select("text0", "text1", "h0", "h1")
    found = both.mapInArrow(compare, "train_text binary, held_text binary, overlap_fraction double, differing_words double")
    return written(found), members


def _count_runs(held: DataFrame, hashes_of: Callable, differing: float) -> np.ndarray:
    """Squeezed counters of the runs of held-out texts, by hash; as many as there are words, within bounds.

    A task counts whole tables and sends them in blocks that are summed in two
    steps, so no task gathers the blocks of all others. A counter is zero only if no run fell on it.
    """
    words = held.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("n")).first()["n"]
    bits = min(COUNTER_BITS[-1], max(COUNTER_BITS[0], int(words).bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                run = held_runs(*hashes_of(b), differing)[1]
                at, n = np.unique(run % np.uint64(1 << bits), return_counts=True)
                total[at.astype(np.int64)] += n
        blocks = _squeezed(total).reshape(-1, BLOCK)
        some = np.flatnonzero(blocks.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([blocks[i].tobytes() for i in some], pa.binary())], names=["block", "counts"])

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(_spread_out(np.frombuffer(c, dtype=np.uint8)) for c in frame["counts"])
        return pd.DataFrame({"block": frame["block"].iloc[:1], "salt": -1, "counts": [_squeezed(total).tobytes()]})

    schema = "block long, salt int, counts binary"
    parts = held.select("words", "hashes").mapInArrow(count, "block long, counts binary").withColumn("salt", F.spark_partition_id() % 1024)
    whole = parts.groupBy("block", "salt").applyInPandas(summed, schema).groupBy("block").applyInPandas(summed, schema)
    out = np.zeros((1 << bits - BLOCK.bit_length() + 1, BLOCK), dtype=np.uint8)
    for r in whole.select("block", "counts").collect():  # at most 2 MB
        out[r.block] = np.frombuffer(r.counts, dtype=np.uint8)
    return out.ravel()


def overlap_fractions(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Words in chunks that both texts of each pair have, over the longer text; texts come as hashes of words, one after the other, and numbers of words."""
    n = len(a[1])
    size = np.concatenate([a[1], b[1]])
    text, chunk, length = cut(np.concatenate([a[0], b[0]]), np.cumsum(size) - size, size)
    pair = text % n
    order = np.lexsort((chunk, pair))
    p, c, w = pair[order], chunk[order], length[order]
    twice = np.flatnonzero((p[1:] == p[:-1]) & (c[1:] == c[:-1]))
    total = np.bincount(text, weights=length, minlength=2 * n)
    return np.bincount(p[twice], weights=w[twice], minlength=n) / np.maximum(total[:n], total[n:])


def spelled_out(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Every pair of records whose texts pair: ``train_key, held_key`` with the measures of the pair."""
    a = members.where("side = 0").select(F.col("text").alias("train_text"), F.col("key").alias("train_key"))
    b = members.where("side = 1").select(F.col("text").alias("held_text"), F.col("key").alias("held_key"))
    few = sent_if_few(pairs)
    trained = a.join(few, "train_text")
    # the members of one side of the pairs are found without moving those of the other
    held = sent_if_few(b.join(F.broadcast(few.select("held_text").distinct()) if few is not pairs else pairs.select("held_text").distinct(), "held_text", "left_semi"))
    return trained.join(held, "held_text").select("train_key", "held_key", "overlap_fraction", "differing_words")


def class_pairs(pairs: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same overlaps with every text standing once: pairs of classes, and membership.

    The pairs are ``train_first, held_first, train_copies, held_copies`` with
    the measures; a class is named by the smallest key of its text on that
    side. The members are ``side`` (0 train, 1 held out), ``first_key, key`` of the classes in
    a pair. Nothing is spelled out, so a text with many copies costs no more than its rows.
    """
    classes = members.groupBy("text", "side").agg(F.min("key").alias("first_key"), F.count("*").alias("copies"))
    part = lambda n, name: classes.where(F.col("side") == n).select(F.col("text").alias(f"{name}_text"), F.col("first_key").alias(f"{name}_first"), F.col("copies").alias(f"{name}_copies"))
    both = pairs.join(part(0, "train"), "train_text").join(part(1, "held"), "held_text")
    taking = pairs.select(F.col("train_text").alias("text"), F.lit(0).alias("side")).unionByName(pairs.select(F.col("held_text").alias("text"), F.lit(1).alias("side"))).distinct()
    named = taking.join(classes.select("text", "side", "first_key"), ["text", "side"])
    return both.drop("train_text", "held_text"), members.join(named, ["text", "side"]).select("side", "first_key", "key")
