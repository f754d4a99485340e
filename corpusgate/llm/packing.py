"""Filling fixed-capacity containers with items of varying length.

Linear grouping: large lengths are put in groups of equal cardinality and
rounded up to the largest of their group, so few sizes remain. How often each
configuration (which sizes share a container) is used is a linear programme over
those few sizes, solved by column generation; its whole parts are taken, and
what is left over is filled one container after the other. The actual items
take the places of the rounded ones, and the small items are placed where they
leave least room.

All planning is done on counts by length. A length is a whole number of tokens
below the capacity, so the plan's size depends on the capacity, not on the
corpus. The items themselves are only numbered within their length, in the
cluster, in groups as many as their number asks for, and the plan says for each
range of numbers where it goes. Pieces that fill a container go nowhere at all:
an item's full pieces take containers in a row from a running sum over items.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: A stretch of containers: ``(length, first rank, last rank + 1, first container)``; rank r lies in container ``first container + r - first rank``.
Placement = tuple[int, int, int, int]

#: About so many items of one length are numbered by one task.
ITEMS_A_GROUP = 200_000

#: The linear programme has at most so many sizes; its time grows with their square and more.
PROGRAMME_GROUPS = 128

# Fixed value: how the public byte-level vocabularies part text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def _encoder(folder: str, name: str):
    import tiktoken

    with open(os.path.join(folder, name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str, text: str, folder: str, name: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """``item, tokens`` of every text that has a token, by a byte-level BPE from vocabulary files in ``folder`` on every executor.

    Null keys, null and empty texts give no row; rows with equal keys are items of their own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(folder, name).encode_ordinary
        for b in batches:
            yield pd.DataFrame({"item": b["item"], "tokens": [len(encode(t)) for t in b["text"]]})

    rows = df.select(F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("text")).where("item is not null and text <> ''")
    return rows.mapInPandas(run, "item long, tokens int").where("tokens > 0")


def _groups(counts: dict[int, int], least: int, groups: int) -> list[tuple[int, int, dict[int, int]]]:
    """Large lengths in groups of equal cardinality: rounded length, number, and actual lengths; largest first. Few lengths are a group each, and nothing is rounded."""
    large = sorted((s for s in counts if s > least), reverse=True)
    if len(large) <= groups:
        return [(s, counts[s], {s: counts[s]}) for s in large]
    share = max(1, -(-sum(counts[s] for s in large) // groups))
    out: list[tuple[int, int, dict[int, int]]] = []
    held: dict[int, int] = {}
    room = share
    for s in large:
        n = counts[s]
        while n:
            take = min(n, room)
            held[s] = held.get(s, 0) + take
            n, room = n - take, room - take
            if not room:
                out.append((max(held), sum(held.values()), held))
                held, room = {}, share
    if held:
        out.append((max(held), sum(held.values()), held))
    return out


def configurations(sizes: list[int], needed: list[int], capacity: int, most: int = 4_000) -> list[tuple[tuple[int, ...], int]]:
    """Configurations of at most three items and how many whole containers of each, by the linear programme of fewest containers.

    ``sizes`` fall and each is over a quarter of the capacity, so a container
    holds three at the most and the best new column is found among pairs, with
    the best third by room. Revised simplex from containers of one size each;
    stops at the optimum or after ``most`` steps, as every step is a valid plan.
    """
    m = len(sizes)
    size, need = np.array(sizes, dtype=np.int64), np.array(needed, dtype=float)
    if not m:
        return []
    columns = [tuple([i] * min(3, capacity // s)) for i, s in enumerate(sizes)]
    inverse = np.diag([1.0 / len(c) for c in columns])
    amount = inverse @ need
    order = np.argsort(size, kind="stable")
    rising = size[order]
    for _ in range(most):
        value = np.maximum(inverse.sum(axis=0), 0.0)  # every container costs one
        best, arg = np.zeros(m + 1), np.full(m + 1, -1)  # the best single item among the k smallest
        for k in range(m):
            better = value[order[k]] > best[k]
            best[k + 1], arg[k + 1] = (value[order[k]], order[k]) if better else (best[k], arg[k])
        room = capacity - (size[:, None] + size[None, :])
        third = np.searchsorted(rising, room, side="right")
        total = np.where(room >= 0, value[:, None] + value[None, :] + best[np.maximum(third, 0)], -1.0)
        i, j = divmod(int(total.argmax()), m)
        if total[i, j] <= 1 + 1e-7:
            break
        entering = tuple(x for x in (i, j, int(arg[third[i, j]])) if x >= 0)
        column = np.bincount(entering, minlength=m).astype(float)
        step = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, amount / step, np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        columns[out] = entering
        pivot = inverse[out] / step[out]
        amount = amount - ratio[out] * step
        amount[out] = ratio[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
    return [(c, int(x + 1e-6)) for c, x in zip(columns, amount) if x + 1e-6 >= 1]


def _best_fill(sizes: list[int], left: list[int], room: int) -> list[int]:
    """How many of each size fill ``room`` best; of equal fills the one with larger items."""
    reach = np.full(room + 1, -2, dtype=np.int32)
    used = np.zeros(room + 1, dtype=np.int32)
    reach[0] = -1
    for j, (s, n) in enumerate(zip(sizes, left)):
        if s > room or not n:
            continue
        used[:] = 0
        # bounded knapsack: from each sum reached, one more of size s at a time
        frontier = reach > -2
        for _ in range(min(n, room // s)):
            step = np.zeros_like(frontier)
            step[s:] = frontier[:-s]
            step &= reach == -2
            if not step.any():
                break
            reach[step] = j
            frontier = step
    total = int(np.flatnonzero(reach > -2).max())
    take = [0] * len(sizes)
    while total:
        j = int(reach[total])
        take[j] += 1
        total -= sizes[j]
    return take


def plan(counts: dict[int, int], capacity: int, groups: int = 512, small: int = 4) -> tuple[list[Placement], int]:
    """Where items go, given how many there are of each length up to ``capacity``; and the number of containers.

    Lengths over ``capacity / small`` are large. Ranks count the items of a
    length from 0. No container exceeds the capacity. Of the plan with the
    linear programme and that without, the one with fewer containers is taken.
    """
    small = max(2, min(4, small))  # the programme knows containers of up to three large items
    plans = [_plan(counts, capacity, min(groups, PROGRAMME_GROUPS), small, True), _plan(counts, capacity, groups, small, False)]
    return min(plans, key=lambda p: p[1])


def _plan(counts: dict[int, int], capacity: int, groups: int, small: int, programme: bool) -> tuple[list[Placement], int]:
    placed: list[Placement] = []
    taken: dict[int, int] = {}
    containers = 0
    free: list[tuple[int, int, int]] = []  # room, first container, number, in order

    def put(length: int, n: int, first: int) -> None:
        rank = taken.get(length, 0)
        placed.append((length, rank, rank + n, first))
        taken[length] = rank + n

    grouped = _groups(counts, capacity // small, groups)
    sizes, left = [g[0] for g in grouped], [g[1] for g in grouped]
    stock = [sorted(g[2].items(), reverse=True) for g in grouped]

    def use(take: dict[int, int], many: int) -> None:
        """``many`` containers of a configuration; each place takes actual items of its group, largest first."""
        nonlocal containers
        edges, filling = {0, many}, []
        for j in (j for j, t in take.items() for _ in range(t)):
            at, own = 0, []
            while at < many:
                s, n = stock[j][0]
                m = min(n, many - at)
                own.append((at, at + m, s))
                stock[j][0] = (s, n - m)
                if n == m:
                    stock[j].pop(0)
                at += m
                edges.add(at)
            filling.append(own)
        for own in filling:
            for a, b, s in own:
                put(s, b - a, containers + a)
        bounds = sorted(edges)
        for a, b in zip(bounds, bounds[1:]):
            room = capacity - sum(next(s for x, y, s in own if x <= a < y) for own in filling)
            if room:
                insort(free, (room, containers + a, b - a))
        containers += many
        for j, t in take.items():
            left[j] -= t * many

    if programme:
        for config, many in configurations(sizes, left, capacity):
            take = {j: config.count(j) for j in config}
            # the programme may provide for more than there are
            many = min([many, *(left[j] // t for j, t in take.items())])
            if many:
                use(take, many)
    while any(left):
        lead = next(j for j, n in enumerate(left) if n)
        rest = left.copy()
        rest[lead] -= 1
        take = _best_fill(sizes, rest, capacity - sizes[lead])
        take[lead] += 1
        use({j: t for j, t in enumerate(take) if t}, min(n // t for n, t in zip(left, take) if t))
    # small items, longest first, each where least room is left
    for s in sorted((s for s in counts if s <= capacity // small), reverse=True):
        n = counts[s]
        while n:
            i = bisect_left(free, (s, -1, 0))
            if i == len(free):
                fresh = -(-n // (capacity // s))
                insort(free, (capacity, containers, fresh))
                containers += fresh
                continue
            room, first, many = free.pop(i)
            m = min(n, many)
            # several of one length may share a container: fill it before the next
            k = max(1, min(room // s, n // m))
            for _ in range(k):
                put(s, m, first)
            n -= m * k
            if room > s * k:
                insort(free, (room - s * k, first, m))
            if many > m:
                insort(free, (room, first + m, many - m))
    return placed, containers


def _salted(rows: DataFrame, by: str, sizes: pd.DataFrame) -> DataFrame:
    """Adds ``salt``: rows with one value of ``by`` in as many groups as their number ``n`` in ``sizes`` asks for."""
    groups = sizes.assign(groups=(-(-sizes["n"] // ITEMS_A_GROUP)).clip(lower=1))[[by, "groups"]]
    many = groups[groups["groups"] > 1]
    if not len(many):
        return rows.withColumn("salt", F.lit(0))
    named = rows.sparkSession.createDataFrame(many)
    joined = rows.join(F.broadcast(named), by, "left")  # at most as many rows as there are lengths
    return joined.withColumn("salt", F.pmod(F.xxhash64("item", "tokens"), F.coalesce("groups", F.lit(1))).cast("int")).drop("groups")


def _full_pieces(rows: DataFrame, capacity: int, many: int) -> DataFrame:
    """``container, item, piece, token_start, tokens`` of the pieces that fill a container; ``many`` items have such.

    Items are numbered by running sums within groups; an item's pieces are only made once it knows its first container.
    """
    items = rows.where(F.col("tokens") >= capacity).select("item", "tokens", F.floor(F.col("tokens") / capacity).cast("long").alias("full"), F.lit(0).alias("all"))
    salted = _salted(items, "all", pd.DataFrame({"all": [0], "n": [many]}))
    if many > ITEMS_A_GROUP:
        tally = salted.groupBy("salt").agg(F.sum("full").alias("full")).orderBy("salt").toPandas()  # a row for each 200,000 items
    else:
        tally = pd.DataFrame({"salt": [0], "full": [0]})
    base = rows.sparkSession.sparkContext.broadcast(dict(zip(tally["salt"], tally["full"].cumsum() - tally["full"])))

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, seen = None, 0
        for b in batches:
            for salt, own in b.groupby("salt", sort=False):
                seen = seen if salt == group else base.value[salt]
                group = salt
                sums = own["full"].cumsum()
                yield pd.DataFrame({"first": seen + sums - own["full"], "item": own["item"], "full": own["full"]})
                seen += int(sums.iloc[-1])

    placed = salted.repartition("salt").sortWithinPartitions("salt", "item", "tokens").select("salt", "item", "full").mapInPandas(number, "first long, item long, full long")
    pieces = placed.select("first", "item", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("piece"))
    return pieces.select((F.col("first") + F.col("piece")).alias("container"), "item", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).cast("int").alias("token_start"), F.lit(capacity).alias("tokens"))


def pack(items: DataFrame, capacity: int, groups: int = 512, small: int = 4) -> DataFrame:
    """``container, item, piece, token_start, tokens`` for a table ``item, tokens``.

    Only items over the capacity are cut, into pieces that fill a container
    each and a remainder that is packed like any item. Containers are numbered
    from 0 without gaps. Items without tokens, or null, are left out; rows with
    equal items are packed each.
    """
    if capacity < 1:
        raise ValueError("a container must hold at least one token")
    spark = items.sparkSession
    rows = items.where("item is not null and tokens > 0").select(F.col("item").cast("long").alias("item"), F.col("tokens").cast("long").alias("tokens"))
    whole = F.floor(F.col("tokens") / capacity).cast("int")
    cut = rows.select("item", whole.alias("piece"), (whole * capacity).alias("token_start"), (F.col("tokens") % capacity).cast("int").alias("tokens"))
    # a row for each length below the capacity; length 0 is of items that full pieces use up
    lengths = cut.groupBy("tokens").agg(F.count("*").alias("n"), F.sum("piece").alias("full"), F.count_if(F.col("piece") > 0).alias("long")).toPandas()
    taken, full = int(lengths["full"].sum()), _full_pieces(rows, capacity, int(lengths["long"].sum()))
    rest, sizes = cut.where("tokens > 0"), lengths.loc[lengths["tokens"] > 0, ["tokens", "n"]].reset_index(drop=True)
    placed, _ = plan({int(t): int(n) for t, n in zip(sizes["tokens"], sizes["n"])}, capacity, groups, small)
    salted = _salted(rest, "tokens", sizes)
    hot = sizes.loc[sizes["n"] > ITEMS_A_GROUP, ["tokens"]]
    base = {(int(t), 0): 0 for t in sizes["tokens"]}
    if len(hot):  # a row for each 200,000 items of such a length
        tally = salted.join(F.broadcast(spark.createDataFrame(hot)), "tokens").groupBy("tokens", "salt").agg(F.count("*").alias("n")).orderBy("tokens", "salt").toPandas()
        tally["base"] = tally.groupby("tokens")["n"].cumsum() - tally["n"]
        base |= {(int(t), int(s)): int(b) for t, s, b in zip(tally["tokens"], tally["salt"], tally["base"])}
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for length, some in pd.DataFrame(placed, columns=["length", "low", "high", "first"]).sort_values("low").groupby("length"):
        by_length[int(length)] = (some["low"].to_numpy(), some["first"].to_numpy())
    sent = spark.sparkContext.broadcast((base, by_length))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bases, where = sent.value
        group, seen = None, 0
        for b in batches:
            out = np.zeros(len(b), dtype=np.int64)
            lengths, salts = b["tokens"].to_numpy(), b["salt"].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], (np.diff(lengths) != 0) | (np.diff(salts) != 0), [True]])) if len(b) else [0]
            for a, z in zip(edges, edges[1:]):
                own = (int(lengths[a]), int(salts[a]))
                seen = seen if own == group else 0
                group = own
                rank = bases[own] + seen + np.arange(z - a)
                low, first = where[own[0]]
                i = np.searchsorted(low, rank, side="right") - 1
                out[a:z] = first[i] + rank - low[i]
                seen += z - a
            yield b.assign(container=out + taken)[["container", "item", "piece", "token_start", "tokens"]]

    ordered = salted.repartition("tokens", "salt").sortWithinPartitions("tokens", "salt", "item", "piece")
    return ordered.mapInPandas(place, "container long, item long, piece int, token_start int, tokens int").unionByName(full)


def pack_windows(df: DataFrame, key: str, text: str, windows: DataFrame, name: str, capacity: str, folder: str) -> DataFrame:
    """``pack`` for each container size of ``windows``, with its name as ``window_name``; texts are tokenised once.

    Windows with a null name or capacity are left out; there are few of them by nature.
    """
    items = written(token_counts(df, key, text, folder))
    out = None
    for w in windows.select(name, capacity).where(f"`{name}` is not null and `{capacity}` is not null").orderBy(name).collect():
        packed = pack(items, int(w[1])).withColumn("window_name", F.lit(w[0]))
        out = packed if out is None else out.unionByName(packed)
    if out is None:
        return df.sparkSession.createDataFrame([], "window_name string, container long, item long, piece int, token_start int, tokens int")
    return out.select("window_name", "container", "item", "piece", "token_start", "tokens")
