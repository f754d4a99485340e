"""Consensus from several annotators' labels.

A regularised classifier on item features and the annotators' confusion
matrices are fitted jointly by expectation-maximisation: the classifier's
output is the prior of each item's label, and the expected labels are in turn
what the classifier learns from. Votes stay in the cluster. Sums of expected
labels are made there by annotator, level and label. Up to a bound of
annotators their matrices are gathered and sent to all tasks; beyond it they
stay tables that are joined to the votes, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reviews import LABELS as REVIEW_LABELS
from ..operators.reviews import LEVELS
from .common import durable

#: The decision labels by name, which is how ties go.
LABELS = sorted(REVIEW_LABELS)
#: Up to so many annotators, of 2.6 KB each, the matrices go through the driver and to all tasks: 13 MB.
MOST_SENT = 5_000
#: The classifier is fitted to so many of the most frequent combinations of features; it serves all of them.
MOST_CELLS = 5_000


@dataclass
class Prior:
    """The classifier: weights by label of each feature value, behind an intercept. Values it has not seen weigh nothing."""

    column: dict[tuple[int, str], int]
    weights: np.ndarray

    def log(self, cells: list[str]) -> np.ndarray:
        """Logarithmic label probabilities of combinations of features, fields parted by ``\u001f``."""
        z = np.repeat(self.weights[:1], len(cells), axis=0)
        for n, cell in enumerate(cells):
            for i, v in enumerate(cell.split("\u001f")):
                if (c := self.column.get((i, v))) is not None:
                    z[n] += self.weights[c]
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))


@dataclass
class Model:
    """What was fitted. ``confusion[annotator, level, true, said]`` up to ``MOST_SENT`` annotators, else the table ``matrices`` (``annotator, level, label, l0, l1, ...``: log probability of the vote by true label).

    ``converged`` tells whether the last round changed no entry by the tolerance or more.
    """

    annotators: list[str]
    confusion: np.ndarray | None
    prior: Prior
    rounds: int
    converged: bool
    matrices: DataFrame | None = None


def tidy_label(label: Column, labels: list[str] = LABELS) -> Column:
    """The label in its own spelling, or null: case, outer spaces, and hyphens or spaces for underscores do not count."""
    tidy = F.regexp_replace(F.lower(F.regexp_replace(label, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), "[- ]", "_")
    return F.when(tidy.isin(labels), tidy)


def votes_by_item(df: DataFrame, item: str, annotator: str, label: str, confidence: str, features: list[str], row: str, labels: list[str], least: int) -> DataFrame:
    """``item, cell_key, votes`` with one vote per annotator, for items with votes of ``least`` annotators.

    Of several votes of an annotator on an item the one with the smallest
    ``row`` holds. Rows with no valid label, no item or no annotator are left out.
    A vote is ``annotator, level, label`` with level 3 for an unknown confidence.
    """
    tidy = lambda c: F.lower(F.regexp_replace(F.col(c).cast("string"), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    place = lambda values, c: F.array_position(F.array(*[F.lit(v) for v in values]), c)
    said = tidy_label(F.col(label), labels)
    level = F.when(tidy(confidence).isin(LEVELS), place(LEVELS, tidy(confidence)).cast("int") - 1).otherwise(len(LEVELS))
    rows = df.select(
        F.col(item).cast("string").alias("item"), tidy(annotator).alias("annotator"), (place(labels, said).cast("int") - 1).alias("label"), level.alias("level"),
        F.concat_ws("\u001f", *[F.coalesce(tidy(f), F.lit("")) for f in features]).alias("cell_key"), F.col(row).alias("row"),
    ).where("item is not null and trim(item) <> '' and annotator <> '' and label is not null")
    once = rows.groupBy("item", "annotator").agg(F.min_by(F.struct("level", "label", "cell_key"), "row").alias("v"))
    # an annotator votes once on an item, so a group has at most as many rows as there are annotators
    votes = F.collect_list(F.struct("annotator", F.col("v.level").alias("level"), F.col("v.label").alias("label")))
    return once.groupBy("item").agg(votes.alias("votes"), F.min("v.cell_key").alias("cell_key")).where(F.size("votes") >= least)


def _classifier(cells: np.ndarray, expected: np.ndarray, ridge: float, weights: np.ndarray | None, steps: int = 60) -> np.ndarray:
    """Weights of a multinomial logistic regression on one-hot features, by gradient steps with backtracking."""
    w = np.zeros((cells.shape[1], expected.shape[1])) if weights is None else weights
    total = expected.sum()

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = cells @ w
        z -= z.max(1, keepdims=True)
        log = z - np.log(np.exp(z).sum(1, keepdims=True))
        grad = cells.T @ (np.exp(log) * expected.sum(1, keepdims=True) - expected)
        # the first feature is the intercept and is not shrunk
        shrunk = w.copy()
        shrunk[0] = 0
        return float(-(expected * log).sum() + 0.5 * ridge * (shrunk**2).sum()) / total, (grad + ridge * shrunk) / total

    rate, (value, grad) = 1.0, loss(w)
    for _ in range(steps):
        while rate > 1e-6:
            tried = w - rate * grad
            new, new_grad = loss(tried)
            if new <= value - 0.3 * rate * (grad**2).sum():
                break
            rate /= 2
        else:
            break
        done = value - new < 1e-9
        w, value, grad, rate = tried, new, new_grad, rate * 2
        if done:
            break
    return w


def _softmax(score: np.ndarray) -> np.ndarray:
    p = np.exp(score - score.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _posterior(codes: list[np.ndarray], log_prior: np.ndarray, log_confusion: np.ndarray) -> np.ndarray:
    """Label probabilities by item; a code is ``(annotator * levels + level) * labels + said``."""
    sizes = np.array([len(c) for c in codes])
    k = log_prior.shape[1]
    by_said = log_confusion.transpose(0, 1, 3, 2).reshape(-1, k)
    return _softmax(np.add.reduceat(by_said[np.concatenate(codes)], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) + log_prior)


def _matrices(votes: np.ndarray, common: np.ndarray, smooth: float) -> np.ndarray:
    """``[annotator, level, true, said]`` probabilities from expected counts of the same shape.

    A level's matrix is drawn to the annotator's over all levels, and that to
    the one all annotators share, so rare annotators and levels are not taken at face value.
    """
    own = votes.sum(1) + smooth * common
    own /= own.sum(2, keepdims=True)
    by_level = votes + 10 * smooth * own[:, None]
    return by_level / by_level.sum(3, keepdims=True)


def _common(votes: np.ndarray, smooth: float) -> np.ndarray:
    """The matrix ``[true, said]`` that all annotators share, from the sum of their counts."""
    k = len(votes)
    common = votes + smooth * (np.eye(k) * 2 + 1) / (k + 2)
    return common / common.sum(1, keepdims=True)


class _Classifier:
    """The classifier over the most frequent cells, fitted anew in every round from where it was."""

    def __init__(self, cells: list[str], labels: int, ridge: float) -> None:
        fields = [c.split("\u001f") for c in cells]
        self.cells = {c: i for i, c in enumerate(cells)}
        self.column = {c: 1 + i for i, c in enumerate(sorted({(i, v) for f in fields for i, v in enumerate(f)}))}
        self.x = np.zeros((len(cells), 1 + len(self.column)))
        self.x[:, 0] = 1
        for n, f in enumerate(fields):
            for i, v in enumerate(f):
                self.x[n, self.column[i, v]] = 1
        self.ridge, self.weights = ridge, np.zeros((self.x.shape[1], labels))

    def fit(self, expected: np.ndarray) -> Prior:
        if expected.sum() > 0:
            self.weights = _classifier(self.x, expected, self.ridge, self.weights)
        return Prior(self.column, self.weights)


def fit_consensus(
    items: DataFrame, labels: list[str] = LABELS, rounds: int = 40, ridge: float = 50.0, smooth: float = 5.0, tolerance: float = 1e-3, most_sent: int = MOST_SENT, most_cells: int = MOST_CELLS
) -> tuple[DataFrame, Model]:
    """Fits the model to items from ``votes_by_item``; gives the items and the model.

    Any number of annotators will do; ``most_sent`` only decides how the work is
    laid out. The classifier is fitted to the ``most_cells`` most frequent
    combinations of features. Without items the model has no annotators and says so.
    """
    items = durable(items)
    cells = [r[0] for r in items.groupBy("cell_key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cell_key").limit(most_cells).collect()]
    names = [r[0] for r in items.select(F.explode("votes.annotator").alias("a")).distinct().limit(most_sent + 1).collect()]
    classifier = _Classifier(sorted(cells), len(labels), ridge)
    if not names:
        k = len(labels)
        return items, Model([], np.zeros((0, len(LEVELS) + 1, k, k)), classifier.fit(np.zeros((len(cells), k))), 0, True)
    fit = _fit_sent if len(names) <= most_sent else _fit_joined
    return fit(items, sorted(names), classifier, len(labels), rounds, smooth, tolerance)


def _sums(k: int) -> list[Column]:
    return [F.sum(f"s{j}").alias(f"s{j}") for j in range(k)]


def _fit_sent(items: DataFrame, names: list[str], classifier: _Classifier, k: int, rounds: int, smooth: float, tolerance: float) -> tuple[DataFrame, Model]:
    """With the matrices of all annotators in every task."""
    spark = items.sparkSession
    levels, n = len(LEVELS) + 1, len(names)
    ids = spark.sparkContext.broadcast(({a: i for i, a in enumerate(names)}, classifier.cells))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who = ids.value[0]
        for b in batches:
            codes = [[(who[v["annotator"]] * levels + v["level"]) * k + v["label"] for v in votes] for votes in b["votes"]]
            yield pd.DataFrame({"item": b["item"], "cell_key": b["cell_key"], "codes": codes})

    coded = durable(items.mapInPandas(encode, "item string, cell_key string, codes array<int>"))
    names_s = [f"s{j}" for j in range(k)]
    schema = "cell boolean, i long, " + ", ".join(f"{s} double" for s in names_s)

    def expect(log_confusion: np.ndarray | None, prior: Prior | None) -> tuple[np.ndarray, np.ndarray]:
        sent = spark.sparkContext.broadcast((log_confusion, prior))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            log_c, known = sent.value
            votes, by_cell = np.zeros((n * levels * k, k)), np.zeros((len(ids.value[1]), k))
            for b in batches:
                if not len(b):
                    continue
                codes = list(b["codes"])
                at, cells = pd.factorize(b["cell_key"])
                if log_c is None:  # the first round goes by vote shares
                    p = np.array([np.bincount(c % k, minlength=k) / len(c) for c in codes])
                else:
                    p = _posterior(codes, known.log(list(cells))[at], log_c)
                place = np.array([ids.value[1].get(c, -1) for c in cells])[at]
                np.add.at(by_cell, place[place >= 0], p[place >= 0])
                np.add.at(votes, np.concatenate(codes), np.repeat(p, [len(c) for c in codes], axis=0))
            for is_cell, sums in ((False, votes), (True, by_cell)):
                kept = np.flatnonzero(sums.any(axis=1))
                yield pd.DataFrame({"cell": is_cell, "i": kept} | {s: sums[kept, j] for j, s in enumerate(names_s)})

        # at most MOST_SENT x levels x labels rows and those of the cells
        out = coded.mapInPandas(run, schema).groupBy("cell", "i").agg(*_sums(k)).toPandas()
        sent.destroy()
        found = []
        for is_cell, size in ((False, n * levels * k), (True, len(classifier.cells))):
            own, total = out[out["cell"] == is_cell], np.zeros((size, k))
            total[own["i"].to_numpy().astype(np.int64)] = own[names_s].to_numpy()
            found.append(total)
        return found[0].reshape(n, levels, k, k).transpose(0, 1, 3, 2), found[1]

    log_confusion = prior = None
    moved, done = 1.0, 0
    while done < rounds and moved >= tolerance:
        votes, by_cell = expect(log_confusion, prior)
        by_level = _matrices(votes, _common(votes.sum((0, 1)), smooth), smooth)
        prior = classifier.fit(by_cell)
        moved = 1.0 if log_confusion is None else float(np.abs(np.exp(log_confusion) - by_level).max())
        log_confusion, done = np.log(by_level), done + 1
    return coded, Model(names, np.exp(log_confusion), prior, done, moved < tolerance)


_VOTE = ["annotator", "level", "label"]


def _expected(votes: DataFrame, matrices: DataFrame | None, prior: Prior | None, k: int) -> DataFrame:
    """``item, cell_key, s0, s1, ...``: label probabilities of every item; by vote shares where there are no matrices yet."""
    if matrices is None:
        shares = [F.avg((F.col("label") == j).cast("double")).alias(f"s{j}") for j in range(k)]
        return votes.groupBy("item").agg(F.first("cell_key").alias("cell_key"), *shares)
    scored = votes.join(matrices, _VOTE).groupBy("item").agg(F.first("cell_key").alias("cell_key"), *[F.sum(f"l{j}").alias(f"s{j}") for j in range(k)])
    names_s = [f"s{j}" for j in range(k)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                at, cells = pd.factorize(b["cell_key"])
                yield b.assign(**dict(zip(names_s, _softmax(b[names_s].to_numpy() + prior.log(list(cells))[at]).T)))

    return scored.mapInPandas(run, scored.schema)


def _fit_joined(items: DataFrame, names: list[str], classifier: _Classifier, k: int, rounds: int, smooth: float, tolerance: float) -> tuple[DataFrame, Model]:
    """With the matrices as a table joined to the votes; the driver holds the shared matrix and the classifier only."""
    spark = items.sparkSession
    levels = len(LEVELS) + 1
    votes = durable(items.select("item", "cell_key", F.explode("votes").alias("v")).select("item", "cell_key", *[F.col(f"v.{c}").alias(c) for c in _VOTE]))
    names_s = [f"s{j}" for j in range(k)]
    schema = "annotator string, level int, label int, " + ", ".join(f"l{j} double" for j in range(k))
    cells = spark.createDataFrame([(c,) for c in classifier.cells], "cell_key string")
    matrices = prior = None
    moved, done = 1.0, 0
    while done < rounds and moved >= tolerance:
        expected = durable(_expected(votes, matrices, prior, k))
        by_cell = np.zeros((len(classifier.cells), k))
        for r in expected.join(F.broadcast(cells), "cell_key").groupBy("cell_key").agg(*_sums(k)).collect():  # at most MOST_CELLS
            by_cell[classifier.cells[r.cell_key]] = [r[s] for s in names_s]
        counts = durable(votes.drop("cell_key").join(expected.drop("cell_key"), "item").groupBy(*_VOTE).agg(*_sums(k)))
        shared = np.zeros((k, k))
        for r in counts.groupBy("label").agg(*_sums(k)).collect():  # a row for each label
            shared[:, r.label] = [r[s] for s in names_s]
        common = _common(shared, smooth)

        def rows(frame: pd.DataFrame) -> pd.DataFrame:
            own = np.zeros((1, levels, k, k))
            own[0, frame["level"].to_numpy(), :, frame["label"].to_numpy()] = frame[names_s].to_numpy()
            logs = np.log(_matrices(own, common, smooth))[0]  # noqa: B023
            out = [(lv, said, *logs[lv, :, said]) for lv in range(levels) for said in range(k)]
            return pd.DataFrame(out, columns=["level", "label", *[f"l{j}" for j in range(k)]]).assign(annotator=frame["annotator"].iloc[0])[["annotator", "level", "label", *[f"l{j}" for j in range(k)]]]

        new = durable(counts.groupBy("annotator").applyInPandas(rows, schema))  # a group has at most levels x labels rows
        if matrices is not None:
            changed = F.greatest(*[F.abs(F.exp(F.col(f"n.l{j}")) - F.exp(F.col(f"o.l{j}"))) for j in range(k)])
            moved = float(new.alias("n").join(matrices.alias("o"), _VOTE).agg(F.max(changed)).first()[0])
        matrices, prior, done = new, classifier.fit(by_cell), done + 1
    return votes, Model(names, None, prior, done, moved < tolerance, matrices)


def consensus_labels(coded: DataFrame, model: Model, labels: list[str] = LABELS) -> DataFrame:
    """``item, decision_label, probability, annotators, agreement, pair_agreement`` for each item.

    ``agreement`` is the share of an item's votes that equal its consensus
    label, ``pair_agreement`` the share of pairs of its votes that are equal
    (null for a single vote). Equal probabilities go to the label that comes first in the list.
    """
    schema = "item string, decision_label string, probability double, annotators int, agreement double, pair_agreement double"
    if not model.annotators:
        return coded.sparkSession.createDataFrame([], schema)
    k = len(labels)

    def measures(item: pd.Series, said: list[np.ndarray], p: np.ndarray) -> pd.DataFrame:
        best, size = p.argmax(1), np.array([len(x) for x in said])
        counts = np.array([np.bincount(x, minlength=k) for x in said])
        pairs = np.where(size > 1, (counts * (counts - 1)).sum(1) / np.maximum(1, size * (size - 1)), np.nan)
        return pd.DataFrame({"item": item, "decision_label": [labels[i] for i in best], "probability": p.max(1), "annotators": size.astype(np.int32), "agreement": counts[np.arange(len(best)), best] / size, "pair_agreement": pairs})

    if model.confusion is None:
        expected = _expected(coded, model.matrices, model.prior, k)
        said = coded.groupBy("item").agg(F.collect_list("label").alias("said"))  # an annotator votes once on an item

        def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield measures(b["item"], list(b["said"]), b[[f"s{j}" for j in range(k)]].to_numpy())

        return expected.join(said, "item").mapInPandas(joined, schema).withColumn("pair_agreement", F.nanvl("pair_agreement", F.lit(None).cast("double")))
    sent = coded.sparkSession.sparkContext.broadcast((np.log(model.confusion), model.prior))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        log_c, prior = sent.value
        for b in batches:
            if len(b):
                codes = list(b["codes"])
                at, cells = pd.factorize(b["cell_key"])
                yield measures(b["item"], [c % k for c in codes], _posterior(codes, prior.log(list(cells))[at], log_c))

    return coded.mapInPandas(run, schema).withColumn("pair_agreement", F.nanvl("pair_agreement", F.lit(None).cast("double")))


def _label_shares(coded: DataFrame, k: int) -> np.ndarray:
    """Shares of the labels among all votes."""
    if "codes" in coded.columns:
        said = coded.select(F.explode("codes").alias("c")).select((F.col("c") % k).alias("label"))
    elif "votes" in coded.columns:  # nothing was fitted
        said = coded.select(F.explode("votes.label").alias("label"))
    else:
        said = coded.select("label")
    n = np.zeros(k)
    for r in said.groupBy("label").agg(F.count("*").alias("n")).collect():  # a row for each label
        n[r.label] = r.n
    return n / max(1, n.sum())


def chance_corrected(found: DataFrame, coded: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """``consensus_labels`` with ``kappa``: by how much an item's votes agree more than votes drawn from all votes would, from 1 down.

    Null for items of one vote, and for all where every vote is the same.
    """
    chance = float((_label_shares(coded, len(labels)) ** 2).sum())
    kappa = (F.col("pair_agreement") - chance) / (1 - chance) if chance < 1 else F.lit(None).cast("double")
    return found.withColumn("kappa", kappa)


def annotator_reliability(coded: DataFrame, model: Model, labels: list[str] = LABELS) -> DataFrame:
    """``reviewer_id, votes, reliability``: how likely each annotator's vote is the true label, over the labels as they occur."""
    schema = "reviewer_id string, votes long, reliability double"
    spark = coded.sparkSession
    if not model.annotators:
        return spark.createDataFrame([], schema)
    k, levels = len(labels), len(LEVELS) + 1
    once = coded if "codes" in coded.columns else coded.select("item", "cell_key").distinct()
    # cells beyond those the classifier was fitted to count as they are, a row for each
    cells = once.groupBy("cell_key").agg(F.count("*").alias("n"))
    prior = model.prior

    def weighted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame((np.exp(prior.log(list(b["cell_key"]))) * b["n"].to_numpy()[:, None]).sum(0)[None], columns=[f"s{j}" for j in range(k)])

    total = np.array(list(cells.mapInPandas(weighted, ", ".join(f"s{j} double" for j in range(k))).agg(*_sums(k)).first()), dtype=float)
    truth = total / total.sum()
    if model.confusion is None:
        right = F.when(F.lit(False), 0.0)
        for j in range(k):
            right = right.when(F.col("label") == j, F.exp(F.col(f"l{j}")) * float(truth[j]))
        by_level = model.matrices.select("annotator", "level", right.alias("r")).groupBy("annotator", "level").agg(F.sum("r").alias("right"))
        votes = coded.groupBy("annotator", "level").agg(F.count("*").alias("n"))
        return votes.join(by_level, ["annotator", "level"]).groupBy(F.col("annotator").alias("reviewer_id")).agg(F.sum("n").alias("votes"), (F.sum(F.col("n") * F.col("right")) / F.sum("n")).alias("reliability"))
    share = {(r.i, r.l): r.n for r in coded.select(F.explode("codes").alias("c")).groupBy(F.expr(f"c div {k * levels}").alias("i"), F.expr(f"(c div {k}) % {levels}").alias("l")).agg(F.count("*").alias("n")).collect()}
    rows = []
    for i, name in enumerate(model.annotators):
        n = [share.get((i, lv), 0) for lv in range(levels)]
        right = [float((np.diag(model.confusion[i, lv]) * truth).sum()) for lv in range(levels)]
        rows.append((name, sum(n), float(np.dot(n, right) / max(1, sum(n)))))
    return spark.createDataFrame(rows, schema)
