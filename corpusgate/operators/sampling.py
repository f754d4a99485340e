"""Deterministic stratified samples and splits. Order comes from hashes, never from partitions or random state."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import any_of, blank, piped
from ..sources.shared import written
from .candidates import bucket

# Buckets in the order they are drawn, and their weights.
BUCKETS = ["duplicate_related", "suspicious_length", "keep_candidate_for_human_review", "needs_review", "rejected"]
WEIGHTS = {"keep_candidate_for_human_review": 60, "needs_review": 50, "rejected": 20, "duplicate_related": 10, "suspicious_length": 10}


def apportion(size: int, weights: dict[str, int] | None = None, order: list[str] | None = None) -> dict[str, int]:
    """Largest-remainder shares of ``size`` over weighted buckets; equal remainders go to the bucket drawn first."""
    weights, order = weights or WEIGHTS, order or BUCKETS
    if size < 0:
        raise ValueError("a sample cannot be smaller than nothing")
    exact = {b: weights[b] / sum(weights.values()) * size for b in order}
    shares = {b: math.floor(x) for b, x in exact.items()}
    left = size - sum(shares.values())
    for b in sorted(order, key=lambda b: (-(exact[b] - shares[b]), order.index(b)))[:left]:
        shares[b] += 1
    return shares


def row_key(df: DataFrame) -> Column:
    """The input index as text, else the candidate id, else empty."""
    keys = [F.col(c).cast("string") for c in ("input_index", "candidate_id") if c in df.columns]
    return F.coalesce(*keys, F.lit(""))


def digest_rank(seed: int, salt: str, value: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}|{salt}|"), F.coalesce(value, F.lit(""))), 256)


def record_rank(seed: int, salt: str) -> Column:
    return digest_rank(seed, salt, piped("row_key", "candidate_id", "parent_record_id", "article_hash"))


def round_robin(df: DataFrame, seed: int, salt: str, most: int, warned_first: bool = False) -> DataFrame:
    """The first ``most`` rows, taken one from each parent in turn, with ``sample_index`` from 1.

    Parents come by hash rank, rows within a parent by warnings (if asked), hash
    rank and key. No row beyond a parent's first ``most`` can be among them, so
    each parent is cut to that in the window, which Spark does before its
    shuffle; the last step orders at most ``most`` rows per parent for a top-k.
    """
    warned = F.when(F.size("parent_document_warning_codes") > 0, 0).otherwise(1) if warned_first and "parent_document_warning_codes" in df.columns else F.lit(1)
    keyed = df.withColumn("row_key", row_key(df)).withColumn("_parent", F.coalesce("parent_record_id", F.lit("")))
    ranked = keyed.withColumns({"_w": warned, "_r": record_rank(seed, salt), "_p": digest_rank(seed, f"{salt}:parent", F.col("_parent"))})
    turn = F.row_number().over(Window.partitionBy("_parent").orderBy("_w", "_r", "row_key"))
    cut = ranked.withColumn("_turn", turn).where(F.col("_turn") <= most).orderBy("_turn", "_p", "_parent").limit(most)
    index = F.row_number().over(Window.orderBy("_turn", "_p", "_parent"))  # at most ``most`` rows
    return cut.withColumn("sample_index", index).drop("_parent", "_w", "_r", "_p", "_turn")


def duplicate_representatives(df: DataFrame, seed: int) -> DataFrame:
    """One row for each hash that several rows share: rejected duplicates first, then warned ones, then by hash rank.

    Chosen by an aggregation with partial results. Needs ``group_size``.
    """
    keyed = df.where(~blank("article_hash") & (F.col("group_size") > 1)).withColumn("row_key", row_key(df))
    late = F.when(F.col("filter_decision") == "reject_duplicate_hash", 0).otherwise(1)
    warned = F.when(F.size("parent_document_warning_codes") > 0, 0).otherwise(1) if "parent_document_warning_codes" in df.columns else F.lit(1)
    order = F.struct(late, warned, record_rank(seed, "duplicate_related_group"), F.col("row_key"))
    columns = [c for c in keyed.columns if c != "row_key"]
    best = keyed.groupBy("article_hash").agg(F.min_by(F.struct(*columns), order).alias("r"))
    return best.select("r.*", F.col("r.group_size").alias("duplicate_group_size"), F.col("r.article_hash").alias("duplicate_group_key"))


def duplicate_related(df: DataFrame) -> Column:
    """Whether a decided candidate has to do with duplicates at all. Needs ``group_size``."""
    return any_of([F.array_contains("filter_reasons", "reject_duplicate_hash"), F.array_contains("risk_flags", "duplicate_hash_loser"), ~blank("duplicate_of"), F.col("group_size") > 1])


def suspicious_length(df: DataFrame) -> Column:
    return F.array_contains("filter_reasons", "needs_review_suspicious_length") | F.array_contains("risk_flags", "suspicious_length_text")


def review_sample(decided: DataFrame, size: int = 150, seed: int = 42, filter_version: str = "corpusgate_filter_v1", id_prefix: str = "phase2h") -> DataFrame:
    """A review sample of about ``size`` rows in five buckets, none of which repeats a row of an earlier one.

    The decided rows are written once, without texts. Each bucket is a
    top-k; its keys, at most ``size`` over all buckets, go to the driver and are
    left out of the next. The rows themselves are then looked up by those keys,
    and their texts in the input, for which nothing is decided again.
    Input indexes must be unique.
    """
    targets = apportion(size)
    slim = written(decided.drop("text"))
    kind = bucket(F.col("filter_decision"))
    pools = {
        "duplicate_related": duplicate_representatives(slim, seed), "suspicious_length": slim.where(suspicious_length(slim)), "keep_candidate_for_human_review": slim.where(kind == "keep"),
        "needs_review": slim.where(kind == "needs_review"), "rejected": slim.where(kind == "rejected"),
    }
    drawn: list[tuple] = []
    for b in BUCKETS:
        if not targets[b]:
            continue
        pool = pools[b].where(~F.col("input_index").isin([d[0] for d in drawn])) if drawn else pools[b]
        rows = round_robin(pool, seed, b, targets[b], warned_first=True).select("input_index", "row_key", "sample_index", F.when(F.lit(b == "duplicate_related"), F.col("group_size")).alias("duplicate_group_size"))
        drawn += [(*r, b) for r in rows.collect()]
    keys = decided.sparkSession.createDataFrame(drawn, "input_index long, row_key string, sample_index int, duplicate_group_size long, sampling_bucket string")
    texts = decided.select("input_index", "text").join(F.broadcast(keys.select("input_index")), "input_index", "left_semi")  # at most ``size`` keys
    out = slim.join(F.broadcast(keys), "input_index").join(texts, "input_index")
    short = F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), "sampling_bucket", "row_key"), 256), 1, 12)
    return out.withColumns({
        "review_sample_id": F.format_string(id_prefix + "-%s-%03d-%s", "sampling_bucket", "sample_index", short), "text_length": F.coalesce(F.nullif("text_char_count", F.lit(0)), F.length(F.trim("text")), F.lit(0)),
        "duplicate_group_key": F.when(F.col("duplicate_group_size").isNotNull(), F.col("article_hash")), "filter_version": F.lit(filter_version), "sampling_seed": F.lit(seed),
    })


def shortfalls(sample: DataFrame, size: int) -> DataFrame:
    """Rows wanted, drawn and lacking for each bucket."""
    wanted = sample.sparkSession.createDataFrame(list(apportion(size).items()), "sampling_bucket string, target int")
    drawn = sample.groupBy("sampling_bucket").agg(F.count("*").alias("selected"))
    joined = wanted.join(drawn, "sampling_bucket", "left").withColumn("selected", F.coalesce("selected", F.lit(0)))
    return joined.withColumn("shortfall", F.greatest(F.col("target") - F.col("selected"), F.lit(0)))


def split_rows(df: DataFrame, key: str, seed: int = 42, train: float = 0.8, validation: float = 0.1, test: float = 0.1) -> DataFrame:
    """Adds ``split_name`` by hash order of ``seed|key``: exact sizes, with what rounding leaves in test.

    Positions come from counts per hash prefix and a row number within it, so no
    task numbers the whole table. Rows with equal keys are told apart by their
    content; null keys count as empty. Ratios must sum to 1.
    """
    if abs(train + validation + test - 1) > 1e-9 or min(train, validation, test) < 0:
        raise ValueError("ratios must be positive and sum to 1")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    ranked = df.withColumns({"_h": F.sha2(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), "_x": whole}).withColumn("_b", F.substring("_h", 1, 3))
    counts = ranked.groupBy("_b").agg(F.count("*").alias("_n"))  # at most 4096 rows
    before = counts.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    placed = ranked.join(F.broadcast(before), "_b").withColumn("_i", F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", "_x")))
    first, second = F.floor(F.col("_total") * train), F.floor(F.col("_total") * validation)
    name = F.when(F.col("_i") <= first, "train").when(F.col("_i") <= first + second, "validation").otherwise("test")
    return placed.withColumn("split_name", name).drop("_h", "_x", "_b", "_before", "_total", "_i")


def seeded_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows, or all if there are fewer, by hash order of ``seed|key``; a top-k, so nothing is sorted whole. Null keys count as empty."""
    if size < 0:
        raise ValueError("a sample cannot be smaller than nothing")
    rank = F.sha2(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return df.withColumn("_rank", rank).orderBy("_rank").limit(size).drop("_rank")


def sample_coverage(sample: DataFrame) -> DataFrame:
    """One row: what a sample covers. Sets are of names of sources and licences, which are few."""
    named = lambda c: F.when(~blank(c), F.col(c))
    warned = F.count_if(F.size("parent_document_warning_codes") > 0) if "parent_document_warning_codes" in sample.columns else F.lit(0).cast("long")
    return sample.agg(
        F.count("*").alias("sampled"), F.count_distinct(named("parent_record_id")).alias("parents_covered"), F.count_distinct(named("source_id")).alias("source_ids_covered"),
        F.array_sort(F.collect_set(named("source_dataset"))).alias("source_datasets"), F.array_sort(F.collect_set(named("license"))).alias("licenses"), warned.alias("with_parent_warning"),
    )
