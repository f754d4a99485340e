"""Contract checks of raw articles and their clauses: required, not blank, at least, one of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import blank, reasons, text_or
from .normalize import DOCUMENT_TYPES, STATUSES
from .reviews import TRUE


def _type_is_wrong(c: Column) -> Column:
    return c.isNotNull() & ~c.isin(DOCUMENT_TYPES)


def _status_is_wrong(c: Column) -> Column:
    return c.isNotNull() & ~c.isin(STATUSES)


def contract_errors(df: DataFrame) -> DataFrame:
    """Adds ``contract_errors`` of an article: its own, then those any of its clauses has, each kind once.

    A document type and a status may be absent but not unknown, and are taken as
    written. An article needs a number of at least 1 and a text; a clause needs
    a number and a text, and an article number of at least 1 if it has one.
    Null or no clauses are sound.
    """
    clause = lambda f: F.coalesce(F.exists("clauses", f), F.lit(False))
    checks = [
        (F.coalesce(F.col("article_number") < 1, F.lit(True)), "article_number must be at least 1"), (blank("text"), "text must not be blank"), (_type_is_wrong(F.col("doc_type")), "doc_type is not listed"), (_status_is_wrong(F.col("status")), "status is not listed"),
        (clause(lambda c: F.coalesce(c["clause_number"], F.lit("")) == ""), "clause_number must not be empty"), (clause(lambda c: blank(c["text"])), "clause text must not be blank"), (clause(lambda c: F.coalesce(c["article_number"] < 1, F.lit(False))), "clause article_number must be at least 1"),
        (clause(lambda c: _type_is_wrong(c["doc_type"])), "clause doc_type is not listed"), (clause(lambda c: _status_is_wrong(c["status"])), "clause status is not listed"),
    ]
    return df.withColumn("contract_errors", reasons(*checks))


def split_contract(checked: DataFrame, synthetic: str = "is_synthetic_example", source: str = "source_dataset", name: str = "synthetic_example") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sound rows, rows with contract errors, and one row: counts of both, and whether all rows are sound and synthetic examples."""
    bad = F.size("contract_errors") > 0
    example = F.coalesce(F.col(synthetic), F.lit(False)) & (F.coalesce(F.col(source), F.lit("")) == name)
    summary = checked.agg(F.count_if(~bad).alias("ok"), F.count_if(bad).alias("broken"), F.coalesce(F.bool_and(~bad & example), F.lit(True)).alias("synthetic_only"))
    return checked.where(~bad).drop("contract_errors"), checked.where(bad), summary


def fixed_fields(df: DataFrame, wanted: dict[str, str | bool], expected_rows: int | None = None) -> DataFrame:
    """One row: ``rows``, for each field how many rows differ from what it must be (a null or missing field differs), ``bad_rows``, and ``as_expected``.

    It is as expected if no row is bad and there are ``expected_rows``, if given.
    """
    differs = {f: ~F.coalesce(F.col(f) == F.lit(v), F.lit(False)) if f in df.columns else F.lit(True) for f, v in wanted.items()}
    any_ = F.lit(False)
    for c in differs.values():
        any_ = any_ | c
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(f"wrong_{f}") for f, c in differs.items()], F.count_if(any_).alias("bad_rows"))
    right = F.col("bad_rows") == 0
    return counts.withColumn("as_expected", right & (F.col("rows") == expected_rows) if expected_rows is not None else right)


def lacking_fields(df: DataFrame, required: list[str]) -> list[str]:
    """The required columns that a table has not; a look at the schema only."""
    return [c for c in required if c not in df.columns]


def config_violations(config: dict[str, object], wanted: dict[str, object]) -> list[str]:
    """What a configuration, such as ``sources.readers.simple_config`` reads, says otherwise than wanted; keys as ``section.key``."""
    found = []
    for path, value in wanted.items():
        at: object = config
        for key in path.split("."):
            at = at.get(key) if isinstance(at, dict) else None
        if at != value or isinstance(at, bool) != isinstance(value, bool):
            found.append(f"{path} is {at!r}, not {value!r}")
    return found


def true_counts(df: DataFrame, flags: list[str]) -> DataFrame:
    """``flag, count``: rows in which a flag is true, or a word that means so; missing columns count nothing."""
    types = dict(df.dtypes)
    truth = {f: F.coalesce(F.col(f), F.lit(False)) if types[f] == "boolean" else F.lower(text_or(f)).isin(TRUE) for f in flags if f in types}
    counts = df.agg(*[(F.count_if(truth[f]) if f in truth else F.count_if(F.lit(False))).alias(f) for f in flags])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("count")) for f in flags])).alias("p")).select("p.*")
