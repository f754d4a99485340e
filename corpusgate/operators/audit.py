"""Content audits: completeness, lengths, markers, citations, overlaps between sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_of, blank, text_or, utrim
from .articles import NEAR_EMPTY, audit_marker_count
from .normalize import first_turn

# Patterns of a citation; the last heeds case.
CITATIONS = [
    r"(?iuU)\b(?:dieu|diều|điều)\s+\d+",
    r"(?iuU)\b(?:khoan|khoản)\s+\d+",
    r"(?iuU)\b(?:luat|luật|bo luat|bộ luật|nghi dinh|nghị định|thong tu|thông tư|quyet dinh|quyết định)\b",
    r"(?U)\b\d+/\d{4}/[A-ZĐ\-]+",
]


def cites(text: Column) -> Column:
    return any_of(F.coalesce(text, F.lit("")).rlike(p) for p in CITATIONS)


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """``field, present, total`` for each field; one aggregation, then a few rows."""
    a = df.agg(F.count("*").alias("total"), *[F.count_if(~blank(f)).alias(f"_{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("present")) for i, f in enumerate(fields)])
    return a.select(F.explode(rows).alias("r"), "total").select("r.*", "total")


def histogram(df: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Counts by value; null and empty are left out, or counted under ``missing``."""
    value = F.nullif(F.col(column).cast("string"), F.lit(""))
    value = F.coalesce(value, F.lit(missing)) if missing else value
    return df.select(value.alias(column)).where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))


def annotated(histogram_: DataFrame, column: str, notes: dict[str, str], note: str = "note") -> DataFrame:
    """Rows of a histogram whose value has a note, with it; the notes are a handful and are broadcast."""
    listed = histogram_.sparkSession.createDataFrame(list(notes.items()), f"{column} string, {note} string")
    return histogram_.join(F.broadcast(listed), column)


def content_summary(df: DataFrame, exact_median: bool = True) -> DataFrame:
    """Rows, mean and median length, empty and nearly empty texts, missing fields, marker counts.

    Lengths are of trimmed text. The median is exact by counting rows per
    length first, whose number the longest text bounds, so no task holds all
    lengths; without rows it is 0.
    """
    length = F.length(F.coalesce(utrim("text"), F.lit("")))
    marks = audit_marker_count(F.col("text"))
    a = df.select(length.alias("n"), marks.alias("m"), *[blank(c).alias(c) for c in ("title", "document_number", "document_type") if c in df.columns])
    have = [c for c in ("title", "document_number", "document_type") if c in df.columns]
    summary = a.agg(
        F.count("*").alias("records"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_chars"), F.count_if(F.col("n") == 0).alias("empty"), F.count_if(F.col("n") <= NEAR_EMPTY).alias("near_empty"),
        F.count_if(F.col("m") > 0).alias("with_markers"), F.count_if(F.col("m") > 1).alias("with_several_markers"), *[F.count_if(c).alias(f"missing_{c}") for c in have],
    )
    if not exact_median:
        return summary
    by_length = a.groupBy("n").agg(F.count("*").alias("k"))
    median = by_length.agg(F.coalesce(F.expr("percentile(n, 0.5, k)"), F.lit(0.0)).alias("median_chars"))
    return summary.crossJoin(F.broadcast(median))  # one row each


def turn_summary(df: DataFrame, conversations: str = "conversations", text: str = "text") -> DataFrame:
    """Whether texts are the user's turn, and how many assistant turns cite."""
    user, assistant = text_or(first_turn(F.col(conversations), "user")), text_or(first_turn(F.col(conversations), "assistant"))
    return df.agg(
        F.count("*").alias("records"), F.count_if((user != "") & (user == text_or(text))).alias("text_is_user_turn"), F.count_if(assistant != "").alias("assistant_turns"), F.count_if((assistant != "") & cites(assistant)).alias("citing_turns"),
        F.coalesce(F.sum(F.length(assistant)), F.lit(0)).alias("assistant_chars"), F.coalesce(F.bool_and(user == text_or(text)), F.lit(True)).alias("all_text_is_user_turn"),
        F.coalesce(F.bround(F.avg(F.when(assistant != "", F.length(assistant))), 2), F.lit(0.0)).alias("mean_assistant_chars"),
    )


def cross_overlap(a: DataFrame, b: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``key, shared`` for each key: distinct non-empty values that both tables hold.

    All keys go through one aggregation by 16-byte digests of the values.
    """
    def values(df: DataFrame, bit: int) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in keys.items()]))
        return df.select(pairs.alias("p")).select("p.*", F.lit(bit).alias("bit")).where("value <> ''").withColumn("value", F.substring(F.sha2("value", 256), 1, 32))

    seen = values(a, 1).unionByName(values(b, 2)).groupBy("key", "value").agg(F.bit_or("bit").alias("bits"))
    return seen.groupBy("key").agg(F.count_if(F.col("bits") == 3).alias("shared"))
