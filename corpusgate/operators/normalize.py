"""Raw records to normalised records, with rejects kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import first_truthy, hash16, lenient_int, one_of, text_or

TRANSFORM_VERSION = "corpusgate_normalize_v1"

# Document types and effective statuses.
DOCUMENT_TYPES = ["hien_phap", "bo_luat", "luat", "nghi_dinh", "thong_tu", "quyet_dinh", "nghi_quyet", "other"]
STATUSES = ["in_force", "expired", "amended", "unknown"]
# The names under which a field may come, first come first served.
ALIASES = {
    "text": ["text", "article_text", "content", "output"],
    "source_id": ["source_id", "doc_id", "id", "_id"],
    "document_type": ["doc_type", "type", "document_type"],
    "document_number": ["number", "doc_number", "law_number"],
    "title": ["title", "document_title", "name", "instruction"],
    "article_number": ["article_number", "article_no"],
    "clause_number": ["clause_number", "khoan"],
    "effective_status": ["status", "effective_status"],
}
TEXT_KEYS = ["text", "article_text", "content", "output", "input"]
LONGEST_METADATA = 2000


def _named(df: DataFrame, field: str) -> Column:
    types = dict(df.dtypes)
    # a number 0 is no value, the text "0" is one
    present = [F.col(f"`{c}`") if types[c] == "string" else F.nullif(F.col(f"`{c}`").cast("string"), F.lit("0")) for c in ALIASES[field] if c in types]
    return first_truthy(*present) if present else F.lit(None).cast("string")


def first_turn(conversations: Column, role: str) -> Column:
    """Content of the first turn with the role, or null."""
    return F.get(F.filter(conversations, lambda t: t["role"] == role), F.lit(0))["content"]


def metadata_json(df: DataFrame) -> Column:
    """The record's other fields as JSON, without text fields, binary columns and strings over 2,000 characters."""
    kept = []
    for f in df.schema.fields:
        if f.name in TEXT_KEYS or f.dataType.typeName() == "binary":
            continue
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "string":
            c = F.when(F.length(c) <= LONGEST_METADATA, c)
        kept.append(c.alias(f.name))
    return F.to_json(F.struct(*kept)) if kept else F.lit("{}")


def record_id(dataset: Column, source_id: Column, text: Column) -> Column:
    """First 16 hex digits of the SHA-256 of ``dataset|source id|first 200 characters``."""
    return hash16(F.concat_ws("|", dataset, source_id, F.substring(text, 1, 200)))


def normalize(df: DataFrame, dataset: Column, url: Column, license_: Column, retrieved_at: Column, keep_raw: bool = False) -> DataFrame:
    """Normalised records in 15 columns; those without any text carry ``error`` and null text.

    With ``keep_raw`` a rejected record also has its whole row as JSON in ``raw_record``.

    Fields are taken from the first of their names whose value is not empty,
    and only then trimmed: a text of blanks hides the later names, and falls
    to the first user turn of ``conversations`` if there is such a column.
    Extra columns go to ``raw_metadata``; equal rows stay equal rows.
    """
    text = text_or(_named(df, "text"))
    if "conversations" in df.columns:
        text = F.when(text == "", text_or(first_turn(F.col("conversations"), "user"))).otherwise(text)
    staged = df.select(
        dataset.alias("source_dataset"), url.alias("source_url"), text_or(_named(df, "source_id"), "UNKNOWN").alias("source_id"), license_.alias("license"), retrieved_at.alias("retrieved_at"),
        one_of(_named(df, "document_type"), DOCUMENT_TYPES, "other").alias("document_type"), text_or(_named(df, "document_number")).alias("document_number"), text_or(_named(df, "title")).alias("title"),
        lenient_int(_named(df, "article_number")).alias("article_number"), F.nullif(text_or(_named(df, "clause_number")), F.lit("")).alias("clause_number"),
        F.nullif(text, F.lit("")).alias("text"), one_of(_named(df, "effective_status"), STATUSES, "unknown").alias("effective_status"), metadata_json(df).alias("raw_metadata"),
        *([F.when(text == "", F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("raw_record")] if keep_raw else []),
    )
    return staged.select(
        record_id(F.coalesce("source_dataset", F.lit("")), F.col("source_id"), F.coalesce("text", F.lit(""))).alias("record_id"), "source_dataset", "source_url", "source_id", "license", "retrieved_at",
        F.lit(TRANSFORM_VERSION).alias("transform_version"), "document_type", "document_number", "title", "article_number", "clause_number", "text", "effective_status", "raw_metadata", *(["raw_record"] if keep_raw else []),
        F.when(F.col("text").isNull(), "Record has no usable text field.").alias("error"),
    )


def split_errors(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good records without the error column and the raw row, and the rejected ones with them."""
    return df.where(F.col(error).isNull()).drop(error, "raw_record"), df.where(F.col(error).isNotNull())
