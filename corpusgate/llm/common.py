"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import durable, written

__all__ = ["composed", "digest", "durable", "letters_digits", "sent_if_few", "table", "tokenizer_dir", "within", "without", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Up to so many keys, 8 bytes each, an anti join sends them to all executors.
MOST_KEYS_SENT = 500_000


def without(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not among ``keys``, a written or small table.

    The keys are counted first: few are broadcast, so the rows stay where they
    are; for more the engine's usual join shuffles both sides.
    """
    return df.join(sent_if_few(keys), key, "left_anti")


def within(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among ``keys``, which are counted first as in ``without``."""
    return df.join(sent_if_few(keys), key, "left_semi")


def sent_if_few(rows: DataFrame) -> DataFrame:
    """``rows``, a written or small table of short rows, marked to be broadcast in a join if they are few."""
    return F.broadcast(rows) if rows.limit(MOST_KEYS_SENT + 1).count() <= MOST_KEYS_SENT else rows


def composed(text: Column) -> Column:
    """Text in composed form (NFC). Worked out in the JVM, and only for texts with combining marks or letters that have another composed form."""
    odd = text.rlike(r"[\p{M}\x{1100}-\x{11FF}\x{0340}-\x{0344}\x{037E}\x{0387}\x{1F71}-\x{1FFD}\x{2126}-\x{212B}\x{F900}-\x{FAFF}]")
    return F.when(odd, F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))).otherwise(text)


def letters_digits(text: Column) -> Column:
    """Lower-case letters with their marks, and digits, of ``text`` in order, all else removed; null counts as empty. For text in composed form."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\p{M}]+", "")


def digest(*columns: Column) -> Column:
    """128 bits that stand for the columns' values as a binary value."""
    joined = F.concat_ws("\u001f", *columns)
    return F.unhex(F.substring(F.sha2(joined, 256), 1, 32))


def tokenizer_dir() -> str:
    """Folder with the public tokenizers' vocabulary files."""
    return os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
