"""Duplicates hidden by formatting differences.

Byte-identical rows are collapsed first, with their counts; only the distinct
survivors are brought to canonical form, and those are grouped again on the
full canonical text, summing the counts. No group is ever gathered: both
groupings are aggregations with partial sums before the shuffle, and the rows
are told their group by a join that the engine may split where one key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import composed, digest, letters_digits, written

_FIELD = r"[^\p{L}\p{N}\n]*[\p{L}\p{N}\p{M}_]+(?:[ \t_]+[\p{L}\p{N}\p{M}_]+){0,3}[ \t]*[:=]"
_JSON = "map<string,string>"


def _pair(name: Column, value: Column) -> Column:
    return F.concat(letters_digits(name), F.lit("\u001e"), letters_digits(value))


def canonical_fields(text: Column) -> Column:
    """Canonical form of a text that may be a JSON object or lines ``field: value``.

    Fields are sorted by name and value, each value staying with its field; a
    line that begins no field goes on with the value before. A text with fewer
    than two fields is canonical as plain letters and digits. Null is empty.
    """
    raw = F.coalesce(text, F.lit(""))
    object_ = F.when(raw.rlike(r"^\s*\{"), F.from_json(raw, _JSON, {"allowSingleQuotes": "false"}))
    pairs = F.transform(F.map_entries(object_), lambda e: _pair(e["key"], e["value"]))
    from_object = F.when(F.size(pairs) >= 2, F.array_join(F.array_sort(pairs), "\u001d"))
    # one separator before each line that begins a field
    cut = F.split(F.regexp_replace(raw, r"(?m)^(?=" + _FIELD + ")", "\u0001"), "\u0001")
    led = F.filter(cut, lambda x: x != "")
    parts = F.transform(led, lambda x: _pair(F.regexp_extract(x, "^" + _FIELD, 0), F.regexp_replace(x, "^" + _FIELD, "")))
    lines = raw.contains("\n") & (F.size(led) >= 2) & led[0].rlike("^" + _FIELD)
    from_lines = F.when(lines, F.array_join(F.array_sort(parts), "\u001d"))
    return F.coalesce(from_object, from_lines, letters_digits(raw))


def _raw_key(columns: list[str]) -> Column:
    """Stands for the bytes of the columns; null and empty are told apart."""
    return digest(*[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns])


def collapse_formatting(df: DataFrame, key: str, plain: list[str], fielded: list[str] | None = None, need_text: bool = True) -> DataFrame:
    """One row per group of equal records: ``group_key``, ``first_no`` (smallest ``key``), ``copies``.

    Records are equal if their ``plain`` columns agree as letters, with their marks in composed form, and digits
    and their ``fielded`` ones as fields in any order. Null counts as empty.
    With ``need_text`` records without any letter or digit are left out,
    otherwise they are equal to each other. Rows with a null ``key`` are left
    out. Other columns are not read.
    """
    fielded = fielded or []
    groups = _survivors(df, key, plain, fielded, need_text).groupBy("canonical").agg(F.min("first_no").alias("first_no"), F.sum("copies").alias("copies"))
    return groups.select(digest(F.col("canonical")).alias("group_key"), "first_no", "copies")


def _survivors(df: DataFrame, key: str, plain: list[str], fielded: list[str], need_text: bool) -> DataFrame:
    """The distinct raw records with their counts, canonical text and its digest, written to the shared folder.

    Written, because the engine would otherwise move tests of the canonical
    text before the first grouping, and so make it for every copy.
    """
    columns = plain + fielded
    raw = df.where(F.col(key).isNotNull()).select(F.col(key).alias("first_no"), *[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(columns)])
    names = [f"_c{i}" for i in range(len(columns))]
    distinct = raw.groupBy(*names).agg(F.min("first_no").alias("first_no"), F.count("*").alias("copies"))
    forms = [letters_digits(F.col(f"_n{i}")) for i in range(len(plain))] + [canonical_fields(F.col(f"_n{i}")) for i in range(len(plain), len(columns))]
    distinct = distinct.withColumns({f"_n{i}": composed(F.col(n)) for i, n in enumerate(names)})
    formed = distinct.select(_raw_key(names).alias("raw_key"), F.concat_ws("\u001f", *forms).alias("canonical"), "first_no", "copies")
    kept = written(formed.withColumn("form_key", digest(F.col("canonical"))))
    return kept.where(F.regexp_replace("canonical", "[\u001d-\u001f]", "") != "") if need_text else kept


def formatting_copies(df: DataFrame, key: str, plain: list[str], fielded: list[str] | None = None, need_text: bool = True) -> DataFrame:
    """``first_no`` and ``copy_no`` for every member of a group but its first.

    Takes the groups of ``collapse_formatting``; a group of one gives no row.
    Rows travel with 16-byte keys only, and of groups only those with copies.
    """
    fielded = fielded or []
    survivors = _survivors(df, key, plain, fielded, need_text)
    groups = survivors.groupBy("canonical").agg(F.min("first_no").alias("group_no"), F.sum("copies").alias("n")).where("n > 1").select(digest(F.col("canonical")).alias("form_key"), "group_no")
    forms = survivors.select("raw_key", "form_key").join(groups, "form_key").select("raw_key", "group_no")
    columns = plain + fielded
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("copy_no"), _raw_key(columns).alias("raw_key"))
    return rows.join(forms, "raw_key").where("copy_no <> group_no").select(F.col("group_no").alias("first_no"), "copy_no")
