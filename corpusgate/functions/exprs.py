"""Column builders used by all operators. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utrim(c: Column | str) -> Column:
    """Trims white space in the Unicode sense; null stays null."""
    return F.regexp_replace(as_col(c).cast("string"), r"(?U)^\s+|\s+$", "")


def text_or(c: Column | str, default: str = "") -> Column:
    """Trimmed text, or the default for null and blank."""
    return F.coalesce(F.nullif(utrim(c), F.lit("")), F.lit(default))


def blank(c: Column | str) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(utrim(c), F.lit("")) == ""


def first_truthy(*columns: Column | str) -> Column:
    """The first value that is neither null nor the empty string nor the number 0. White space counts as a value."""
    return F.coalesce(*[F.nullif(as_col(c).cast("string"), F.lit("")) for c in columns])


def hash16(c: Column | str) -> Column:
    return F.substring(F.sha2(as_col(c), 256), 1, 16)


def piped(*columns: Column | str) -> Column:
    """Values joined by ``|``, null as empty."""
    return F.concat_ws("|", *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in columns])


def one_of(c: Column | str, values: Iterable[str], default: str | None) -> Column:
    """Lower-case trimmed text if listed, else the default."""
    tidy = F.lower(utrim(c))
    return F.when(tidy.isin(list(values)), tidy).otherwise(F.lit(default))


def lenient_int(c: Column | str) -> Column:
    """Whole number of trimmed text; anything else is null. Fractions are not cut."""
    return F.when(utrim(c).rlike(r"^[+-]?\d+$"), utrim(c).try_cast("int"))


def rate(numerator: Column, denominator: Column, digits: int = 6) -> Column:
    """Rounded quotient, half to even; 0 where the denominator is 0."""
    return F.when(denominator > 0, F.bround(numerator / denominator, digits)).otherwise(F.lit(0.0))


def reasons(*pairs: tuple[Column, str]) -> Column:
    """The texts whose conditions hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(t)) for c, t in pairs])).cast("array<string>")


def sorted_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def contains_any(text: Column | str, phrases: Iterable[str]) -> Column:
    """Whether any of the phrases stands in the text, whatever its case; null text holds none."""
    low = F.lower(F.coalesce(as_col(text), F.lit("")))
    return any_of(F.contains(low, F.lit(p.lower())) for p in phrases)


def contains_all(text: Column | str, phrases: Iterable[str]) -> Column:
    """Whether all of the phrases stand in the text, whatever its case; null text holds none, and no phrases are all held."""
    low = F.lower(F.coalesce(as_col(text), F.lit("")))
    return reduce(lambda a, b: a & b, [F.contains(low, F.lit(p.lower())) for p in phrases], F.lit(True))


def preview(c: Column | str, most: int = 80) -> Column:
    """Text cut to ``most`` characters, the last three of them dots."""
    return F.when(F.length(as_col(c)) > most, F.concat(F.substring(as_col(c), 1, most - 3), F.lit("..."))).otherwise(as_col(c))


def word_count(c: Column | str) -> Column:
    trimmed = utrim(c)
    return F.when(F.coalesce(trimmed, F.lit("")) == "", 0).otherwise(F.size(F.split(trimmed, r"(?U)\s+")))
