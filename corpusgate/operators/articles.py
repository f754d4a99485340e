"""Documents into articles, and articles into chunks.

An article begins at a line with an article label and a number. Instead of
finding offsets, a mark is put before each such line and the text is split
there, so the whole parse is one projection and one explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import blank, hash16, rate, reasons, sorted_set, utrim

PARSER_VERSION = "corpusgate_articles_v1"
NEAR_EMPTY, SHORTEST, LONGEST, CHUNK = 50, 100, 50_000, 4_000
# The spellings of the article label, three of them garbled as they occur in sources.
LABELS = ["Điều", "Dieu", "Äiá»u", "ÄIá»€U", "Ðiá»u", "ĐIỀU"]
# Fixed value: a marker line; groups: prefix, number, title. ``(?d)`` lets only a line feed end a line.
MARKER = r"(?md)^(\s{0,3}(?:#{1,6}\s*)?)(?:" + "|".join(LABELS) + r")\s+(\d+)[ \t]*(?:[.:]|-)?[ \t]*([^\n]*)$"
# Fixed value: the audit counts by a looser pattern of its own.
AUDIT_MARKER = r"(?iuU)(?:^|\n)\s*(?:dieu|điều)\s+\d+"
_MARK = "\u0001"


def split_articles(text: Column) -> Column:
    """Array of the pieces of a text before each marker line; the first is what precedes all, often empty."""
    clean = F.translate(text, _MARK, "")
    return F.split(F.regexp_replace(clean, MARKER, _MARK + "$0"), _MARK, -1)


def audit_marker_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(AUDIT_MARKER))


def chunk_text(text: Column, most: int = CHUNK) -> Column:
    """Paragraphs packed greedily into chunks of up to ``most`` characters.

    A paragraph that does not fit by itself is packed line by line, and what
    is left of it may take in later paragraphs; a single longer line stays
    whole. Blank text gives one empty chunk, null gives null.
    """
    content = utrim(text)
    trimmed = lambda parts: F.filter(F.transform(parts, utrim), lambda p: p != "")
    paragraphs = trimmed(F.split(content, r"\n(?U)\s*\n"))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("held"))

    def fold(state: Column, part: Column, glue: str) -> Column:
        joined = F.when(state["held"] == "", part).otherwise(F.concat(state["held"], F.lit(glue), part))
        flushed = F.when(state["held"] == "", state["done"]).otherwise(F.concat(state["done"], F.array(state["held"])))
        return F.when(F.length(joined) <= most, F.struct(state["done"].alias("done"), joined.alias("held"))).otherwise(F.struct(flushed.alias("done"), part.alias("held")))

    def paragraph(state: Column, p: Column) -> Column:
        both = F.when(state["held"] == "", p).otherwise(F.concat(state["held"], F.lit("\n\n"), p))
        flushed = F.when(state["held"] == "", state["done"]).otherwise(F.concat(state["done"], F.array(state["held"])))
        lines = F.aggregate(trimmed(F.split(p, r"\R")), F.struct(flushed.alias("done"), F.lit("").alias("held")), lambda s, x: fold(s, x, "\n"))
        return (
            F.when(F.length(both) <= most, F.struct(state["done"].alias("done"), both.alias("held")))
            .when(F.length(p) <= most, F.struct(flushed.alias("done"), p.alias("held")))
            .otherwise(lines)
        )

    def finish(s: Column) -> Column:
        out = F.when(s["held"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["held"])))
        return F.when(F.size(out) > 0, out).otherwise(F.array(content))

    return F.when(F.length(content) <= most, F.array(content)).otherwise(F.aggregate(paragraphs, start, paragraph, finish))


def missing_provenance(df: DataFrame) -> Column:
    """Names of the provenance fields a document lacks; a source id or a source URL will do."""
    return reasons(
        (blank("source_dataset"), "source_dataset"), (blank("license"), "license"), (blank("retrieved_at"), "retrieved_at"), (blank("record_id"), "record_id"), (blank("source_id") & blank("source_url"), "source_id_or_source_url"),
    )


def parse_documents(df: DataFrame) -> DataFrame:
    """Documents with ``pieces``, ``missing_fields`` and the ``reason`` why a document is rejected, or null."""
    staged = df.withColumn("missing_fields", missing_provenance(df)).withColumn("pieces", F.when(~blank("text"), split_articles(utrim("text"))))
    why = F.when(F.size("missing_fields") > 0, "missing_required_provenance").when(blank("text"), "blank_document_text").when(F.size("pieces") < 2, "no_article_markers_detected")
    return staged.withColumn("reason", why)


def rejected_documents(parsed: DataFrame) -> DataFrame:
    return parsed.where("reason is not null").select(F.col("record_id").alias("parent_record_id"), "source_id", "reason", "missing_fields")


def parse_warnings(parsed: DataFrame) -> DataFrame:
    """One row for each document with text before its first article."""
    early = parsed.where("reason is null").where(~blank(F.col("pieces")[0]))
    return early.select(
        F.col("record_id").alias("parent_record_id"), "source_id", F.lit("preamble_before_first_article").alias("code"), F.lit("Document contains non-empty preamble before the first article marker.").alias("message")
    )


def articles(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """One row per article: the ``keep`` columns, ``article_pos`` from 1, number, title, text and flags."""
    # a document without text or marker has no piece beyond the first; to ask for its reason, or to explode without the
    # outer form, would make the engine split the text once more for a filter
    rows = parsed.where(F.size("missing_fields") == 0).select(*keep, F.posexplode_outer("pieces").alias("article_pos", "piece")).where("article_pos > 0")
    title = utrim(F.regexp_extract("piece", MARKER, 3))
    title = F.when(title.rlike(r"^[.:\-]*$"), None).otherwise(title)
    heading = F.startswith(utrim(F.regexp_extract("piece", MARKER, 1)), F.lit("#"))
    text = utrim("piece")
    flags = reasons((heading, "markdown_heading_marker"), (title.isNull(), "article_title_missing"), (F.length(text) < SHORTEST, "suspicious_short_article"), (F.length(text) > LONGEST, "suspicious_long_article"))
    return rows.select(*keep, "article_pos", F.regexp_extract("piece", MARKER, 2).try_cast("int").alias("article_number"), title.alias("article_title"), text.alias("text"), F.array_sort(flags).alias("parse_flags"))


def candidates(parsed: DataFrame, most: int = CHUNK) -> DataFrame:
    """One row per chunk of each article, with the parent's provenance, flags and text hash."""
    provenance = [F.col("record_id").alias("parent_record_id"), "source_dataset", "source_id", "source_url", "license", "retrieved_at", "title", F.col("document_type").alias("parent_document_type"), F.col("document_number").alias("parent_document_number")]
    keep = ["record_id", "source_dataset", "source_id", "source_url", "license", "retrieved_at", "title", "document_type", "document_number"]
    rows = articles(parsed, keep).withColumn("chunks", chunk_text(F.col("text"), most))
    split = F.when(F.size("chunks") > 1, F.concat("parse_flags", F.array(F.lit("split_into_multiple_chunks")))).otherwise(F.col("parse_flags"))
    out = rows.select(*provenance, "article_pos", "article_number", "article_title", sorted_set(split).alias("parse_flags"), F.posexplode_outer("chunks").alias("chunk_index", "text"))
    return out.withColumns({"text_hash": hash16("text"), "parser_version": F.lit(PARSER_VERSION), "uncertain_parse": F.size("parse_flags") > 0, "is_legal_ground_truth": F.lit(False), "approved_for_rag_index": F.lit(False)})


def parse_metrics(parsed: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row of counts over documents and their candidates; an empty table gives zeros."""
    marks = F.when(~blank("text"), F.size(split_articles(F.col("text"))) - 1).otherwise(0)
    docs = parsed.select(marks.alias("m"), F.size("missing_fields").alias("lacks"), F.col("reason").isNotNull().alias("bad"), (~blank(F.col("pieces")[0]) & F.col("reason").isNull()).alias("early")).agg(
        F.count("*").alias("documents"), F.count_if("bad").alias("rejected_documents"), F.count_if(F.col("lacks") == 0).alias("with_provenance"), F.count_if(F.col("m") > 0).alias("documents_with_markers"),
        F.count_if(F.col("m") == 0).alias("documents_without_markers"), F.count_if(F.col("m") == 1).alias("documents_with_one_article"), F.count_if(F.col("m") > 1).alias("documents_with_several_articles"), F.count_if("early").alias("warnings"),
    )
    n = F.length("text")
    rows = chunks.agg(
        F.count("*").alias("candidates"), (F.count("*") - F.count_distinct("text_hash")).alias("duplicate_hashes"), F.count_if(n == 0).alias("empty"), F.count_if(n <= NEAR_EMPTY).alias("near_empty"),
        F.count_if((n < SHORTEST) | (n > LONGEST)).alias("suspicious_length"), F.count("article_number").alias("with_number"), F.count_if("uncertain_parse").alias("uncertain"),
    )
    both = docs.crossJoin(F.broadcast(rows))  # one row each
    rates = {"provenance_coverage": rate(F.col("with_provenance"), F.col("documents")), "article_number_rate": rate(F.col("with_number"), F.col("candidates"))}
    return both.withColumns(rates).drop("with_provenance", "with_number")
