"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tokenizer_dir


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mojibake import repair_encoding

    return repair_encoding(table(spark, sf_dir, "synthetic_legal_articles"), ["text", "title"], ["record_no"]).select("record_no", "field_name")


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mojibake import repair_encoding

    found = repair_encoding(table(spark, sf_dir, "synthetic_legal_articles"), ["text", "title"], ["record_no"])
    return found.select("record_no", "field_name", "spans", F.length("restored_text").alias("restored_chars"), F.md5("restored_text").alias("restored_md5"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pair_defects import find_pair_defects

    return find_pair_defects(table(spark, sf_dir, "sample_qa").select("row_no", "instruction", "input", "output")).where("defect is not null").select("row_no", "defect")


def p4_defect_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pair_defects import find_pair_defects

    found = find_pair_defects(table(spark, sf_dir, "sample_qa").select("instruction", "input", "output"))
    return found.select(F.explode("defects").alias("defect")).groupBy("defect").agg(F.count("*").alias("pairs"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lookalikes import unify_lookalikes

    found = unify_lookalikes(table(spark, sf_dir, "synthetic_legal_articles"), ["text", "document_title"], ["record_no"])
    return found.where("not garbled").select("record_no", "field_name")


def p5_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields that change, in their one form."""
    from .lookalikes import unify_lookalikes

    found = unify_lookalikes(table(spark, sf_dir, "synthetic_legal_articles"), ["text", "document_title"], ["record_no"])
    return found.where("not garbled").select("record_no", "field_name", "places", "unified_text")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .format_dups import formatting_copies

    articles = formatting_copies(table(spark, sf_dir, "synthetic_legal_articles"), "record_no", ["text"])
    answers = formatting_copies(table(spark, sf_dir, "sample_qa"), "row_no", ["instruction", "input"], ["output"], need_text=False)
    named = [d.select(F.lit(t).alias("table_name"), "first_no", "copy_no") for t, d in (("synthetic_legal_articles", articles), ("sample_qa", answers))]
    return named[0].unionByName(named[1])


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each group of articles and of QA rows, with its number of copies."""
    from .format_dups import collapse_formatting

    articles = collapse_formatting(table(spark, sf_dir, "synthetic_legal_articles"), "record_no", ["text"])
    answers = collapse_formatting(table(spark, sf_dir, "sample_qa"), "row_no", ["instruction", "input"], ["output"], need_text=False)
    named = [d.select(F.lit(t).alias("table_name"), "first_no", "copies") for t, d in (("synthetic_legal_articles", articles), ("sample_qa", answers))]
    return named[0].unionByName(named[1])


def _consensus(spark: SparkSession, sf_dir: str, least: int):
    from .consensus import LABELS, fit_consensus, votes_by_item

    reviews = table(spark, sf_dir, "reviewer_decisions_completed")
    items = votes_by_item(reviews, "candidate_id", "reviewer_id", "decision_label", "confidence", ["filter_decision", "sampling_bucket"], "review_row", LABELS, least)
    return fit_consensus(items)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .consensus import consensus_labels

    return consensus_labels(*_consensus(spark, sf_dir, 1)).where("annotators >= 3").select(F.col("item").alias("candidate_id"), "decision_label")


def p1_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the reviewers of each candidate agree, also beyond chance, with its label and how sure that is."""
    from .consensus import chance_corrected, consensus_labels

    coded, model = _consensus(spark, sf_dir, 1)
    found = chance_corrected(consensus_labels(coded, model), coded)
    return found.select(F.col("item").alias("candidate_id"), "decision_label", F.round("probability", 4).alias("probability"), "annotators", F.round("agreement", 4).alias("agreement"), F.round("kappa", 4).alias("kappa"))


def p1_reviewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .consensus import annotator_reliability

    return annotator_reliability(*_consensus(spark, sf_dir, 1)).select("reviewer_id", "votes", F.round("reliability", 4).alias("reliability"))


def _overlaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from .split_overlap import cross_split_overlaps

    return cross_split_overlaps(table(spark, sf_dir, "sample_qa"), "row_no", "split", ["instruction", "input"], ["output"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .split_overlap import spelled_out

    pairs = spelled_out(*_overlaps(spark, sf_dir))
    return pairs.select(F.least("train_key", "held_key").alias("row_no_a"), F.greatest("train_key", "held_key").alias("row_no_b"))


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps between texts, each named by the smallest row number of its side, with its number of copies there."""
    from .split_overlap import class_pairs

    pairs, _ = class_pairs(*_overlaps(spark, sf_dir))
    return pairs.select(F.col("train_first").alias("train_no"), F.col("held_first").alias("held_no"), "train_copies", "held_copies", F.round("overlap_fraction", 6).alias("overlap"), F.round("differing_words", 6).alias("differing"))


def p3_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every text that ``p3_classes`` names."""
    from .split_overlap import class_pairs

    _, members = class_pairs(*_overlaps(spark, sf_dir))
    return members.select(F.when(F.col("side") == 0, "train").otherwise("held_out").alias("side"), F.col("first_key").alias("first_no"), F.col("key").alias("row_no"))


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out records that overlap with training, by split and source."""
    pairs, members = _overlaps(spark, sf_dir)
    hit = pairs.groupBy("held_text").agg(F.max("overlap_fraction").alias("o")).join(members.where("side = 1").withColumnRenamed("text", "held_text"), "held_text")
    rows = table(spark, sf_dir, "sample_qa").where(F.col("split").isin("validation", "test")).select(F.col("row_no").alias("key"), "split", F.lower(F.trim("source")).alias("source"))
    joined = rows.join(hit.select("key", "o"), "key", "left")
    return joined.groupBy("split", "source").agg(F.count("*").alias("records"), F.count("o").alias("overlapping"), F.round(F.avg("o"), 6).alias("mean_overlap"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_windows

    windows = table(spark, sf_dir, "context_windows")
    return pack_windows(table(spark, sf_dir, "documents"), "doc_id", "text", windows, "window_name", "capacity_tokens", tokenizer_dir())


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir).withColumnRenamed("item", "doc_id")


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used for each window, and the part of their room that is filled."""
    windows = table(spark, sf_dir, "context_windows").select("window_name", "capacity_tokens")
    used = _packed(spark, sf_dir).groupBy("window_name").agg(F.countDistinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return used.join(F.broadcast(windows), "window_name").select("window_name", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("filled"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .leakage import find_leaks

    leaks = find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "heldout_items"), "item_id", "text")
    return leaks.select("doc_id", "item_id").distinct()


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items given away, with the number of documents that hold them and the largest part held."""
    from .leakage import find_leaks

    leaks = find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "heldout_items"), "item_id", "text")
    return leaks.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.round(F.max("covered"), 6).alias("largest_part"))


def p8_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold parts of items within an edit distance, also where no run of eight words is unbroken."""
    from .leakage import find_edited

    found = find_edited(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "heldout_items"), "item_id", "text")
    return found.select("doc_id", "item_id", F.round("covered", 6).alias("covered"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .shared_spans import shared_pairs, shared_spans

    _, classes, copies = shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    return shared_pairs(classes, copies).select(F.col("doc_a").alias("doc_id_a"), F.col("doc_b").alias("doc_id_b"))


def p9_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each document other documents hold."""
    from .shared_spans import coverage, shared_spans

    documents = table(spark, sf_dir, "documents")
    spans, _, copies = shared_spans(documents, "doc_id", "text")
    found = coverage(documents, "doc_id", "text", spans, copies)
    return found.select(F.col("doc").alias("doc_id"), "shared_chars", F.round("share", 6).alias("share"))


def p9_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of documents with a common span: a row for each member, with the number of others it is linked to by the set."""
    from .shared_spans import shared_spans, span_classes

    _, classes, copies = shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    return span_classes(classes, copies).select(F.col("class").alias("class_id"), F.col("doc").alias("doc_id"), (F.col("members") - 1).alias("links"))


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shared passages of every distinct text; a text that several rows have whole is one itself."""
    from .shared_spans import merged_spans, shared_spans

    documents = table(spark, sf_dir, "documents")
    spans, _, copies = shared_spans(documents, "doc_id", "text")
    texts = documents.select(F.col("doc_id").alias("doc"), "text")
    twins = copies.select("doc").distinct().join(texts, "doc").select("doc", F.lit(0).cast("long").alias("start"), F.length("text").cast("long").alias("length"))
    found = merged_spans(spans.unionByName(twins)).join(texts, "doc")
    return found.select(F.col("doc").alias("doc_id"), F.col("start").alias("span_start"), F.col("length").alias("span_chars"), F.expr("substring(text, cast(start + 1 as int), cast(length as int))").alias("passage"))


QUERIES = {f.__name__: f for f in (p1_found, p1_agreement, p1_reviewers, p2_found, p2_restored, p3_found, p3_classes, p3_members, p3_report, p4_found, p4_defect_types, p5_found, p5_unified, p6_found, p6_groups, p7_packed, p7_fill, p8_found, p8_edited, p8_items, p9_found, p9_classes, p9_coverage, p9_passages)}


_FORM = r"regexp_replace(lower(nfc_normalize({})), '[^\p{{L}}\p{{N}}\p{{M}}]+', '', 'g')"

#: SQL of the queries that SQL can express over whole tables.
ORACLE_SQL: dict[str, str] = {}
_FIELD_SQL = r"[^\p{L}\p{N}\n]*[\p{L}\p{N}\p{M}_]+(?:[ \t_]+[\p{L}\p{N}\p{M}_]+){0,3}[ \t]*[:=]"


def _form(c: str) -> str:
    return _FORM.format(c)


_PAIR_SQL = "{} || chr(30) || {}"
_COPIES_SQL = rf"""
    WITH qa AS (
        SELECT row_no, instruction, input, coalesce(output, '') AS raw FROM sample_qa
    ), cut AS (
        SELECT *, CASE WHEN regexp_matches(raw, '^\s*\{{') AND json_valid(raw) THEN list_transform(json_keys(raw), lambda k: {_PAIR_SQL.format(_form("k"), _form("coalesce(json_extract_string(raw, '$.\"' || k || '\"'), '')"))}) END AS pairs,
               list_filter(string_split(regexp_replace(raw, '(?m)^({_FIELD_SQL})', chr(1) || '\1', 'g'), chr(1)), lambda x: x <> '') AS led
        FROM qa
    ), fields AS (
        SELECT *, CASE WHEN contains(raw, chr(10)) AND len(led) >= 2 AND regexp_matches(led[1], '^{_FIELD_SQL}')
                       THEN list_transform(led, lambda x: {_PAIR_SQL.format(_form(f"regexp_extract(x, '^{_FIELD_SQL}')"), _form(f"regexp_replace(x, '^{_FIELD_SQL}', '')"))}) END AS lines
        FROM cut
    ), forms AS (
        SELECT 'sample_qa' AS table_name, row_no AS no, {_form("coalesce(instruction, '')")} || chr(31) || {_form("coalesce(input, '')")} || chr(31) ||
               CASE WHEN len(pairs) >= 2 THEN array_to_string(list_sort(pairs), chr(29)) WHEN lines IS NOT NULL THEN array_to_string(list_sort(lines), chr(29)) ELSE {_form("raw")} END AS canonical
        FROM fields
        UNION ALL
        SELECT 'synthetic_legal_articles', record_no, {_form("text")} FROM synthetic_legal_articles WHERE {_form("text")} <> ''
    )
"""
ORACLE_SQL["p6_groups"] = _COPIES_SQL + "SELECT table_name, min(no) AS first_no, count(*) AS copies FROM forms GROUP BY table_name, canonical"
ORACLE_SQL["p6_found"] = _COPIES_SQL + """
    SELECT table_name, first_no, no AS copy_no FROM (SELECT table_name, no, min(no) OVER (PARTITION BY table_name, canonical) AS first_no FROM forms) WHERE no <> first_no
"""
# every window of 300 characters of every text, by brute force
ORACLE_SQL["p9_found"] = """
    WITH windows AS (
        SELECT DISTINCT doc_id, md5(substr(text, place, 300)) AS w FROM (SELECT doc_id, text, unnest(range(1, length(text) - 298)) AS place FROM documents WHERE length(text) >= 300)
    ), held AS (
        SELECT w, list(doc_id) AS docs FROM windows GROUP BY w HAVING count(*) > 1
    ), sets AS (SELECT DISTINCT list_sort(docs) AS docs FROM held)
    SELECT DISTINCT a AS doc_id_a, b AS doc_id_b FROM (SELECT unnest(docs) AS a, docs FROM sets) JOIN LATERAL (SELECT unnest(docs) AS b) ON a < b
"""
ORACLE_SQL["p9_coverage"] = """
    WITH windows AS (
        SELECT doc_id, place, md5(substr(text, place, 300)) AS w FROM (SELECT doc_id, text, unnest(range(1, length(text) - 298)) AS place FROM documents WHERE length(text) >= 300)
    ), held AS (
        SELECT w FROM windows GROUP BY w HAVING count(DISTINCT doc_id) > 1
    ), covered AS (
        SELECT doc_id, least(300, coalesce(lead(place) OVER (PARTITION BY doc_id ORDER BY place) - place, 300)) AS chars FROM windows SEMI JOIN held USING (w)
    )
    SELECT doc_id, CAST(sum(chars) AS BIGINT) AS shared_chars, round(sum(chars) / any_value(length(d.text)), 6) AS share FROM covered JOIN documents d USING (doc_id) GROUP BY doc_id
"""
# runs of eight words or more by their eight-word windows, and chains of runs in order
_WORDS_SQL = r"regexp_extract_all(replace(lower(strip_accents({})), 'đ', 'd'), '[\p{{L}}\p{{N}}]+')"
ORACLE_SQL["p8_found"] = f"""
WITH RECURSIVE items AS (
    SELECT item_id, {_WORDS_SQL.format('text')} AS w FROM heldout_items WHERE text IS NOT NULL
), item_grams AS (
    SELECT item_id, i, array_to_string(w[i:i+7], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS i FROM items WHERE len(w) >= 8)
), docs AS (
    SELECT doc_id, {_WORDS_SQL.format('text')} AS w FROM documents WHERE text IS NOT NULL
), doc_grams AS (
    SELECT doc_id, j, array_to_string(w[j:j+7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS j FROM docs WHERE len(w) >= 8)
), met AS (
    SELECT doc_id, item_id, i, j, i - row_number() OVER (PARTITION BY doc_id, item_id, j - i ORDER BY i) AS island FROM doc_grams JOIN item_grams USING (g)
), runs AS (
    SELECT doc_id, item_id, min(i) AS i, min(j) AS j, count(*) + 7 AS n FROM met GROUP BY doc_id, item_id, j - i, island
), sized AS (
    SELECT r.*, len(w) AS size, CAST(floor(len(w) * 1.5) AS BIGINT) AS width FROM runs r JOIN items USING (item_id)
), chains AS (
    SELECT doc_id, item_id, size, j + width AS high, i + least(n, width) AS i_end, j + least(n, width) AS j_end, least(n, width) AS total FROM sized
    UNION
    SELECT c.doc_id, c.item_id, c.size, high, i + m, j + m, total + m - lost FROM (
        SELECT c.*, s.i, s.j, least(s.n, c.high - s.j) AS m, greatest(0, c.i_end - s.i, c.j_end - s.j) AS lost FROM chains c JOIN sized s USING (doc_id, item_id) WHERE s.i > c.i_end - s.n AND s.j > c.j_end - s.n AND s.i + s.n > c.i_end AND s.j + s.n > c.j_end
    ) c WHERE m - lost >= 8
)
SELECT doc_id, item_id FROM chains GROUP BY doc_id, item_id, size HAVING max(total) * 2 > size
"""
