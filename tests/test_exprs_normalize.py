from pyspark.sql import functions as F

from corpusgate.functions import exprs
from corpusgate.operators import normalize, quality


def one(spark, schema, row, *columns):
    return spark.createDataFrame([row], schema).select(*columns).first()


def test_unicode_trim_and_blank(spark):
    r = one(spark, "a string, b string, c string", ("  x　", " \t", None), exprs.utrim("a").alias("a"), exprs.blank("b").alias("b"), exprs.blank("c").alias("c"), exprs.word_count("a").alias("n"))
    assert (r.a, r.b, r.c, r.n) == ("x", True, True, 1)


def test_first_truthy_is_not_trimmed(spark):
    r = one(spark, "a string, b string", ("", "  "), exprs.first_truthy("a", "b", F.lit("z")).alias("v"), exprs.text_or("b", "d").alias("t"))
    assert (r.v, r.t) == ("  ", "d")


def test_lenient_int(spark):
    values = [" 12 ", "3.5", "x", None, "-4", "99999999999"]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(exprs.lenient_int("v")).collect()]
    assert got == [12, None, None, None, -4, None]


def test_rate_rounds_half_to_even_and_guards_zero(spark):
    r = spark.range(1).select(exprs.rate(F.lit(1), F.lit(8), 2).alias("a"), exprs.rate(F.lit(3), F.lit(8), 2).alias("b"), exprs.rate(F.lit(1), F.lit(0)).alias("c")).first()
    assert (r.a, r.b, r.c) == (0.12, 0.38, 0.0)


def normalized(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return normalize.normalize(df, F.lit("set"), F.lit("url"), F.lit("MIT"), F.lit("now"))


def test_text_of_blanks_hides_later_names_then_falls_to_the_user_turn(spark):
    schema = "text string, content string, conversations array<struct<role:string,content:string>>"
    talk = [("system", "s"), ("user", " hỏi "), ("assistant", "đáp")]
    rows = [("   ", "hidden", talk), ("", "seen", talk), (None, None, [("assistant", "đáp")]), (None, None, None)]
    got = [(r.text, r.error) for r in normalized(spark, rows, schema).collect()]
    assert got == [("hỏi", None), ("seen", None), (None, "Record has no usable text field."), (None, "Record has no usable text field.")]


def test_record_fields(spark):
    schema = "text string, doc_id string, doc_type string, status string, article_number int, article_no string, note string, record_id string, output string"
    r = normalized(spark, [("điều", " d1 ", " LUAT ", "con hieu luc", 0, "7", "n" * 2001, "clash", "x")], schema).first()
    assert (r.source_id, r.document_type, r.effective_status, r.article_number) == ("d1", "luat", "unknown", 7)
    import hashlib
    import json

    assert r.record_id == hashlib.sha256("set|d1|điều".encode()).hexdigest()[:16]
    assert json.loads(r.raw_metadata).keys() == {"doc_id", "doc_type", "status", "article_number", "article_no", "record_id"}


def test_quality_of_a_batch_and_of_none(spark):
    rows = [("a", "d1", "1"), ("a", "d1", "2"), (None, "d2", None), ("b", None, "-3")]
    n = normalized(spark, rows, "text string, doc_id string, article_number string")
    m = quality.quality_metrics(n).first()
    assert (m.total_seen, m.total_rejected, m.parse_success_rate, m.duplicate_rate, m.malformed_article_rate) == (4, 1, 0.75, 0.333333, 0.333333)
    messages = {r.metric: r.message for r in quality.violations(quality.quality_metrics(n)).collect()}
    assert messages["parse_success_rate"] == "parse_success_rate=0.7500 < required 0.9900" and "duplicate_rate" in messages
    empty = quality.quality_metrics(n.limit(0)).first()
    assert empty.total_seen == 0 and empty.duplicate_rate == 0.0


def test_splitting_errors_keeps_every_row(spark):
    n = normalized(spark, [("a",), ("a",), (" ",)], "text string")
    good, bad = normalize.split_errors(n)
    assert good.count() == 2 and bad.count() == 1 and "error" not in good.columns
