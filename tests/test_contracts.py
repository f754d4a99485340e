from pyspark.sql import functions as F

from corpusgate.functions.exprs import preview
from corpusgate.operators import audit
from corpusgate.operators.contracts import config_violations, contract_errors, fixed_fields, lacking_fields, split_contract, true_counts
from corpusgate.sources.readers import simple_config

SCHEMA = "article_number int, text string, doc_type string, status string, clauses array<struct<clause_number:string,article_number:int,doc_type:string,status:string,text:string>>, contract_errors string"


def errors(spark, *row):
    return contract_errors(spark.createDataFrame([(*row, "clash")], SCHEMA)).first().contract_errors


def test_articles_and_clauses(spark):
    assert errors(spark, 1, "a", "luat", "in_force", None) == errors(spark, 1, "a", None, None, []) == []
    assert errors(spark, 0, " ", "LUAT", "con hieu luc", [("1", None, None, None, "a")]) == ["article_number must be at least 1", "text must not be blank", "doc_type is not listed", "status is not listed"]
    assert errors(spark, None, "a", None, None, [("", 0, "x", "y", None), (None, 1, None, None, "a")]) == [
        "article_number must be at least 1", "clause_number must not be empty", "clause text must not be blank", "clause article_number must be at least 1", "clause doc_type is not listed", "clause status is not listed",
    ]


def test_preview_and_notes(spark):
    got = [r[0] for r in spark.createDataFrame([("x" * 80,), ("y" * 81,), (None,)], "t string").select(preview("t")).collect()]
    assert got == ["x" * 80, "y" * 77 + "...", None]
    h = audit.histogram(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), "k")
    assert [tuple(r) for r in audit.annotated(h, "k", {"a": "n", "z": "m"}).collect()] == [("a", 2, "n")]
    assert audit.annotated(h.limit(0), "k", {"a": "n"}).agg(F.count("*")).first()[0] == 0


def test_split_fixed_fields_flags_and_configuration(spark):
    df = spark.createDataFrame([("a", True, "synthetic_example", []), ("b", True, "x", []), ("c", None, None, ["e"])], "id string, is_synthetic_example boolean, source_dataset string, contract_errors array<string>")
    ok, bad, summary = split_contract(df)
    assert (ok.count(), bad.first().id, tuple(summary.first())) == (2, "c", (2, 1, False)) and tuple(split_contract(df.limit(1))[2].first()) == (1, 0, True) and tuple(split_contract(df.limit(0))[2].first()) == (0, 0, True)
    r = fixed_fields(df, {"source_dataset": "x", "is_synthetic_example": True, "none": False}, 3).first()
    assert (r.rows, r.wrong_source_dataset, r.wrong_is_synthetic_example, r.wrong_none, r.bad_rows, r.as_expected) == (3, 2, 1, 3, 3, False)
    assert fixed_fields(df.limit(2), {"is_synthetic_example": True}, 2).first().as_expected and lacking_fields(df, ["id", "none"]) == ["none"]
    flags = spark.createDataFrame([(True, " YES ", 1), (None, "no", 2)], "a boolean, b string, c int")
    assert {r.flag: r["count"] for r in true_counts(flags, ["a", "b", "c", "missing"]).collect()} == {"a": 1, "b": 1, "c": 1, "missing": 0}
    config = simple_config("mode: scaffold_only\nsafety:\n  train: false\n  gate: true\n")
    assert config_violations(config, {"mode": "scaffold_only", "safety.train": False, "safety.gate": True}) == []
    assert config_violations(config, {"safety.train": True, "data.use": False}) == ["safety.train is False, not True", "data.use is None, not False"]
