from pyspark.sql import functions as F

from corpusgate.operators import audit, instructions

ROW = {
    "id": "synthetic-demo-000001", "instruction": "Explain.", "input": "", "output": "Synthetic answer.", "source": "synthetic-demo", "format": "alpaca", "domain": "vietnamese-legal-demo", "task_type": "explanation", "difficulty": "easy",
    "is_synthetic": True, "is_legal_ground_truth": False, "approved_for_rag_index": False, "disclaimer": "Synthetic demo data. Not legal advice.",
}
SCHEMA = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'string'}" for k, v in ROW.items())


def errors(spark, **change):
    return instructions.validate_rows(spark.createDataFrame([tuple((ROW | change).values())], SCHEMA)).first().errors


def test_validation_is_staged(spark):
    assert errors(spark) == []
    assert errors(spark, instruction=None, output=" ", id="x") == ["instruction must be a string."]
    assert errors(spark, output=" ", id="x") == ["output must not be blank."]
    assert errors(spark, input=None) == ["input must be a string."]
    assert errors(spark, id="x", source="y", task_type="z", is_synthetic=None, is_legal_ground_truth=True, disclaimer="Demo", output="This is OFFICIAL legal text") == [
        "id must start with synthetic-demo-.", "source must equal synthetic-demo.", "task_type is invalid: z", "is_synthetic must be true.", "is_legal_ground_truth must be false.", "disclaimer must mention: synthetic",
        "disclaimer must mention: not legal advice", "Row must not claim official legal authority.",
    ]
    df = spark.createDataFrame([tuple(ROW.values())], SCHEMA)
    assert instructions.validate_rows(df.drop("source", "id")).first().errors == ["Missing required field: id", "Missing required field: source"]
    assert instructions.validate_rows(df.withColumn("is_synthetic", F.lit(1))).first().errors == ["is_synthetic must be true."]


def test_duplicates_prompts_and_scores(spark):
    df = spark.createDataFrame([("1", "A", "", "x y z", "d"), ("1", "A", None, "x y z", None), ("2", " B", "ctx ", None, "d")], "id string, instruction string, input string, output string, disclaimer string")
    assert {r.measure: r.duplicates for r in instructions.duplicate_counts(df).collect()} == {"id": 1, "instruction": 1, "input": 1, "output": 1, "instruction_input_output": 1}
    got = [r[0] for r in df.select(instructions.prompt(False)).collect()]
    assert got[0] == "### Disclaimer\nd\n\n### Instruction\nA\n\n### Response\n" and got[2] == "### Disclaimer\nd\n\n### Instruction\nB\n\n### Context\nctx\n\n### Response\n"
    s = instructions.response_scores(spark.createDataFrame([("X y qqqqqqqqq", "x y z"), (None, None), ("short", "x")], "r string, e string"), "r", "e").collect()
    assert [(x.format_valid, round(x.overlap, 3), x.task_pass) for x in s] == [(True, 0.667, True), (False, 0.0, False), (False, 0.0, False)]


def test_templates(spark):
    rows = instructions.render_templates(spark, 7, {"instruction": ["{topic} {index}", "{case_anchor}"]}, {"topic": (["a", "b", "c"], 2)}).orderBy("index").collect()
    assert [r.instruction for r in rows] == ["a 1", "synthetic-demo-000002", "b 3", "synthetic-demo-000004", "c 5", "synthetic-demo-000006", "a 7"]


def test_line_scan(spark):
    df = spark.createDataFrame([(1, "a = 1\n  # Push here\nx.PUSH()\r\npush pull"), (2, None)], "k int, t string")
    assert sorted(map(tuple, instructions.lines_holding(df, "k", "t", ["push", "pull"]).collect())) == [(1, 3, "push"), (1, 4, "pull"), (1, 4, "push")]


def test_citations_heed_case_only_in_numbers(spark):
    texts = ["theo ĐIỀU 5", "khoan 3", "Bộ luật này", "12/2020/NĐ-CP", "12/2020/nđ", "điềutra", None, "luậtsư"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(audit.cites(F.col("t"))).collect()]
    assert got == [True, True, True, True, False, False, False, False]


def test_summary_of_some_and_of_none(spark):
    schema = "text string, title string, document_number string, document_type string"
    df = spark.createDataFrame([("Điều 1\nĐiều 2", "t", None, "luat"), ("x" * 60, " ", "1", None), (None, None, "", "luat")], schema)
    s = audit.content_summary(df).first()
    assert (s.records, s.total_chars, s.empty, s.near_empty, s.with_markers, s.with_several_markers, s.missing_title, s.median_chars) == (3, 73, 1, 2, 1, 1, 2, 13.0)
    e = audit.content_summary(df.limit(0)).first()
    assert (e.records, e.total_chars, e.median_chars) == (0, 0, 0.0)
    assert {r.field: r.present for r in audit.completeness(df, ["title", "document_type"]).collect()} == {"title": 1, "document_type": 2}
    assert {r.document_type: r["count"] for r in audit.histogram(df, "document_type", "MISSING").collect()} == {"luat": 2, "MISSING": 1}


def test_overlap_and_turns(spark):
    a = spark.createDataFrame([("x", "1"), ("x", ""), (None, "2")], "k string, v string")
    b = spark.createDataFrame([("x", "2"), ("x", "")], "k string, v string")
    assert {r.key: r.shared for r in audit.cross_overlap(a, b, {"k": F.col("k"), "v": F.col("v")}).collect()} == {"k": 1, "v": 1}
    t = spark.createDataFrame([("hỏi", [("user", " hỏi "), ("assistant", "theo Điều 2")]), ("khác", [("user", "hỏi")])], "text string, conversations array<struct<role:string,content:string>>")
    s = audit.turn_summary(t).first()
    assert (s.text_is_user_turn, s.assistant_turns, s.citing_turns, s.all_text_is_user_turn) == (1, 1, 1, False)
    assert audit.turn_summary(t.limit(0)).first().all_text_is_user_turn is True
