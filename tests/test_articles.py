import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusgate.operators import articles as art

SCHEMA = "record_id string, source_dataset string, source_id string, source_url string, license string, retrieved_at string, title string, document_type string, document_number string, text string"


def docs(spark, *texts, **other):
    base = {"source_dataset": "s", "source_id": "1", "source_url": None, "license": "MIT", "retrieved_at": "now", "title": "t", "document_type": "luat", "document_number": "5"} | other
    return art.parse_documents(spark.createDataFrame([(str(i), *base.values(), t) for i, t in enumerate(texts)], SCHEMA))


def rows(spark, *texts):
    return art.articles(docs(spark, *texts), ["record_id"]).orderBy("record_id", "article_pos").collect()


def test_markers_titles_and_flags(spark):
    got = rows(spark, "mở đầu\nĐiều 1. Phạm vi\nnội dung " + "x" * 100 + "\n## Điều 2:\nngắn\n  Dieu 3 - Ba\nĐIỀU 4abc")
    assert [(r.article_number, r.article_title) for r in got] == [(1, "Phạm vi"), (2, None), (3, "Ba"), (4, "abc")]
    assert got[0].parse_flags == [] and got[1].parse_flags == ["article_title_missing", "markdown_heading_marker", "suspicious_short_article"]
    assert got[3].text == "ĐIỀU 4abc"


def test_label_heeds_case_and_place(spark):
    assert rows(spark, "theo Điều 5 của luật\nđiều 6. nhỏ\n    Điều 7. quá sâu") == []


def test_carriage_returns_and_mark_characters(spark):
    got = rows(spark, "Điều 1. A\r\nx\u0001y\r\nĐiều 2. B\r\nz")
    assert [(r.article_number, r.article_title, r.text) for r in got] == [(1, "A", "Điều 1. A\r\nxy"), (2, "B", "Điều 2. B\r\nz")]


def test_rejects_and_warnings(spark):
    parsed = docs(spark, "Điều 1. A", "trước\nĐiều 1. A", "không có", " ", None)
    reasons = {r.parent_record_id: r.reason for r in art.rejected_documents(parsed).collect()}
    assert reasons == {"2": "no_article_markers_detected", "3": "blank_document_text", "4": "blank_document_text"}
    assert [r.parent_record_id for r in art.parse_warnings(parsed).collect()] == ["1"]
    bad = docs(spark, "Điều 1. A", license=" ", source_id="")
    (r,) = art.rejected_documents(bad).collect()
    assert (r.reason, r.missing_fields) == ("missing_required_provenance", ["license", "source_id_or_source_url"])


def pack(text, most):
    """Plain model of the chunker."""
    content = text.strip()
    if len(content) <= most:
        return [content]
    out, held = [], ""
    for p in filter(None, (p.strip() for p in re.split(r"\n\s*\n", content))):
        joined = f"{held}\n\n{p}" if held else p
        if len(joined) <= most:
            held = joined
            continue
        if held:
            out.append(held)
            held = ""
        if len(p) <= most:
            held = p
            continue
        for line in filter(None, (x.strip() for x in p.splitlines())):
            joined = f"{held}\n{line}" if held else line
            if len(joined) <= most:
                held = joined
            else:
                if held:
                    out.append(held)
                held = line
    if held:
        out.append(held)
    return out or [content]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab đ\n.", max_size=120), min_size=1, max_size=20), st.integers(5, 40))
def test_chunks_match_the_plain_model(spark, texts, most):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.c for r in df.select("i", art.chunk_text(F.col("t"), most).alias("c")).collect()}
    assert got == {i: pack(t, most) for i, t in enumerate(texts)}


def test_candidates_and_metrics(spark):
    body = "\n\n".join("đoạn " + "y" * 60 for _ in range(4))
    parsed = docs(spark, f"Điều 1. A\n\n{body}\nĐiều 2. B\n" + "z" * 120, "không có")
    c = art.candidates(parsed, 100)
    got = c.orderBy("article_pos", "chunk_index").collect()
    assert {r.chunk_index for r in got if r.article_pos == 1} == {0, 1, 2, 3, 4} or len(got) > 3
    assert all("split_into_multiple_chunks" in r.parse_flags and r.uncertain_parse for r in got if r.article_pos == 1)
    assert all(not r.approved_for_rag_index and not r.is_legal_ground_truth for r in got)
    m = art.parse_metrics(parsed, c).first()
    assert (m.documents, m.rejected_documents, m.candidates, m.provenance_coverage) == (2, 1, len(got), 1.0)
    none = docs(spark)
    assert art.parse_metrics(none, art.candidates(none)).first().candidates == 0


@pytest.mark.parametrize("text,n", [("Điều 1\n dieu 2", 2), ("xem điều 3", 0), (None, 0), ("\n\nDIEU 4", 1)])
def test_audit_counts_by_its_own_pattern(spark, text, n):
    assert spark.createDataFrame([(text,)], "t string").select(art.audit_marker_count(F.col("t"))).first()[0] == n
