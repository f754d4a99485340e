import os

import pytest

from corpusgate.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["candidate_id", "decision_label"], "p2_found": ["record_no", "field_name"], "p3_found": ["row_no_a", "row_no_b"], "p4_found": ["row_no", "defect"], "p5_found": ["record_no", "field_name"],
    "p6_found": ["table_name", "first_no", "copy_no"], "p8_found": ["doc_id", "item_id"], "p9_found": ["doc_id_a", "doc_id_b"],
}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_with_distinct_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    rows = df.collect()
    assert len(rows) == len(set(rows))
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_on_empty_tables(spark, empty_tables, name):
    assert QUERIES[name](spark, empty_tables).count() == 0 or name == "p3_report"
