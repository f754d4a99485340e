import pytest
from pyspark.sql import functions as F

from corpusgate.functions.exprs import contains_all
from corpusgate.operators import candidates, instructions, manifest, reviews, sampling
from corpusgate.sources import registry


def test_registry_names_aliases_and_unknown_names(spark):
    m = spark.createDataFrame([("a", "u", "MIT", True), ("b", None, None, None), (None, "x", "y", False)], "source_dataset string, dataset_url string, license string, license_confirmed boolean")
    known = registry.from_table(m, {"other": "a"})
    assert known.get("a") == known.get("other") and known.get("b").license == "" and known.get("a").license_confirmed
    with pytest.raises(KeyError, match="a, b, other"):
        known.get("c")
    df = spark.createDataFrame([("other",), ("c",), (None,)], "s string")
    assert [r[0] for r in df.select(known.resolved(df.s)).collect()] == ["a", None, None]
    with pytest.raises(Exception, match="unknown source"):
        df.select(known.resolved(df.s, strict=True)).collect()
    row = registry.provenance_record(spark, known.get("a"), 10, 7, "v1", "f.jsonl", retrieved_at="now").first()
    assert (row.source_dataset, row.actual_records_seen, row.offline_fixture_used, row.bulk_download_blocked, row.retrieved_at) == ("a", 7, "f.jsonl", True, "now")
    assert registry.from_table(m.limit(0)).sources == {} and df.select(registry.Registry({}).resolved(df.s)).where("1 = 1").count() == 3


def test_seeded_sample_coverage_and_split_overlaps(spark):
    df = spark.createDataFrame([(str(n), f"p{n % 3}", "d" if n % 2 else None, " ", "MIT") for n in range(40)], "id string, parent_record_id string, source_dataset string, source_id string, license string")
    a = {r.id for r in sampling.seeded_sample(df, "id", 7).collect()}
    assert len(a) == 7 and a == {r.id for r in sampling.seeded_sample(df.repartition(5), "id", 7).collect()} and sampling.seeded_sample(df, "id", 99).count() == 40
    with pytest.raises(ValueError):
        sampling.seeded_sample(df, "id", -1)
    c = sampling.sample_coverage(df).first()
    assert (c.sampled, c.parents_covered, c.source_ids_covered, c.source_datasets, c.licenses) == (40, 3, 0, ["d"], ["MIT"])
    parts = {"train": df.where("id < '3'"), "test": df.where("id >= '2'"), "none": df.limit(0)}
    shared = {(r.first, r.second): r.shared for r in instructions.split_overlaps(parts).collect()}
    assert shared[("test", "train")] == df.where("id >= '2' and id < '3'").count() > 0 and shared[("none", "test")] == 0


def test_union_of_outputs_and_counts(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, why string"), spark.createDataFrame([(2,), (3,)], "id int")
    assert sorted(map(tuple, candidates.union_outputs([a, b]).collect())) == [(1, "x"), (2, None), (3, None)]
    with pytest.raises(ValueError):
        candidates.union_outputs([])
    counted = {(r.field, r.value): r["count"] for r in reviews.value_counts(a.unionByName(a), ["why"]).collect()}
    assert counted == {("why", "x"): 2}
    accepted = spark.createDataFrame([(" a ",), ("a",), ("b",), (None,), (" ",)], "candidate_id string")
    assert tuple(manifest.accepted_counts(accepted).first()) == (3, 2, 1)
    df = spark.createDataFrame([("Hồ sơ và THỜI hạn",), ("hồ sơ",), (None,)], "t string")
    assert [r[0] for r in df.select(contains_all("t", ["hồ sơ", "thời hạn"])).collect()] == [True, False, False]


def test_manifest_carries_no_texts(spark):
    filtered = spark.createDataFrame([("c1", "p", "d", "long text" * 50)], "candidate_id string, parent_record_id string, source_dataset string, text string")
    ids = spark.createDataFrame([("c1",)], "candidate_id string")
    rows = manifest.first_rows(filtered, manifest.RECORD_ORDER, None, manifest.RECORD_FIELDS, ids)
    assert "text" not in rows.select("r.*").columns and rows.count() == 1
    assert manifest.first_rows(filtered, manifest.RECORD_ORDER, None, manifest.RECORD_FIELDS, ids.where(F.lit(False))).count() == 0
