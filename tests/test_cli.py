import json
import os

import pytest

from corpusgate.cli import COMMANDS, main, parser


def read(folder):
    out = []
    for base, _, files in os.walk(folder):
        for f in sorted(files):
            if f.startswith("part"):
                out += [json.loads(x) for x in open(os.path.join(base, f), encoding="utf-8")]
    return out


def lines(path, rows):
    path.write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_from_raw_to_manifest(spark, tmp_path):
    t = lambda *p: str(tmp_path.joinpath(*p))
    body = "nội dung " * 30
    raw = lines(tmp_path / "raw.jsonl", [{"doc_id": str(i), "source_url": "u", "doc_type": "luat", "title": "t", "text": f"mở đầu\nĐiều 1. A {i}\n{body}{i}\nĐiều 2. B\n{body}"} for i in range(4)] + [{"doc_id": "x", "text": " "}])
    run = lambda *a: main(list(a), spark)
    assert run("ingest", "--input", raw, "--output", t("in"), "--dataset", "d", "--url", "u", "--license", "MIT") == 2  # one of five has no text
    assert len(read(t("in", "normalized"))) == 4 and len(read(t("in", "rejected"))) == 1 and json.load(open(t("in", "quality_report.json")))["violations"]
    assert json.loads(read(t("in", "rejected"))[0]["raw_record"])["doc_id"] == "x" and json.load(open(t("in", "provenance_manifest.json")))["actual_records_seen"] == 5
    assert run("parse", "--input", t("in", "normalized"), "--output", t("p"), "--strict") == 0
    assert len(read(t("p", "candidates"))) == 8 and len(read(t("p", "warnings"))) == 4
    assert run("filter", "--input", t("p", "candidates"), "--warnings", t("p", "warnings"), "--output", t("f")) == 0
    assert json.load(open(t("f", "filter_report.json")))["duplicate_candidates_rejected"] == 3
    assert run("sample", "--input", t("p", "candidates"), "--output", t("s"), "--size", "10") == 0
    os.rename(t("s", "review_form"), t("form.csv"))
    assert run("fill", "--input", t("form.csv"), "--output", t("done.csv"), "--reviewer", "r", "--notes", "n", "--label", "accept_for_later_corpus_candidate") == 0
    assert run("review", "--input", t("done.csv"), "--output", t("r")) == 0
    accepted = [r for r in read(t("r", "outcomes")) if r["bucket"] == "accepted"]
    assert accepted and len(read(t("s", "review_sample"))) == len(accepted)
    assert run("manifest", "--accepted", t("r", "outcomes"), "--reviews", t("done.csv"), "--samples", t("s", "review_sample"), "--filtered", t("f", "decided"), "--output", t("m")) == 0
    assert json.load(open(t("m", "manifest_report.json")))["written"] == len(accepted)
    assert run("review", "--input", t("form.csv"), "--output", t("r2")) == 2  # the form is not filled


def test_instruction_track(spark, tmp_path, capsys):
    t = lambda *p: str(tmp_path.joinpath(*p))
    run = lambda *a: main(list(a), spark)
    assert run("synth", "--count", "40", "--output", t("rows")) == 0
    assert run("validate", "--input", t("rows"), "--report", t("report.json")) == 0
    assert json.load(open(t("report.json")))["duplicates"]["id"] == 0
    assert run("split", "--input", t("rows"), "--output", t("split")) == 0
    assert [len(read(t("split", f"split_name={s}"))) for s in ("train", "validation", "test")] == [32, 4, 4]
    assert run("package", "--input", t("split"), "--output", t("pack"), "--archive", t("pack.zip")) == 0
    assert sum(1 for _ in open(t("pack", "train.jsonl"))) == 32 and os.path.exists(t("pack.zip"))
    with open(t("split", "split_name=test", "part-x.json"), "w") as f:
        f.write(open(t("pack", "train.jsonl")).readline())
    assert run("package", "--input", t("split"), "--output", t("pack2")) == 2 and "test.jsonl and train.jsonl share 1" in capsys.readouterr().out
    bad = lines(tmp_path / "bad.jsonl", [{"id": 1}])
    assert run("validate", "--input", bad) == 1
    assert run("split", "--input", t("rows"), "--output", t("split2"), "--train", "0.5") == 1
    assert run("synth", "--count", "5", "--output", t("rows"), "--inside", t("elsewhere")) == 1
    (tmp_path / "policy.txt").write_text("# push\nnever Push_to_hub here\n")
    assert run("scan", "--input", t("policy.txt"), "--phrase", "push_to_hub") == 2 and "policy.txt:2" in capsys.readouterr().out
    assert run("inspect", "--input", bad) == 0 and run("content", "--input", t("nothing"), "--report", t("r.json")) == 1


def test_of_identical_candidates_the_first_is_kept(spark, tmp_path):
    row = {"parent_record_id": "p", "source_dataset": "d", "source_id": "s", "source_url": "u", "license": "MIT", "retrieved_at": "now", "text": "một hai ba bốn năm " * 30, "parse_flags": ["x"]}
    raw = lines(tmp_path / "c.jsonl", [row, row | {"text": "khác hẳn " * 40}, row, row])
    assert main(["filter", "--input", raw, "--output", str(tmp_path / "f")], spark) == 0
    got = {r["input_index"]: r["filter_decision"] for r in read(str(tmp_path / "f" / "decided"))}
    assert got == {0: "keep_candidate_for_human_review", 1: "keep_candidate_for_human_review", 2: "reject_duplicate_hash", 3: "reject_duplicate_hash"}


def test_ingest_beyond_the_cap(spark, tmp_path):
    raw = lines(tmp_path / "raw.jsonl", [{"doc_id": str(i), "doc_type": "luat", "title": "t", "text": f"văn bản {i}"} for i in range(1200)])
    common = ["ingest", "--input", raw, "--dataset", "d", "--url", "u", "--license", "MIT", "--max-records", "1200"]
    with pytest.warns(UserWarning, match="1200"):
        main([*common, "--output", str(tmp_path / "a")], spark)
    assert len(read(str(tmp_path / "a" / "normalized"))) == 1000
    main([*common, "--all", "--output", str(tmp_path / "b")], spark)
    assert len(read(str(tmp_path / "b" / "normalized"))) == 1200


def test_every_command_is_parsed():
    for name in COMMANDS:
        with pytest.raises(SystemExit):
            parser().parse_args([name, "--help"])
