import json
import os
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer
from threading import Thread

import pytest

from corpusgate.sources import readers, shared, writers
from corpusgate.streaming import ingest


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_lines_are_numbered_and_limits_count_what_they_say(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", '{"a": 1}\n\n{"a": 2}\n   \n{"a": 3}\n')
    assert [r.line_number for r in readers.numbered_lines(spark, p).collect()] == [1, 2, 3, 4, 5]
    assert [r.a for r in readers.first_records(spark, p, 2, "a int").orderBy("line_number").collect()] == [1, 2]
    assert [r.a for r in readers.first_records(spark, p, 2, "a int", blank_lines_count=True).collect()] == [1]
    rows, mode = readers.load_records(spark, 2, fixture=p)
    assert [json.loads(r.value)["a"] for r in rows.orderBy("ordinal").collect()] == [1, 2] and mode == "offline_fixture"
    with pytest.raises(ValueError):
        readers.load_records(spark, 2)
    with pytest.warns(UserWarning, match="5000"):
        assert readers.record_limit(5000) == 1000
    with pytest.raises(ValueError):
        readers.record_limit(0)


def test_numbers_over_several_files_and_splits(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    write(folder / "b.jsonl", "".join(f"b{n}\r\n" for n in range(500)))
    write(folder / "a.jsonl", "".join(f"a{n}\n" for n in range(300)) + "\nlast")
    write(folder / "c.jsonl", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = readers.numbered_lines(spark, str(folder)).collect()
        assert len({r.path for r in got}) == 2 and len(got) == 802
        assert all(r.value == f"{r.path[-7]}{r.line_number - 1}" for r in got if r.value not in ("", "last"))
        assert {r.line_number for r in got if r.value == "last"} == {302}
        rows = readers.indexed(spark.read.text(str(folder))).collect()
        assert sorted(r.input_index for r in rows) == list(range(802))
        assert {r.value for r in rows if r.input_index in (0, 302)} == {"a0", "b0"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.value for r in readers.first_lines(spark, str(folder), 301).collect()][-2:] == ["a299", "last"]
    assert [r.n for r in readers.indexed(spark.range(5).repartition(2), "n").orderBy("n").collect()] == list(range(5))


def test_remote_records_are_bounded_and_errors_name_them(spark, tmp_path):
    write(tmp_path / "r.jsonl", "".join(json.dumps({"a": n}) + "\n\n" for n in range(30)))
    write(tmp_path / "broken.jsonl", '{"a": 1}\n{\n')
    server = ThreadingHTTPServer(("127.0.0.1", 0), partial(SimpleHTTPRequestHandler, directory=str(tmp_path)))
    Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        rows, mode = readers.load_records(spark, 5, remote=f"{base}/r.jsonl")
        assert mode == "remote_stream" and [json.loads(r.value)["a"] for r in rows.orderBy("ordinal").collect()] == [0, 1, 2, 3, 4]
        for name in ("none.jsonl", "broken.jsonl"):
            with pytest.raises(Exception, match=name):
                readers.load_records(spark, 5, remote=f"{base}/{name}")[0].collect()
    finally:
        server.shutdown()


def test_checked_and_strict_json_lines(spark, tmp_path):
    p = write(tmp_path / "b.jsonl", '{"a": 1}\n[1]\n\n{broken\n')
    issues = {r.line_number: r.issue for r in readers.checked_jsonl(spark, p).collect()}
    assert issues == {1: None, 2: "Row must be a JSON object.", 4: "Invalid JSON."}
    with pytest.raises(ValueError, match="line 2"):
        readers.strict_jsonl(spark, p)
    with pytest.raises(Exception):  # noqa: B017
        readers.read_jsonl(spark, p, "a int").collect()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b\nc', ["x"], None)], "z int, note string, flags array<string>, empty string")
    writers.write_csv(df, str(tmp_path / "c"), ["note", "missing"])
    back = readers.read_csv(spark, str(tmp_path / "c"))
    assert back.columns == ["note", "missing", "empty", "flags", "z"]
    assert back.first().asDict() == {"note": 'a "q", b\nc', "missing": "", "empty": "", "flags": '["x"]', "z": "1"}


def test_json_lines_keep_nulls_and_are_not_clobbered(spark, tmp_path):
    out = str(tmp_path / "d")
    df = spark.createDataFrame([(2, None), (1, "x")], "a int, b string")
    writers.write_jsonl(df, out, order=["a"], one_file=True)
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.startswith("part"))
    assert text == '{"a":1,"b":"x"}\n{"a":2,"b":null}\n'
    with pytest.raises(Exception):  # noqa: B017
        writers.write_jsonl(df, out)


def test_guards(tmp_path):
    (tmp_path / "in").mkdir()
    assert writers.guard_path(str(tmp_path / "out"), str(tmp_path))
    for bad in (tmp_path.parent / "x", tmp_path, tmp_path / "in" / "deep"):
        with pytest.raises(ValueError):
            writers.guard_path(str(bad), str(tmp_path), (str(tmp_path / "in"),))
    with pytest.raises(FileNotFoundError):
        readers.require_files([str(tmp_path / "none")])


def test_publish_only_if_not_failed(tmp_path):
    done = []
    for verdict in ("FAIL", "PASS WITH RISKS"):
        writers.publish(lambda v=verdict: v, {"x": lambda: done.append("x")}, lambda said: done.append(said))
    assert done == ["FAIL", "PASS WITH RISKS", "x"]
    a = write(tmp_path / "a.txt", "1")
    assert writers.package(str(tmp_path / "p"), {"train.jsonl": a}, "# card", str(tmp_path / "p.zip")) == ["train.jsonl", "README.md"] and os.path.exists(tmp_path / "p.zip")


def test_report_and_buckets(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    writers.write_buckets(df, str(tmp_path / "b"), "k")
    assert sorted(f for f in os.listdir(tmp_path / "b") if "=" in f) == ["k=a", "k=b"]
    assert writers.write_report(df.where("n = 1"), str(tmp_path / "r.json")) == {"k": "a", "n": 1} == json.load(open(tmp_path / "r.json"))
    with pytest.raises(ValueError):
        writers.write_report(df, str(tmp_path / "r.json"))


def test_notebooks_documents_and_config(spark, tmp_path):
    book = {"cells": [{"cell_type": "code", "source": ["a\n", "b"]}, {"cell_type": "markdown", "source": "text"}]}
    p = write(tmp_path / "n.ipynb", json.dumps(book))
    cells = readers.notebook_cells(readers.read_whole_texts(spark, p)).orderBy("cell_no").collect()
    assert [(c.cell_type, c.source) for c in cells] == [("code", "a\nb"), ("markdown", "text")]
    assert readers.notebook_cells(spark.createDataFrame([("no json",)], "text string")).count() == 0
    assert readers.read_json_document(spark, p).count() == 1
    assert readers.simple_config("# c\na: 1\nb:\n  x: true\n  y: null\n  z: 'q'\nlist:\n  - u\n  - 2\nt: hello") == {"a": 1, "b": {"x": True, "y": None, "z": "q"}, "list": ["u", 2], "t": "hello"}
    with pytest.raises(ValueError):
        readers.simple_config("nonsense")


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    write(folder / "1.jsonl", '{"text": "a", "doc_id": "1"}\n{"text": " ", "doc_id": "2"}\n')
    schema = "text string, doc_id string"
    stream = ingest.normalize_stream(ingest.arriving(spark, str(folder), schema), "s", "u", "MIT", "now")
    for _ in range(2):  # the second finds nothing new
        ingest.append_to(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 2 and got.where("rejected = 'true'").first().source_id == "2"


def test_written_tables_are_cleared(spark):
    shared.clear_written(spark)
    table = shared.written(spark.range(3))
    assert table.count() == 3 and shared.clear_written(spark) == 1 and shared.clear_written(spark) == 0
    with pytest.raises(Exception):  # noqa: B017
        table.count()
