"""Command line: one sub-command per stage. Exit codes: 0 done, 1 bad input, 2 a gate or check failed."""

from __future__ import annotations

import argparse
import datetime
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import articles, audit, candidates, instructions, manifest, normalize, quality, reviews, sampling
from .plans.queries import DEMO_DIMENSIONS, DEMO_TEMPLATES
from .sources import readers, registry, shared, writers


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("corpusgate").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _load(spark: SparkSession, path: str) -> DataFrame:
    """A table by its ending: parquet, CSV with a header, else JSON lines."""
    readers.require_files([path])
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return readers.read_csv(spark, path) if path.rstrip("/").endswith(".csv") else readers.read_jsonl(spark, path)


def _indexed(df: DataFrame) -> DataFrame:
    """With ``input_index``; where the input has none, each row's place in the input."""
    return df if "input_index" in df.columns else readers.indexed(df)


def ingest(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.all:
        raw, mode = readers.read_jsonl(spark, a.input), "whole_input"
    else:
        rows, mode = readers.load_records(spark, readers.record_limit(a.max_records), fixture=a.input)
        # at most ``MOST_RECORDS`` lines; their schema is that of all of them
        raw = spark.read.json(spark.sparkContext.parallelize([r.value for r in rows.orderBy("ordinal").collect()], 1))
    now = a.retrieved_at or datetime.datetime.now(datetime.timezone.utc).isoformat()
    records = normalize.normalize(raw, F.lit(a.dataset), F.lit(a.url), F.lit(a.license), F.lit(now), keep_raw=True).persist()
    good, bad = normalize.split_errors(records)
    writers.write_jsonl(good, os.path.join(a.output, "normalized"), overwrite=a.overwrite)
    writers.write_jsonl(bad, os.path.join(a.output, "rejected"), overwrite=a.overwrite)
    metrics = quality.quality_metrics(records)
    source = registry.Source(a.dataset, a.url, a.license)
    seen = records.count()
    writers.write_report(registry.provenance_record(spark, source, a.max_records, seen, normalize.TRANSFORM_VERSION, os.path.basename(a.input.rstrip("/")), retrieved_at=now), os.path.join(a.output, "provenance_manifest.json"))
    missed = [r.message for r in quality.violations(metrics).collect()]
    writers.write_report(metrics.withColumns({"mode": F.lit(mode), "violations": F.array(*map(F.lit, missed)).cast("array<string>")}), os.path.join(a.output, "quality_report.json"))
    return 2 if missed else 0


def inspect(spark: SparkSession, a: argparse.Namespace) -> int:
    checked = readers.checked_lines(readers.first_lines(spark, a.input, a.limit, blank_lines_count=True))
    counts = checked.agg(F.count("*").alias("rows"), F.count("issue").alias("broken")).first()
    print(f"rows {counts.rows}, broken {counts.broken}")
    return 1 if counts.broken else 0


def content(spark: SparkSession, a: argparse.Namespace) -> int:
    writers.write_report(audit.content_summary(_load(spark, a.input)), a.report)
    return 0


def parse(spark: SparkSession, a: argparse.Namespace) -> int:
    parsed = articles.parse_documents(_load(spark, a.input)).persist()
    if a.strict and parsed.where(F.size("missing_fields") > 0).limit(1).count():
        writers.write_report(parsed.agg(F.count("*").alias("documents"), F.count_if(F.size("missing_fields") > 0).alias("without_provenance")).withColumn("status", F.lit("BLOCKED")), os.path.join(a.output, "parse_report.json"))
        return 2
    chunks = articles.candidates(parsed, a.max_chars)
    for name, df in (("candidates", chunks), ("rejected", articles.rejected_documents(parsed)), ("warnings", articles.parse_warnings(parsed))):
        writers.write_jsonl(df, os.path.join(a.output, name), overwrite=a.overwrite)
    writers.write_report(articles.parse_metrics(parsed, chunks), os.path.join(a.output, "parse_report.json"))
    return 0


def filter_(spark: SparkSession, a: argparse.Namespace) -> int:
    df = _indexed(_load(spark, a.input))
    if a.warnings:
        df = candidates.with_warnings(df, _load(spark, a.warnings))
    decided = candidates.decide(df).withColumn("bucket", candidates.bucket(F.col("filter_decision"))).persist()
    writers.write_buckets(decided, os.path.join(a.output, "decided"), "bucket", overwrite=a.overwrite, order=["input_index"])
    report = writers.write_report(candidates.filter_metrics(decided), os.path.join(a.output, "filter_report.json"))
    return 0 if report["counts_reconcile"] else 2


def sample(spark: SparkSession, a: argparse.Namespace) -> int:
    drawn = sampling.review_sample(candidates.decide(_indexed(_load(spark, a.input))), a.size, a.seed).persist()
    writers.write_jsonl(drawn, os.path.join(a.output, "review_sample"), order=["sampling_bucket", "sample_index"], overwrite=a.overwrite, one_file=True)
    blank = {c: F.lit("") for c in ("reviewer_id", "review_date", "decision_label", "confidence", "notes")} | {c: F.lit("false") for c in ("legal_ground_truth_approved", "rag_index_approved")}
    form = ["review_sample_id", "candidate_id", "parent_record_id", "source_dataset", "source_id", "source_url", "license", "title", "article_number", "article_title", "filter_decision", "sampling_bucket", *blank]
    writers.write_csv(drawn.withColumns(blank), os.path.join(a.output, "review_form"), form, overwrite=a.overwrite, only_required=True)
    for r in sampling.shortfalls(drawn, a.size).orderBy("sampling_bucket").collect():
        print(f"{r.sampling_bucket}: {r.selected} of {r.target}")
    return 0


def fill(spark: SparkSession, a: argparse.Namespace) -> int:
    """One decision for all rows of a review form."""
    if os.path.realpath(a.output) == os.path.realpath(a.input):
        raise ValueError("the output must not be the form itself")
    if a.label not in reviews.LABELS or a.confidence not in reviews.LEVELS:
        raise ValueError("unknown label or confidence")
    date = datetime.date.fromisoformat(a.date).isoformat() if a.date else datetime.date.today().isoformat()
    values = {"reviewer_id": a.reviewer, "review_date": date, "decision_label": a.label, "confidence": a.confidence, "notes": a.notes, "legal_ground_truth_approved": "false", "rag_index_approved": "false"}
    form = _load(spark, a.input)
    writers.write_csv(form.withColumns({c: F.lit(v) for c, v in values.items()}), a.output, [*[c for c in form.columns if c not in values], *values], overwrite=a.overwrite)
    return 0


def review(spark: SparkSession, a: argparse.Namespace) -> int:
    checked = reviews.validate_reviews(_load(spark, a.input)).persist()
    settled = reviews.adjudicate(checked.where(F.size("invalid_reasons") == 0)).withColumn("bucket", reviews.outcome()).persist()
    report = writers.write_report(reviews.label_audit(checked, settled), os.path.join(a.output, "label_audit.json"))
    if report["invalid_rows"] or report["forbidden_flags"]:
        writers.write_jsonl(checked.where(F.size("invalid_reasons") > 0), os.path.join(a.output, "invalid"), overwrite=a.overwrite)
        return 2
    writers.write_buckets(settled.withColumn("outcome", F.col("bucket")), os.path.join(a.output, "outcomes"), "outcome", overwrite=a.overwrite)
    return 0


def join(spark: SparkSession, a: argparse.Namespace) -> int:
    filtered = candidates.union_outputs([_load(spark, path) for path in a.filtered.split(",")])
    m = manifest.join_manifest(_load(spark, a.accepted), _load(spark, a.reviews), _load(spark, a.samples), filtered).persist()
    metrics = manifest.manifest_metrics(m).persist()
    verdict = lambda: "FAIL" if metrics.first()["rejected"] else "PASS"
    report = lambda said: writers.write_report(metrics, os.path.join(a.output, "manifest_report.json"))
    said = writers.publish(verdict, {"manifest": lambda: writers.write_jsonl(m, os.path.join(a.output, "manifest"), order=["candidate_id"], overwrite=a.overwrite)}, report)
    return 2 if said == "FAIL" else 0


def synth(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = instructions.render_templates(spark, a.count, DEMO_TEMPLATES, DEMO_DIMENSIONS).select("id", "instruction", "input", "output")
    n = F.substring("id", -6, 6).cast("int")
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.pmod(n - 1, F.lit(len(values))) + 1).cast("int"))
    fixed = {"source": F.lit("synthetic-demo"), "format": F.lit("alpaca"), "domain": F.lit("vietnamese-legal-demo"), "task_type": at(instructions.TASK_TYPES), "difficulty": at(instructions.DIFFICULTIES), "is_synthetic": F.lit(True)}
    fixed |= {"is_legal_ground_truth": F.lit(False), "approved_for_rag_index": F.lit(False), "disclaimer": F.lit("Synthetic demo data only. Not legal advice.")}
    writers.write_jsonl(rows.withColumns(fixed), a.output, order=["id"], overwrite=a.overwrite)
    return 0


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    broken = readers.checked_jsonl(spark, a.input).where("issue is not null").count() if not a.input.rstrip("/").endswith(".parquet") else 0
    checked = instructions.validate_rows(_load(spark, a.input)) if not broken else None
    bad = checked.where(F.size("errors") > 0).count() if checked is not None else broken
    print(f"invalid {bad}")
    if a.report and checked is not None:
        counts = instructions.duplicate_counts(checked)
        writers.write_report(counts.agg(F.map_from_entries(F.collect_list(F.struct("measure", "duplicates"))).alias("duplicates"), F.lit(bad).alias("invalid")), a.report)
    return 1 if bad else 0


def split(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = sampling.split_rows(_load(spark, a.input), "id", a.seed, a.train, a.validation, a.test)
    writers.write_buckets(rows, a.output, "split_name", overwrite=a.overwrite)
    return 0


def pack_dataset(spark: SparkSession, a: argparse.Namespace) -> int:
    """The split files of a folder under plain names beside a card, zipped; refused if a file is missing or two share an id."""
    files = {f"{n}.jsonl": os.path.join(a.input, f"split_name={n}") for n in ("train", "validation", "test")}
    readers.require_files(list(files.values()))
    shared = instructions.split_overlaps({n: readers.read_jsonl(spark, path) for n, path in files.items()}).where("shared > 0").collect()
    for r in shared:
        print(f"{r.first} and {r.second} share {r.shared}")
    if shared:
        return 2
    parts = {n: [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part-")] for n, path in files.items()}
    writers.package(a.output, parts, a.card, a.archive)
    return 0


def scan(spark: SparkSession, a: argparse.Namespace) -> int:
    """Forbidden phrases in texts or in the code cells of notebooks."""
    texts = readers.read_whole_texts(spark, a.input)
    cells = readers.notebook_cells(texts).where("cell_type = 'code'").withColumn("path", F.concat_ws("#", "path", "cell_no")).select("path", F.col("source").alias("text"))
    hits = instructions.lines_holding(texts.where(~F.endswith("path", F.lit(".ipynb"))).unionByName(cells), "path", "text", a.phrase)
    if a.report:
        writers.write_jsonl(hits, a.report, order=["path", "line_no"], overwrite=a.overwrite)
    first = hits.orderBy("path", "line_no").limit(a.show).collect()
    for h in first:
        print(f"{h.path}:{h.line_no}: {h.phrase}")
    return 2 if first else 0


COMMANDS = {
    "ingest": (ingest, ["--dataset", "--url", "--license"], {"--max-records": (int, readers.DEFAULT_RECORDS), "--retrieved-at": (str, None)}), "inspect": (inspect, [], {"--limit": (int, 10)}), "content": (content, ["--report"], {}), "parse": (parse, [], {"--max-chars": (int, articles.CHUNK)}),
    "filter": (filter_, [], {"--warnings": (str, None)}), "sample": (sample, [], {"--size": (int, 150), "--seed": (int, 42)}), "fill": (fill, ["--reviewer", "--notes"], {"--label": (str, "uncertain"), "--confidence": (str, "medium"), "--date": (str, None)}),
    "review": (review, [], {}), "manifest": (join, ["--accepted", "--reviews", "--samples", "--filtered"], {}), "synth": (synth, [], {"--count": (int, 2500)}), "validate": (validate, [], {"--report": (str, None)}),
    "split": (split, [], {"--seed": (int, 42), "--train": (float, 0.8), "--validation": (float, 0.1), "--test": (float, 0.1)}), "package": (pack_dataset, [], {"--card": (str, "# Synthetic rows\n"), "--archive": (str, None)}), "scan": (scan, [], {"--report": (str, None), "--show": (int, 50)}),
}
_NO_INPUT, _NO_OUTPUT = {"manifest", "synth"}, {"inspect", "content", "validate", "scan"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corpusgate", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name, (_, needed, optional) in COMMANDS.items():
        c = sub.add_parser(name)
        if name not in _NO_INPUT:
            c.add_argument("--input", required=True)
        if name not in _NO_OUTPUT:
            c.add_argument("--output", required=True)
            c.add_argument("--inside", help="a folder that the output must lie in")
        for flag in needed:
            c.add_argument(flag, required=True)
        for flag, (kind, default) in optional.items():
            c.add_argument(flag, type=kind, default=default)
        if name == "ingest":
            c.add_argument("--all", action="store_true", help="read the whole input, whatever its size")
        if name == "parse":
            c.add_argument("--strict", action="store_true", help="write nothing if any document lacks provenance")
        if name == "scan":
            c.add_argument("--phrase", action="append", required=True)
        c.add_argument("--overwrite", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        if getattr(a, "inside", None):
            writers.guard_path(a.output, a.inside, tuple(filter(None, [getattr(a, "input", None)])))
        spark = spark or _session()
        try:
            return COMMANDS[a.command][0](spark, a)
        finally:
            shared.clear_written(spark)
    except (ValueError, FileNotFoundError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
