"""Instruction rows: template rendering, validation, duplicate audit, prompts, scoring, policy scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import contains_any, reasons, text_or, utrim

# Fixed values of valid instruction rows.
TASK_TYPES = ["classification", "explanation", "retrieval_style_qa", "drafting_demo"]
DIFFICULTIES = ["easy", "medium", "hard"]
DISCLAIMER_TERMS = ["synthetic", "demo", "not legal advice"]
CLAIMS = ["this is official legal text", "this is official legal advice", "official legal authority", "official legal answer", "binding legal advice", "authoritative legal interpretation"]
TEXT_FIELDS = ["id", "instruction", "input", "output", "source", "format", "domain", "task_type", "difficulty", "disclaimer"]
# The headings of a prompt.
HEADINGS = {"disclaimer": "### Disclaimer\n", "instruction": "### Instruction\n", "input": "### Context\n", "output": "### Response\n"}


def render_templates(spark: SparkSession, count: int, templates: dict[str, list[str]], dimensions: dict[str, tuple[list[str], int]], id_format: str = "synthetic-demo-%06d") -> DataFrame:
    """``count`` rows made from templates, by row number from 1.

    A dimension gives the value at ``((n - 1) * stride) mod size``; a template
    column takes its templates in turn and replaces ``{dimension}``, ``{index}``
    and ``{case_anchor}``. Built from ``spark.range``, so any part of any row can
    be made anywhere.
    """
    if count <= 0:
        raise ValueError("count must be greater than zero.")
    n = F.col("index")
    at = lambda values, stride: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod((n - 1) * stride, F.lit(len(values))) + 1).cast("int"))
    rows = spark.range(1, count + 1).select(F.col("id").alias("index")).withColumn("id", F.format_string(id_format, "index"))
    rows = rows.withColumns({d: at(values, stride) for d, (values, stride) in dimensions.items()})

    def fill(t: Column) -> Column:
        for d in dimensions:
            t = F.replace(t, F.lit("{" + d + "}"), F.col(d))
        return F.replace(F.replace(t, F.lit("{case_anchor}"), F.col("id")), F.lit("{index}"), n.cast("string"))

    return rows.withColumns({c: fill(at(texts, 1)) for c, texts in templates.items()})


def validate_rows(df: DataFrame, source: str = "synthetic-demo", format_: str = "alpaca", domain: str = "vietnamese-legal-demo", id_prefix: str = "synthetic-demo-") -> DataFrame:
    """Adds ``errors``. Missing columns stop everything, then the first null or blank text, then all checks of content run.

    ``input`` may be blank but not null. Flags must be the boolean itself. A
    column of another type than text counts as not a string. The messages are fixed values.
    """
    missing = [f for f in [*TEXT_FIELDS[:9], "is_synthetic", "is_legal_ground_truth", "approved_for_rag_index", "disclaimer"] if f not in df.columns]
    if missing:
        return df.withColumn("errors", F.array(*[F.lit(f"Missing required field: {f}") for f in missing]))
    types = dict(df.dtypes)
    first = F.lit(None).cast("string")
    for f in reversed(TEXT_FIELDS):
        bad = F.lit(True) if types[f] != "string" else F.col(f).isNull()
        first = F.when(bad, f"{f} must be a string.").otherwise(first if f == "input" else F.when(F.col("_v")[f] == "", f"{f} must not be blank.").otherwise(first))
    # trimmed once, in a step of its own
    staged = df.withColumn("_v", F.struct(*[text_or(f).alias(f) for f in TEXT_FIELDS]))
    v = {f: F.col("_v")[f] for f in TEXT_FIELDS}
    listed = lambda f, values: F.when(~v[f].isin(values), F.concat(F.lit(f"{f} is invalid: "), v[f]))
    flag = lambda f, want: F.lit(True) if types[f] != "boolean" else ~F.coalesce(F.col(f) == want, F.lit(False))
    head = reasons((~F.startswith(v["id"], F.lit(id_prefix)), f"id must start with {id_prefix}."), (v["source"] != source, f"source must equal {source}."), (v["format"] != format_, f"format must equal {format_}."), (v["domain"] != domain, f"domain must equal {domain}."))
    middle = F.array_compact(F.array(listed("task_type", TASK_TYPES), listed("difficulty", DIFFICULTIES)))
    low = F.lower(v["disclaimer"])
    tail = reasons(
        (flag("is_synthetic", True), "is_synthetic must be true."), (flag("is_legal_ground_truth", False), "is_legal_ground_truth must be false."), (flag("approved_for_rag_index", False), "approved_for_rag_index must be false."),
        *[(~F.contains(low, F.lit(t)), f"disclaimer must mention: {t}") for t in DISCLAIMER_TERMS], (contains_any(F.concat_ws(" ", v["instruction"], v["input"], v["output"]), CLAIMS), "Row must not claim official legal authority."),
    )
    return staged.withColumn("errors", F.when(first.isNotNull(), F.array(first)).otherwise(F.concat(head, middle, tail))).drop("_v")


def instruction_audit(validated: DataFrame, source: str = "synthetic-demo") -> DataFrame:
    """One row: rows that are valid and not, the errors in all, and of each class that is counted by itself."""
    errors = F.col("errors")
    of = lambda t: F.coalesce(F.sum(F.size(F.filter(errors, lambda e: F.contains(e, F.lit(t))))), F.lit(0)).cast("long")
    return validated.agg(
        F.count("*").alias("total_rows"), F.count_if(F.size(errors) == 0).alias("valid_rows"), F.count_if(F.size(errors) > 0).alias("invalid_rows"), F.coalesce(F.sum(F.size(errors)), F.lit(0)).cast("long").alias("errors"),
        of("official legal authority").alias("official_authority_claims"), of(f"source must equal {source}").alias("source_mismatches"), of("is_synthetic must be true").alias("synthetic_false"),
        of("is_legal_ground_truth must be false").alias("legal_ground_truth_true"), of("approved_for_rag_index must be false").alias("rag_index_true"), of("disclaimer").alias("disclaimer_issues"),
    )


def split_overlaps(parts: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """``first, second, shared``: keys that two split files share, for every two of them; disjoint files give zeros.

    One aggregation with a bit for each file, so a key is looked at once whatever the number of files.
    """
    if len(parts) > 32:
        raise ValueError("over 32 split files")
    names = sorted(parts)
    seen = None
    for n, name in enumerate(names):
        own = parts[name].where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k"), F.lit(1 << n).cast("long").alias("bit"))
        seen = own if seen is None else seen.unionByName(own)
    bits = seen.groupBy("k").agg(F.bit_or("bit").alias("bits"))
    pairs = [(a, b, 1 << i | 1 << j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j]
    counts = bits.agg(*[F.count_if(F.col("bits").bitwiseAND(m) == m).alias(f"p{n}") for n, (_, _, m) in enumerate(pairs)], F.count("*").alias("keys"))
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"p{n}").alias("shared")) for n, (a, b, _) in enumerate(pairs)]))
    return counts.select(rows.alias("r")).select("r.*")


def duplicate_counts(df: DataFrame) -> DataFrame:
    """``measure, duplicates``: rows less distinct values of id, instruction, input, output and the three texts together.

    One pass: every row sends a digest for each measure, counted with partial
    sums, so no value, however frequent, is gathered.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    measures = {"id": text("id"), "instruction": text("instruction"), "input": text("input"), "output": text("output"), "instruction_input_output": F.concat_ws("\u001f", text("instruction"), text("input"), text("output"))}
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.unhex(F.substring(F.sha2(c, 256), 1, 32)).alias("d")) for m, c in measures.items()]))
    groups = df.select(pairs.alias("p")).select("p.*").groupBy("measure", "d").agg(F.count("*").alias("n"))
    return groups.groupBy("measure").agg((F.sum("n") - F.count("*")).alias("duplicates"))


def prompt(with_answer: bool = True) -> Column:
    """Prompt of trimmed texts under headings; the context is left out where the input is blank, null texts are empty."""
    part = lambda c: F.concat(F.lit(HEADINGS[c]), text_or(c))
    context = F.when(text_or("input") != "", F.concat(part("input"), F.lit("\n\n"))).otherwise("")
    disclaimer = F.concat(F.lit(HEADINGS["disclaimer"]), F.coalesce("disclaimer", F.lit("")))
    return F.concat(disclaimer, F.lit("\n\n"), part("instruction"), F.lit("\n\n"), context, part("output") if with_answer else F.lit(HEADINGS["output"]))


def overlap_score(response: Column, expected: Column) -> Column:
    """Share of the expected answer's distinct words that stand in the response."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+"), lambda w: w != ""))
    return F.size(F.array_intersect(words(expected), words(response))) / F.greatest(F.size(words(expected)), F.lit(1))


def response_scores(df: DataFrame, response: str, expected: str, shortest: int = 10, least: float = 0.15) -> DataFrame:
    """Adds ``format_valid`` (longer than ``shortest`` characters), ``overlap`` and ``task_pass``."""
    valid = F.length(F.coalesce(utrim(response), F.lit(""))) > shortest
    scored = df.withColumns({"format_valid": valid, "overlap": overlap_score(F.col(response), F.col(expected))})
    return scored.withColumn("task_pass", F.col("overlap") >= least)


def lines_holding(df: DataFrame, key: str, text: str, phrases: list[str], comment: str = "#") -> DataFrame:
    """``key, line_no, phrase`` for each line, comments aside, that holds a phrase; as written, whatever its case."""
    lines = df.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\R")).alias("line_no", "line")).where(~F.startswith(F.ltrim("line"), F.lit(comment)))
    hits = F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(F.lower("line"), F.lower(p)))
    return lines.select(key, (F.col("line_no") + 1).alias("line_no"), F.explode(hits).alias("phrase"))
