"""Readers. Rows keep an ordinal where later steps go by input order."""

from __future__ import annotations

import io
import json
import os
import warnings
from collections.abc import Iterator
from itertools import islice
from urllib.parse import unquote, urlparse
from urllib.request import urlopen

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MOST_RECORDS, DEFAULT_RECORDS = 1000, 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def require_files(paths: list[str]) -> None:
    """Raises FileNotFoundError naming every local file that is not there."""
    missing = [p for p in paths if "://" not in p and not os.path.exists(p)]
    if missing:
        raise FileNotFoundError("missing input: " + ", ".join(missing))


def record_limit(requested: int, most: int = MOST_RECORDS) -> int:
    """The number of records to read: at least 1, at most ``most``; a larger request is cut to that with a warning."""
    if requested <= 0:
        raise ValueError(f"max records must be positive, got {requested}")
    if requested > most:
        warnings.warn(f"max records {requested} exceeds the cap; reading {most}", stacklevel=2)
    return min(requested, most)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, line_number, value``: lines of each file as text, numbered from 1 within the file.

    Files are read in splits by many tasks. A line's place in its split comes
    from the order of reading; a first job counts the lines of each split, and
    the numbers of lines before each (a row for each split) are joined to the
    lines. Lines end at a line feed; a carriage return before it is dropped. An
    empty file has no lines. The read fails if a split was laid out differently the second time.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    at = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), "value")
    # the limit of tasks and rows per task that the ids allow keeps their difference within a split exact
    counts = at.groupBy("path", "split").agg(F.count("*").alias("lines"), F.min("id").alias("first"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = counts.select("path", "split", "lines", "first", before.alias("before"))
    place = F.col("id") - F.col("first")
    same = place.between(0, F.col("lines") - 1)
    number = F.when(same, F.col("before") + place + 1).otherwise(F.raise_error(F.lit("the files were split differently when their lines were counted")))
    return at.join(splits, ["path", "split"], "left").select("path", number.alias("line_number"), F.regexp_replace("value", r"\r$", "").alias("value"))


def _line_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a path in order of their names."""
    return sorted(spark.read.text(path).inputFiles())


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; blank lines are skipped, a broken line fails the read."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def first_lines(spark: SparkSession, path: str, most: int, blank_lines_count: bool = False) -> DataFrame:
    """``path, line_number, value`` of the first ``most`` lines in file order that count; blank ones count only if asked.

    Files are taken in order of their names and read no further than needed:
    on this machine line by line, elsewhere by a scan and a top-k. A line number is that within its file.
    """
    found: list[tuple[str, int, str]] = []
    for file in _line_files(spark, path):
        if len(found) >= most:
            break
        found += _first_lines(spark, file, most - len(found), blank_lines_count)
    return spark.createDataFrame(found, "path string, line_number long, value string")


def first_records(spark: SparkSession, path: str, most: int, schema: str, blank_lines_count: bool = False) -> DataFrame:
    """The first ``most`` records in file order, from ``first_lines``; blank lines give no record."""
    chosen = first_lines(spark, path, most, blank_lines_count).where(F.trim("value") != "")
    return chosen.select("path", "line_number", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("path", "line_number", "r.*")


def _first_lines(spark: SparkSession, file: str, most: int, blank_lines_count: bool) -> list[tuple[str, int, str]]:
    """The first lines of a file that count, with blank ones only if they count."""
    if file.startswith("file:"):
        with open(unquote(urlparse(file).path), encoding="utf-8", newline="\n") as f:
            full = ((file, n, line.rstrip("\r\n")) for n, line in enumerate(f, 1) if blank_lines_count or line.strip())
            return list(islice(full, most))
    lines = numbered_lines(spark, file)
    rows = (lines if blank_lines_count else lines.where(F.trim("value") != "")).orderBy("line_number").limit(most).collect()  # at most ``most``
    return [(r.path, r.line_number, r.value) for r in rows]


def checked_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``path, line_number, value, issue`` of the non-blank lines; the issue names invalid JSON or a value that is no object, else is null."""
    return checked_lines(numbered_lines(spark, path))


def checked_lines(lines: DataFrame) -> DataFrame:
    """The non-blank lines of a table with a column ``value``, with ``issue``."""
    lines = lines.where(F.trim("value") != "")
    v = F.try_parse_json("value")
    issue = F.when(v.isNull(), "Invalid JSON.").when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "Row must be a JSON object.")
    return lines.withColumn("issue", issue)


def strict_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are all JSON objects; raises ValueError naming the first line that is not."""
    checked = checked_jsonl(spark, path)
    bad = checked.where("issue is not null").orderBy("path", "line_number").limit(1).collect()
    if bad:
        raise ValueError(f"line {bad[0].line_number} of {bad[0].path}: {bad[0].issue}")
    return checked.drop("issue")


def read_csv(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """CSV with a header, every value text, empty ones as the empty string.

    Quoted line breaks are kept, for which each file is read whole by one task;
    without ``line_breaks`` a row is a line, and large files are split.
    """
    raw = spark.read.options(header=True, multiLine=line_breaks, escape='"', inferSchema=False).csv(path)
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of each file as one value."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def notebook_cells(notebooks: DataFrame, text: str = "text") -> DataFrame:
    """``cell_no, cell_type, source`` of every cell of notebooks in a text column; a source may be a list of lines or one string.

    A text that is no notebook gives no row.
    """
    cells = F.from_json(F.get_json_object(text, "$.cells"), "array<struct<cell_type:string,source:string>>")
    rows = notebooks.select("*", F.posexplode(cells).alias("cell_no", "cell"))
    source = F.col("cell.source")
    listed = F.array_join(F.from_json(source, "array<string>"), "")
    return rows.select(*notebooks.columns, "cell_no", F.col("cell.cell_type").alias("cell_type"), F.coalesce(listed, source, F.lit("")).alias("source"))


def simple_config(text: str) -> dict[str, object]:
    """Two-level ``key: value`` configuration: booleans, null, whole numbers, text, and lists of ``- item`` lines.

    Comments and blank lines are skipped; a line of another form raises ValueError.
    """
    words = {"true": True, "false": False, "null": None, "": None}

    def scalar(v: str) -> object:
        v = v.strip()
        if v.lower() in words:
            return words[v.lower()]
        return int(v) if v.lstrip("-").isdigit() else v.strip("\"'")

    out: dict[str, object] = {}
    section: dict[str, object] | None = None
    held: tuple[dict[str, object], str] | None = None
    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if line.lstrip().startswith("- "):
            if held is None:
                raise ValueError(f"list item without a key: {line.strip()}")
            home, key = held
            home[key] = [*(home[key] if isinstance(home[key], list) else []), scalar(line.strip()[2:])]
            continue
        name, sep, value = line.strip().partition(":")
        if not sep:
            raise ValueError(f"not a key and a value: {line.strip()}")
        home = section if line[0].isspace() and section is not None else out
        if value.strip() == "" and home is out:
            section = {}
            out[name] = section
            held = (out, name)
        else:
            home[name] = scalar(value)
            held = (home, name)
    return {k: None if v == {} else v for k, v in out.items()}


class _Lines(InputPartition):
    def __init__(self, path: str, most: int) -> None:
        self.path, self.most = path, most


def _open_lines(path: str):
    """Lines of a file, or of what an address serves, which are asked for as they are read."""
    if path.startswith(("http://", "https://")):
        return io.TextIOWrapper(urlopen(path, timeout=60), encoding="utf-8")  # noqa: S310
    return open(path, encoding="utf-8")


class BoundedJsonReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [_Lines(self.options["path"], record_limit(int(self.options.get("limit", DEFAULT_RECORDS))))]

    def read(self, partition: _Lines) -> Iterator[tuple]:
        n = 0
        try:
            with _open_lines(partition.path) as f:
                for line in f:
                    if n == partition.most:
                        return
                    if line.strip():
                        json.loads(line)
                        n += 1
                        yield n, line.strip()
        except (OSError, ValueError) as e:
            raise RuntimeError(f"cannot read records of {partition.path}: {e}") from e


class BoundedJsonSource(DataSource):
    """``spark.read.format("bounded_jsonl")``: the first ``limit`` records of a stream of JSON lines, read no further than needed.

    A path of this machine or an address that serves the lines. What cannot be
    read or is no JSON fails with the path named.
    """

    @classmethod
    def name(cls) -> str:
        return "bounded_jsonl"

    def schema(self) -> str:
        return "ordinal long, value string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return BoundedJsonReader(self.options)


def indexed(df: DataFrame, name: str = "input_index") -> DataFrame:
    """Rows with their place in the input, from 0: by order of reading, files in the order of their names and splits in order within them.

    Rows are told apart by where they stand, never by what they hold. A first
    job counts the rows of each split. A table that is not read from files takes the order of its partitions.
    """
    at = df.select("*", F.monotonically_increasing_id().alias("_id"))
    try:
        at = at.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_split"))
        at.schema  # noqa: B018
    except AnalysisException:
        at = at.withColumns({"_path": F.lit(""), "_split": F.shiftright("_id", 33)})
    counts = at.groupBy("_path", "_split").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))  # a row for each split
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_path", "_split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = counts.select("_path", "_split", "_n", "_first", before.alias("_before"))
    place = F.col("_id") - F.col("_first")
    index = F.when(place.between(0, F.col("_n") - 1), F.col("_before") + place).otherwise(F.raise_error(F.lit("the input was split differently when its rows were counted")))
    return at.join(splits, ["_path", "_split"], "left").withColumn(name, index).drop("_id", "_path", "_split", "_n", "_first", "_before")


def load_records(spark: SparkSession, most: int, fixture: str | None = None, remote: str | None = None) -> tuple[DataFrame, str]:
    """Bounded records and where they are from: a local fixture wins over a remote handle; one of them must be given."""
    path = fixture or remote
    if not path:
        raise ValueError("neither a fixture nor a remote handle is given")
    spark.dataSource.register(BoundedJsonSource)
    rows = spark.read.format("bounded_jsonl").option("path", path).option("limit", record_limit(most)).load()
    return rows, "offline_fixture" if fixture else "remote_stream"
