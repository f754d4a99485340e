"""Writers and their guards. What is decided on the driver is decided before anything is written."""

from __future__ import annotations

import json
import os
import shutil
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def guard_path(path: str, inside: str, inputs: tuple[str, ...] = ()) -> str:
    """The resolved path, if it lies inside a folder and neither is nor lies in an input; else ValueError."""
    full, root = os.path.realpath(path), os.path.realpath(inside)
    if os.path.commonpath([full, root]) != root or full == root:
        raise ValueError(f"{path} must lie inside {inside}")
    for i in map(os.path.realpath, inputs):
        if os.path.commonpath([full, i]) == i:
            raise ValueError(f"{path} must not lie in the input {i}")
    return full


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None, overwrite: bool = False, one_file: bool = False) -> None:
    """JSON lines with explicit nulls. ``one_file`` is for exports small enough for one task; else files follow the partitions, in order if sorted."""
    df = df.orderBy(*order) if order else df
    df = df.coalesce(1) if one_file else df
    df.write.mode("overwrite" if overwrite else "errorifexists").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, required: list[str], overwrite: bool = False, only_required: bool = False) -> None:
    """CSV with a header: the required columns first, missing ones empty, then the others sorted; arrays, maps and structs as JSON."""
    extra = [] if only_required else sorted(c for c in df.columns if c not in required)
    types = dict(df.dtypes)

    def cell(c: str):
        if c not in types:
            return F.lit("").alias(c)
        nested = types[c].startswith(("array", "map", "struct"))
        return (F.to_json(F.col(f"`{c}`")) if nested else F.col(f"`{c}`").cast("string")).alias(c)

    out = df.select(*[cell(c) for c in [*required, *extra]])
    out.write.mode("overwrite" if overwrite else "errorifexists").options(header=True, quoteAll=False, escape='"').csv(path)


def write_report(report: DataFrame, path: str) -> dict:
    """One row as a readable JSON file; raises ValueError for any other number of rows."""
    rows = report.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"a report is one row, not {len(rows)}")
    values = rows[0].asDict(recursive=True)
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        if path.endswith(".md"):
            f.writelines(f"- {k}: {v}\n" for k, v in values.items())
        else:
            json.dump(values, f, ensure_ascii=False, indent=2, default=str)
    return values


def write_buckets(df: DataFrame, path: str, bucket: str, overwrite: bool = False, order: list[str] | None = None) -> None:
    """All buckets in one pass over the data, a folder each; in order over the files of a bucket if asked."""
    df = df.orderBy(bucket, *order) if order else df
    df.write.mode("overwrite" if overwrite else "errorifexists").partitionBy(bucket).json(path)


def publish(verdict: Callable[[], str], outputs: dict[str, Callable[[], None]], report: Callable[[str], None]) -> str:
    """Runs the outputs only if the verdict is not FAIL; the report is written always. Returns the verdict."""
    said = verdict()
    report(said)
    if said != "FAIL":
        for write in outputs.values():
            write()
    return said


def package(folder: str, files: dict[str, str | list[str]], card: str, archive: str | None = None) -> list[str]:
    """Copies files under given names beside a README with the card, and zips them if asked; returns the names. Several sources of one name are put after each other."""
    os.makedirs(folder, exist_ok=True)
    for name, sources in files.items():
        with open(os.path.join(folder, name), "wb") as out:
            for source in [sources] if isinstance(sources, str) else sources:
                with open(source, "rb") as f:
                    shutil.copyfileobj(f, out)
    with open(os.path.join(folder, "README.md"), "w", encoding="utf-8") as f:
        f.write(card)
    names = [*sorted(files), "README.md"]
    if archive:
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for name in names:
                z.write(os.path.join(folder, name), name)
    return names
