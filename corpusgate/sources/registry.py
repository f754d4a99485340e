"""Sources by name or alias, and the provenance record of a run."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a provenance record, in order.
PROVENANCE = "source_dataset string, dataset_url string, license string, license_confirmed boolean, attribution_required boolean, attribution_note string, retrieved_at string, max_records int, actual_records_seen long, bulk_download_blocked boolean, offline_fixture_used string, notes string, transform_version string"


@dataclass(frozen=True)
class Source:
    name: str
    url: str = ""
    license: str = ""
    license_confirmed: bool = False
    attribution_required: bool = False
    attribution_note: str = ""


@dataclass
class Registry:
    """Sources by id, and other names for the ids. There are few of them by nature."""

    sources: dict[str, Source]
    aliases: dict[str, str] = field(default_factory=dict)

    def get(self, name: str) -> Source:
        """The source of an id or alias; raises KeyError that lists the known names."""
        own = self.aliases.get(name, name)
        if own not in self.sources:
            raise KeyError(f"unknown source {name!r}; known: {', '.join(sorted({*self.sources, *self.aliases}))}")
        return self.sources[own]

    def resolved(self, name: Column, strict: bool = False) -> Column:
        """The id of each name of a column: aliases replaced; an unknown name becomes null, or fails the job if ``strict``."""
        known = {**{s: s for s in self.sources}, **self.aliases}
        pairs = F.create_map(*[F.lit(x) for kv in sorted(known.items()) for x in kv]) if known else F.create_map().cast("map<string,string>")
        found = pairs[name]
        return F.when(found.isNull() & name.isNotNull(), F.raise_error(F.concat(F.lit("unknown source "), name))).otherwise(found) if strict else found


def from_table(manifest: DataFrame, aliases: dict[str, str] | None = None, name: str = "source_dataset") -> Registry:
    """A registry from a table of sources with one row each, of at most 10,000."""
    rows = manifest.limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("over 10,000 sources")
    pick = lambda r, c, default: getattr(r, c, None) if getattr(r, c, None) is not None else default
    sources = {r[name]: Source(r[name], pick(r, "dataset_url", ""), pick(r, "license", ""), pick(r, "license_confirmed", False), pick(r, "attribution_required", False), pick(r, "attribution_note", "")) for r in rows if r[name] is not None}
    return Registry(sources, aliases or {})


def provenance_record(spark: SparkSession, source: Source, max_records: int, seen: int, transform_version: str, fixture: str | None = None, notes: str = "", retrieved_at: str | None = None) -> DataFrame:
    """One row that says what a run read of a source, by what licence, when, and how much."""
    when = retrieved_at or datetime.datetime.now(datetime.timezone.utc).isoformat()
    row = (source.name, source.url, source.license, source.license_confirmed, source.attribution_required, source.attribution_note, when, max_records, seen, True, fixture, notes, transform_version)
    return spark.createDataFrame([row], PROVENANCE)
