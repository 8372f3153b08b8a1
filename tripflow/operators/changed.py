"""Cleaning only the months whose source files have changed.

Each month of the cleaned table keeps, as the note of its part, a digest of
the files it was made from (name, length, time of change). A run lists the
source files, compares the digests, cleans the months that are new or
changed in one job, and removes months whose files are gone; readers see
all of it at once (``PartTable``). A run without a change writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators.clean import clean_months
from tripflow.operators.partials import month_part
from tripflow.schemas import ServiceSpec, service
from tripflow.sinks.parts import PartTable, part_name
from tripflow.sources.parquet import FOLDER_MONTH, with_folder_month

Month = tuple[int, int]


@dataclass(frozen=True)
class Changes:
    """Months (year, month) that a run cleaned, removed and left."""

    cleaned: list[Month]
    removed: list[Month]
    left: list[Month]


def source_months(spark: SparkSession, root: str, spec: ServiceSpec | str, glob_filter: str = "*.parquet") -> DataFrame:
    """Rows (year, month, folder, digest) of a service's month folders, in either layout.

    Files are listed, not read; a month's digest covers the name, length and time of all its files.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob_filter)
        .option("recursiveFileLookup", "true")
        .load(f"{root.rstrip('/')}/{service(spec).folder}")
        .select("path", "length", "modificationTime")
    )
    year, month = (F.regexp_extract("path", FOLDER_MONTH, k).try_cast("int") for k in (1, 2))
    one = F.concat_ws("|", F.regexp_extract("path", "[^/]+$", 0), "length", F.unix_micros("modificationTime"))
    return (
        listed.withColumns({"year": year, "month": month, "folder": F.regexp_replace("path", "/[^/]+$", "")})
        .filter("year IS NOT NULL AND month BETWEEN 1 AND 12")
        .groupBy("year", "month", "folder")
        .agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(one))), 256).alias("digest"))
    )


def clean_changed(spark: SparkSession, root: str, target: str, spec: ServiceSpec | str) -> Changes:
    """Bring the cleaned table under ``target`` up to date with the month folders under ``root``.

    Months must have one schema (what ``clean_months`` types may differ in type across runs).
    """
    spec = service(spec)
    table = PartTable(spark, target)
    found = {(r["year"], r["month"]): r for r in source_months(spark, root, spec).collect()}  # a row a month
    notes, names = table.live(), {month_part(spec.name, *m): m for m in found}
    changed = {p: m for p, m in names.items() if notes.get(p) != found[m]["digest"]}
    prefix = f"{part_name(spec.name)}."
    gone = [p for p in notes if p not in names and p.startswith(prefix)]
    if changed or gone:
        parts = {p: found[m]["digest"] for p, m in changed.items()} | dict.fromkeys(gone)
        if changed:
            raw = spark.read.parquet(*(found[m]["folder"] for m in changed.values()))
            cleaned = clean_months(with_folder_month(raw), spec)
        else:
            cleaned = spark.createDataFrame([], "year int, month int")
        name = F.concat(F.lit(prefix), F.lpad("year", 4, "0"), F.lit("."), F.lpad("month", 2, "0"))
        table.replace(cleaned.withColumn("part", name), parts)
    ends = [tuple(int(x) for x in p.rsplit(".", 2)[1:]) for p in gone]
    return Changes(sorted(changed.values()), sorted(ends), sorted(set(found) - set(changed.values())))


def read_cleaned(spark: SparkSession, target: str, schema: T.StructType | str) -> DataFrame:
    """The cleaned trips of all months, by a schema with the columns wanted."""
    return PartTable(spark, target).read(schema).drop("part")
