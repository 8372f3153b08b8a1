"""Tables of parts that are replaced one by one, each replacement visible at once.

A part (a month of a service, say) lies in one of two slots of its own:
``{root}/data/part=<name>/slot=<0|1>``. A replacement writes the slots that
readers don't use; then a new manifest, a small table of (part, slot, note),
names the slots that count. Manifests alternate between two slots as well
and carry a version, the highest of which holds. So

* readers see all parts of a replacement or none of them;
* a job that dies before its manifest leaves the table as it was, and its
  rerun overwrites what it left;
* a part that is replaced by no rows goes, or stays as an empty part if it has a note;
* files don't pile up: each part has two slots, and there are two manifests.

One writer at a time. A reader keeps a valid view until the part it reads
has been replaced twice. ``note`` is free text kept with a part (the state
of its source, say). Only names, slots and notes reach the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sources.paths import exists

MANIFEST = "version long, part string, slot int, note string"
# The slot of a part that has a note but no rows.
EMPTY = -1
_NAME = re.compile(r"[A-Za-z0-9._-]+")


def part_name(*values) -> str:
    """A part's name: the values joined by ``.``, other characters than letters, digits and ``_-`` as ``_``."""
    return ".".join(re.sub(r"[^A-Za-z0-9_-]", "_", str(v)) for v in values)


class PartTable:
    """A table of parts under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _manifest(self) -> tuple[int, dict[str, tuple[int, str | None]]]:
        """The version that holds (-1: none yet), and slot and note of each live part."""
        slots = [p for p in (f"{self.root}/manifest/slot={k}" for k in (0, 1)) if exists(self.spark, p)]
        rows = self.spark.read.schema(MANIFEST).parquet(*slots).collect() if slots else []
        version = max((r["version"] for r in rows), default=-1)
        return version, {r["part"]: (r["slot"], r["note"]) for r in rows if r["version"] == version and r["part"]}

    def live(self) -> dict[str, str | None]:
        """The parts that count, with their notes."""
        return {part: note for part, (_, note) in self._manifest()[1].items()}

    def replace(self, rows: DataFrame, parts: dict[str, str | None], part_col: str = "part") -> None:
        """Put ``rows`` (with their part's name in ``part_col``) in place of the ``parts`` (name to note).

        Rows of other parts are refused; a part without rows and note is removed.
        """
        bad = [p for p in parts if not _NAME.fullmatch(p)]
        if bad:
            raise ValueError(f"not a part's name: {bad[0]!r}")
        if not parts:
            return
        version, live = self._manifest()
        slots = {p: 1 - max(0, live[p][0]) if p in live else 0 for p in parts}
        names = self.spark.createDataFrame(list(slots.items()), "part string, slot int")
        placed = rows.withColumnRenamed(part_col, "part").join(F.broadcast(names), "part", "left")
        stray = F.concat(F.lit("rows of a part that is not replaced: "), F.coalesce("part", F.lit("null")))
        checked = placed.withColumn("slot", F.coalesce("slot", F.raise_error(stray).cast("int")))
        (
            checked.hint("rebalance", "part", "slot")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("part", "slot")
            .parquet(f"{self.root}/data")
        )
        # a slot that got no rows may still hold those of two replacements ago
        full = {r["part"] for r in checked.select("part").distinct().collect()}  # some of ``parts``
        kept = {p: at for p, at in live.items() if p not in parts}
        kept |= {p: (slots[p] if p in full else EMPTY, note) for p, note in parts.items() if p in full or note is not None}
        self._commit(version + 1, kept)

    def _commit(self, version: int, parts: dict[str, tuple[int, str | None]]) -> None:
        listed = [(version, p, slot, note) for p, (slot, note) in parts.items()] or [(version, None, None, None)]
        frame = self.spark.createDataFrame(listed, MANIFEST).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{self.root}/manifest/slot={version % 2}")

    def read(self, schema: T.StructType | str, parts: list[str] | None = None) -> DataFrame:
        """The live rows (of some parts), with their part's name; only live slots are listed and scanned."""
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        live = self._manifest()[1]
        full = {p for p, (slot, _) in live.items() if slot != EMPTY}
        chosen = sorted(full if parts is None else set(parts) & full)
        paths = [f"{self.root}/data/part={p}/slot={live[p][0]}" for p in chosen]
        whole = T.StructType([*schema.fields, T.StructField("part", T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], whole)
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*schema.names, F.col("part").cast("string").alias("part"))
