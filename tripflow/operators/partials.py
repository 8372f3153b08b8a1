"""The zone-month report kept up to date month by month.

A ``PartTable`` holds partial sums and counts, one part for each service and
source month, one row for each (zone, month, service) of it. New or
corrected months are aggregated alone and replace their parts; the report
is a merge of the partials, whose number does not grow with the trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.money import EXACT_TYPE
from tripflow.operators.report import Measure, _month_col, measures_for
from tripflow.sinks.parts import PartTable, part_name

KEYS = ["revenue_zone", "revenue_month", "service_type"]


def source_part(pickup: str = "pickup_datetime") -> Column:
    """The part of a trip: its service and the month of its pickup.

    Cleaning keeps trips inside their folder's month, so this is the source
    folder's month too.
    """
    service = F.regexp_replace("service_type", "[^A-Za-z0-9_-]", "_")
    return F.concat_ws(".", service, F.date_format(pickup, "yyyy"), F.date_format(pickup, "MM"))


def month_part(service_type: str, year: int, month: int) -> str:
    """The name that ``source_part`` gives to a service's month."""
    return part_name(service_type, f"{year:04d}", f"{month:02d}")


def partial_report(
    trips: DataFrame, measures: list[Measure] | None = None, part: Column | None = None, exact: bool = False
) -> DataFrame:
    """Mergeable sums and counts of each measured column, by part, zone, month and service.

    ``exact`` sums decimals of six places, whatever the order of rows; a value
    that they can't hold (NaN, an infinity, 10^22 and more) is summed apart, as
    a double, so it reaches the report.
    """
    aggs = []
    for c in dict.fromkeys(m.column for m in measures or measures_for(trips)):
        value = F.col(c).cast("double")
        if exact:
            held = F.col(c).try_cast(EXACT_TYPE)
            aggs.append(F.sum(held).cast("decimal(38,6)").alias(f"{c}_exact"))
            value = F.when(held.isNull(), value)
        aggs += [F.sum(value).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
    return trips.groupBy(
        (source_part() if part is None else part).alias("part"),
        F.col("PULocationID").alias("revenue_zone"),
        _month_col(trips, "pickup_datetime").alias("revenue_month"),
        F.col("service_type"),
    ).agg(*aggs)


def merged_report(partials: DataFrame, measures: list[Measure]) -> DataFrame:
    """The report of all partials, with the columns of ``zone_month_report``."""
    aggs = []
    for m in measures:
        total = F.sum(f"{m.column}_sum")
        if f"{m.column}_exact" in partials.columns:
            exact = F.sum(f"{m.column}_exact").cast("double")
            total = F.when(total.isNull(), exact).otherwise(total + F.coalesce(exact, F.lit(0.0)))
        if m.kind == "avg":
            total = total / F.nullif(F.sum(f"{m.column}_n"), F.lit(0))
        aggs.append(total.alias(m.alias))
    return partials.groupBy(*KEYS).agg(*aggs)


class IncrementalReport:
    """A report under ``root`` whose months are replaced one by one."""

    def __init__(self, spark: SparkSession, root: str, measures: list[Measure], exact: bool = False):
        self.table, self.measures, self.exact = PartTable(spark, root), measures, exact

    def _schema(self, ntz: bool = True) -> T.StructType:
        month = T.TimestampNTZType() if ntz else T.TimestampType()
        out = T.StructType().add("revenue_zone", T.IntegerType()).add("revenue_month", month).add("service_type", T.StringType())
        for c in dict.fromkeys(m.column for m in self.measures):
            if self.exact:
                out = out.add(f"{c}_exact", T.DecimalType(38, 6))
            out = out.add(f"{c}_sum", T.DoubleType()).add(f"{c}_n", T.LongType())
        return out

    def refresh(self, trips: DataFrame, months: list[tuple[str, int, int]]) -> None:
        """Put the cleaned ``trips`` in place of what the table has of ``months`` (service, year, month).

        Months without trips go from the report; trips of other months are refused.
        """
        rows = partial_report(trips, self.measures, exact=self.exact)
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._schema().fields]
        self.table.replace(rows.select("part", *fields), {month_part(*m): None for m in months})

    def report(self) -> DataFrame:
        """The report of all months; reads the partials only."""
        return merged_report(self.table.read(self._schema()), self.measures)
