"""Cleaning what changed, months grouped by footer schema, ranking by ranges."""

import shutil

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tripflow.operators.changed import clean_changed, read_cleaned
from tripflow.operators.clean import clean_months
from tripflow.operators.ranking import global_rank
from tripflow.plans import catalog_kept
from tripflow.plans.adapters import raw_trips_from_lineitem
from tripflow.schemas import GREEN
from tripflow.sources.parquet import month_folders, read_months_merged
from tripflow.sources.tables import read_table


def green(spark, sf_small):
    return raw_trips_from_lineitem(read_table(spark, sf_small, "lineitem"), GREEN)


def month_rows(raw, year, month):
    return raw.filter((F.col("year") == year) & (F.col("month") == month)).drop("year", "month").coalesce(1)


def rows_of(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_only_changed_months_are_cleaned(spark, sf_small, tmp_path):
    raw = green(spark, sf_small)
    root, target = str(tmp_path / "raw"), str(tmp_path / "clean")
    months = [(1996, 1), (1996, 2), (1996, 3)]
    for y, m in months:  # the plain layout
        month_rows(raw, y, m).write.parquet(f"{root}/green/{y}/{m:02d}")
    # a month of which cleaning leaves nothing
    month_rows(raw, 1996, 4).write.parquet(f"{root}/green/1999/07")
    some = raw.filter((F.col("year") == 1996) & (F.col("month") <= 3))
    schema = clean_months(raw, GREEN).schema
    want = rows_of(clean_months(some, GREEN))
    first = clean_changed(spark, root, target, GREEN)
    assert (first.cleaned, first.removed, first.left) == ([*months, (1999, 7)], [], [])
    assert rows_of(read_cleaned(spark, target, schema)) == want
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "clean").rglob("*") if p.is_file()}
    again = clean_changed(spark, root, target, GREEN)
    assert (again.cleaned, again.removed, again.left) == ([], [], [*months, (1999, 7)])
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "clean").rglob("*") if p.is_file()}
    # one month changes, one vanishes, one is new
    month_rows(raw, 1996, 2).filter("trip_distance < 25").write.mode("overwrite").parquet(f"{root}/green/1996/02")
    shutil.rmtree(f"{root}/green/1996/03")
    month_rows(raw, 1997, 5).write.parquet(f"{root}/green/1997/05")
    last = clean_changed(spark, root, target, GREEN)
    assert (last.cleaned, last.removed, last.left) == ([(1996, 2), (1997, 5)], [(1996, 3)], [(1996, 1), (1999, 7)])
    kept = raw.filter(
        "(year = 1996 AND month = 1) OR (year = 1996 AND month = 2 AND trip_distance < 25) OR (year = 1997 AND month = 5)"
    )
    assert rows_of(read_cleaned(spark, target, schema)) == rows_of(clean_months(kept, GREEN))


def test_the_mended_month_is_not_read_by_one_task(spark, sf_small, tmp_path, monkeypatch):
    """No task of ``clean_changed_months`` reads all line items: every write has the splits of its scan."""
    rows = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    rows.repartition(6).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    plans, parquet = [], DataFrameWriter.parquet

    def noted(self, path, *args, **kw):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return parquet(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    try:
        got = rows_of(catalog_kept.q_clean_changed_months(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    scans = [p for p in plans if "l_returnflag" in p]
    assert len(scans) == 2 and not any("Coalesce" in p for p in scans)
    assert all("REBALANCE" in p for p in scans)
    assert got == rows_of(clean_months(green(spark, sf_small), GREEN))


def test_months_of_one_schema_share_a_scan(spark, tmp_path):
    kinds = ("int", "bigint", "string")
    for k in range(12):
        one = spark.range(3).select(F.col("id").cast(kinds[k % 3]).alias("PULocationID"), F.lit(k).alias("k"))
        one.coalesce(1).write.parquet(f"{tmp_path}/green/{2015 + k // 4}/{k % 4 + 1:02d}")
    df = read_months_merged(spark, str(tmp_path), GREEN)
    assert len(month_folders(spark, str(tmp_path), GREEN)) == 12
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    got = {(r.year, r.month, r.k, r.PULocationID) for r in df.collect()}
    assert got == {(2015 + k // 4, k % 4 + 1, k, i) for k in range(12) for i in range(3)}


def test_global_rank_without_one_task(spark):
    df = spark.range(0, 5000, 1, 7).select("id", (F.col("id") * 7919 % 31).alias("n"))
    for parts in (1, 5):
        ranked = global_rank(df, [F.desc("n"), F.col("id")], "place", partitions=parts)
        rows = ranked.orderBy("place").collect()
        want = sorted(((r.id, r.n) for r in df.collect()), key=lambda x: (-x[1], x[0]))
        assert [(r.id, r.n) for r in rows] == want and [r.place for r in rows] == list(range(1, 5001))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert global_rank(df.limit(0), [F.col("id")]).count() == 0
