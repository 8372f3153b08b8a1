"""Readers for monthly trip files.

Layouts understood:

* the original one: ``{root}/{folder}/{year}/{MM}/*.parquet`` (no
  ``key=value`` names, so Spark sees no partition columns);
* the partitioned one this package writes:
  ``{root}/{folder}/year={y}/month={m}/*.parquet``, where filters on
  ``year``/``month`` prune whole folders before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.casts import conform, conformed
from tripflow.schemas import ServiceSpec, service


def month_path(root: str, spec: ServiceSpec | str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/{service(spec).folder}/{year}/{month:02d}/"


def read_month(
    spark: SparkSession, root: str, spec: ServiceSpec | str, year: int, month: int
) -> DataFrame:
    """One month's folder, schema from the parquet footers."""
    return spark.read.parquet(month_path(root, spec, year, month))


def read_year(
    spark: SparkSession,
    root: str,
    spec: ServiceSpec | str,
    year: int | str,
    glob_filter: str | None = "*.parquet",
    partitioned: bool = False,
) -> DataFrame:
    """All month folders of a year through a ``{year}/*/`` glob
    (``year="*"``: of every year).

    ``glob_filter`` keeps only matching file names (markers such as
    ``_SUCCESS`` are skipped either way). ``partitioned`` reads the
    ``year=/month=`` layout instead, keeping ``year``/``month`` columns.
    """
    base = f"{root.rstrip('/')}/{service(spec).folder}"
    reader = spark.read
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if partitioned:
        return reader.option("basePath", base).parquet(f"{base}/year={year}/*/")
    return reader.parquet(f"{base}/{year}/*/")


# Year and month of a file's folder, in either layout.
FOLDER_MONTH = r"/(?:year=)?(\d{4})/(?:month=)?(\d{1,2})/[^/]+$"


def with_folder_month(df: DataFrame) -> DataFrame:
    """Add ``year``/``month`` taken from each row's file path
    (``.../{year}/{MM}/file.parquet``, or ``.../year={year}/month={M}/...``);
    a file-metadata read, no shuffle."""
    path = F.col("_metadata.file_path")
    pattern = FOLDER_MONTH
    return df.withColumns(
        {
            "year": F.regexp_extract(path, pattern, 1).try_cast("int"),
            "month": F.regexp_extract(path, pattern, 2).try_cast("int"),
        }
    )


def read_months(
    spark: SparkSession,
    root: str,
    spec: ServiceSpec | str,
    years: list[int] | None = None,
    glob_filter: str | None = "*.parquet",
) -> DataFrame:
    """Every month folder (of the given years) in one scan, with the folder
    month as ``year``/``month`` columns, for months whose files have one
    schema (``read_months_merged`` takes months that differ)."""
    spec = service(spec)
    base = f"{root.rstrip('/')}/{spec.folder}"
    paths = [f"{base}/{y}/*/" for y in years] if years else [f"{base}/*/*/"]
    reader = spark.read
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    return with_folder_month(reader.parquet(*paths))


def read_with_schema(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    strict: bool = False,
    glob_filter: str | None = None,
) -> DataFrame:
    """Read with a declared schema.

    ``strict=True`` hands the schema to the parquet reader, which fails on
    files whose physical type differs (a bigint file read as int). The
    default reads each path by the schema in its own footers and projects it
    onto the declared one with ``try_cast`` and typed nulls for absent
    columns; columns that are never used are still pruned from the scans.
    Files of one path must agree (give one path a month).
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if strict:
        return reader.schema(schema).parquet(*paths)
    frames = [conform(reader.parquet(p), schema) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def month_folders(
    spark: SparkSession, root: str, spec: ServiceSpec | str, years: list[int] | None = None
) -> list[tuple[int, int, str]]:
    """``(year, month, path)`` of every ``{year}/{MM}`` folder, listed through
    the Hadoop file system of the path (local, HDFS, object stores)."""
    spec = service(spec)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = f"{root.rstrip('/')}/{spec.folder}"
    patterns = [f"{base}/{y}/*" for y in years] if years else [f"{base}/*/*"]
    found = []
    for pattern in patterns:
        glob = jvm.org.apache.hadoop.fs.Path(pattern)
        statuses = glob.getFileSystem(conf).globStatus(glob) or []
        for st in statuses:
            if not st.isDirectory():
                continue
            path = st.getPath()
            y, m = path.getParent().getName(), path.getName()
            if y.isdigit() and m.isdigit():
                found.append((int(y), int(m), path.toString()))
    return sorted(found)


def read_months_merged(
    spark: SparkSession,
    root: str,
    spec: ServiceSpec | str,
    years: list[int] | None = None,
    glob_filter: str | None = "*.parquet",
) -> DataFrame:
    """Every month folder read by its own footer schema and unioned, with all
    columns that any month has and ``year``/``month`` of the folder.

    For months whose files disagree: a column may be bigint in one month,
    double or text in another, or absent. The columns that cleaning types
    take their declared type (``try_cast``); any other column keeps its type
    where all months agree, becomes double where they differ in number type
    only, and text otherwise. Absent columns are null. Months with one footer
    schema share a scan, so the plan has one scan for each distinct schema; no
    data passes through the driver.
    """
    spec = service(spec)
    typed: dict[str, T.DataType] = dict.fromkeys(spec.int_cols, T.IntegerType())
    typed |= dict.fromkeys(spec.double_cols, T.DoubleType())
    typed[spec.vendor_col] = T.StringType() if spec.licence_digit else T.IntegerType()
    groups: dict[str, tuple[T.StructType, list[str]]] = {}

    def reader():
        return spark.read.option("pathGlobFilter", glob_filter) if glob_filter else spark.read

    for _, _, path in month_folders(spark, root, spec, years):
        schema = reader().parquet(path).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    if not groups:
        raise FileNotFoundError(f"no month folders under {root}/{spec.folder}")
    found: dict[str, list[T.DataType]] = {}
    for schema, _ in groups.values():
        for f in schema.fields:
            kinds = found.setdefault(f.name, [])
            if f.dataType not in kinds:
                kinds.append(f.dataType)
    target = T.StructType([T.StructField(c, typed.get(c) or common_type(kinds)) for c, kinds in found.items()])
    out = None
    for schema, paths in groups.values():
        df = with_folder_month(reader().schema(schema).parquet(*paths))
        one = df.select(*conformed(df, target), "year", "month")
        out = one if out is None else out.unionByName(one)
    return out


def common_type(kinds: list[T.DataType]) -> T.DataType:
    """A type that holds the values of all ``kinds``."""
    if len(kinds) == 1:
        return kinds[0]
    if all(isinstance(k, (T.TimestampType, T.TimestampNTZType)) for k in kinds):
        return T.TimestampNTZType()
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.LongType() if all(isinstance(k, T.IntegralType) for k in kinds) else T.DoubleType()
    return T.StringType()
