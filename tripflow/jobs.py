"""Command-line jobs: clean, report, publish, consume.

    python -m tripflow.jobs clean   --root DATA --out OUT --service green --year 2020 [--month 3]
    python -m tripflow.jobs report  --root OUT --year 2020 --services green yellow \
                                    --report-out R --details-out D [--replace] [--format parquet --option k=v --table]
    python -m tripflow.jobs publish --input PATH --service yellow --bootstrap HOST:PORT --topic rides
    python -m tripflow.jobs consume --bootstrap HOST:PORT --topic rides --out DIR --checkpoint DIR
    python -m tripflow.jobs consume --bootstrap HOST:PORT --topic rides            (console)

``clean`` writes ``year=/month=`` partitions with dynamic overwrite. Without
``--month`` it cleans every month folder of the year in one Spark job (each
row judged against its own folder month); months whose column types differ
are read each by its own schema, and keep all their columns. With
``--month`` it writes that month alone, in ``--files`` files (4).

``consume`` needs ``--out`` and ``--checkpoint`` to keep its answers: each
query writes ``OUT/{query}`` and resumes from ``CHECKPOINT/{query}``.
``publish`` and ``consume`` take the security and batch options of a topic.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import metrics as M
from tripflow.operators.clean import clean_month, clean_months
from tripflow.operators.report import zone_month_report
from tripflow.operators.unify import register_trips, unify
from tripflow.operators.wire import decode_rides
from tripflow.schemas import service
from tripflow.session import get_session
from tripflow.sinks.writers import (
    ORIGINAL_FILES_PER_MONTH,
    publish_rides,
    write_clean,
    write_details,
    write_report,
)
from tripflow.sources.parquet import read_month, read_months_merged
from tripflow.sources.stream import KafkaSource, ride_stream
from tripflow.streaming.runner import await_any, start_query

PARTITIONS = ["year", "month"]


def run_clean(
    spark: SparkSession,
    root: str,
    out: str,
    svc: str,
    year: int,
    month: int | None,
    files: int = ORIGINAL_FILES_PER_MONTH,
) -> None:
    """Clean one month (into ``files`` files) or all months of a year in one
    job, into ``{out}/{service}/year=/month=``; source folders are per
    month, so the year's write needs no shuffle."""
    spec = service(svc)
    target = f"{out.rstrip('/')}/{spec.folder}"
    if month:
        cleaned = clean_month(read_month(spark, root, spec, year, month), spec, year, month)
        placed = cleaned.withColumns({"year": F.lit(year), "month": F.lit(month)})
        write_clean(placed, target, files=files, partition_cols=PARTITIONS)
        return
    write_clean(clean_months(read_months_merged(spark, root, spec, [year]), spec), target, partition_cols=PARTITIONS)


def load_cleaned(spark: SparkSession, root: str, svc: str, year: int) -> DataFrame:
    """Cleaned trips of a year."""
    base = f"{root.rstrip('/')}/{service(svc).folder}"
    return spark.read.parquet(base).filter(F.col("year") == year).drop(*PARTITIONS)


def run_report(
    spark: SparkSession,
    root: str,
    year: int,
    services: list[str],
    report_out: str,
    details_out: str | None,
    replace: bool,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    as_table: bool = False,
) -> None:
    """``report_out`` and ``details_out`` are paths, or table names with ``as_table``."""
    trips = unify({s: load_cleaned(spark, root, s, year) for s in services})
    register_trips(spark, trips)
    target = {"fmt": fmt, "options": options, "as_table": as_table}
    write_report(zone_month_report(trips), report_out, mode="overwrite" if replace else "errorifexists", **target)
    if details_out:
        write_details(trips, details_out, mode="replace" if replace else "append", **target)


def ride_queries(rides: DataFrame, exact: bool = False) -> dict[str, tuple[DataFrame, str, int | None, list[str] | None]]:
    """The five continuous metrics: plan, output mode, state partitions and
    the keys of an update-mode answer."""
    glob, windowed = M.STATE_PARTITIONS_GLOBAL, M.STATE_PARTITIONS_WINDOWED
    return {
        "running_totals": (M.running_totals(rides, exact), "update", glob, []),
        "window_metrics": (M.window_metrics(rides, exact=exact), "update", windowed, ["window"]),
        "surcharged_trips": (M.surcharged_trips(rides), "update", glob, []),
        "anomalies": (M.anomalies(rides), "append", None, None),
        "peak_windows": (M.peak_windows(rides), "complete", windowed, None),
    }


def start_consume(
    spark: SparkSession,
    source: KafkaSource | str,
    out: str | None = None,
    checkpoint: str | None = None,
    sink: str | None = None,
    trigger: str | None = None,
    max_per_trigger: int | None = None,
    exact: bool = False,
) -> dict:
    """Start all five queries over one subscription (or folder of text files)."""
    sink = sink or ("table" if out else "console")
    if sink not in ("table", "console"):
        raise ValueError("the sink of consume is 'table' or 'console'")
    if sink == "table" and not (out and checkpoint):
        raise ValueError("sink 'table' needs an output folder and a checkpoint folder")
    rides = decode_rides(ride_stream(spark, source, max_per_trigger))
    started = {}
    for name, (plan, mode, parts, _) in ride_queries(rides, exact).items():
        started[name] = start_query(
            plan,
            name=name,
            mode=mode,
            sink=sink,
            path=f"{out.rstrip('/')}/{name}" if sink == "table" else None,
            checkpoint=f"{checkpoint.rstrip('/')}/{name}" if checkpoint else None,
            trigger=trigger,
            state_partitions=parts,
        )
    return started


def _topic(p: argparse.ArgumentParser) -> None:
    p.add_argument("--bootstrap", required=True)
    p.add_argument("--topic", required=True)
    p.add_argument("--security", help="security protocol, such as SASL_SSL")
    p.add_argument("--mechanism", help="SASL mechanism, such as OAUTHBEARER")
    p.add_argument("--token-endpoint")
    p.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE")


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def _source(args) -> KafkaSource:
    return KafkaSource(
        args.bootstrap,
        args.topic,
        starting_offsets=getattr(args, "starting_offsets", "earliest"),
        security=args.security,
        mechanism=args.mechanism,
        token_endpoint=args.token_endpoint,
        max_offsets_per_trigger=getattr(args, "max_offsets", None),
        min_partitions=getattr(args, "min_partitions", None),
        extra=_pairs(args.kafka_option),
    )


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tripflow.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--root", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--service", required=True)
    c.add_argument("--year", type=int, required=True)
    c.add_argument("--month", type=int)
    c.add_argument("--files", type=int, default=ORIGINAL_FILES_PER_MONTH, help="files of the one month")
    r = sub.add_parser("report")
    r.add_argument("--root", required=True)
    r.add_argument("--year", type=int, required=True)
    r.add_argument("--services", nargs="+", default=["green", "yellow"])
    r.add_argument("--report-out", required=True)
    r.add_argument("--details-out")
    r.add_argument("--replace", action="store_true")
    r.add_argument("--format", default="parquet")
    r.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    r.add_argument("--table", action="store_true", help="the outputs are table names")
    p = sub.add_parser("publish")
    p.add_argument("--input", required=True)
    p.add_argument("--service", required=True)
    _topic(p)
    k = sub.add_parser("consume")
    _topic(k)
    k.add_argument("--out")
    k.add_argument("--checkpoint")
    k.add_argument("--sink", choices=["table", "console"])
    k.add_argument("--starting-offsets", default="earliest")
    k.add_argument("--max-offsets", type=int, default=10_000_000, help="records of a micro-batch")
    k.add_argument("--min-partitions", type=int)
    return ap


def main(argv: list[str] | None = None) -> None:
    ap = parser()
    args = ap.parse_args(argv)
    if args.job == "consume" and bool(args.out) != bool(args.checkpoint):
        ap.error("--out and --checkpoint go together")
    if args.job == "consume" and (args.sink == "console") == bool(args.out) and args.sink:
        ap.error("--sink table needs --out and --checkpoint, --sink console takes neither")
    spark = get_session()
    if args.job == "clean":
        run_clean(spark, args.root, args.out, args.service, args.year, args.month, args.files)
    elif args.job == "report":
        run_report(
            spark,
            args.root,
            args.year,
            args.services,
            args.report_out,
            args.details_out,
            args.replace,
            args.format,
            _pairs(args.option),
            args.table,
        )
    elif args.job == "publish":
        publish_rides(spark.read.parquet(args.input), args.service, _source(args))
    elif args.job == "consume":
        start_consume(spark, _source(args), args.out, args.checkpoint, args.sink)
        await_any(spark)


if __name__ == "__main__":
    main()
