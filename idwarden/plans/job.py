"""The batch job: read the sources, fill every result table.

    python -m idwarden.plans.job --env dev --root /data --source okta --input_file source/okta/x.parquet

Table names may come one by one (``--risk_table scores``) or as the ``tables`` map of a JSON file.
"""

import argparse
import json
import logging
import sys
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from threading import Lock

from pyspark.sql import SparkSession

from idwarden.constants import SOURCE_KEYS, TABLES
from idwarden.functions.checks import one_of, positive
from idwarden.plans.ledger import Ledger, Run, listed
from idwarden.plans.partials import FROM_PARTIALS, Store
from idwarden.plans.registry import CHECKS, DETECTORS, of_days
from idwarden.plans.session import session
from idwarden.plans.sinks import write_catalog_table, write_table
from idwarden.sources import Sources, load_sources

log = logging.getLogger(__name__)

WRITE_METHODS = ("direct", "indirect")


@dataclass(frozen=True)
class Sink:
    """Files below ``path``, tables of a ``catalog`` (its name and that of a schema), or a connector by its options."""

    path: str | None = None
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    catalog: str | None = None

    def write(self, rows, table: str, run_id: str | None) -> int:
        if self.catalog is not None:
            return write_catalog_table(rows, f"{self.catalog}.{table}", run_id or uuid.uuid4().hex, fmt=self.fmt)
        return write_table(rows, table, path=self.path, fmt=self.fmt, run_id=run_id, options=self.options)


@dataclass(frozen=True)
class Outcome:
    key: str
    table: str
    rows: int = 0
    seconds: float = 0.0
    error: str | None = None


def _loaded_once(load: Callable[..., Sources]) -> Callable[..., Sources]:
    """``load``, but tables that read the same days share one listing of the files and their footers. A load that fails is tried again."""
    lock, known = Lock(), {}

    def shared(days=None) -> Sources:
        key = None if days is None else tuple(sorted(days.items()))
        with lock:
            if key not in known:
                known[key] = load(days=days)
            return known[key]

    return shared


def run(
    src: Sources | Callable[..., Sources], sink: Sink, *, tables: dict[str, str] | None = None, run_id: str | None = None,
    keys: list[str] | None = None, parallel: int = 4, first_day: str | None = None, last_day: str | None = None,
    store: Store | None = None,
) -> list[Outcome]:
    """Fill the tables of ``keys`` (all by default). A table that fails does not stop the others.

    Several tables are computed at once so that one table's last tasks do not idle the cluster.
    A range of days needs ``src`` as a function of ``days``, so that each table reads what it needs around the range; it is called once for each
    range that tables read.
    With ``store`` the tables of ``FROM_PARTIALS`` are merged from its partials, which are brought up to date first.
    """
    positive(parallel=parallel)
    detectors = {**DETECTORS, **CHECKS}
    names = {**TABLES, **{name: name for name in CHECKS}, **(tables or {})}
    for key in [*names, *(keys or [])]:
        one_of("table key", key, detectors)

    if not callable(src) and (first_day or last_day):
        raise ValueError("a range of days needs a function that loads the sources")
    load = _loaded_once(src) if callable(src) else lambda days=None: src
    merged = [key for key in keys or list(DETECTORS) if store is not None and key in FROM_PARTIALS]
    with ThreadPoolExecutor(parallel) as pool:
        for source, days in pool.map(lambda s: (s, store.refresh(s)), sorted({s for key in merged for s in FROM_PARTIALS[key][0]})):
            log.info("%s: partials of %s days made anew", source, len(days))

    def rows_of(key: str):
        return store.table(key, load(days=None).hr) if key in merged else of_days(key, first_day, last_day, load)

    def fill(key: str) -> Outcome:
        began = time.monotonic()
        try:
            rows = sink.write(rows_of(key), names[key], run_id)
            log.info("%s: %s rows", names[key], rows or "no")
            return Outcome(key, names[key], rows, time.monotonic() - began)
        except Exception as e:
            log.warning("%s failed", names[key], exc_info=True)
            return Outcome(key, names[key], 0, time.monotonic() - began, str(e))

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(fill, keys or list(DETECTORS)))


def chosen(source: str, *, only_affected: bool = False, checks: bool = False) -> list[str]:
    """Keys to fill: all result tables, with ``checks`` the quality checks too, or only those that read ``source``."""
    one_of("source", source, SOURCE_KEYS)
    everything = {**DETECTORS, **CHECKS} if checks else DETECTORS
    return [key for key, detector in everything.items() if source in detector.reads or not only_affected]


def warehouse_sink(project: str, dataset: str, write_method: str = "direct", temp_bucket: str | None = None) -> Sink:
    """Options of the public BigQuery connector: append, new and relaxed columns allowed."""
    options = {
        "table": f"{project}:{dataset}.{{table}}",
        "writeMethod": write_method,
        "writeDisposition": "WRITE_APPEND",
        "schemaUpdateOptions": "ALLOW_FIELD_ADDITION,ALLOW_FIELD_RELAXATION",
    }
    if write_method == "indirect" and temp_bucket:
        options["temporaryGcsBucket"] = temp_bucket
    return Sink(None, "bigquery", options)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Fill the identity-access result tables")
    # Names of arguments and of the connector's options.
    p.add_argument("--env", default="dev", help="stands for {env} in --config, and picks that entry of the file if it has one")
    p.add_argument("--config", help="JSON file with root or gcs_bucket, tables and the other settings")
    p.add_argument("--ledger", help="folder with the files done so far: only unseen files of --source are read, runs that failed are repeated first")
    p.add_argument("--partials", help="folder with partial results per day: tables without days are merged from them, over all files below root, "
                   "and only days whose files changed are read")
    p.add_argument("--unique", action="store_true", help="keep one row for each event id, for input that may be delivered twice")
    p.add_argument("--same_columns", action="store_true", help="all files of a folder have the same columns: read one footer only")
    p.add_argument("--root", help="folder or URI that holds source/")
    p.add_argument("--gcs_bucket", help="short for --root gs://<bucket>")
    p.add_argument("--source", required=True, choices=SOURCE_KEYS)
    p.add_argument("--input_file", help="one file below root, used instead of the whole folder of --source")
    p.add_argument("--first_day", metavar="YYYY-MM-DD", help="only result rows of this day and later, in tables that have days")
    p.add_argument("--last_day", metavar="YYYY-MM-DD", help="only result rows of this day and earlier")
    p.add_argument("--sink_path", help="folder of the result tables; <root>/gold by default")
    p.add_argument("--sink_catalog", metavar="CATALOG.SCHEMA", help="write catalog tables, whose rows of a run are replaced in one commit")
    p.add_argument("--sink_format", default="parquet")
    p.add_argument("--sink_option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--bq_project")
    p.add_argument("--bq_dataset")
    p.add_argument("--write_method", choices=WRITE_METHODS)
    p.add_argument("--temp_gcs_bucket")
    p.add_argument("--run_id", help="names this run; a rerun with the same name replaces its rows")
    p.add_argument("--only_affected", action="store_true", help="only tables that read --source")
    p.add_argument("--checks", action="store_true", help="write the data-quality checks too")
    p.add_argument("--parallel", type=int, default=4, help="tables computed at once")
    p.add_argument("--shuffle_partitions", type=int, help="before adaptive merging; shuffled bytes / 200 MB is a good size")
    for key in TABLES:
        p.add_argument(f"--{key}", help=argparse.SUPPRESS)
    return p


def settings(argv: list[str] | None = None) -> argparse.Namespace:
    """Arguments, completed from ``--config``; arguments win."""
    args = parser().parse_args(argv)
    config = {}
    if args.config:
        with open(args.config.replace("{env}", args.env), encoding="utf-8") as f:
            config = json.load(f)
        config = config.get(args.env, config)
        if config.get("env", args.env) != args.env:
            raise ValueError(f"{args.config} is for {config['env']}, not for {args.env}")
    for name in ("root", "gcs_bucket", "bq_project", "bq_dataset", "sink_path", "temp_gcs_bucket", "write_method", "ledger", "partials", "sink_catalog"):
        if getattr(args, name) is None:
            setattr(args, name, config.get(name))
    args.write_method = args.write_method or "direct"
    one_of("write_method", args.write_method, WRITE_METHODS)
    named = {key: getattr(args, key) for key in TABLES if getattr(args, key)}
    args.tables = {**config.get("tables", {}), **named}
    if args.root is None:
        if args.gcs_bucket is None:
            raise ValueError("give --root or --gcs_bucket")
        args.root = f"gs://{args.gcs_bucket}"
    if args.sink_catalog:
        args.sink = Sink(fmt=args.sink_format, catalog=args.sink_catalog)
    elif args.bq_project and args.bq_dataset and not args.sink_path:
        args.sink = warehouse_sink(args.bq_project, args.bq_dataset, args.write_method, args.temp_gcs_bucket)
    else:
        options = dict(o.split("=", 1) for o in args.sink_option)
        args.sink = Sink(args.sink_path or f"{args.root}/gold", args.sink_format, options)
    args.run_id = args.run_id or uuid.uuid4().hex
    return args


def runs_to_do(spark: SparkSession, args: argparse.Namespace) -> list[Run]:
    """Runs of the ledger that failed, then one of all unseen files: of the source, or of ``--input_file``."""
    ledger = Ledger(spark, args.ledger)
    failed = ledger.unfinished()
    below = f"{args.root}/source/{args.source}"
    if args.input_file:
        below = args.input_file if ":" in args.input_file or args.input_file.startswith("/") else f"{args.root}/{args.input_file}"
    new = ledger.take(listed(spark, below), args.run_id)
    return [*failed, *([new] if new else [])]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit code 0 when every table was filled, 1 when any failed."""
    args = settings(argv)
    started = spark is None
    if started:
        sizing = {"spark.sql.shuffle.partitions": str(args.shuffle_partitions)} if args.shuffle_partitions else {}
        spark = session("idwarden", **sizing)
    failed = []
    try:
        todo = runs_to_do(spark, args) if args.ledger else [Run(args.run_id, args.input_file)]
        if not todo:
            log.info("no new files of %s", args.source)
        for one in todo:
            load = partial(load_sources, spark, args.root, args.source, one.files, merge_schema=not args.same_columns, unique=args.unique)
            outcomes = run(
                load, args.sink, tables=args.tables, run_id=one.run_id, keys=chosen(args.source, only_affected=args.only_affected, checks=args.checks),
                parallel=args.parallel, first_day=args.first_day, last_day=args.last_day,
                store=Store(spark, args.root, args.partials, args.unique) if args.partials else None,
            )
            tables = [o.table for o in outcomes if o.error]
            if args.ledger and not tables:
                # A run that failed in part is repeated as a whole, under its run id.
                Ledger(spark, args.ledger).finish(one)
            failed += tables
    finally:
        if started:
            spark.stop()
    if failed:
        log.error("failed: %s", ", ".join(failed))
    return 1 if failed else 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    sys.exit(main())
