"""Command line, started with ``python -m stratalake`` or through ``spark-submit``."""

from __future__ import annotations

import argparse
import logging
from dataclasses import replace

from stratalake.config import Layer, PipelineConfig, standard_layers
from stratalake.operators import step_report
from stratalake.plans import run_all, run_bronze, run_gold, run_silver
from stratalake.session import build_session, fit_shuffles
from stratalake.sinks import export_jdbc
from stratalake.sources import read_layer, size_in_bytes
from stratalake.streaming import ingest_new_files, quarantine_new_rows, refresh_from_new_rows


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stratalake", description="Run one layer, all of them, or only what is new.")
    parser.add_argument("step", choices=["bronze", "silver", "gold", "all", "incremental", "export"])
    parser.add_argument("--root", required=True, help="folder below which the layers are stored")
    parser.add_argument("--dropzone", help="folder or glob of raw files")
    parser.add_argument("--table", default="trips")
    parser.add_argument("--databases", nargs=3, default=["bronze", "silver", "gold"])
    parser.add_argument("--quarantine", help="folder for rows without valid dates")
    parser.add_argument("--infer-schema", action="store_true")
    parser.add_argument("--on-empty", choices=["warn", "fail"], default="warn")
    parser.add_argument("--on-conflict", choices=["latest", "fail"], default="latest")
    parser.add_argument("--max-files", type=int, help="files per batch of an incremental run")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-table")
    parser.add_argument("--jdbc-driver")
    args = parser.parse_args(argv)
    if args.step in ("bronze", "all", "incremental") and not args.dropzone:
        parser.error(f"{args.step} needs --dropzone")
    if args.step == "export" and not (args.jdbc_url and args.jdbc_table):
        parser.error("export needs --jdbc-url and --jdbc-table")
    return args


def config_from(args: argparse.Namespace) -> PipelineConfig:
    bronze, silver, gold = standard_layers(args.root, tuple(args.databases), args.table)
    config = PipelineConfig(
        dropzone=args.dropzone or "",
        bronze=bronze,
        silver=silver,
        gold=gold,
        infer_schema=args.infer_schema,
        on_empty=args.on_empty,
        on_conflict=args.on_conflict,
    )
    return replace(config, quarantine=Layer(args.quarantine)) if args.quarantine else config


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    args = parse(argv)
    config = config_from(args)
    spark = build_session(f"stratalake-{args.step}")
    inputs = {"silver": config.bronze.path, "gold": config.silver.path, "export": config.gold.path}
    fit_shuffles(spark, size_in_bytes(spark, inputs.get(args.step, config.dropzone)))
    steps = []
    if args.step == "all":
        steps = run_all(spark, config)
    elif args.step == "bronze":
        steps = [run_bronze(spark, config)]
    elif args.step == "silver":
        steps, _ = run_silver(spark, config)
    elif args.step == "gold":
        steps = [run_gold(spark, config)]
    elif args.step == "incremental":
        progress = f"{args.root.rstrip('/')}/progress"
        steps = ingest_new_files(spark, config, f"{progress}/ingest", args.max_files)
        steps += refresh_from_new_rows(spark, config, f"{progress}/refresh", args.max_files)
        if config.quarantine:
            steps += quarantine_new_rows(spark, config, f"{progress}/quarantine", args.max_files)
    else:
        gold = read_layer(spark, config.gold.path, config.gold.partition_columns)
        export_jdbc(gold, args.jdbc_url, args.jdbc_table, driver=args.jdbc_driver)
    if steps:
        step_report(spark, steps).show(truncate=False)


if __name__ == "__main__":
    main()
