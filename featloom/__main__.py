"""Run a job with spark-submit or ``python -m featloom``.

    python -m featloom [upload|preprocess|cluster|write-results|all] [options]

Master, memory and the like are left to spark-submit. Without options for columns
and bounds the table is the default product table; every row is kept.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from featloom.plans.jobs import run_all, run_mode
from featloom.specs import (
    BandSpec,
    CleanSpec,
    ClusterSpec,
    CollectionSpec,
    PipelineSpec,
    TierSpec,
)


def _names(text: str) -> tuple[str, ...]:
    return tuple(filter(None, text.split(",")))


def _bound(text: str) -> tuple[str, float]:
    name, _, value = text.rpartition("=")
    return name, float(value)


def _band(text: str) -> BandSpec | None:
    return None if text == "none" else BandSpec(*map(float, text.split(":")))


def _tier(text: str) -> TierSpec | None:
    if text == "none":
        return None
    column, low, medium, output = text.split(":")
    return TierSpec(column, float(low), float(medium), output)


def _clean(args: argparse.Namespace) -> CleanSpec:
    own = CleanSpec()
    if args.columns:
        # Bounds and tier of the default table do not fit another one.
        own = CleanSpec(columns=args.columns, upper_bounds={}, tier=None)
    return CleanSpec(
        columns=own.columns,
        upper_bounds=dict(args.upper_bound) if args.upper_bound else own.upper_bounds,
        band=own.band if args.band is None else _band(args.band),
        tier=own.tier if args.tier is None else _tier(args.tier),
        row_limit=args.row_limit,
        order_by=args.order_by,
        passthrough=args.passthrough,
    )


def _spec(args: argparse.Namespace) -> PipelineSpec:
    return PipelineSpec(
        source_path=args.source_path,
        preprocessed_path=args.preprocessed_path,
        predictions_path=args.predictions_path,
        model_path=args.model_path,
        collections=CollectionSpec(root=args.root),
        separator=args.separator,
        clean=_clean(args),
        cluster=ClusterSpec(k=args.k, seed=args.seed, partitions=args.partitions),
    )


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="featloom")
    parser.add_argument("mode", nargs="?", default="preprocess")
    for name, text in {
        "--source-path": "delimited text with a header",
        "--root": "folder of the collections",
        "--preprocessed-path": "cleaned table",
        "--predictions-path": "labelled table",
        "--model-path": "scaler and clusters",
    }.items():
        parser.add_argument(name, required=True, help=f"{text}; on storage all executors see")
    parser.add_argument("--separator", default="\t")
    parser.add_argument("--columns", type=_names, help="features, separated by commas")
    parser.add_argument("--upper-bound", type=_bound, action="append", metavar="COLUMN=VALUE")
    parser.add_argument("--band", help="lower:upper:error as quantiles, or none")
    parser.add_argument("--tier", help="column:low_below:medium_upto:output, or none")
    parser.add_argument("--order-by", type=_names, default=(), help="key of a row limit")
    parser.add_argument("--passthrough", type=_names, default=(), help="columns to carry along")
    parser.add_argument("--row-limit", type=int, help="rows kept by preprocess, first by --order-by; default: all")
    parser.add_argument("--partitions", type=int, help="partitions to fit in; default: as stored")
    parser.add_argument("--k", type=int, default=ClusterSpec().k)
    parser.add_argument("--seed", type=int, default=ClusterSpec().seed)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(f"featloom-{args.mode}").getOrCreate()
    try:
        spec = _spec(args)
        if args.mode == "all":
            run_all(spark, spec)
        else:
            run_mode(spark, args.mode, spec)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
