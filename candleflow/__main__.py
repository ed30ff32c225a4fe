"""Command-line runner: ``python -m candleflow refresh --source DIR --out DIR``
(or the same file through ``spark-submit``).  Uses the session the launcher
provides (master, memory and spark.checkpoint.dir come from it)."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import schemas
from .plans.refresh import run_refresh, score_table
from .session import ensure_checkpoint_dir, release_scratch


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="candleflow")
    sub = parser.add_subparsers(dest="command", required=True)
    ref = sub.add_parser("refresh", help="landed klines -> bronze -> silver -> features -> models -> metrics")
    ref.add_argument("--source", required=True, help="folder of landed kline files")
    ref.add_argument("--out", required=True, help="root folder of the written tables and models")
    ref.add_argument("--families", default="lr", help="comma-separated: lr,gbt,rf")
    ref.add_argument("--null-policy", default=schemas.DEFAULT_NULL_POLICY, choices=sorted(schemas.NULL_POLICIES))
    ref.add_argument("--purge", type=int, default=0, help="training rows dropped in front of the cut")
    ref.add_argument("--run-id", default=None)
    one = sub.add_parser("score", help="score a feature table with a saved model and append the records")
    one.add_argument("--model", required=True, help="folder of the saved model")
    one.add_argument("--source", required=True, help="feature table (Parquet)")
    one.add_argument("--out", required=True, help="table that the prediction records are appended to")
    one.add_argument("--run-id", default=None, help="scoring again under the same id replaces its records")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("candleflow").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.command == "score":
        score_table(spark, args.model, args.source, args.out, args.run_id).show(truncate=False)
        release_scratch(spark)
        return 0
    families = [f for f in args.families.split(",") if f]
    metrics = run_refresh(
        spark, args.source, args.out, families, args.null_policy, args.purge, args.run_id
    )
    metrics.select("model", "metric", "value").show(truncate=False)
    release_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
