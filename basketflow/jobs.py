"""Command line for spark-submit: ``stage``, ``preprocess`` and ``train``."""

import argparse

from pyspark.sql import SparkSession

from basketflow.plans import stages
from basketflow.session import RUNTIME_SETTINGS


def main(argv: list[str] | None = None) -> None:
    defaults = stages.Settings()
    parser = argparse.ArgumentParser(prog="basketflow")
    parser.add_argument("stage", choices=["stage", "preprocess", "train"])
    parser.add_argument("input", help="folder to read")
    parser.add_argument("output", help="folder to write")
    parser.add_argument("--sample-rate", type=float, default=defaults.sample_rate)
    parser.add_argument("--num-prods", type=int, default=defaults.num_prods)
    parser.add_argument("--max-items", type=int, default=defaults.max_items)
    parser.add_argument("--max-seq", type=int, default=defaults.max_seq)
    parser.add_argument("--embedding-size", type=int, default=defaults.embedding_size)
    parser.add_argument("--scratch", help="folder shared by all executors, if the cluster names none")
    parser.add_argument("--no-class-weights", action="store_true")
    args = parser.parse_args(argv)
    settings = stages.Settings(
        sample_rate=args.sample_rate,
        num_prods=args.num_prods,
        max_items=args.max_items,
        max_seq=args.max_seq,
        embedding_size=args.embedding_size,
        use_class_weights=not args.no_class_weights,
    )
    builder = SparkSession.builder.appName(f"basketflow {args.stage}")
    if args.scratch:
        builder = builder.config("spark.checkpoint.dir", args.scratch)
    spark = builder.getOrCreate()
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if args.stage == "stage":
        stages.stage(spark, args.input, args.output)
    elif args.stage == "preprocess":
        stages.preprocess(spark, args.input, args.output, settings)
    else:
        stages.train(spark, args.input, args.output, settings)


if __name__ == "__main__":
    main()
