"""Command line jobs: ``spark-submit`` this file, or ``python -m pricewright <job>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from pricewright import schemas
from pricewright.operators import category
from pricewright.operators.score import score
from pricewright.plans import jobs, presets
from pricewright.sources import sinks
from pricewright.sources.layout import read_layout, write_layout
from pricewright.sources.star import read_star, to_parquet
from pricewright.stage import Stage
from pricewright.streaming.scoring import (
    read_request_table,
    read_requests,
    score_into_sinks,
    score_stream,
)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pricewright")
    job = parser.add_subparsers(dest="job", required=True)

    def add(name: str, text: str, *options: str) -> None:
        sub = job.add_parser(name, help=text)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        if "data" in options:
            sub.add_argument("--format", choices=["csv", "parquet", "layout"], default="csv")
        if "requests" in options:
            sub.add_argument("--format", choices=["json", "parquet"], default="json")
            sub.add_argument("--keep", nargs="*", default=[], help="id columns to pass through")
        if name in ("train", "baseline", "compare"):
            sub.add_argument("--quick", action="store_true", help="small models, all rows")
        if name in ("train", "baseline"):
            sub.add_argument("--candidates", type=int, help="parameter sets to try")
            sub.add_argument("--folds", type=int, default=presets.FOLDS)
            sub.add_argument("--parallelism", type=int, default=2, help="fits at a time")
            sub.add_argument("--scores", help="folder of scores, from which a stopped search goes on")
        if name == "stream":
            limit = sub.add_mutually_exclusive_group()
            limit.add_argument("--max-files", type=int, help="files of a batch")
            limit.add_argument("--max-bytes", help="bytes of a batch, such as 1g")
            sub.add_argument("--once", action="store_true", help="stop when the folder is drained")
            sub.add_argument("--rejects", help="folder of its own for rejected requests")
        if name == "convert":
            sub.add_argument("--buckets", type=int, help="lay tables out by order, in so many files")

    add("train", "search, evaluate and save the current model", "data", "out")
    add("baseline", "search, evaluate and save the older model", "data", "out")
    add("compare", "fit and rank the four algorithms", "data", "out")
    add("ranking", "rank the results a compare run wrote", "results")
    add("categories", "category table, SQL seed and report", "data", "out")
    add("convert", "published CSV files to Parquet", "data", "out")
    add("score", "price a table of requests", "requests", "model", "out")
    add("stream", "price request files as they arrive", "requests", "model", "out", "checkpoint")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"pricewright {args.job}").getOrCreate()

    def star(*tables: str):
        names = tables or tuple(schemas.TABLES)
        if args.format == "layout":
            return read_layout(spark, args.data, names)
        return read_star(spark, args.data, names, args.format)

    if args.job == "train":
        source = star()
        space = presets.QUICK_SPACE if args.quick else presets.SEARCH_SPACE
        count = args.candidates or (2 if args.quick else presets.SEARCH_CANDIDATES)
        paths = f"{args.out}/model", f"{args.out}/result"
        with Stage(spark) as stage:
            trained = jobs.train(
                source, stage, space, count, *paths, args.folds, args.parallelism, args.scores
            )
            trained.record.select("algorithm", "r2", "mae", "mape", "vs_baseline").show(
                truncate=False
            )
        counts = list(trained.counts.items())
        spark.createDataFrame(counts, "table_name string, row_count long").show()
        trained.search.summary(spark).show(truncate=False)
    elif args.job == "baseline":
        space = dict(presets.BASELINE_SEARCH_SPACE)
        if args.quick:
            space.update(n_estimators=[4, 6], max_depth=[3, 4])
        count = args.candidates or (2 if args.quick else presets.BASELINE_SEARCH_CANDIDATES)
        source = star(*schemas.CORE_TABLES)
        paths = f"{args.out}/model", f"{args.out}/result"
        with Stage(spark) as stage:
            trained = jobs.train_baseline(
                source, stage, space, count, *paths, args.folds, args.parallelism, args.scores
            )
            trained.metrics.show()
    elif args.job == "compare":
        with Stage(spark) as stage:
            rows = jobs.prepare_baseline(star(*schemas.CORE_TABLES), stage, trim=False)
            rows = stage.table(rows, "training_rows")
            sizes = presets.QUICK if args.quick else {}
            jobs.compare(rows, tuple(presets.ALGORITHMS), sizes, args.out).show()
    elif args.job == "ranking":
        jobs.compare_results(spark, args.results, tuple(presets.ALGORITHMS)).show()
    elif args.job == "categories":
        with Stage(spark) as stage:
            stats = jobs.categories(
                star(*schemas.CATEGORY_TABLES),
                stage,
                f"{args.out}/category_stats_seed",
                f"{args.out}/category_stats",
            )
            category.top_categories(stats).show(truncate=False)
            category.bottom_categories(stats).show(truncate=False)
            category.category_ranges(stats).show()
    elif args.job == "convert" and args.buckets:
        write_layout(star(), args.out, args.buckets)
    elif args.job == "convert":
        to_parquet(spark, args.data, args.out)
    elif args.job == "score":
        requests = read_request_table(spark, args.requests, args.format, args.keep)
        score(requests, sinks.load_model(args.model), tuple(args.keep)).write.parquet(args.out)
    elif args.job == "stream":
        requests = read_requests(
            spark, args.requests, args.format, args.keep, args.max_files, args.max_bytes
        )
        model, keep = sinks.load_model(args.model), tuple(args.keep)
        trigger = None if args.once else {"processingTime": "10 seconds"}
        paths = [args.out, *([args.rejects] if args.rejects else []), args.checkpoint]
        start = score_into_sinks if args.rejects else score_stream
        start(requests, model, *paths, keep, trigger).awaitTermination()


if __name__ == "__main__":
    main()
