"""Run a landing job: ``spark-submit`` this package, or ``python -m siltbed``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from siltbed.sources import FileLog, KafkaLog
from siltbed.streaming import LandingJob


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="siltbed", description="Land a message log into a partitioned table.")
    source = parser.add_argument_group("source (one of)")
    source.add_argument("--brokers", help="bootstrap servers of the topic")
    source.add_argument("--log-path", help="folder of Parquet log files")
    parser.add_argument("--topic")
    parser.add_argument("--group")
    parser.add_argument("--mapper", help="registered mapper name, such as csv_hour, or module:name")
    parser.add_argument("--output", help="output root")
    parser.add_argument("--parameters", default="", help="JSON object of mapper arguments, or free text")
    parser.add_argument("--app-name", default="log_landing")
    parser.add_argument("--start-offset", type=int)
    parser.add_argument("--auto-offset-reset", default="earliest", choices=["earliest", "latest", "none"])
    parser.add_argument("--partitions", type=int, help="partition count of the topic")
    parser.add_argument("--min-partitions", type=int, help="read tasks to split the topic into")
    parser.add_argument("--checkpoint")
    parser.add_argument("--rebalance", action="store_true", help="gather files per directory before writing")
    parser.add_argument("--compact", action="store_true", help="then gather the landed rows by day")
    parser.add_argument("--continuous", action="store_true", help="keep running instead of stopping at the log's end")
    return parser


def job_from_args(argv: list[str] | None = None) -> tuple[LandingJob, argparse.Namespace]:
    args = build_parser().parse_args(argv)
    source = None
    if args.brokers and args.topic:
        source = KafkaLog(
            args.brokers,
            args.topic,
            n_partitions=args.partitions,
            min_partitions=args.min_partitions,
        )
    elif args.log_path:
        source = FileLog(args.log_path, args.topic)
    job = LandingJob(
        source=source,
        topic=args.topic,
        group=args.group,
        mapper=args.mapper,
        output=args.output,
        parameters=args.parameters,
        app_name=args.app_name,
        start_offset=args.start_offset,
        auto_offset_reset=args.auto_offset_reset,
        checkpoint=args.checkpoint,
        rebalance=args.rebalance,
        n_partitions=args.partitions,
    )
    return job, args


def main(argv: list[str] | None = None) -> None:
    job, args = job_from_args(argv)
    spark = SparkSession.builder.appName(job.app_name).getOrCreate()
    # The job's rollover limits bound a batch by the cluster and its measured rate; the next one follows at once.
    job.start(spark, processing_time="0 seconds" if args.continuous else None).awaitTermination()
    if args.compact:
        job.compact(spark)


if __name__ == "__main__":
    main()
