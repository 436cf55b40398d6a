"""Start one of the applications with spark-submit.

    spark-submit run_job.py session --actions A --users U --tasks T --task-id 2 --out O
    spark-submit run_job.py page    --actions A --tasks T --task-id 3 --out O
    spark-submit run_job.py product --actions A --cities C --products P --tasks T --task-id 4 --out O
    spark-submit run_job.py ads     --servers host:9092 --topics t1,t2 --out O --checkpoint K

Tables are Parquet folders. ``--tasks`` is the task table; ``--params`` gives its
JSON text directly instead. ``--cities`` may be a JSON object of JDBC options.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from footfall.operators.ads import BLACKLIST_THRESHOLD
from footfall.params import JobParams, load_params
from footfall.plans.page_job import run_page_job
from footfall.plans.product_job import run_product_job
from footfall.plans.session_job import run_session_job
from footfall.settings import apply_recommended
from footfall.sources.ad_log import file_lines, kafka_lines
from footfall.sources.tables import read_table
from footfall.streaming.ad_stream import AdTables, serve_ad_stream


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["session", "page", "product", "ads"])
    for name in ("actions", "users", "cities", "products", "tasks", "params", "out", "checkpoint"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--task-id", type=int, default=0)
    parser.add_argument("--sequence", default="", help="comma list of columns ordering equal times")
    parser.add_argument("--servers")
    parser.add_argument("--topics")
    parser.add_argument("--log-folder", help="text files instead of Kafka")
    parser.add_argument("--threshold", type=int, default=BLACKLIST_THRESHOLD)
    return parser.parse_args()


def task_params(spark: SparkSession, args: argparse.Namespace) -> JobParams:
    if args.params:
        return JobParams.from_json(args.params, args.task_id)
    return load_params(read_table(spark, args.tasks), args.task_id)


def dimension(spark: SparkSession, where: str):
    if where.lstrip().startswith("{"):
        return read_table(spark, source="jdbc", options=json.loads(where))
    return read_table(spark, where)


def main() -> None:
    args = arguments()
    spark = apply_recommended(SparkSession.builder.appName(f"footfall-{args.job}").getOrCreate())
    if args.job == "ads":
        lines = (
            file_lines(spark, args.log_folder)
            if args.log_folder
            else kafka_lines(spark, args.servers, args.topics)
        )
        serve_ad_stream(lines, AdTables(args.out), args.checkpoint, threshold=args.threshold)
        return
    params = task_params(spark, args)
    actions = read_table(spark, args.actions)
    if args.job == "session":
        run_session_job(actions, read_table(spark, args.users), params, args.out)
    elif args.job == "page":
        sequence = [c for c in args.sequence.split(",") if c]
        run_page_job(actions, params, args.out, sequence)
    else:
        cities, products = dimension(spark, args.cities), read_table(spark, args.products)
        run_product_job(actions, cities, products, params, args.out)


if __name__ == "__main__":
    main()
