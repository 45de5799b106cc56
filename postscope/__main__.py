"""Command line: answer one question over one input.

    python -m postscope q1 time /data/posts.json [--k 10] [--master local[*]] [--log events/]

Prints the answer as JSON arrays (dates as ISO text), one per line, and
optionally appends the run event to ``--log``. Without ``--master`` an
existing cluster session configuration is used as is.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="postscope", description=__doc__.splitlines()[0])
    ap.add_argument("question", choices=["q1", "q2", "q3"])
    ap.add_argument("strategy", choices=["time", "memory"])
    ap.add_argument("path")
    ap.add_argument("--k", type=int, default=10)
    ap.add_argument("--master", default=None)
    ap.add_argument("--log", default=None, help="folder to append the run event to (JSON)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from postscope.plans.registry import run_logged
    from postscope.sources.posts import result_to_json
    from postscope.session import get_session

    spark = get_session(args.master) if args.master else SparkSession.builder.getOrCreate()
    rows, event = run_logged(spark, args.question, args.strategy, args.path, args.k, log_path=args.log)
    if rows:
        df = spark.createDataFrame(rows)
        for r in result_to_json(df).collect():
            print(r.json)
    done = event.first()
    print(f"# {done.status} in {done.total_duration_ms} ms, metrics {done.metrics}", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
