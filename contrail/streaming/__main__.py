"""Print the lines of files arriving in a directory, one micro-batch every
two seconds (``--parse``: as typed clean-flight rows).

    python -m contrail.streaming /landing/dir [--interval "2 seconds"] [--parse] [--timeout 60]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from contrail.operators.parse import parse_lines
from contrail.schemas import CLEAN_FLIGHTS
from contrail.session import scratch_path
from contrail.streaming.files import BATCH_INTERVAL, print_batches, text_stream


def main(argv: list[str] | None = None):
    ap = argparse.ArgumentParser(prog="contrail.streaming")
    ap.add_argument("directory")
    ap.add_argument("--interval", default=BATCH_INTERVAL)
    ap.add_argument("--parse", action="store_true", help="parse pipe-delimited clean flight lines")
    ap.add_argument("--checkpoint", help="keep the progress here: a restart goes on after the files already printed")
    ap.add_argument("--new-files-only", action="store_true", help="leave out files older than the start")
    ap.add_argument("--timeout", type=float, help="stop after this many seconds")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("contrail-stream").getOrCreate()
    since = spark.sql("select date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss\")").first()[0] if args.new_files_only else None
    stream = text_stream(spark, args.directory, modified_after=since)
    if args.parse:
        stream = parse_lines(stream, CLEAN_FLIGHTS, strict=False)
    q = print_batches(stream, args.checkpoint or scratch_path(spark, "tail"), args.interval)
    try:
        q.awaitTermination(args.timeout) if args.timeout else q.awaitTermination()
    finally:
        q.stop()
    return q


if __name__ == "__main__":
    main()
