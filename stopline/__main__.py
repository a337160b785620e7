"""``spark-submit`` entry: land the feeds of a period and write its summary."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from stopline.period import Period
from stopline.plans.summary import land_archives, land_feeds, run_summary


def main() -> None:
    parser = argparse.ArgumentParser(prog="stopline", description=__doc__)
    parser.add_argument("feed_root", help="directory with a sub-directory of CSV tables, or a zip archive, per day")
    parser.add_argument("lake", help="where the tables are landed")
    parser.add_argument("output", help="where report and document are written")
    parser.add_argument("start", help="first day, YYYY-MM-DD")
    parser.add_argument("end", help="last day, YYYY-MM-DD")
    parser.add_argument("--archives", action="store_true", help="days are zip archives")
    options = parser.parse_args()
    period = Period.parse(options.start, options.end)
    spark = SparkSession.builder.appName("stopline").getOrCreate()
    try:
        (land_archives if options.archives else land_feeds)(spark, options.feed_root, options.lake, period)
        run_summary(spark, options.lake, period, options.output, datetime.now())
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
