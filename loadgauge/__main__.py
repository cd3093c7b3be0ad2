"""``spark-submit`` / ``python -m loadgauge <root> --train <log> --test <log> [--settings settings.json]``.

Runs all jobs in order.  Under spark-submit the session's own settings apply.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import Settings
from .plans import jobs


def main() -> None:
    args = argparse.ArgumentParser(prog="loadgauge", description=__doc__)
    args.add_argument("root", help="folder of the stage tables")
    args.add_argument("--train", required=True, help="text log to learn from")
    args.add_argument("--test", required=True, help="text log to forecast")
    args.add_argument("--settings", help="JSON file with the settings that differ from the defaults")
    given = args.parse_args()
    values = {}
    if given.settings:
        with open(given.settings, encoding="utf-8") as file:
            values = json.load(file)
    settings = Settings.from_dict(values)
    spark = SparkSession.builder.appName("loadgauge").getOrCreate()
    for part, path in ((jobs.TRAIN, given.train), (jobs.TEST, given.test)):
        print(part, jobs.parse(spark, path, given.root, part, settings), jobs.aggregate(spark, given.root, part, settings))
    jobs.report(spark, given.root)
    jobs.build_features(spark, given.root, settings)
    jobs.train(spark, given.root, settings)
    jobs.evaluate(spark, given.root, settings).show(100, False)
    jobs.simulate(spark, given.root, settings.intervals[-1], "prophet", settings).show(10, False)


if __name__ == "__main__":
    main()
