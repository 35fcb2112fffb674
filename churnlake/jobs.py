"""Run a layer: ``python -m churnlake.jobs silver ROOT``, then gold, train and score."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from churnlake.layout import Layout
from churnlake.plans.forest import run_score, run_train
from churnlake.plans.gold import VALID_FROM, run_gold
from churnlake.plans.model import confusion_matrix
from churnlake.plans.silver import run_silver
from churnlake.scratch import staging


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("layer", choices=("silver", "gold", "train", "score"))
    parser.add_argument("root", help="lake folder on shared storage")
    parser.add_argument("--as-of", help="latest allowed date, default today")
    parser.add_argument("--json-lines", action="store_true", help="usage is JSON Lines")
    parser.add_argument("--valid-from", default=VALID_FROM)
    parser.add_argument("--replace", action="store_true", help="replace existing gold tables")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"churnlake-{options.layer}").getOrCreate()
    layout = Layout(options.root.rstrip("/"))
    with staging(spark, options.layer):
        if options.layer == "train":
            run_train(spark, layout)
            return 0
        if options.layer == "score":
            confusion_matrix(run_score(spark, layout)).show()
            return 0
        if options.layer == "gold":
            run_gold(spark, layout, options.valid_from, options.replace)
            return 0
        as_of = F.to_date(F.lit(options.as_of)) if options.as_of else None
        status = run_silver(spark, layout, as_of, multi_line=not options.json_lines)
    for name, outcome in status.items():
        print(f"{name}: {outcome}")
    return 0 if all(outcome == "SUCCESS" for outcome in status.values()) else 1


if __name__ == "__main__":
    sys.exit(main())
