"""Command line: ``python -m cohortix segment|predict|score|cases|report`` (or via spark-submit)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cohortix.plans import prediction, report, scoring, segmentation
from cohortix.plans.settings import Settings
from cohortix.session import build_session
from cohortix.sources.sinks import write_table
from cohortix.sources.tables import READERS, load_canonical, load_checked, read_table


def _pairs(text: str) -> tuple[str, str]:
    name, _, source = text.partition("=")
    return name, source


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cohortix")
    top.add_argument("--master", default=None, help="left to spark-submit if not given")
    steps = top.add_subparsers(dest="step", required=True)
    segment = steps.add_parser("segment", help="clean, cluster and name the segments")
    segment.add_argument("--input", required=True)
    segment.add_argument("--format", choices=READERS, default="parquet")
    segment.add_argument("--column", action="append", type=_pairs, default=[], metavar="NAME=SOURCE",
                         help="canonical column name and its name in the input")
    segment.add_argument("--quarantine", action="store_true",
                         help="check CSV lines against the types and set those that do not fit aside, in OUT/quarantine")
    segment.add_argument("--quantiles", choices=("exact", "approx"), default="exact")
    steps.add_parser("predict", help="churn, surrogate, campaign, exports, artefacts")
    score = steps.add_parser("score", help="score a table of unseen rows")
    score.add_argument("--input", required=True)
    score.add_argument("--format", choices=READERS, default="parquet")
    score.add_argument("--output", required=True)
    steps.add_parser("cases", help="score the boundary cases")
    steps.add_parser("report", help="assemble the report payload")
    for name in ("segment", "predict", "score", "cases", "report"):
        steps.choices[name].add_argument("--out", required=True, help="folder of the run")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.step == "segment":
        names = dict(args.column)
        names = {c: names.get(c, c) for c in segmentation.S.CANONICAL}
        if args.quarantine:
            found = load_checked(spark, args.input, names)
            write_table(found.quarantined, f"{args.out}/quarantine")
            raw = found.rows
        else:
            raw = load_canonical(spark, args.input, args.format, names)
        segmentation.segment_customers(raw, args.out, Settings(quantiles=args.quantiles))
    elif args.step == "predict":
        prediction.predict_and_plan(spark, args.out)
    elif args.step == "score":
        rows = read_table(spark, args.input, args.format)
        scored = scoring.score_table(spark, f"{args.out}/artefacts", rows)
        scored.write.mode("overwrite").parquet(args.output)
    elif args.step == "cases":
        scoring.score_cases(spark, args.out)
    else:
        report.build_report(spark, args.out)


def main() -> None:
    args = parser().parse_args()
    run(build_session(args.master), args)


if __name__ == "__main__":
    main()
