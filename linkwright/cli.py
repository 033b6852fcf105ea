"""python -m linkwright.cli run --mode {train,test,full} --data DIR --work DIR [--folders]
python -m linkwright.cli validate [-m FILE] [-c FILE] [-t DIR] [--check-ids]"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="linkwright", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("--mode", choices=("train", "test", "full"), default="full")
    run.add_argument("--data", required=True)
    run.add_argument("--work", required=True)
    run.add_argument("--folders", action="store_true", help="write result files as folders of part files, for large results")
    check = sub.add_parser("validate")
    check.add_argument("--matching", "-m", default="output/matching_results.tsv")
    check.add_argument("--candidate", "-c", default="output/candidate_pairs.tsv", help="left out if it doesn't exist")
    check.add_argument("--test-dir", "-t", default="dataset/test")
    check.add_argument("--check-ids", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("linkwright").getOrCreate()
    if args.command == "run":
        from .plans.linkage import run as link

        link(spark, args.mode, args.data, args.work, single=not args.folders)
        return 0
    from .operators.validate import validate

    report = validate(spark, args.matching, args.candidate, args.test_dir, args.check_ids)
    for kind in ("info", "warnings", "errors"):
        for line in getattr(report, kind):
            print(f"{kind.rstrip('s')}: {line}")
    print("PASS" if report.passed else "FAIL")
    return 0 if report.passed else 1


if __name__ == "__main__":
    sys.exit(main())
