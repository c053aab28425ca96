"""python -m depotkit etl RAW_DIR WORK_DIR [--jdbc URL] | features WORK_DIR | models WORK_DIR [--fast]"""

import argparse

from pyspark.sql import SparkSession

from depotkit.operators.quality import audit_summary
from depotkit.plans import pipeline


def main() -> None:
    parser = argparse.ArgumentParser(prog="depotkit")
    steps = parser.add_subparsers(dest="step", required=True)
    etl = steps.add_parser("etl", help="raw CSV files to clean tables and an audit log")
    etl.add_argument("raw_dir")
    etl.add_argument("work_dir")
    etl.add_argument("--jdbc", help="also load the clean tables into this database")
    for name, text in (("features", "clean tables to feature tables"), ("models", "feature tables to models")):
        steps.add_parser(name, help=text).add_argument("work_dir")
    steps.choices["models"].add_argument("--fast", action="store_true", help="presets instead of grid search")
    args = parser.parse_args()
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.step == "etl":
        _, audit = pipeline.run_etl(spark, args.raw_dir, args.work_dir, jdbc_url=args.jdbc)
        audit_summary(audit).show()
    elif args.step == "features":
        for name, profile in pipeline.run_features(spark, args.work_dir)[1].items():
            print(name)
            profile.show(truncate=False)
    else:
        pipeline.run_models(spark, args.work_dir, run_grid=not args.fast)[1].show(100, truncate=False)


if __name__ == "__main__":
    main()
