"""``python -m harrow.cli run|bootstrap [--root FOLDER] [--dataset NAME]``."""

from __future__ import annotations

import argparse

from harrow.settings import Settings, project_root


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="harrow", description="Harmonize workbooks of yearly facts.")
    parser.add_argument("command", nargs="?", default="run", choices=("run", "bootstrap"))
    parser.add_argument("--root", default=None, help="by default HARROW_ROOT or the project around the working folder")
    parser.add_argument("--dataset", default="dataset")
    args = parser.parse_args(argv)
    settings = Settings.from_environment(args.root or str(project_root()))
    if args.command == "bootstrap":
        for folder in settings.create_folders():
            print(folder)
        return 0
    from pyspark.sql import SparkSession

    from harrow.plans.pipeline import run_pipeline

    spark = SparkSession.builder.appName("harrow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    done = run_pipeline(spark, settings, args.dataset)
    for path in (*done.processed.values(), *done.lists.values(), *done.postprocessed.reports.values()):
        print(path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
