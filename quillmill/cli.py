"""The command line: run, resume, report, gold, config validate."""

from __future__ import annotations

import argparse
import json
import sys

from quillmill.sources import config as C
from quillmill.sources import files


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("quillmill").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def _calibration(spark, path: str | None):
    if path is None:
        return None
    told = spark.read.schema("provider string, model string, task string, slope decimal(9,6), shift decimal(9,6), knots array<struct<at: decimal(9,6), value: decimal(9,6)>>").json(path)
    return told.drop("knots") if told.where("knots IS NOT NULL").isEmpty() else told.where("knots IS NOT NULL").drop("slope", "shift")


def _answers(spark, path: str):
    """(question, answer) of a folder of JSON lines of final questions; a question is known by the digest of its text."""
    from pyspark.sql import functions as F

    from quillmill.functions.text import slim_md5

    return spark.read.schema("text_question string, text_answer string").json(path).select(slim_md5(F.col("text_question")).alias("question"), F.col("text_answer").alias("answer"))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillmill")
    commands = parser.add_subparsers(dest="command", required=True)
    start = commands.add_parser("run", help="make questions of a folder of .docx files")
    start.add_argument("--input", required=True)
    again = commands.add_parser("resume", help="go on with a run from its first incomplete stage")
    again.add_argument("run_id")
    for p in (start, again):
        p.add_argument("--output", required=True)
        p.add_argument("--config")
        p.add_argument("--calibration", help="JSON lines of provider, model, task, and knots or slope and shift")
    shown = commands.add_parser("report", help="print the report of a run")
    shown.add_argument("run_id")
    shown.add_argument("--output", required=True)
    gold = commands.add_parser("gold", help="hold a run against gold questions and the run before it; ends with 3 if the change is refused")
    gold.add_argument("--before", required=True, help="questions.jsonl of the run before")
    gold.add_argument("--after", required=True, help="questions.jsonl of the changed run")
    gold.add_argument("--gold", required=True, help="questions.jsonl with the right answers")
    checked = commands.add_parser("config", help="check a configuration").add_subparsers(dest="action", required=True).add_parser("validate")
    checked.add_argument("--config")
    args = parser.parse_args(argv)
    try:
        if args.command == "report":
            print(files.read(f"{args.output}/{args.run_id}/run_report.json").decode(), end="")
            return 0
        if args.command == "gold":
            from quillmill.operators import report

            spark = _session()
            told = report.gold_regression(*[_answers(spark, path) for path in (args.before, args.after, args.gold)], "question").first().asDict()
            print(json.dumps(told))
            return 3 if told["refused"] else 0
        config = C.load(args.config)
        if args.command == "config":
            print("valid")
            return 0
        source = args.input if args.command == "run" else None
        if source is None:
            told = json.loads(files.read(f"{args.output}/workspace/{args.run_id}/run.json"))
            if told["config_digest"] != config.digest:
                raise C.ConfigError("the configuration is not that of the run")
            source = told["source"]
        from quillmill.plans import pipeline

        spark = _session()
        done = pipeline.run(spark, source, args.output, config, _calibration(spark, args.calibration))
        if args.command == "resume" and done.run_id != args.run_id:
            raise C.ConfigError("the inputs are not those of the run")
        print(json.dumps({"run_id": done.run_id, "output": done.output}))
        return 0
    except (C.ConfigError, FileNotFoundError) as error:
        print(error, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
