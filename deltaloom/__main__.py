"""python -m deltaloom run pipeline.yaml [--conf k=v]... [--global FILE] [--check] [--checkpoint FOLDER [--until-done]]

A definition in streaming mode whose source has a log runs on, from its checkpoint. Exit codes: 0 done, 1 failed, 2 a definition
that is wrong."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

import yaml


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="deltaloom", description="Runs change-data pipelines on Spark.")
    parser.add_argument("command", choices=["run"])
    parser.add_argument("definition", type=Path)
    parser.add_argument("--conf", action="append", default=[], help="a Spark setting, k=v")
    parser.add_argument("--global", dest="common", type=Path, help="a YAML file of pipeline settings, under the definition's own")
    parser.add_argument("--check", action="store_true", help="parse and check only")
    parser.add_argument("--checkpoint", help="where a stream keeps what it has done")
    parser.add_argument("--until-done", action="store_true", help="end a stream when it has read all there is")
    args = parser.parse_args(argv)
    from deltaloom.plans.definition import DefinitionError, parse

    try:
        definition = parse(args.definition.read_text(), yaml.safe_load(args.common.read_text()) if args.common else None)
    except (OSError, DefinitionError) as wrong:
        print(f"{args.definition}: {wrong}", file=sys.stderr)
        return 2
    if args.check:
        return 0
    from pyspark.sql import SparkSession

    from deltaloom.plans.planner import run

    builder = SparkSession.builder.appName(str(definition.config["name"])).config("spark.sql.timeType.enabled", "true")
    for pair in args.conf:
        builder = builder.config(*pair.split("=", 1))
    spark = builder.getOrCreate()
    try:
        if not (definition.streaming and any(s.options.get("log.path") for s in definition.sources)):
            run(spark, definition)
            return 0
        if not args.checkpoint:
            print(f"{args.definition}: a stream needs --checkpoint", file=sys.stderr)
            return 2
        from deltaloom.streaming.launch import launch

        running, _ = launch(spark, definition, args.checkpoint)
        if args.until_done:
            running.processAllAvailable()
            running.stop()
        else:
            running.awaitTermination()
    except Exception as wrong:  # noqa: BLE001  whatever a run fails with
        print(f"{args.definition}: {str(wrong)[:500]}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
