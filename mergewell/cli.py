"""Command line: python -m mergewell.cli VERB ... ; every verb has --dry-run, which checks and plans but writes nothing."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mergewell.operators import candidates, gold, ingest, provenance, records
from mergewell.sources import config, paged


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("mergewell").getOrCreate()
    for source in (paged.PagedJson, paged.TokenPaged):
        spark.dataSource.register(source)
    return spark


def validate(args) -> int:
    _, sources = config.read_config(args.config)
    print(f"{len(sources)} sources, all valid")
    return 0


def list_enabled(args) -> int:
    _, sources = config.read_config(args.config)
    for s in sources:
        if s["enabled"]:
            print(s["id"], s.get("type", "-"), s["parser_asignado"])
    return 0


def run_ingest(args) -> int:
    spark = _session()
    catalogue = spark.read.parquet(args.catalogue) if args.catalogue else None
    _, sources = config.load_sources(args.config, catalogue)
    good, bad, failures = ingest.ingest(spark, sources, args.secret or None)
    staged = provenance.append(good, f"{args.out}/staging", args.dry_run)
    held = provenance.append(bad, f"{args.out}/quarantine", args.dry_run)
    for failure in failures:
        print("failed", failure, file=sys.stderr)
    total = (staged or 0) + (held or 0) + len(failures)
    print(provenance.run_notice(total, len(failures), held or 0))
    return 1 if failures else 0


def materialize(args) -> int:
    spark = _session()
    staged = spark.read.parquet(args.staging)
    persons, centers, errors = records.project_types(staged, args.event)
    written = [provenance.append(rows, f"{args.out}/{name}", args.dry_run) for name, rows in (("persons", persons), ("acopio_centers", centers), ("errors", errors))]
    print("persons, centers, errors:", *written)
    return 0


def consolidate(args) -> int:
    spark = _session()
    people = spark.read.parquet(args.persons)
    edges = candidates.find_candidates(people).withColumn("decision", F.lit("pending"))
    entities, members, history = gold.gold_tables(people, gold.clusters(edges))
    written = [provenance.append(rows, f"{args.out}/{name}", args.dry_run) for name, rows in (("dedup_candidates", edges), ("gold_entities", entities), ("gold_members", members), ("gold_history", history))]
    print("candidates, entities, members, history:", *written)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="mergewell")
    verbs = top.add_subparsers(dest="verb", required=True)

    def verb(name: str, run, *options: str, secret: bool = False):
        made = verbs.add_parser(name)
        for option in options:
            made.add_argument(f"--{option}", required=option != "catalogue")
        if secret:
            made.add_argument("--secret", default="")
        made.add_argument("--dry-run", action="store_true")
        made.set_defaults(run=run)

    verb("validate", validate, "config")
    verb("list-enabled", list_enabled, "config")
    for name in ("ingest", "run"):
        verb(name, run_ingest, "config", "catalogue", "out", secret=True)
    verb("materialize", materialize, "staging", "event", "out")
    verb("consolidate", consolidate, "persons", "out")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return args.run(args)
    except (ValueError, FileNotFoundError) as error:
        print(f"FAILED {error}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
