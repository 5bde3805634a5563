"""Run a job with spark-submit.

    spark-submit --py-files seqprep.zip run_job.py process-sequences \
        --source-table db.occurrence --target-table db.sequences
    spark-submit --py-files seqprep.zip run_job.py lookup \
        --source-table db.occurrence --target-table db.target_gene \
        --concept-table db.concept --label-table db.label \
        --source-column v_targetgene --result-column targetgene

Catalog settings come from the command line (``--conf``). A failing job raises,
and spark-submit returns a failure status.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from seqprep import Vocabulary, lookup_job, process_sequences_job, read_vocabulary
from seqprep.plans.process_sequences import KEYS, SEQUENCE_COLUMN


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="run_job.py")
    jobs = root.add_subparsers(dest="job", required=True)
    clean = jobs.add_parser("process-sequences", help="clean the sequences of a table")
    look = jobs.add_parser("lookup", help="look terms up in a vocabulary")
    for job in (clean, look):
        job.add_argument("-s", "--source-table", required=True)
        job.add_argument("-t", "--target-table", required=True)
        job.add_argument("--format", default="parquet", help="table format, such as iceberg")
        job.add_argument("-k", "--key", action="append", help="key column, once for each")
    clean.add_argument("--sequence-column", default=SEQUENCE_COLUMN)
    clean.add_argument("-o", "--option", action="append", default=[], help="cleaning option, name=value")
    look.add_argument("--concept-table", help="id, name, parent_id")
    look.add_argument("--on-missing", choices=["error", "null"], default="error", help="without a concept table")
    look.add_argument("--exact", action="store_true", help="match terms as they are")
    look.add_argument("--label-table", help="concept_id, label")
    look.add_argument("-c", "--source-column", required=True)
    look.add_argument("-r", "--result-column", help="column for the concept name")
    look.add_argument("--result-concept-column", help="column for concept and lineage")
    return root


def vocabulary_of(spark: SparkSession, args: argparse.Namespace) -> Vocabulary | None:
    """The vocabulary; None, with ``--on-missing null``, if a table of it is not there."""
    try:
        return read_vocabulary(spark, args.concept_table, args.label_table) if args.concept_table else None
    except ValueError:
        if args.on_missing == "error":
            raise
        return None


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.job == "lookup" and args.result_column is None and args.result_concept_column is None:
        raise SystemExit("give --result-column, --result-concept-column or both")
    # beyond this size the JVM leaves a generated method uncompiled; Spark then splits it
    spark = (
        SparkSession.builder.appName(f"seqprep {args.job}")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    if args.job == "process-sequences":
        rows = process_sequences_job(
            spark,
            args.source_table,
            args.target_table,
            args.format,
            args.sequence_column,
            args.key or KEYS,
            dict(option.split("=", 1) for option in args.option),
        )
    else:
        vocabulary = vocabulary_of(spark, args)
        rows = lookup_job(
            spark,
            args.source_table,
            args.target_table,
            vocabulary,
            args.source_column,
            args.result_column,
            args.result_concept_column,
            args.format,
            args.key or KEYS,
            exact=args.exact,
            on_missing=args.on_missing,
        )
    print(f"{rows} rows written to {args.target_table}")
    return rows


if __name__ == "__main__":
    main()
