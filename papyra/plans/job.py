"""Batch job: ``spark-submit --py-files papyra.zip papyra/plans/job.py ENV INPUT FORMAT OUTPUT``.

After the four arguments may follow ``--input PATH`` for further inputs, ``--option NAME=VALUE``
for the reader (``multiLine=true`` and ``escape="`` for quoted line breaks), ``--schema DDL``,
``--id COLUMN`` for a column of unique ids, and ``--sample FRACTION``. All files go through one
job, so duplicates are found across files and the files do not overwrite each other's output.
"""

from __future__ import annotations

import argparse
import dataclasses
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from papyra.operators.clean import add_doc_id
from papyra.operators.select import sample_rows
from papyra.plans.prepare import prepare_papers
from papyra.sources.files import read_files, write_by_id
from papyra.sources.session import get_session


@dataclasses.dataclass(frozen=True)
class JobArguments:
    env: str
    input_path: str
    input_format: str
    output_path: str
    more_inputs: tuple[str, ...] = ()
    options: tuple[tuple[str, str], ...] = ()
    schema: str | None = None
    id_column: str | None = None
    sample_fraction: float | None = None

    @classmethod
    def parse(cls, argv: Sequence[str]) -> JobArguments:
        """From the program name, four arguments in order, and options."""
        if len(argv) < 5 or any(a.startswith("--") for a in argv[1:5]):
            raise ValueError("expected four arguments: ENV INPUT FORMAT OUTPUT")
        parser = argparse.ArgumentParser(prog=argv[0], exit_on_error=False)
        parser.add_argument("--input", action="append", default=[])
        parser.add_argument("--option", action="append", default=[], type=lambda o: tuple(o.split("=", 1)))
        parser.add_argument("--schema")
        parser.add_argument("--id")
        parser.add_argument("--sample", type=float)
        found, rest = parser.parse_known_args(argv[5:])
        if rest or any(len(o) != 2 for o in found.option):
            raise ValueError(f"not understood: {' '.join(rest) or found.option}")
        return cls(
            *argv[1:5], tuple(found.input), tuple(found.option), found.schema, found.id, found.sample
        )


def prepare_files(
    spark: SparkSession, args: JobArguments, seed: int = 0, **patterns
) -> DataFrame:
    """The prepared papers of the job's input; ``patterns`` are those of ``prepare_papers``."""
    paths = [args.input_path, *args.more_inputs]
    papers = read_files(spark, paths, args.input_format, args.schema, **dict(args.options))
    if args.id_column is not None:
        papers = add_doc_id(papers, key=args.id_column)
    if args.sample_fraction is not None:
        papers = sample_rows(papers, args.sample_fraction, seed)
    return prepare_papers(papers, **patterns)


def run(args: JobArguments, seed: int = 0) -> None:
    spark = get_session(args.env, "paper preparation")
    # By id, so that hits of a search are read from few files.
    write_by_id(prepare_files(spark, args, seed), args.output_path)


if __name__ == "__main__":
    run(JobArguments.parse(sys.argv))
