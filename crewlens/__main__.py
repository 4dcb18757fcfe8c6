"""The whole report from the command line: ``python -m crewlens ROOT OUT``, or with spark-submit."""

import argparse
from collections.abc import Sequence

from crewlens import vocabulary as V
from crewlens.functions.parsing import DATE_FORMATS
from crewlens.plans import report
from crewlens.session import discard_copies, session


def main(arguments: Sequence[str] | None = None) -> None:
    """Parse the command line and run the report."""
    parser = argparse.ArgumentParser(prog="crewlens", description=__doc__)
    parser.add_argument("root", help="folder of the sheets")
    parser.add_argument("out", help="folder of the results")
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv", help="format of the sheets")
    parser.add_argument("--scan-bytes", type=int, default=0, help="size of the input, to size splits and shuffles")
    parser.add_argument("--cores", type=int, default=0, help="executor cores, for the same")
    parser.add_argument("--sep", default=",", help="separator of CSV cells")
    parser.add_argument("--encoding", default="UTF-8", help="encoding of CSV sheets")
    parser.add_argument("--multi-line", nargs="*", default=(), help="CSV sheets with line breaks inside cells")
    parser.add_argument("--date-format", action="append", help="layout of dates that are not ISO; may be repeated")
    parser.add_argument("--column-dates", action="store_true", help="choose day or month first by all values of a date column")
    parser.add_argument("--buckets", type=int, default=0, help="deal the employee sheets to so many buckets first")
    parser.add_argument("--versions", type=int, default=0, help="publish as a new version and keep so many; 0 writes in place")
    parser.add_argument("--year", type=int, default=V.REPORT_YEAR, help="year of the report")
    parser.add_argument("--department", help="column of the department")
    parser.add_argument("--entry-date", help="column with the date of joining")
    parser.add_argument("--reference-date", default=V.REFERENCE_DATE, help="date up to which tenure counts")
    given = parser.parse_args(arguments)
    spark = session(scan_bytes=given.scan_bytes, cores=given.cores)
    options = report.Options(
        given.sep, given.encoding, tuple(given.multi_line), tuple(given.date_format or DATE_FORMATS), given.year,
        given.department, given.entry_date, given.reference_date, given.column_dates, given.buckets, given.versions,
    )
    report.run(spark, given.root, given.out, given.format, options)
    discard_copies(spark)


if __name__ == "__main__":
    main()
