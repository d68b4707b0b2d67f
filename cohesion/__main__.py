"""Run a study: ``spark-submit -m cohesion`` / ``python -m cohesion``.

    python -m cohesion --study studies/MY_STUDY/config --input export.csv --output mapped/
    python -m cohesion --study studies/MY_STUDY/config --input-dir sources/ --output mapped/

One shared export (``--input``) or per-entity files (``--input-dir``: each
entity's ``source_files`` or ``<entity>.csv|.tsv|.txt``). Writes one output
per entity, ``validation_report``, ``study_metrics`` and ``mapping_summary.txt``; prints one line per entity. Exit code
1 when an entity failed.
"""

from __future__ import annotations

import argparse
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cohesion")
    ap.add_argument("--study", required=True, help="directory of entity specs (*.yaml)")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="one export file shared by all entities")
    src.add_argument("--input-dir", help="directory of per-entity source files")
    ap.add_argument("--output", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--share", default="none", choices=["none", "persist", "one_scan"])
    ap.add_argument("--sep", help="delimiter of --input (default: by file name, or found in the header line)")
    ap.add_argument("--multi-line", action=argparse.BooleanOptionalAction, default=None,
                    help="quoted fields of --input hold line ends (default: found in the file)")
    ap.add_argument("--bad-rows", choices=["error", "skip", "keep"], default=None,
                    help="rows with more fields than the header: an error (the default), skipped, or kept without the surplus")
    a = ap.parse_args(argv)

    from .plans.engine import map_study, release
    from .session import get_session
    from .sources.readers import read_file
    from .sources.sinks import write_metrics, write_reports, write_study
    from .spec import load_study

    spark = get_session()
    specs = load_study(a.study)
    source = read_file(spark, a.input, sep=a.sep, multi_line=a.multi_line, bad_rows=a.bad_rows) if a.input else None
    results = map_study(source, specs, source_dir=a.input_dir, share=a.share, bad_rows=a.bad_rows)
    paths = write_study(results, a.output, a.format)
    if results:
        write_reports(results, a.output, a.format, paths)
        write_metrics(results, paths, a.output, a.format, a.study)
    release(results)
    failed = False
    for k, r in results.items():
        n = r.written.get("rows")
        print(f"{k}\t{'FAILED: ' + r.error if r.error else f'{n} rows -> {paths.get(k)}'}")
        failed |= r.error is not None
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
