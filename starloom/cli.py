"""``python -m starloom``: load extracts, build the star, check it, publish it.

One callable for a scheduler.  Folder targets are checked before they are
published: with ``--fail-on-check`` a failing check publishes nothing, leaves
the previous star as it is, and the exit code is 2.  (Catalog tables are
overwritten in place and checked afterwards.)  The checks table is printed; it
is a few dozen rows.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession


def run(spark: SparkSession, extracts: str, target: str, source_format: str = "csv",
        target_format: str = "parquet", null_tokens=None, stable_keys: bool = False,
        fail_on_check: bool = False, incremental: bool = False, on_bad: str = "fail",
        file_names: dict | None = None, multi_line=None, infer_members: bool = False, jdbc: dict | None = None):
    from starloom.plans import checks
    from starloom.sinks import published_checks, write_star_tables
    from starloom.sources import load_sources
    from starloom.sources.readers import FREE_TEXT_SOURCES

    sources = load_sources(spark, extracts, fmt=source_format, null_tokens=null_tokens, on_bad=on_bad,
                           file_names=file_names, multi_line_sources=multi_line or FREE_TEXT_SOURCES)
    if target_format == "table":
        star = write_star_tables(spark, sources, target, fmt="table", stable_keys=stable_keys)
        result = checks.check_star(sources, star)
        if fail_on_check:
            checks.assert_star(result)
        return star, result
    star = write_star_tables(spark, sources, target, fmt=target_format, stable_keys=stable_keys,
                             incremental=incremental, checks="all", require=fail_on_check,
                             infer_members=infer_members, jdbc=jdbc)
    return star, published_checks(spark, target)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="starloom", description=__doc__.splitlines()[0])
    ap.add_argument("--extracts", required=True, help="folder with the source extracts")
    ap.add_argument("--target", required=True, help="folder (or catalog location) for the star")
    ap.add_argument("--source-format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--target-format", default="parquet", choices=["parquet", "csv", "table"])
    ap.add_argument("--null-token", action="append", default=[], help="text read as null, repeatable")
    ap.add_argument("--stable-keys", action="store_true", help="keep keys of the star at --target")
    ap.add_argument("--fail-on-check", action="store_true")
    ap.add_argument("--bad-records", default="fail", choices=["fail", "quarantine", "null"],
                    help="CSV records that do not fit the schema: fail, keep apart and count, or read as null")
    ap.add_argument("--file-name", action="append", default=[], metavar="SOURCE=FILE",
                    help="an extract's file name where it is not SOURCE.csv, repeatable")
    ap.add_argument("--multi-line", action="append", default=[], metavar="SOURCE",
                    help="extracts whose text holds line breaks (default: order_reviews), repeatable")
    ap.add_argument("--infer-members", action="store_true", help="members for keys that facts use and dimensions lack")
    ap.add_argument("--jdbc-url", help="also load the published tables into this database, in one step")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password-env", metavar="NAME", help="environment variable that holds the password")
    ap.add_argument("--incremental", action="store_true", help="write only the days that changed (parquet)")
    args = ap.parse_args(argv)

    from starloom.plans.checks import StarCheckFailed
    from starloom.session import get_session

    jdbc = None
    if args.jdbc_url:
        from starloom.sinks import jdbc_options
        password = os.environ[args.jdbc_password_env] if args.jdbc_password_env else None
        jdbc = jdbc_options(args.jdbc_url, args.jdbc_user, password, args.jdbc_driver)
    spark = get_session(app_name="starloom-build")
    try:
        _, result = run(spark, args.extracts, args.target, args.source_format, args.target_format,
                        args.null_token, args.stable_keys, args.fail_on_check, args.incremental,
                        args.bad_records, dict(f.split("=", 1) for f in args.file_name), args.multi_line,
                        args.infer_members, jdbc)
    except StarCheckFailed as e:
        print(f"check failed: {e}", file=sys.stderr)
        return 2
    result.show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
